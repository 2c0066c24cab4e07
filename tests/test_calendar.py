import datetime as dt

from castline.operators import dims as dm


def test_calendar_has_4018_days_with_reference_attributes(spark):
    cal = dm.dim_date(dm.gen_dim_date(spark))
    got = {r.full_date: r for r in cal.collect()}
    assert len(got) == 4018
    assert min(got) == dt.date(2020, 1, 1) and max(got) == dt.date(2030, 12, 31)
    for d, r in got.items():
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert r.year == d.year and r.month == d.month and r.quarter == (d.month - 1) // 3 + 1
        assert r.month_name == d.strftime("%B") and r.day_name == d.strftime("%A")
        assert r.week_of_year == d.isocalendar()[1]
        assert r.day_of_week == d.isoweekday() and r.day_of_month == d.day
        assert r.is_weekend == (d.weekday() >= 5)
        assert r.fiscal_year == (d.year + 1 if d.month >= 7 else d.year)
        assert r.fiscal_quarter == ((d.month - 7) % 12) // 3 + 1
        assert r.year_month == f"{d.year}-{d.month:02d}"
        assert r.year_quarter == f"{d.year}-Q{(d.month - 1) // 3 + 1}"
        assert r.fiscal_year_quarter == f"{r.fiscal_year}-FQ{r.fiscal_quarter}"


def test_platform_dimension_keys(spark):
    import hashlib
    got = {r.platform_id: r.platform_key for r in dm.dim_platform(dm.platform_seed(spark)).collect()}
    assert len(got) == 7
    assert got["youtube"] == hashlib.md5(b"youtube").hexdigest()
