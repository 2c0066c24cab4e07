"""Data-quality operators (Q-*, A16) and the audit runner (Q-RUN).

Every check returns its *failing rows* as a DataFrame (empty = pass), so a
check is itself a distributed query.  The runner evaluates all row-level
checks of a table in **one aggregated pass** (``sum(when(fail, 1))`` per
check), uniqueness with one ``groupBy`` per key, and key lookups with
``left_anti`` joins; only the per-check failure counts (one row per check) are
brought to the driver to decide whether a blocking check failed.  In a build the
job that writes a candidate counts its row checks as it writes (:class:`Audit`), and
only the others read it before it is published.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

col = F.col


class AuditFailure(RuntimeError):
    pass


# ------------------------------------------------------------------ checks
def assert_not_null(df: DataFrame, column: str) -> DataFrame:
    """Q-NN: rows where ``column`` is NULL."""
    return df.where(col(column).isNull())


def assert_positive_values(df: DataFrame, column: str) -> DataFrame:
    """Q-POS: rows with a negative value (zero and NULL pass)."""
    return df.where(col(column) < 0)


def duplicate_groups(df: DataFrame, *columns: str, include_nulls: bool = True) -> DataFrame:
    """A16 / Q-UNQ: key values occurring more than once, with their count.

    ``include_nulls=True`` is the audit form (NULL keys form a group);
    ``False`` is the column-test form, which ignores NULL keys."""
    src = df
    if not include_nulls:
        cond = None
        for c in columns:
            cond = col(c).isNotNull() if cond is None else cond & col(c).isNotNull()
        src = df.where(cond)
    return (src.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).where(col("cnt") > 1))


#: Slots of the sieve's bitmap: 4 MB, whatever the size of the table.
SIEVE_SLOTS = 1 << 25


def duplicate_groups_sieved(df: DataFrame, *columns: str) -> DataFrame:
    """:func:`duplicate_groups` by two passes of which only the second one moves keys.

    First pass: a 64-bit hash of each key is counted (partial aggregates of hashes), and the slots of those seen twice become
    bitmaps of 32,768 bits that merge by OR; all of them are at most ``SIEVE_SLOTS`` bits, which bounds the
    broadcast.  Second pass: rows whose slot is set, and only those, are grouped by their whole key.  Two different
    keys with one hash or slot only make the second pass look at more rows.
    """
    slot = F.pmod(F.xxhash64(*columns), F.lit(SIEVE_SLOTS)) + 1       # Spark's bitmap buckets count from 1
    twice = (df.select(F.xxhash64(*columns).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select((F.pmod("h", F.lit(SIEVE_SLOTS)) + 1).alias("slot")))
    marks = twice.groupBy(F.expr("bitmap_bucket_number(slot)").alias("_bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("_bits"))
    rows = df.select(*columns, slot.alias("_slot")).withColumns(
        {"_bucket": F.expr("bitmap_bucket_number(_slot)"), "_at": F.expr("bitmap_bit_position(_slot)")})
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    suspect = rows.join(F.broadcast(marks), "_bucket").where(F.call_function("getbit", byte, (F.col("_at") % 8).cast("int")) == 1)
    return suspect.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).where(col("cnt") > 1)


def may_repeat(df: DataFrame, *columns: str) -> bool:
    """False if no key without a NULL occurs twice; True if one may: two rows have one 64-bit hash of the key.

    Only hashes are shuffled, so an audit moves whole keys just where this finds something.
    """
    rows = df.dropna(subset=list(columns)).select(F.xxhash64(*columns).alias("h"))
    return not rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def assert_valid_date_key(df: DataFrame, column: str, dim_date: DataFrame) -> DataFrame:
    """Q-REF / JN12: non-NULL keys missing from the (bounded, broadcast) calendar."""
    d = F.broadcast(dim_date.select(col("date_key").alias("_dk")))
    return (df.where(col(column).isNotNull())
            .join(d, col(column) == col("_dk"), "left_anti").select(column))


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Q-VAL: values outside the list; NULL passes (``NOT IN`` is unknown)."""
    return df.where(~col(column).isin(list(values)))


def referential(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q-FK: child rows whose non-NULL key has no parent row."""
    p = parent.select(col(parent_col).alias("_pk"))
    return child.where(col(child_col).isNotNull()).join(p, col(child_col) == col("_pk"), "left_anti")


# ------------------------------------------------------------------ runner
@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str               # not_null | unique (columns joined by ",") | accepted_values | positive | valid_date_key
    values: tuple = ()
    blocking: bool = True
    sieved: bool = False    # unique: of a written table, whose keys are moved only where hashes repeat


ROW_TESTS = ("not_null", "accepted_values", "positive")


def failures_of(checks: list[Check]) -> list[Column]:
    """One count of failing rows for each check of rows."""
    out = []
    for i, c in enumerate(checks):
        if c.test == "not_null":
            fail = col(c.column).isNull()
        elif c.test == "positive":
            fail = col(c.column) < 0
        else:
            fail = ~col(c.column).isin(list(c.values))
        out.append(F.count(F.when(fail, 1)).alias(f"f{i}"))
    return out


def run_checks(model: str, df: DataFrame, checks: list[Check], dim_date: DataFrame | None = None) -> DataFrame:
    """Failure counts for every check of one table: (model, column_name, test, failures)."""
    parts = []
    row_checks = [c for c in checks if c.test in ROW_TESTS]
    if row_checks:
        agg = df.agg(*failures_of(row_checks))
        stack = ", ".join(f"'{c.column}', '{c.test}', f{i}" for i, c in enumerate(row_checks))
        parts.append(agg.selectExpr(f"stack({len(row_checks)}, {stack}) AS (column_name, test, failures)"))
    for c in checks:
        if c.test == "unique":
            keys = c.column.split(",")
            twice = duplicate_groups_sieved(df.dropna(subset=keys), *keys) if c.sieved else duplicate_groups(df, *keys, include_nulls=False)
            n = twice.agg(F.count(F.lit(1)).alias("failures"))
            parts.append(n.select(F.lit(c.column).alias("column_name"), F.lit("unique").alias("test"), "failures"))
        elif c.test == "valid_date_key":
            n = assert_valid_date_key(df, c.column, dim_date).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(n.select(F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "column_name", "test", col("failures").cast("bigint"))


def audit_runner(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Q-RUN: all checks of all tables as one result DataFrame."""
    out = None
    for model, df in tables.items():
        mine = [c for c in checks if c.model == model]
        if not mine:
            continue
        r = run_checks(model, df, mine)
        out = r if out is None else out.unionByName(r)
    return out


def enforce(results: DataFrame, checks: list[Check]) -> list[tuple]:
    """Raise :class:`AuditFailure` if a blocking check failed.

    Collects one row per check (a bounded result), never table rows."""
    blocking = {(c.model, c.column, c.test) for c in checks if c.blocking}
    failed = [tuple(r) for r in results.where(col("failures") > 0).collect()]
    bad = [r for r in failed if (r[0], r[1], r[2]) in blocking]
    if bad:
        raise AuditFailure(f"blocking audits failed: {bad}")
    return failed


@dataclass
class Gate:
    """Audits candidates before they are published and keeps the results (a row a check)."""

    checks: list[Check]
    dim_date: DataFrame | None = None
    enforced: bool = True
    results: list[tuple] = field(default_factory=list)

    def of(self, model: str) -> Audit | None:
        """What to show the candidate of a model to; None without checks."""
        mine = [c for c in self.checks if c.model == model]
        return Audit(self, model, mine) if mine else None


class Audit:
    """The checks of one model: those of rows are counted by the job that writes the candidate, the others read it."""

    def __init__(self, gate: Gate, model: str, checks: list[Check]) -> None:
        self.gate, self.model, self.checks = gate, model, checks
        self.of_rows = [c for c in checks if c.test in ROW_TESTS]
        self.seen: Observation | None = None

    def watch(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the counts observed as they pass."""
        if not self.of_rows:
            return rows
        self.seen = Observation()
        return rows.observe(self.seen, *failures_of(self.of_rows))

    def __call__(self, candidate: DataFrame) -> None:
        observed, left = [], self.checks
        if self.seen is not None:
            counts, self.seen = self.seen.get, None
            observed = [(self.model, c.column, c.test, counts[f"f{i}"]) for i, c in enumerate(self.of_rows)]
            left = [c for c in self.checks if c.test not in ROW_TESTS]
        got = observed
        if left:
            left = [replace(c, sieved=True) for c in left]
            got = got + [tuple(r) for r in run_checks(self.model, candidate, left, self.gate.dim_date).collect()]
        self.gate.results += got
        blocking = {(c.column, c.test) for c in self.checks if c.blocking}
        bad = [r for r in got if r[3] > 0 and (r[1], r[2]) in blocking]
        if bad and self.gate.enforced:
            raise AuditFailure(f"blocking audits failed, {self.model} is not published: {bad}")


# The declared column tests of the podcast-vs-video pipeline, in their order.
TOOL1_TESTS: list[Check] = [
    Check("raw_spotify_episodes", "id", "unique"), Check("raw_spotify_episodes", "id", "not_null"),
    Check("raw_spotify_episode_performance", "episode_id", "not_null"),
    Check("raw_spotify_episode_performance", "date", "not_null"),
    Check("raw_spotify_show_stats", "date", "not_null"),
    Check("raw_youtube_videos", "id", "unique"), Check("raw_youtube_videos", "id", "not_null"),
    Check("raw_youtube_daily_stats", "video_id", "not_null"), Check("raw_youtube_daily_stats", "date", "not_null"),
    Check("stg_spotify_episodes", "episode_id", "unique"), Check("stg_spotify_episodes", "episode_id", "not_null"),
    Check("stg_spotify_episodes", "title", "not_null"), Check("stg_spotify_episodes", "published_date", "not_null"),
    Check("stg_spotify_daily_performance", "episode_id", "not_null"),
    Check("stg_spotify_daily_performance", "metric_date", "not_null"),
    Check("stg_spotify_daily_performance", "starts", "not_null"),
    Check("stg_spotify_daily_performance", "streams", "not_null"),
    Check("stg_spotify_show_stats", "stats_date", "unique"), Check("stg_spotify_show_stats", "stats_date", "not_null"),
    Check("stg_youtube_videos_json", "video_id", "unique"), Check("stg_youtube_videos_json", "video_id", "not_null"),
    Check("stg_youtube_videos_json", "title", "not_null"),
    Check("stg_youtube_videos_json", "published_date", "not_null"),
    Check("stg_youtube_daily_stats", "video_id", "not_null"), Check("stg_youtube_daily_stats", "metric_date", "not_null"),
    Check("stg_youtube_daily_stats", "views", "not_null"),
    Check("content_unified_mapped", "content_id", "unique"), Check("content_unified_mapped", "content_id", "not_null"),
    Check("content_unified_mapped", "title", "not_null"),
    Check("content_unified_mapped", "published_date", "not_null"),
    Check("content_unified_mapped", "content_source", "accepted_values",
          ("both_platforms", "spotify_only", "youtube_only")),
    Check("mart_content_performance", "content_id", "unique"),
    Check("mart_content_performance", "content_id", "not_null"),
    Check("mart_daily_metrics", "metric_date", "unique"), Check("mart_daily_metrics", "metric_date", "not_null"),
    Check("mart_platform_comparison", "platform", "unique"), Check("mart_platform_comparison", "platform", "not_null"),
    Check("mart_platform_comparison", "platform", "accepted_values", ("spotify", "youtube")),
    Check("seed_content_mapping", "content_id", "unique"), Check("seed_content_mapping", "content_id", "not_null"),
]


def checks_sql(checks: list[Check]) -> str:
    """The same checks as one SQL statement (used by the oracle)."""
    parts = []
    for c in checks:
        head = f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test"
        if c.test == "not_null":
            parts.append(f"{head}, count(*) AS failures FROM {c.model} WHERE {c.column} IS NULL")
        elif c.test == "positive":
            parts.append(f"{head}, count(*) AS failures FROM {c.model} WHERE {c.column} < 0")
        elif c.test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            parts.append(f"{head}, count(*) AS failures FROM {c.model} WHERE {c.column} NOT IN ({vals})")
        else:
            parts.append(f"{head}, count(*) AS failures FROM (SELECT {c.column} FROM {c.model} "
                         f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1) g")
    return "\nUNION ALL\n".join(parts)
