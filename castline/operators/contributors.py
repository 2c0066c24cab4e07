"""Distinct contributors of any window (A12): exact counts by the days on which an author enters and leaves it.

An author is in the window that ends on day d if the author's last day with commits up to d lies in it.  So each such
day adds one to the count, and takes it away again when the window has moved on or the author commits
again, whichever is first.  These changes are summed by day and then along the days of a repository: the work is in
proportion to the commits, whatever the number of authors or the length of the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

col = F.col
WINDOWS = (7, 30, 90)


def author_days(commits: DataFrame) -> DataFrame:
    """``repo_full_name, author_email, n, again``: an author's days (numbers) with commits, and the next one of each.

    Rows are dealt by repository and author once; the copies of a day and the next day are found there.
    """
    seen = commits.select("repo_full_name", "author_email", F.unix_date(col("committed_at").cast("date")).alias("n"))
    each = seen.repartition("repo_full_name", "author_email").distinct()
    return each.withColumn("again", F.lead("n").over(Window.partitionBy("repo_full_name", "author_email").orderBy("n")))


def changes(days: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    """``repo_full_name, n, active`` and the change of each window's count on day n."""
    def at(n, of: int | None, by: int):
        """A change of window ``of`` (None: of all, on a day with commits)."""
        return F.struct(n.alias("n"), F.lit(of is None).alias("active"),
                        *[F.lit(by if of in (None, w) else 0).alias(f"contributors_{w}d") for w in windows])

    named = col("author_email").isNotNull()
    moves = F.when(named, F.array(at(col("n"), None, 1), *[at(F.least(col("n") + w, col("again")), w, -1) for w in windows])) \
        .otherwise(F.array(at(col("n"), None, 0)))
    return days.select("repo_full_name", F.explode(moves).alias("c")).select("repo_full_name", "c.*")


def contributors_rolling(commits: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """``repo_full_name, day, contributors_<n>d``: distinct authors of the days up to each day with commits."""
    commits = commits.where(col("repo_full_name").isNotNull() & col("committed_at").isNotNull())
    names = [f"contributors_{w}d" for w in windows]
    daily = changes(author_days(commits), windows).groupBy("repo_full_name", "n").agg(
        F.max("active").alias("active"), *[F.sum(c).alias(c) for c in names])
    so_far = Window.partitionBy("repo_full_name").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumns({c: F.sum(c).over(so_far) for c in names}).where("active").select(
        "repo_full_name", F.date_from_unix_date("n").alias("day"), *names)
