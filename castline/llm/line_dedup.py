"""Line dedup by winnowing (operator 1), with DataFrame functions only.

A run is a stretch of consecutive lines (lines without a word aside).  A run of
at least ``MIN_WORDS`` words that occurred before, in an earlier document or
further up in the same one without overlap, is deleted where it occurs later.

1. Each line gets a hash; a window is the shortest run of at least MIN_WORDS words
   that starts at a line, or that ends at one.  The smallest line hash of a window
   is its fingerprint.  Two equal runs of MIN_WORDS words or more have a window in
   common and so a fingerprint: none is missed.
2. Fingerprint positions are joined: windows whose fingerprint lies at one place
   only in the whole corpus can't repeat and go.
3. The windows that start at a line extend a match downwards, those that end at a
   line upwards; their hash of all line hashes is compared.  The first place of
   each window content stays, the others are marked, and marked windows merge to
   runs.  Every line of a repeated run lies in one of its windows, so the union is
   the whole run and no line besides.
4. Each document keeps the lines outside its marked runs.

All groups (fingerprints, window contents) are pre-aggregated and joined back with
``hot_join``, so a passage in a third of all documents neither lands in one task
nor is paired with itself.  The only group a task must hold is one document's lines.

Defined results: null text counts as empty and stays without lines; lines are
compared with white space runs as one space and ends trimmed; documents are in
the order of id (null first), then of a hash of the text; rows that repeat both id
and text count as one document and get the same result; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castline.llm.common import hot_join, staged, table

MIN_WORDS = 50
DOC = ["doc_id", "thash"]


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, thash, text``: the columns that count, null text as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("thash"), text.alias("text"))


def hashed_lines(rows: DataFrame) -> DataFrame:
    """``doc_id, thash, pos, h1, h2, words`` of every line with a word; no text leaves the scan."""
    line = F.trim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " "))
    each = rows.select(*DOC, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).select(
        *DOC, "pos", line.alias("line")).where("line <> ''")
    return each.select(*DOC, "pos", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"),
                       (F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1).cast("long").alias("words"))


def windows(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, thash, first, last, fp, fp_pos, run1, run2``: the windows of every document."""
    doc = Window.partitionBy(*DOC)
    lines = (hashed_lines(rows).repartition(*DOC).dropDuplicates([*DOC, "pos"])
             .withColumn("end", F.sum("words").over(doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("off", F.col("end") - F.col("words")))
    down = doc.orderBy("off").rangeBetween(0, min_words - 1)
    up = doc.orderBy("end").rangeBetween(-(min_words - 1), 0)

    def window(over) -> F.Column:
        return F.struct(F.min("pos").over(over).alias("first"), F.max("pos").over(over).alias("last"),
                        (F.max("end").over(over) - F.min("off").over(over)).alias("n"),
                        F.min(F.struct("h1", "pos")).over(over).alias("fp"),
                        F.xxhash64(F.collect_list("h1").over(over)).alias("run1"),
                        F.xxhash64(F.collect_list("h2").over(over)).alias("run2"))

    both = lines.select(*DOC, window(down).alias("down"), window(up).alias("up"))
    return (both.select(*DOC, F.explode(F.array("down", "up")).alias("w")).where(F.col("w.n") >= min_words)
            .select(*DOC, "w.first", "w.last", F.col("w.fp.h1").alias("fp"), F.col("w.fp.pos").alias("fp_pos"), "w.run1", "w.run2")
            .dropDuplicates([*DOC, "first", "last"]))


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, thash, runs``: the merged runs to delete, as an array of (first, last) line numbers."""
    every = staged(windows(rows, min_words), "line-windows")
    place = F.struct(*DOC, "fp_pos")
    prints = (every.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n_fp"))
              .where("a <> b").select("fp", "n_fp"))
    shared = staged(hot_join(every, staged(prints, "line-prints"), "fp", "n_fp")
                    .withColumn("run", F.struct("run1", "run2")).select(*DOC, "first", "last", "run"), "line-shared")
    firsts = shared.groupBy("run").agg(F.min(F.struct(*DOC, "first", "last")).alias("at"),
                                       F.count(F.lit(1)).alias("n_run")).where("n_run > 1")
    same = F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("thash") == F.col("at.thash"))
    later = (hot_join(shared, staged(firsts, "line-firsts"), "run", "n_run")
             .where(~same | (F.col("first") > F.col("at.last"))).select(*DOC, "first", "last"))
    order = Window.partitionBy(*DOC).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.withColumn("new", F.coalesce((F.col("first") > reach + 1).cast("int"), F.lit(1))).withColumn(
        "island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy(*DOC, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed, text`` of every row: the text without its repeated runs."""
    rows = keyed(docs)
    runs = staged(repeated_runs(rows, min_words), "line-runs")
    # Both sides grow with the corpus: a merge join at every size, so that a small run shows the plan of a large one.
    joined = rows.join(runs.withColumnsRenamed({"doc_id": "r_id", "thash": "r_hash"}).hint("merge"),
                       F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("thash") == F.col("r_hash")), "left")
    lines = F.split("text", "\n", -1)
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.when(F.col("runs").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: lines[i]), "\n"))
    return joined.select(
        "doc_id", F.when(F.col("text") == "", 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"], r["last"])), ","), F.lit("")).alias("removed"),
        text.alias("text"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


#: The definition itself, without fingerprints: windows by their lines, the first place of each content stays.
ORACLE = rf"""
WITH every AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM documents),
plain AS (
  SELECT doc_id, pos, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM every),
counted AS (
  SELECT *, len(string_split(line, ' ')) AS words FROM plain WHERE line <> ''),
placed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS stop,
         sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS off FROM counted),
wins AS (
  SELECT doc_id, min(pos) OVER d AS first, max(pos) OVER d AS last, max(stop) OVER d - min(off) OVER d AS n, list(line) OVER d AS run
  FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY off RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
  UNION
  SELECT doc_id, min(pos) OVER u, max(pos) OVER u, max(stop) OVER u - min(off) OVER u, list(line) OVER u
  FROM placed WINDOW u AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
firsts AS (
  SELECT run, min({{'d': doc_id, 'a': first, 'b': last}}) AS place FROM wins WHERE n >= {MIN_WORDS} GROUP BY run),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS pos
  FROM wins JOIN firsts USING (run) WHERE n >= {MIN_WORDS} AND (doc_id <> place.d OR first > place.b)),
runs AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed, sum(b - a + 1) AS n_removed
  FROM (SELECT doc_id, min(pos) AS a, max(pos) AS b
        FROM (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone) g
        GROUP BY doc_id, island) i GROUP BY doc_id)
SELECT e.doc_id, CASE WHEN any_value(e.text) = '' THEN 0 ELSE count(*) END AS n_lines,
       cast(coalesce(any_value(r.n_removed), 0) AS bigint) AS n_removed, coalesce(any_value(r.removed), '') AS removed,
       coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (g.pos IS NULL), '') AS text
FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos LEFT JOIN runs r ON r.doc_id = e.doc_id
GROUP BY e.doc_id
"""
