"""Quality rules (operator 6).

Base rules come from counts of the whole text.  The verdict on the rest is a
log-likelihood ratio between two multinomials over hashed byte 4-grams: the
trusted target (labelled documents of good quality) and the raw corpus (every
document).  The mean ratio over the n-grams of a document, that is the sum
divided by its length, is held against one fixed threshold.

* The raw counts cover all documents; each task adds its n-grams to one table of
  ``BUCKETS`` counts, and the tables are summed by bucket, so what reaches the
  driver is ``BUCKETS`` rows at any size.
* The target counts and the threshold come from all labelled documents.  Texts meet
  their labels in a join by id; scores are written once, and the two order statistics of
  the threshold are found in the written scores by counting intervals (``at_rank``).  The
  threshold lies between the two labels: under ``KEEP_SHARE`` of the trusted scores, by
  ``SLACK`` of the way from there to the median of the bad ones.  Without labels of
  both kinds nothing is rejected by score.

Defined results: null text has no words and fails the base rules, and so does
empty text; a document without n-grams scores 0; repeated rows are judged alike;
an empty table gives an empty result; other columns are ignored by ``judge`` and
passed through by ``keep_good``.  A null id is judged like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import WHITE, discard, staged, table

BUCKETS = 1 << 16
GRAM = 4
#: Intervals that one round of ``at_rank`` counts; as many rows reach the driver.
INTERVALS = 4096
#: Share of the trusted documents that the threshold must keep.
KEEP_SHARE = 0.998
SLACK = 0.1
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids = np.array(list(map(hash, words)), np.int64).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            keys = (keys ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    again = np.isin(keys, np.unique(twice))
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    edge[at] += 1
    np.subtract.at(edge, at + width, 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = text.encode().split()          # bytes: exactly the six ASCII white-space characters
    chars = len(text) - sum(map(text.count, WHITE))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def grams(text: str | None) -> np.ndarray:
    """Hash buckets of the byte 4-grams of a whole text."""
    data = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint32)
    if len(data) < GRAM:
        return np.zeros(0, np.uint32)
    v = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24
    return (v * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All labelled ids with ``good`` 1 or 0, one row an id."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min((F.col("quality") == 1).cast("int")).alias("good"))


def count_grams(texts: DataFrame, weight: str | None = None) -> np.ndarray:
    """Counts of the buckets over all rows of ``texts`` as one array of BUCKETS."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in slices(batches):
            found = [grams(t) for t in b.column(0).to_pylist()]
            total += np.bincount(np.concatenate(found) if found else [], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield batch(schema, at.astype(np.int32), total[at])

    rows = texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the target's over the corpus' share of each bucket, one count added to each."""
    t, r = target + 1.0, raw + 1.0
    return np.log(t / t.sum()) - np.log(r / r.sum())


def at_rank(scores: DataFrame, rank: int) -> float:
    """``llr`` at place ``rank`` (from 0) of the sorted rows, exactly.

    Each round counts the rows of INTERVALS equal intervals between the smallest and the largest
    value and goes on inside the interval that holds the place, until it holds one value.
    """
    low, high = scores.agg(F.min("llr"), F.max("llr")).first()
    while low < high:
        place = F.floor((F.col("llr") - F.lit(low)) / F.lit(high - low) * INTERVALS)
        held = (scores.where(F.col("llr").between(low, high)).groupBy(F.least(place, F.lit(INTERVALS - 1)).alias("place"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("llr").alias("low"), F.max("llr").alias("high")).collect())
        for r in sorted(held, key=lambda r: r["place"]):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low


def threshold(labelled: DataFrame) -> float:
    """Under the KEEP_SHARE of the trusted scores by SLACK of the way to the middle bad score.

    Short clean texts scatter more than the others; the slack keeps them.  Labels
    that are missing, or that the score does not tell apart, reject nothing.
    ``labelled`` has ``good`` and ``llr`` and is read several times: pass a staged table.
    """
    n = dict(labelled.groupBy("good").count().collect())
    if not n.get(1) or not n.get(0):
        return -np.inf
    good, bad = labelled.where("good = 1"), labelled.where("good = 0")
    floor = at_rank(good, int((1 - KEEP_SHARE) * (n[1] - 1)))
    middle = (at_rank(bad, (n[0] - 1) // 2) + at_rank(bad, n[0] // 2)) / 2
    return floor - SLACK * (floor - middle) if middle < floor else -np.inf


def score(texts: DataFrame, ratio: np.ndarray, base: bool = True) -> DataFrame:
    """``doc_id``, the base counts and ``llr`` (mean log ratio) of every row."""
    names = BASE if base else []
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in names], ("llr", pa.float64())])
    sent = texts.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = sent.value
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            mean = [float(ratio[g].mean()) if len(g) else 0.0 for g in map(grams, texts)]
            yield batch(schema, b.column(0), *(zip(*map(base_counts, texts), strict=True) if base and texts else [[]] * len(names)),
                        mean)

    return texts.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, " + "".join(f"{n} bigint, " for n in names) + "llr double")


def fit(texts: DataFrame, labels: DataFrame, base: bool = True) -> tuple[np.ndarray, DataFrame, float]:
    """The log ratio of each bucket, the written scores of all rows, and the threshold."""
    ids = staged(trusted_ids(labels), "quality-trusted")
    # Labels grow with the corpus: merge joins at every size, so that a small run shows the plan of a large one.
    good = texts.join(ids.where("good = 1").hint("merge"), "doc_id", "left_semi")
    ratio = log_ratio(count_grams(good), count_grams(texts))
    scores = staged(score(texts, ratio, base), "quality-scores")
    labelled = staged(scores.join(ids.hint("merge"), "doc_id").groupBy("doc_id").agg(F.first("good").alias("good"), F.avg("llr").alias("llr"))
                      .select("good", "llr"), "quality-labelled")
    return ratio, scores, threshold(labelled)


def fails(n_words, n_repeat_words):
    """The base rules; works on columns and on numbers."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``llr, base_failed, kept``."""
    _, scores, cut = fit(_texts(docs), labels)
    return scores.withColumn("base_failed", fails(F.col("n_words"), F.col("n_repeat_words"))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(float(cut))))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text passes; no row moves to another task."""
    ratio, scores, cut = fit(_texts(docs), labels, base=False)
    discard(scores)
    sent, at = docs.sparkSession.sparkContext.broadcast(ratio), docs.columns.index("text")

    def passes(text: str | None) -> bool:
        n_words, _, _, _, n_repeat = base_counts(text)
        if fails(n_words, n_repeat):
            return False
        found = grams(text)
        return (float(sent.value[found].mean()) if len(found) else 0.0) >= cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array([passes(t) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
