"""Mixing sources to target weights (operator 8).

Temperature mixing: the weight of a source is its share of all tokens to the
power ``alpha``, normalised.  ``alpha`` is bisected between 0 (all sources alike)
and 1 (as the corpus is) until the weights meet a target entropy, or, if a
repetition limit is given, to the flattest weights within it.

A weight becomes a number of passes over the source: as many that the source
passed over least comes out ``least`` times (1: every document is used).  Whole
passes take every document; a last part of a pass takes documents up to its
budget of tokens.  Each pass has a permutation of its own: a document's place in
it is a hash of the document and the pass, the unit interval is cut into blocks,
and the budget is counted over the block sums and then inside one block of each
source.  So a source of any size is counted by about the root of its documents
in blocks, and no task holds a source.  ``position`` (0 to 1) puts the passes of
all sources into one order with the target weights throughout.

Words ``[^\\x20\\x09-\\x0D]+`` count as tokens.

Defined results: a null source is a source of its own; null or empty text has no
tokens and takes part in whole passes; a source without tokens is passed over
``least`` times; documents at the same place of a pass are taken or left together;
repeated rows are each mixed in; an empty table gives an empty result; ``remix``
passes all other columns through.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castline.llm.common import partitions, staged, table

#: Passes over a source at most, for one pass over the source passed over least.
REPEAT_LIMIT = 2.0
LEAST = 1.0
STEPS = 50
#: Exponents tried in one job when the entropy is the target, and such jobs.
POINTS, ROUNDS = 16, 6
#: Sources up to which their table is broadcast (about 100 bytes each).
BROADCAST_SOURCES = 100_000
SEED = 20_011


def source_key() -> Column:
    return F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source")))


def row_hash() -> Column:
    return F.xxhash64("doc_id", "text")


def place(row: Column, epoch: Column) -> Column:
    """Where a document lies in the permutation of a pass: 0 to 1."""
    return F.pmod(F.xxhash64(row, epoch.cast("int"), F.lit(SEED)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def n_tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def bisect(meets: Callable[[float], bool], steps: int = STEPS) -> float:
    """The smallest exponent of 0 to 1 that meets a condition which holds from some exponent on."""
    low, high = 0.0, 1.0
    if meets(low):
        return low
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if meets(mid) else (mid, high)
    return high


def entropies(sources: DataFrame, total: int, alphas: list[float]) -> list[float]:
    """Entropy of the weights at each exponent, from sums over the sources."""
    log_share = F.log(F.col("tokens") / F.lit(float(total)))
    sums = [c for a in alphas for c in (F.sum(F.exp(a * log_share)), F.sum(F.exp(a * log_share) * log_share))]
    got = sources.where("tokens > 0").agg(*[c.alias(f"s{i}") for i, c in enumerate(sums)]).first()
    return [math.log(got[2 * i]) - a * got[2 * i + 1] / got[2 * i] for i, a in enumerate(alphas)]


def entropy_exponent(sources: DataFrame, total: int, target: float) -> float:
    """The exponent whose weights have the target entropy (the nearest end if none has)."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        alphas = [low + (high - low) * k / (POINTS - 1) for k in range(POINTS)]
        found = entropies(sources, total, alphas)     # falls as the exponent grows
        if found[0] <= target:
            return low
        if found[-1] >= target:
            return high
        k = next(i for i, h in enumerate(found) if h <= target)
        low, high = alphas[k - 1], alphas[k]
    return (low + high) / 2


def plan(docs: DataFrame, limit: float | None = REPEAT_LIMIT, entropy: float | None = None, least: float = LEAST) -> DataFrame:
    """One row per source: ``key, n_docs, tokens, weight, epochs, whole, cut, blocks``.

    A document takes part in pass ``e`` if ``e < whole``, or if ``e = whole`` and
    its place there is under ``cut``.
    """
    thin = staged(docs.select(source_key().alias("key"), n_tokens().alias("n_tokens"),
                              row_hash().alias("row")), "mix-rows")
    sources = staged(thin.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens")), "mix-sources")
    total, top, low = sources.where("tokens > 0").agg(F.sum("tokens"), F.max("tokens"), F.min("tokens")).first()
    if not total:
        alpha, norm = 1.0, 1.0
    else:
        spread = top / low
        alpha = (entropy_exponent(sources, total, entropy) if entropy is not None
                 else bisect(lambda a: spread ** (1 - a) * least <= limit * (1 + 1e-12)))
        norm = sources.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(alpha)))).first()[0]
    share = F.col("tokens") / F.lit(float(total or 1))
    passes = F.when(F.col("tokens") > 0, F.lit(least) * F.pow(F.col("tokens") / F.lit(float(top or 1)), F.lit(alpha - 1)))
    sources = sources.withColumns({
        "weight": F.when(F.col("tokens") > 0, F.pow(share, F.lit(alpha)) / F.lit(norm)).otherwise(F.lit(0.0)),
        "epochs": F.round(F.coalesce(passes, F.lit(least)), 9),
        "blocks": F.ceil(F.sqrt("n_docs")).cast("long"),
    }).withColumn("whole", F.floor("epochs").cast("int")).withColumn(
        "budget", F.round((F.col("epochs") - F.col("whole")) * F.col("tokens")).cast("long"))
    sources = staged(sources, "mix-weights")
    return staged(sources.join(cuts(thin, sources), "key", "left").withColumn("cut", F.coalesce("cut", F.lit(0.0))), "mix-plan")


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join by ``key``; the sources are broadcast only if they are counted and few."""
    return rows.join(F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources, "key")


def cuts(thin: DataFrame, sources: DataFrame) -> DataFrame:
    """``key, cut``: the place in the last part of a pass at which its budget is used up."""
    part = sources.where("budget > 0").select("key", "budget", "blocks", "whole")
    rows = with_source(thin, part).withColumn("place", place(F.col("row"), F.col("whole"))).withColumn(
        "block", F.floor(F.col("place") * F.col("blocks")))
    sums = rows.groupBy("key", "block", "budget", "blocks").agg(F.sum("n_tokens").alias("held"))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a root of a source's rows
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    edge = staged(sums.where("before <= budget AND before + held > budget").select("key", "block", "before"), "mix-edge")
    inside = rows.join(F.broadcast(edge) if edge.count() <= BROADCAST_SOURCES else edge, ["key", "block"])
    upto = Window.partitionBy("key", "block").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    over = inside.withColumn("used", F.col("before") + F.sum("n_tokens").over(upto)).where("used > budget")
    found = over.groupBy("key").agg(F.min("place").alias("cut"))
    return part.select("key").join(found, "key", "left").select("key", F.coalesce("cut", F.lit(1.0)).alias("cut"))


def passes(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (with ``key`` and ``row``) once for each pass they take part in: adds ``epoch, block, position``."""
    epoch = F.explode(F.sequence(F.lit(0), F.col("whole")))
    return (with_source(rows, sources.select("key", "weight", "epochs", "whole", "cut", "blocks"))
            .withColumn("epoch", epoch)
            .withColumn("place", place(F.col("row"), F.col("epoch")))
            .where((F.col("epoch") < F.col("whole")) | (F.col("place") < F.col("cut")))
            .withColumn("block", F.floor(F.col("place") * F.col("blocks")))
            # the last part of a pass spreads what is under its cut over what is left of the epochs
            .withColumn("position", (F.col("epoch") + F.when(F.col("epoch") < F.col("whole"), F.col("place")).otherwise(
                F.col("place") / F.col("cut") * (F.col("epochs") - F.col("whole")))) / F.col("epochs")))


def mix(docs: DataFrame, **target) -> DataFrame:
    """``doc_id, source, n_tokens, epoch, block, position, weight``: one row for each use of a document."""
    sources = plan(docs, **target)
    rows = docs.select("doc_id", "source", n_tokens().alias("n_tokens"), source_key().alias("key"), row_hash().alias("row"))
    return passes(rows, sources).select("doc_id", "source", "n_tokens", "epoch", "block", "position", "weight")


def remix(docs: DataFrame, **target) -> DataFrame:
    """The rows of ``docs``, with their columns, as often as they are used and in the order of the mix."""
    sources = plan(docs, **target)
    cols = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], source_key().alias("key"),
                        row_hash().alias("row"))
    used = passes(inner, sources)
    order = ["position", "row", "epoch"]
    return (used.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
