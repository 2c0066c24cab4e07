"""N-gram Jaccard join by T-occurrence search (operator 3).

Documents link when the Jaccard similarity of their sets of word n-grams reaches
a threshold; the result is the connected component of each document.

1. Equal sets become one node (pre-aggregated), so exact copies of any number
   are one row from here on.
2. Sieve.  Of a set's n-grams in the order of their hashes, the first ``n - ceil(t n) + l`` have at least
   ``l`` in common with those of any linked set.  A set of which fewer occur among the first n-grams of other
   rows is linked with nothing and goes no further; nearly all sets end here, at a quarter of a number an
   n-gram.
3. Routing of the rest.  Two linked sets of at most U n-grams differ in at most
   ``H = 2U(1-t)/(1+t)`` of them, so of ``H + 1`` parts of the hash range at least
   one is equal in both.  A node gives one signature for each part (bands of sizes
   have a number of parts each; near the upper end a node also gives those of the
   next band).  Spare parts, ``EMPTY`` or as many as a set of the band is likely to
   leave empty, make up for empty ones; a set with more empty parts signs its
   smallest n-grams as well (two linked sets share one of them).  No empty part is
   signed, as all sets would meet there.  Of its ``f`` filled parts two linked sets share ``f - H``
   or more, so a node keeps the ``H + 1`` rarest of its signatures, by one order for all nodes, and
   linked nodes still share one (prefix filter).  A text that differs from the others of a family in
   more parts than a link allows thus keeps parts of its own and stays out of their buckets.  Nodes that share a
   kept signature meet at the smallest of them, the pivot: as many (node, pivot) pairs as nodes in the bucket,
   not all pairs.
4. T-occurrence search.  Pivots are indexed by inverted lists (n-gram -> pivots),
   nodes are the queries: DivideSkip sets the longest lists aside, merges the
   short ones and looks candidates up in the long ones by binary search; what
   reaches the overlap is returned with it.  A hot pivot's queries are spread over
   cells, with its list copied to each.  A node asks its smallest pivot first, and then only pivots that are in
   another component, so that a large group of near copies is not searched once for each signature.
5. Rest.  Nodes in their pivot's component are done.  Others may still link
   to members of the pivot's buckets; by the triangle inequality of the Jaccard
   distance only to members whose distance to the pivot is near theirs.  Those are
   indexed, in chunks of bounded size, and searched once more in the same way; a
   search returns one link for each component it meets, not all.
6. Components of all links.

Overlap and union are exact counts over 64-bit hashes of n-grams.

Defined results: words are split at ASCII white space and A-Z lower-cased; a text
of fewer words than ``n`` has its whole sequence as one n-gram; without words or
with null text a document has an empty set and is linked with nothing; documents
with null id take part, and an id of null counts only where a component has no
other; repeated rows are equal sets; an empty table gives an empty result; other
columns are ignored by ``link`` and passed through by ``one_of_each``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import discard, hot_join, staged, table, without
from castline.llm.components import components

N = 3
#: Similarity in percent: linked if 100 * intersection >= PERCENT * union.
PERCENT = 90
BAND = 1.5
#: Spare parts at least.
EMPTY = 2
#: Of 100 n-grams so many more are among the first ones of the sieve, and must be shared.
MORE = 5
#: Queries of a cell, and members of an index chunk, at about which they are split.
CELL = 1_000
#: Lists set aside by DivideSkip: T / (MU * log2(longest) + 1).
MU = 0.0085
MEMBER_BITS = 1 << 25


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Tables of the word hash: a random odd number for each byte (A-Z as a-z), white space, powers of an odd base and its inverse.
_RNG = np.random.default_rng(20_260)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z: differences of one running sum over the bytes, brought to a common power."""
    b = np.frombuffer(b" " + data + b" ", np.uint8)
    word = _WORD[b]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1      # starts and ends by turns
    start, end = edge[::2], edge[1::2]
    up, down = powers(len(b))
    total = np.cumsum(_BYTE[b] * up, dtype=np.uint64)
    return mix((total[end - 1] - total[start - 1]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """The sorted distinct hashes of a whole text's word n-grams."""
    h = word_hashes((text or "").encode())
    if not len(h):
        return h
    size = min(n, len(h))
    key = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        key += h[k:k + len(key)] * np.uint64(pow(_BASE, 2 * k + 3, 1 << 64))
    key = np.sort(mix(key))
    return key[np.concatenate([[True], key[1:] != key[:-1]])]


@cache
def parts_of(low: int, high: int, percent: int) -> tuple[int, int]:
    """Most differing n-grams of linked sets in a band of sizes ``low`` to ``high - 1``, and its number of parts."""
    differ = 2 * (high - 1) * (100 - percent) // (100 + percent)
    least = max(percent * low // 100, 1)      # the smallest set that signs
    for spare in range(EMPTY, 2 * differ + EMPTY):
        parts = differ + 1 + spare
        empty = parts * math.exp(-least / parts)
        if spare >= empty + 2 * math.sqrt(empty):
            return differ, parts
    return differ, differ + 1 + EMPTY         # small sets


def bands(size: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """``(band, differ, parts)`` that a set of ``size`` gives signatures for.

    A band holds the sizes ``low`` to ``high - 1``.  Sets that can link across its
    end meet in the next band, for which the smaller one signs too.
    """
    low, high, band = 1, 2, 0
    while size >= high:
        low, high, band = high, max(high + 1, int(high * BAND)), band + 1
    found = [(band, *parts_of(low, high, percent))]
    if 100 * size >= percent * high:
        found.append((band + 1, *parts_of(high, max(high + 1, int(high * BAND)), percent)))
    return [x for x in found if x[1]]     # no difference allowed: only equal sets link


def signatures(keys: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """One hash of each filled part of a set, for each band it signs for."""
    return np.concatenate([np.zeros(0, np.uint64), *(hashes for hashes, _ in signed_parts(keys, percent))])


def signed_parts(keys: np.ndarray, percent: int = PERCENT) -> list[tuple[np.ndarray, int]]:
    """For each band a set signs for, one hash of each filled part, and how many of these (the most frequent) may go."""
    out = []
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keys, dtype=np.uint64)])
    for band, differ, parts in bands(len(keys), percent):
        of = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)      # ascends with the keys
        edge = np.searchsorted(of, np.arange(parts + 1, dtype=np.uint64))
        filled = edge[1:] > edge[:-1]
        sums = total[edge[1:]] - total[edge[:-1]]
        out.append((mix(sums + places(band, parts))[filled], max(int(filled.sum()) - differ - 1, 0)))
        if filled.sum() <= differ:      # the differing n-grams could lie in all filled parts, of this set and of another such
            out.append((mix(keys[:len(keys) * (100 - percent) // 100 + 1] + places(band, parts)[0]), 0))
    return out


_places: dict[tuple[int, int], np.ndarray] = {}


def places(band: int, parts: int) -> np.ndarray:
    """A number for each part of a band (there is one entry a band)."""
    if (band, parts) not in _places:
        _places[band, parts] = mix(np.uint64(band << 32) + np.arange(parts, dtype=np.uint64))
    return _places[band, parts]


class Lists:
    """Inverted lists of a few sets, searched by T-occurrence."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), self.sizes)
        order = np.argsort(keys, kind="stable")       # a list is in the order of its sets
        keys, self.owner = keys[order], owner[order]
        self.keys, self.start = np.unique(keys, return_index=True)
        self.start = np.append(self.start, len(keys))

    def shared(self, k: int, keys: np.ndarray) -> int:
        """How many of the keys' lists hold the k-th set: binary search of the keys in the set."""
        own = self.sets[k]
        spot = np.searchsorted(own, keys)
        spot[spot == len(own)] = 0
        return int((own[spot] == keys).sum())

    def search(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets that share at least ``least`` (1 or more) keys with a query, and how many (DivideSkip)."""
        none = np.zeros(0, np.int64)
        if len(query) < least or not len(self.keys):
            return none, none
        at = np.searchsorted(self.keys, query)
        at[at == len(self.keys)] = 0
        at = at[self.keys[at] == query]
        if len(at) < least:
            return none, none
        first, size = self.start[at], self.start[at + 1] - self.start[at]
        by_size = np.argsort(size, kind="stable")
        first, size = first[by_size], size[by_size]
        longest = int(size[-1])
        aside = min(int(least / (MU * np.log2(max(longest, 2)) + 1)), least - 1)
        short = len(size) - aside
        lists = [self.owner[f:f + n] for f, n in zip(first[:short].tolist(), size[:short].tolist(), strict=True)]
        found, counts = merge(lists, least - aside, len(self.sizes))
        if len(found) * 4 < aside:                    # few candidates: all long lists at once for each
            long = self.keys[at[by_size[short:]]]
            extra = [self.shared(k, long) for k in found.tolist()]
            counts = counts + np.array(extra, counts.dtype) if extra else counts
        else:
            for k in range(short, len(size)):         # the long lists, the shorter first
                if not len(found):
                    break
                long = self.owner[first[k]:first[k] + size[k]]
                spot = np.searchsorted(long, found)
                spot[spot == len(long)] = 0
                counts = counts + (long[spot] == found)
                open_ = counts + (len(size) - 1 - k) >= least
                if not open_.all():
                    found, counts = found[open_], counts[open_]
        ok = counts >= least
        return found[ok], counts[ok]


def merge(lists: list[np.ndarray], least: int, n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of at least ``least`` of the ascending lists, and in how many: by a heap, or counted at once if many."""
    if sum(map(len, lists)) <= 64:
        runs = [(m, sum(1 for _ in g)) for m, g in groupby(heapq.merge(*[x.tolist() for x in lists]))]
        runs = [r for r in runs if r[1] >= least]
        return np.array([m for m, _ in runs], np.int64), np.array([c for _, c in runs], np.int64)
    counts = np.bincount(np.concatenate(lists), minlength=n_sets)
    found = np.flatnonzero(counts >= least)
    return found, counts[found]


def first_grams(keys: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The first n-grams of a set by hash, and how many of them any linked set has among its own first ones."""
    size = len(keys)
    need = -(-percent * size // 100)
    return keys[:size - need + 1 + MORE * size // 100], 1 + MORE * (percent * size // 100) // 100


def sets_of(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, thash, n_shingles, set1, set2, firsts, need`` of every row; ``set1, set2`` name a set."""
    schema = pa.schema([("doc_id", pa.int64()), ("thash", pa.int64()), ("n_shingles", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()),
                        ("firsts", pa.list_(pa.int64())), ("need", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingles(t, n) for t in b.column(1).to_pylist()]
            names = [name_of(s) for s in sets]
            firsts = [first_grams(s, percent) for s in sets]
            yield batch(schema, b.column(0), b.column(2), [len(s) for s in sets], [x for x, _ in names], [y for _, y in names],
                        int_lists([f for f, _ in firsts]), [k for _, k in firsts])

    return texts_of(docs).mapInArrow(
        run, "doc_id bigint, thash bigint, n_shingles bigint, set1 bigint, set2 bigint, firsts array<bigint>, need bigint")


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_hash(text).alias("thash"))


def text_hash(text) -> F.Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def name_of(keys: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    import xxhash
    d = xxhash.xxh3_128_digest(keys.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def int_lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).astype(np.uint64).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def members_filter(nodes: DataFrame) -> bytes:
    """A bitmap of fixed size with the bit of each ``thash`` in ``nodes``; only a first sieve."""
    bit = F.pmod("thash", F.lit(MEMBER_BITS)) + 1       # Spark's bitmap buckets count from 1
    parts = (nodes.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("part"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect())
    out = bytearray(MEMBER_BITS // 8 + 4096)
    for part, bits in parts:      # at most MEMBER_BITS / 32768 + 1 rows of 4 KB
        out[(part - 1) * 4096:part * 4096] = bits
    return bytes(out)


def sets_again(docs: DataFrame, nodes: DataFrame, n: int, of) -> DataFrame:
    """``node, part, keys, spare`` with the pairs (keys, spare) of ``of(set)``, numbered by ``part``, of the rows that lead
    a node in ``nodes`` (``node, rep, thash``), from their texts."""
    sent = docs.sparkSession.sparkContext.broadcast(members_filter(nodes))
    schema = pa.schema([("rep", pa.int64()), ("thash", pa.int64()), ("part", pa.int32()), ("keys", pa.list_(pa.int64())),
                        ("spare", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for b in slices(batches):
            at = b.column(2).to_numpy() & (MEMBER_BITS - 1)      # a power of two: the mask is pmod
            rows = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            if len(rows):
                b = b.take(pa.array(rows))
                every = [of(shingles(t, n)) for t in b.column(1).to_pylist()]
                own = pa.array(np.repeat(np.arange(len(every)), [len(e) for e in every]))
                yield batch(schema, b.column(0).take(own), b.column(2).take(own), [k for e in every for k in range(len(e))],
                            int_lists([keys for e in every for keys, _ in e]), [spare for e in every for _, spare in e])

    found = texts_of(docs).mapInArrow(run, "rep bigint, thash bigint, part int, keys array<bigint>, spare int")
    # Only the row of the class's own id is joined, so copies do not multiply; rows that repeat it are equal.
    return (found.join(nodes.select("node", F.col("rep").alias("r"), F.col("thash").alias("h")).hint("merge"),
                       F.col("rep").eqNullSafe(F.col("r")) & (F.col("thash") == F.col("h")))
            .select("node", "part", "keys", "spare"))


FOUND = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("inter", pa.int64()), ("n_node", pa.int64()), ("n_other", pa.int64())])
FOUND_DDL = "node bigint, other bigint, inter bigint, n_node bigint, n_other bigint"


def occurrence_search(index: DataFrame, queries: DataFrame, sets: DataFrame, percent: int, one_a_comp: bool = False) -> DataFrame:
    """T-occurrence search cell by cell: ``node, other`` and the counts of pairs at or over ``percent``.

    ``index`` and ``queries`` have ``cell`` and ``node`` (and ``comp`` if only one
    link for each component is wanted, and none into the own one).
    """
    extra = ["comp"] if one_a_comp else []

    def both(rows: DataFrame) -> DataFrame:
        full = rows.select("cell", "node", *extra).distinct().hint("merge").join(sets, "node")
        # fresh names for columns: both sides come from the same tables
        return full.select(*[F.col(c).alias(c, metadata={"side": c}) for c in ("cell", "node", "keys", *extra)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            nodes, keys, comps = unpack(left)
            lists = Lists(keys)
            for node, query, comp in zip(*unpack(right), strict=True):
                size = len(query)
                hits, counts = lists.search(query, max(1, -(-percent * size // 100)))
                met = {comp}
                for k, inter in zip(hits.tolist(), counts.tolist(), strict=True):
                    other = int(lists.sizes[k])
                    if nodes[k] == node or 100 * inter < percent * (size + other - inter):
                        continue
                    if one_a_comp:
                        if comps[k] in met:
                            continue
                        met.add(comps[k])
                    out.append((node, nodes[k], inter, size, other))
        return pa.Table.from_batches([batch(FOUND, *(map(list, zip(*out, strict=True)) if out else [[]] * 5))], FOUND)

    return both(index).groupBy("cell").cogroup(both(queries).groupBy("cell")).applyInArrow(run, FOUND_DDL)


def unpack(rows: pa.Table) -> tuple[list[int], list[np.ndarray], list]:
    """Nodes, key arrays and components of a cell, each node once."""
    nodes, keys, seen = [], [], {}
    comps = rows["comp"].to_pylist() if "comp" in rows.column_names else [None] * rows.num_rows
    kept = []
    column = rows["keys"].combine_chunks()
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for i, node in enumerate(rows["node"].to_pylist()):
        if node not in seen:
            seen[node] = True
            nodes.append(node)
            keys.append(flat[ends[i]:ends[i + 1]].view(np.uint64))
            kept.append(comps[i])
    return nodes, keys, kept


def cells(pairs: DataFrame) -> DataFrame:
    """``pairs`` (``node, pivot``) with the cell of each: pivots share cells; one with many queries has several."""
    held = staged(pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n_pivot")), "join-held")
    bins = F.lit(max(pairs.count() // CELL, 1))
    salted = hot_join(pairs, held, "pivot", "n_pivot").withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("n_pivot") / CELL).cast("long")))
    return salted.withColumn("cell", F.xxhash64(F.pmod(F.xxhash64("pivot"), bins), "salt"))


def search_pivots(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Step 3: every node against the pivots of its cells."""
    placed = staged(cells(pairs), "join-cells")
    return occurrence_search(placed.select("cell", F.col("pivot").alias("node")), placed.select("cell", "node"), sets, percent)


def with_components(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """``pairs`` with the components ``comp`` of the node and ``comp_pivot`` of the pivot (itself without links)."""
    held = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n_pivot"))
    named = staged(held.join(comps.select(F.col("node").alias("pivot"), F.col("comp").alias("c")).hint("merge"), "pivot", "left").select(
        "pivot", "n_pivot", F.coalesce("c", "pivot").alias("comp_pivot")), "join-pivots")
    both = hot_join(pairs, named, "pivot", "n_pivot").drop("n_pivot")
    return both.join(comps.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def search_rest(pairs: DataFrame, found: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Step 5: nodes that are not in their pivot's component, against the members of its buckets that are near enough."""
    reach = (100 - percent) / 100
    known = found.select("node", F.col("other").alias("pivot"), "inter", "n_node", "n_other").distinct()
    union = F.col("n_node") + F.col("n_other") - F.col("inter")
    far = pairs.join(known, ["node", "pivot"], "left").select(
        "node", "pivot", F.coalesce(100 * F.col("inter") >= percent * union, F.lit(False)).alias("linked"),
        # a pair that the search did not report is further apart than twice the reach, or was not asked for
        F.coalesce(1 - F.col("inter") / union, F.lit(2 * reach)).alias("dist"))
    far = staged(with_components(staged(far, "join-far"), comps).withColumn("open", F.col("comp") != F.col("comp_pivot")), "join-far")
    groups = staged(far.groupBy("pivot").agg(
        F.min(F.when(F.col("open"), F.col("dist"))).alias("nearest"),
        F.count(F.when(F.col("open"), 1)).alias("n_open"), F.count(F.lit(1)).alias("n_all")).where("n_open > 0"), "join-groups")
    near = staged(hot_join(far, groups, "pivot", "n_all").where(~F.col("linked") | (F.col("dist") >= F.col("nearest") - reach - 1e-9)),
                  "join-near")
    # A group whose members are one node or one component has nothing left to find.
    mixed = staged(near.groupBy("pivot").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count(F.lit(1)).alias("n_near"))
                   .where("c1 <> c2").select("pivot", "n_near"), "join-mixed")
    rows = staged(hot_join(near, mixed, "pivot", "n_near"), "join-open")
    discard(far, near, groups, mixed)
    # Chunks of the members by a hash of the node; each open node asks every chunk of its group.
    chunks = F.ceil(F.col("n_all") / CELL).cast("long")
    sides = F.ceil(F.col("n_open") / CELL).cast("long")
    index = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks)).withColumn(
        "side", F.explode(F.sequence(F.lit(0).cast("long"), sides - 1)))
    queries = rows.where("open").withColumn("side", F.pmod(F.xxhash64("node", F.lit(1)), sides)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    cell = F.xxhash64("pivot", "chunk", "side")
    return occurrence_search(index.select(cell.alias("cell"), "node", "comp"), queries.select(cell.alias("cell"), "node", "comp"),
                             sets, percent, one_a_comp=True)


def linked(found: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` of the pairs that reach the threshold."""
    return found.where(100 * F.col("inter") >= percent * (F.col("n_node") + F.col("n_other") - F.col("inter"))).select(
        F.col("node").alias("a"), F.col("other").alias("b"))


def link(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, thash, leads`` of every row.

    ``n_links`` counts the links that the search found between the document's
    class of equal sets and others (at least one for each component joined);
    ``leads`` marks the one row of a component that stays if one is to stay (the
    smallest id, then the smallest hash of the text), and every row of an empty set.
    """
    every = staged(sets_of(docs, n, percent).withColumn("row", F.monotonically_increasing_id()), "join-sets")
    full = every.where("n_shingles > 0")
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash", "row")
    classes = staged(full.groupBy("set1", "set2").agg(F.min("row").alias("node"), F.min("doc_id").alias("rep"),
                                                       F.min(lead).alias("lead"), F.count(F.lit(1)).alias("n_rows"))
                     .withColumn("thash", F.col("lead.thash")), "join-classes")
    # Tables that grow with the corpus are merge-joined at every size: a small run then shows the plan of a large one.
    maybe = staged(classes.join(sieved(full).hint("merge"), F.col("node") == F.col("row")).select("node", "rep", "thash"), "join-maybe")
    signed = staged(sets_again(docs, maybe, n, lambda keys: signed_parts(keys, percent)).select(
        "node", "part", "spare", F.explode("keys").alias("sig")), "join-signed")
    kept = staged(rarest(signed), "join-kept")
    buckets = staged(kept.groupBy("sig").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select("sig", "pivot", "n"), "join-buckets")
    pairs = staged(hot_join(kept, buckets, "sig", "n").where("node <> pivot").select("node", "pivot").distinct(), "join-pairs")
    discard(signed, kept, buckets, maybe)
    edges = pair_edges(docs, classes, pairs, n, percent)
    comps = components(edges)
    links = edges.union(edges.select("b", "a")).distinct().groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n_links"))
    named = staged(classes.join(comps, "node", "left").join(links, "node", "left").withColumn("comp", F.coalesce("comp", "node")),
                   "join-named")
    first = named.groupBy("comp").agg(F.min("rep").alias("component_id"), F.min("lead").alias("first"))
    result = staged(named.join(first, "comp").select(
        F.struct("set1", "set2").alias("key"), "component_id", "n_rows", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("first.row").alias("first")), "join-result")
    discard(named, classes, pairs, edges)
    keyed = full.select("doc_id", "n_shingles", "thash", "row", F.struct("set1", "set2").alias("key"))
    cols = ["doc_id", "n_shingles", "component_id", "n_links", "thash"]
    out = hot_join(keyed, result, "key", "n_rows").select(*cols, (F.col("row") == F.col("first")).alias("leads"))
    alone = every.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn(
        "n_links", F.lit(0).cast("long")).select(*cols, F.lit(True).alias("leads"))
    return out.unionByName(alone)


def sieved(full: DataFrame) -> DataFrame:
    """``row`` of the rows that share as many first n-grams with other rows as a link needs.

    Copies count as other rows here: their one class then goes on although it may be linked with nothing else.
    """
    firsts = full.select("row", "need", F.explode("firsts").alias("gram"))
    twice = staged(firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "join-twice")
    shared = hot_join(firsts, twice, "gram", "n").groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    rows = staged(shared.where("n >= need").select("row"), "join-sieved")
    discard(twice)
    return rows


def rarest(signed: DataFrame) -> DataFrame:
    """``node, sig`` of the signatures that another node has too, without the ``spare`` most frequent of each node's part."""
    shared = staged(signed.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "join-shared")
    # A set has no more of them than parts; rows that repeat a document are one here.
    own = hot_join(signed, shared, "sig", "n").groupBy("node", "part", "spare").agg(
        F.sort_array(F.collect_set(F.struct("n", "sig"))).alias("held"))
    return own.select("node", F.explode(F.slice("held", F.lit(1), F.greatest(F.size("held") - F.col("spare"), F.lit(0)))).alias("k")).select(
        "node", "k.sig")


def pair_edges(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a, b`` between nodes that the pairs lead to."""
    involved = pairs.select("node").union(pairs.select("pivot")).distinct()
    nodes = staged(classes.join(involved, "node").select("node", "rep", "thash"), "join-nodes")
    sets = staged(sets_again(docs, nodes, n, lambda keys: [(keys, 0)]).select("node", "keys"), "join-keys")
    # One pivot for each node first; of the others only those that are in another component by then.
    low = 100 - 2 * (100 - percent)
    first = staged(pairs.groupBy("node").agg(F.min("pivot").alias("pivot")), "join-first")
    found = staged(search_pivots(first, sets, low), "join-found")
    left = with_components(pairs, components(linked(found, percent))).where("comp <> comp_pivot").select("node", "pivot").join(
        first.select("node", F.col("pivot").alias("asked")).hint("merge"), "node").where("pivot <> asked").select("node", "pivot")
    more = staged(search_pivots(staged(left, "join-left"), sets, low), "join-found")
    every = found.unionByName(more)
    edges = linked(every, percent)
    rest = staged(search_rest(pairs, every, components(edges), sets, percent), "join-rest")
    edges = staged(edges.union(linked(rest, percent)), "join-edges")
    discard(sets, nodes, first, found, more, rest)
    return edges


def one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component; rows without words all stay."""
    rows = staged(link(docs, n, percent).select("doc_id", F.col("thash").alias("key"), "leads"), "join-verdict")
    names = rows.groupBy("doc_id", "key").agg(F.max("leads").alias("leads"), F.count(F.lit(1)).alias("n"),
                                              F.min("leads").alias("all_lead"))
    gone = staged(names.where("NOT leads").select("doc_id", "key"), "join-gone")
    again = staged(names.where("leads AND NOT all_lead").select("doc_id", "key"), "join-again")
    discard(rows)
    return without(docs, text_hash(F.col("text").cast("string")), gone, again)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: All pairs that share an n-gram, counted; components by following links from each document.
ORACLE = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {N} THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + {N - 1}], ' ') for i in generate_series(1, len(w) - {N - 1})])
                 END AS s FROM words),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id
FROM sets s LEFT JOIN least l ON l.doc_id = s.doc_id
"""
