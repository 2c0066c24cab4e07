"""Removal of repeated byte strings by suffix arrays (operator 12).

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else, in
the same document or another, is removed.

1. Anchors.  The smallest hash among the grams of ``GRAM`` bytes of a window of
   ``LENGTH`` bytes (the leftmost of equal ones) is the window's anchor: equal windows have equal
   anchors at one offset.  The windows of one anchor are consecutive; together
   they are a piece of fewer than ``2 LENGTH`` bytes.
2. Pieces whose anchor occurs once in the corpus go.  Equal pieces become one with a count, so
   copies of any number are one from here on; each string of a piece that occurs twice is repeated.
3. Suffix arrays decide about the pieces that occur once.  The distinct pieces of an anchor are joined to
   a text, and the suffix arrays of the texts are built by linear grouping construction (``suffix_groups``),
   many texts of a task together.  Neighbours that share ``LENGTH`` symbols within their pieces start with a
   string that occurs twice.  Before that a piece is cut to the blocks of ``WIDTHS[0]`` offsets whose common bytes
   another piece of the anchor has too: all its repeated strings lie there.
4. Anchors with more than ``CELL`` distinct pieces (a passage that very many documents share in
   different surroundings) are divided first: their windows by blocks of ``WIDTHS``
   offsets, and a block by the bytes that all its windows have in common.  Equal windows stay
   together, and at a width of 1 all pieces of a group are equal: no text
   grows with the number of documents.
5. Starts of repeated strings go back to all documents that hold the piece, joined so that a
   hot piece's rows don't move (``hot_join``), and each document drops what they cover.

Anchors and pieces are named by 64-bit hashes each; strings are compared byte by byte in
the suffix arrays.

Defined results: null text is empty; matches never cross documents; rows that repeat
id and text are occurrences of their own, so a row that occurs twice keeps only what is in
no string of ``LENGTH`` bytes; a text under ``LENGTH`` bytes stays whole; null ids
take part; texts of any length are cut whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import hot_join, staged, table
from castline.llm.ngram_join import mix, powers
from castline.llm.suffix_groups import Texts, common_prefixes, ragged, suffix_arrays

LENGTH = 400
GRAM = 64
#: Distinct pieces of an anchor that are sorted together.
CELL = 32
#: Offsets of a block, level by level.
WIDTHS = (64, 8, 1)
#: Pieces that a task sorts at a time.
BATCH = 2_000
#: Windows of a text that are looked at at once; a place among them fits PLACE_BITS.
SLAB = 1 << 22
PLACE_BITS = 23

_BYTES = np.random.default_rng(20_261).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
DOC = ["doc_id", "thash"]
PIECE = "anchor bigint, piece bigint, at int, body binary, n bigint"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    blocks = -(-len(values) // width)
    full = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    full[:len(values)] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def pieces_of(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``anchor, piece, first, at, count`` of a text's pieces: hashes, the first window's start, its offset
    from the anchor, and the number of windows."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    b = np.frombuffer(data, np.uint8)
    out = []
    for begin in range(0, len(b) - length + 1, SLAB):
        part = b[begin:begin + SLAB + length - 1]
        up, down = powers(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * up, dtype=np.uint64, out=total[1:])
        hashes = mix((total[gram:] - total[:-gram]) * down[:len(part) - gram + 1])
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = sliding_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        where = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        count = np.diff(np.append(first, len(where)))
        anchor, at = hashes[where[first]], first - where[first]
        content = (total[first + count - 1 + length] - total[first]) * down[first]
        piece = mix(mix(content) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + count.astype(np.uint64))
        out.append((anchor, piece, first + begin, at, count))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("thash"), text.alias("text"))


def uses_of(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, thash, anchor, piece, first, at, windows`` of all pieces of all rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("thash", pa.int64()), ("anchor", pa.int64()), ("piece", pa.int64()),
                        ("first", pa.int64()), ("at", pa.int32()), ("windows", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            found = [pieces_of(t.encode(), length, gram) for t in b.column(2).to_pylist()]
            own = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            anchor, piece, first, at, count = (np.concatenate(x) for x in zip(*found, strict=True))
            yield batch(schema, b.column(0).take(own), b.column(1).take(own), pa.array(anchor.view(np.int64)),
                        pa.array(piece.view(np.int64)), pa.array(first), pa.array(at.astype(np.int32)), pa.array(count.astype(np.int32)))

    return rows.mapInArrow(run, "doc_id bigint, thash bigint, anchor bigint, piece bigint, first bigint, at int, windows int")


def same_doc(a: str, b: str) -> F.Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.thash") == F.col(f"{b}.thash"))


def bodies(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """The bytes of distinct pieces (``PIECE``), each from the one document named in ``kinds``."""
    wanted = kinds.groupBy(*[F.col(f"of.{c}").alias(c) for c in DOC]).agg(
        F.collect_list(F.struct("anchor", "piece", "of.first", "of.at", "of.windows", "n")).alias("wanted"))
    schema = pa.schema([("anchor", pa.int64()), ("piece", pa.int64()), ("at", pa.int32()), ("body", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            out = []
            for text, wants in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = text.encode()
                out += [(w["anchor"], w["piece"], w["at"], data[w["first"]:w["first"] + w["windows"] - 1 + length], w["n"]) for w in wants]
            yield batch(schema, *(list(x) for x in zip(*out, strict=True)))

    # Both sides grow with the corpus: a merge join at every size, so that a small run shows the plan of a large one.
    joined = rows.alias("t").join(wanted.hint("merge").alias("w"), same_doc("t", "w"))
    return joined.select("text", "wanted").mapInArrow(run, PIECE)


def repeated_starts(texts: list[list[tuple[int, bytes]]], length: int) -> list[list[list[tuple[int, int]]]]:
    """For each piece ``(at, body)`` of each text the runs (first, last) of offsets at which a string starts that
    occurs twice in the text."""
    t = Texts([[body for _, body in pieces] for pieces in texts])
    starts = np.array(t.pieces, np.int64).reshape(-1, 2)
    first, stop = starts[:, 0], starts.sum(1) - length + 1
    order = suffix_arrays(t)
    shared = common_prefixes(t, order, first, stop)
    left = np.zeros(len(t.symbols), bool)               # a whole string starts here, within its piece
    left[ragged(first, np.maximum(stop - first, 0))] = True
    twice = np.zeros(len(t.symbols), bool)
    hit = np.flatnonzero((shared >= length) & left[order])
    twice[order[hit]] = True
    twice[order[hit - 1]] = True                        # it shares the string, so the string is whole there too
    out, k = [], 0
    for pieces in texts:
        out.append([])
        for at, _ in pieces:
            marks = twice[first[k]:stop[k]]
            k += 1
            edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
            out[-1].append([(at + int(a), at + int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)])
    return out


def blocks_of(at: int, body: bytes, width: int, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """``number, first, last`` offset and the bytes that all windows have in common, for each block of offsets of a piece."""
    last = at + len(body) - length
    for block in range(at // width, last // width + 1):
        core = body[block * width + width - 1 - at:block * width + length - at]
        yield block, max(at, block * width), min(last, block * width + width - 1), core


def cut_to_shared(pieces: list[tuple[int, bytes]], width: int, length: int) -> list[tuple[int, bytes] | None]:
    """The pieces of one anchor without the blocks at their ends that no other piece can share; None if nothing is left."""
    every = [[(low, high, xxhash.xxh3_128_digest(core) + block.to_bytes(8, "little", signed=True))
              for block, low, high, core in blocks_of(at, body, width, length)] for at, body in pieces]
    seen = Counter(name for own in every for _, _, name in own)
    out: list[tuple[int, bytes] | None] = []
    for (at, body), own in zip(pieces, every, strict=True):
        held = [(low, high) for low, high, name in own if seen[name] > 1]
        out.append((held[0][0], body[held[0][0] - at:held[-1][1] - at + length]) if held else None)
    return out


RUNS = "array<struct<a:int,b:int>>"


def sorted_cells(pieces: DataFrame, length: int) -> DataFrame:
    """``anchor, piece, runs``: the repeated starts in pieces that occur once, of anchors with few distinct pieces."""
    schema = pa.schema([("anchor", pa.int64()), ("piece", pa.int64()),
                        ("runs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])
    width = min(WIDTHS[0], length // 4)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("anchor", "ascending"), ("piece", "ascending")])
        columns = [rows[c].to_pylist() for c in ("anchor", "piece", "at", "body", "n")]
        texts: list[list[tuple[int, int, int, bytes]]] = []      # (piece, n, at, body)
        for _, own in groupby(zip(*columns, strict=True), key=lambda r: r[0]):
            own = [next(same) for _, same in groupby(own, key=lambda r: r[1])]      # a repeated document gives its pieces twice
            cut = cut_to_shared([(at, body) for _, _, at, body, _ in own], width, length)
            left = [(r[0], r[1], r[4], *c) for r, c in zip(own, cut, strict=True) if c is not None]
            if any(r[2] == 1 for r in left):
                texts.append(left)
        texts.sort(key=lambda rs: sum(len(r[4]) for r in rs))      # texts that advance together end together
        out, held, size = [], [], 0
        for k, rs in enumerate(texts):
            held.append(rs)
            size += len(rs)
            if size >= BATCH or k == len(texts) - 1:
                found = repeated_starts([[(r[3], r[4]) for r in rs_] for rs_ in held], length)
                out += [(r[0], r[1], [{"a": a, "b": b} for a, b in runs]) for rs_, own in zip(held, found, strict=True)
                        for r, runs in zip(rs_, own, strict=True) if runs and r[2] == 1]
                held, size = [], 0
        return pa.Table.from_batches([batch(schema, *(map(list, zip(*out, strict=True)) if out else [[]] * 3))], schema)

    bins = max(pieces.count() // BATCH, 1)
    return pieces.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(bins))).applyInArrow(run, f"anchor bigint, piece bigint, runs {RUNS}")


def whole_runs(pieces: DataFrame, last: F.Column) -> DataFrame:
    """``anchor, piece, runs`` of the pieces that occur more than once: every string of theirs is repeated."""
    run = F.struct(F.col("at").cast("int").alias("a"), last.cast("int").alias("b"))
    return pieces.where("n > 1").select("anchor", "piece", F.array(run).alias("runs"))


def undecided(pieces: DataFrame, name: str) -> DataFrame:
    """The distinct ``pieces`` of anchors that have one that occurs once and another one."""
    groups = staged(pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
                    .where("kinds > 1 AND least = 1").select("anchor", "kinds"), name)
    return hot_join(pieces, groups, "anchor", "kinds").select(pieces.columns)


def divided(pieces: DataFrame, width: int, length: int) -> DataFrame:
    """``up_anchor, up_piece`` and the smaller pieces (``PIECE``) of each piece: one for each block of ``width`` offsets."""
    schema = pa.schema([("up_anchor", pa.int64()), ("up_piece", pa.int64()), ("anchor", pa.int64()), ("piece", pa.int64()),
                        ("at", pa.int32()), ("body", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for anchor, piece, at, body, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for block, first, last, core in blocks_of(at, body, width, length):
                    own = body[first - at:last - at + length]
                    out.append((anchor, piece, named(core, anchor, width, block), named(own, first, last), first, own, n))
            yield batch(schema, *(list(x) for x in zip(*out, strict=True)))

    return pieces.select("anchor", "piece", "at", "body", "n").mapInArrow(run, f"up_anchor bigint, up_piece bigint, {PIECE}")


def named(content: bytes, *numbers: int) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(content + repr(numbers).encode()), "little", signed=True)


def repeats(pieces: DataFrame, length: int, widths: tuple[int, ...]) -> DataFrame:
    """``anchor, piece, runs`` of the ``pieces`` (``PIECE``, staged) that occur once and hold repeated starts.

    The windows of a block have bytes in common if the block is narrower than a window.
    """
    groups = staged(pieces.groupBy("anchor").agg(F.countDistinct("piece").alias("kinds"), F.count(F.lit(1)).alias("rows"))
                    .where(F.col("kinds") > CELL).select("anchor", "rows"), "suffix-large")
    if not widths or groups.isEmpty():
        return staged(sorted_cells(pieces, length), "suffix-runs")
    # Fewer than one anchor in CELL pieces is large; those with most rows are broadcast, the others joined.
    small = pieces.join(groups.select("anchor").hint("merge"), "anchor", "left_anti")
    large = hot_join(pieces, groups, "anchor", "rows")
    parts = staged(divided(large, widths[0], length), "suffix-parts")
    held = staged(parts.groupBy("anchor").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("rows")).where("uses > 1")
                  .select("anchor", "rows"), "suffix-held")
    kept = staged(hot_join(parts, held, "anchor", "rows").select(parts.columns), "suffix-kept")
    distinct = staged(kept.groupBy("anchor", "piece").agg(
        F.first("at").alias("at"), F.first("body").alias("body"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")),
        "suffix-distinct")
    plain = distinct.select("anchor", "piece", "at", "body", "n")
    found = whole_runs(plain, F.col("at") + F.octet_length("body") - length).unionByName(
        repeats(staged(undecided(plain, "suffix-open"), "suffix-undecided"), length, widths[1:]))
    sizes = distinct.select("anchor", "piece", "rows").join(found.hint("merge"), ["anchor", "piece"]).select(
        F.struct("anchor", "piece").alias("key"), "rows", "runs")
    back = hot_join(kept.select("up_anchor", "up_piece", F.struct("anchor", "piece").alias("key")), staged(sizes, "suffix-back"),
                    "key", "rows")
    up = back.groupBy(F.col("up_anchor").alias("anchor"), F.col("up_piece").alias("piece")).agg(
        F.flatten(F.collect_set("runs")).alias("runs"))
    return staged(staged(sorted_cells(staged(small, "suffix-small"), length), "suffix-runs").unionByName(up), "suffix-all")


def covered(docs_rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, thash, spans``: byte ranges to remove (they may overlap), of each document with any."""
    uses = staged(uses_of(docs_rows, length, gram), "suffix-uses")
    many = staged(uses.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_anchor")).where("n_anchor > 1"), "suffix-anchors")
    shared = staged(hot_join(uses, many, "anchor", "n_anchor").drop("n_anchor"), "suffix-shared")
    kinds = staged(shared.groupBy("anchor", "piece").agg(
        F.min(F.struct(*DOC, "first", "at", "windows")).alias("of"), F.count(F.lit(1)).alias("n")), "suffix-kinds")
    pieces = staged(bodies(docs_rows, undecided(kinds, "suffix-open"), length), "suffix-pieces")
    # A piece that was divided although it occurs more than once is whole anyway.
    runs = whole_runs(kinds.select("anchor", "piece", "n", "of.at", "of.windows"), F.col("at") + F.col("windows") - 1).unionByName(
        repeats(pieces, length, tuple(w for w in WIDTHS if w <= length // 4)).join(
            kinds.where("n > 1").select("anchor", "piece").hint("merge"), ["anchor", "piece"], "left_anti"))
    sized = staged(kinds.select("anchor", "piece", "n").join(runs.hint("merge"), ["anchor", "piece"]).select(
        F.struct("anchor", "piece").alias("key"), "n", "runs"), "suffix-sized")
    hits = hot_join(shared.select(*DOC, "first", "at", F.struct("anchor", "piece").alias("key")), sized, "key", "n")
    base = F.col("first") - F.col("at")
    spans = F.transform("runs", lambda r: F.struct((base + r["a"]).alias("a"), (base + r["b"] + length).alias("b")))
    return hits.select(*DOC, spans.alias("spans")).groupBy(*DOC).agg(F.flatten(F.collect_set("spans")).alias("spans"))


def without_spans(data: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    if not spans:
        return data, 0
    kept, end, runs = [], 0, 0
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if a > end or not runs:
            kept.append(data[end:a])
            runs += 1
        end = max(end, b)
    return b"".join([*kept, data[end:]]), runs


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` holds the remaining bytes."""
    return _cut(docs, length, gram, "kept binary", pa.binary(), lambda data: data)


def _cut(docs: DataFrame, length: int, gram: int, column: str, kind: pa.DataType, view) -> DataFrame:
    rows = texts_of(docs)
    spans = staged(covered(rows, length, gram), "suffix-spans")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        (column.split()[0], kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            out = []
            for doc_id, text, gone in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = text.encode()
                left, runs = without_spans(data, gone)
                out.append((doc_id, len(data), len(data) - len(left), runs, view(left)))
            yield batch(schema, *(list(x) for x in zip(*out, strict=True)))

    joined = rows.alias("t").join(spans.hint("merge").alias("s"), same_doc("t", "s"), "left")
    return joined.select("t.doc_id", "text", "spans").mapInArrow(
        run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {column}")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(table(spark, sf_dir, "documents"), LENGTH, GRAM, "kept_sha256 string", pa.string(),
                lambda data: hashlib.sha256(data).hexdigest())
