"""Merkle manifest of a dataset with a proof for every row (operator 13).

Leaves are digests of whole rows.  Each group (language) has a binary tree over
its leaves in the order of their ids, and a tree over the groups' roots, in the
order of the groups, gives the root of the dataset.

1. Leaves are hashed in the scan; only digests and ids move on.
2. Order.  Leaves are sorted by range over all tasks and numbered there; a group's
   offset in a task is the sum of its counts in earlier tasks.  A group in a third
   of all rows, or in all, so lies in many tasks.
3. Nodes.  Consecutive runs of ``2^CHUNK_BITS`` nodes become subtrees in one
   grouping; their roots are the leaves of the next one.  Each node comes out with
   its sibling's digest: the segment towards its parent.
4. Pointer jumping.  A node that holds the segment of ``d`` levels is joined with
   its ancestor ``d`` levels up, which holds the segment of the next ``d``; the two
   are concatenated and the distance doubles.  A round keeps only the nodes that
   later rounds ask for (levels that ``2d`` divides).  After ``log2(depth)``
   rounds every leaf holds its proof.  An ancestor near the root is asked for by very many nodes:
   such keys are few and broadcast (``hot_join``), all others are joined by a shuffle.
5. A proof is folded from a leaf: on which side a sibling stands follows from the
   leaf's number, where none stands from the group's size.

Defined results: null columns are ``-`` in a leaf and a null group comes first;
within a group null ids come first, rows that repeat an id are in the order of their leaf
digests (equal rows are equal leaves at different places); texts of any length are
hashed whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castline.llm.arrow import batch
from castline.llm.common import hot_join, partitions, staged, table

#: Nodes of 2^CHUNK_BITS places are hashed to one subtree by one call.
CHUNK_BITS = 10
#: Rows whose id has a crc32 that this divides are tampered with.
TAMPER = 7

NODE = "grp string, n bigint, level int, idx bigint, digest binary, seg binary"


def field(value: Column) -> Column:
    """``-`` for null, else the byte length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(n_chars: Column) -> Column:
    parts = [field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars), field(F.col("text"))]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves_of(docs: DataFrame) -> DataFrame:
    """``grp, doc_id, leaf, altered``: ``altered`` is the leaf of the row after tampering."""
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0) & F.col("n_chars").isNotNull()
    return docs.select(
        # order-preserving, and null before all others
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_of(F.col("n_chars")).alias("leaf"),
        F.when(hit, leaf_of(F.col("n_chars").cast("long") + 1)).alias("altered")).withColumn(
        "altered", F.coalesce("altered", "leaf"))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``grp``) with ``idx``, the place within the group in this order, and the group's size ``n``."""
    cols = rows.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", task int, seq bigint"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, group, seq = TaskContext.get().partitionId(), None, 0
        for b in batches:
            seqs = []
            for g in b.column("grp").to_pylist():
                seq = seq + 1 if g == group else 0      # sorted: a group is one run of a task
                group = g
                seqs.append(seq)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([task] * len(seqs), pa.int32()), pa.array(seqs, pa.int64())],
                                             names=[*cols, "task", "seq"])

    by = ["grp", *order]
    placed = staged(rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by).mapInArrow(number, schema),
                    f"{name}-placed")
    # One row for each group of a task: no more than tasks and groups together.
    held = placed.groupBy("grp", "task").agg(F.count(F.lit(1)).alias("held"))
    over = Window.partitionBy("grp")
    before = F.sum("held").over(over.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = held.select("grp", "task", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(over).alias("n"))
    return placed.join(offsets, ["grp", "task"]).select(*cols, (F.col("before") + F.col("seq")).alias("idx"), "n")


def depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``: the smallest d with 2^d >= n."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def at_level(n: Column, level: Column) -> Column:
    """How many nodes a tree of ``n`` leaves has on a level."""
    return F.call_function("shiftright", n - 1, level) + 1


def subtrees(nodes: DataFrame) -> DataFrame:
    """The nodes of one chunk's subtree below its root with their segments, and the root (segment null)."""
    schema = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
                        ("digest", pa.binary()), ("seg", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        grp, n, level, idx = (rows[c][0].as_py() for c in ("grp", "n", "level", "idx"))
        now, out = rows["digest"].to_pylist(), []
        top = level + CHUNK_BITS
        while level < top and (n - 1) >> level:      # more than one node on this level of the whole tree
            for k, own in enumerate(now):
                sibling = now[k ^ 1] if k ^ 1 < len(now) else b""
                out.append((level, idx + k, own, sibling))
            now = [hashlib.sha256("".join(x.hex() for x in now[k:k + 2]).encode()).digest() for k in range(0, len(now), 2)]
            level, idx = level + 1, idx >> 1
        out += [(level, idx + k, own, None) for k, own in enumerate(now)]
        cols = list(zip(*out, strict=True))
        return pa.Table.from_batches([batch(schema, [grp] * len(out), [n] * len(out), *map(list, cols))], schema)

    chunk = F.call_function("shiftright", F.col("idx"), F.lit(CHUNK_BITS)).alias("chunk")
    return nodes.select("grp", "n", "level", "idx", "digest").groupBy("grp", chunk).applyInArrow(run, NODE)


def trees(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Nodes below the roots of all groups' trees with their segments (``NODE``), and ``grp, n, root``.

    ``leaves`` has ``grp, n, idx, digest``.
    """
    open_, level = leaves.withColumn("level", F.lit(0)), 0
    below, roots = [], []
    while True:
        made = staged(subtrees(open_), f"{name}-nodes")
        tops = made.where("seg IS NULL")
        below.append(made.where("seg IS NOT NULL"))
        roots.append(tops.where(at_level(F.col("n"), F.col("level")) == 1).select("grp", "n", F.col("digest").alias("root")))
        level += CHUNK_BITS
        open_ = tops.where(at_level(F.col("n"), F.col("level")) > 1)
        if open_.isEmpty():
            break
    nodes, found = below[0], roots[0]
    for more, tip in zip(below[1:], roots[1:], strict=True):
        nodes, found = nodes.unionByName(more), found.unionByName(tip)
    return nodes, found


def proofs(nodes: DataFrame, name: str) -> DataFrame:
    """``grp, idx, seg`` of every leaf below a root: the siblings' digests up to the root, by pointer jumping."""
    rows = nodes.select("grp", "n", "level", "idx", "seg")
    deepest = rows.agg(F.max("n")).first()[0] or 1
    distance = 1
    while distance < (deepest - 1).bit_length():
        up = F.lit(distance)
        key = F.struct("grp", (F.col("level") + up).alias("level"), F.call_function("shiftright", F.col("idx"), up).alias("idx")).alias("key")
        asking = rows.where(F.col("level") % (2 * distance) == 0)
        beyond = F.col("level") + up >= depth(F.col("n"))
        # The nodes below an ancestor: those of its span that the tree has.
        below = F.col("level") - up
        span = F.least(F.call_function("shiftleft", F.col("idx") + 1, up), at_level(F.col("n"), below)) - F.call_function(
            "shiftleft", F.col("idx"), up)
        ancestors = rows.where(F.col("level") % (2 * distance) == distance).select(
            F.struct("grp", "level", "idx").alias("key"), F.col("seg").alias("next"), span.alias("asked"))
        longer = hot_join(asking.where(~beyond).select("*", key), ancestors, "key", "asked").select(
            "grp", "n", "level", "idx", F.concat("seg", "next").alias("seg"))
        rows = staged(longer.unionByName(asking.where(beyond)), f"{name}-jump")
        distance *= 2
    return rows.where("level = 0").select("grp", "idx", "seg")


def fold(leaf: bytes, idx: int, n: int, seg: bytes) -> tuple[bytes, list[bytes]]:
    """The root that a leaf and its siblings give, and the siblings."""
    digest, level, at, used = leaf, 0, 0, []
    while (n - 1) >> level:
        place = idx >> level
        if place % 2 == 0 and place == (n - 1) >> level:      # the last run has one node
            pair = [digest]
        else:
            used.append(seg[at:at + 32])
            at += 32
            pair = [used[-1], digest] if place % 2 else [digest, used[-1]]
        digest = hashlib.sha256("".join(x.hex() for x in pair).encode()).digest()
        level += 1
    return digest, used


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, digests as hex text."""
    leaves = staged(numbered(leaves_of(docs), ["doc_id", "leaf"], "merkle"), "merkle-leaves")
    nodes, subroots = trees(leaves.select("grp", "n", "idx", F.col("leaf").alias("digest")), "merkle")
    low = proofs(nodes, "merkle")
    # The groups' roots are the leaves of one more tree.
    tops = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("n").alias("n_own"),
                                    F.col("root").alias("digest")), ["name"], "merkle-top")
    tops = staged(tops, "merkle-top-leaves")
    top_nodes, root = trees(tops.select("grp", "n", "idx", "digest"), "merkle-top")
    high = proofs(top_nodes, "merkle-top").withColumnRenamed("seg", "up_seg")
    named = tops.join(high, ["grp", "idx"], "left").join(root.select(F.col("grp"), "root"), "grp").select(
        F.col("name").alias("grp"), F.col("n_own").alias("n_rows"), F.col("digest").alias("subroot"), "root",
        F.col("idx").alias("up_idx"), F.col("n").alias("up_n"), F.coalesce("up_seg", F.lit(b"")).alias("up_seg"))
    held = leaves.join(low.hint("merge"), ["grp", "idx"], "left").withColumn("seg", F.coalesce("seg", F.lit(b"")))
    rows = hot_join(staged(held, "merkle-proofs"), staged(named, "merkle-groups"), "grp", "n_rows")
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                        ("verified", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, leaf, altered, idx, n, seg, subroot, top, up_idx, up_n, up_seg in zip(
                    *(c.to_pylist() for c in b.columns), strict=True):
                part, siblings = fold(altered, idx, n, seg)
                folded, more = fold(part, up_idx, up_n, up_seg)
                proof = hashlib.sha256("".join(x.hex() for x in siblings + more).encode()).hexdigest()
                out.append((doc_id, leaf.hex(), subroot.hex(), top.hex(), proof, folded.hex(), folded == top))
            yield batch(schema, *(map(list, zip(*out, strict=True)) if out else [[]] * 7))

    return rows.select("doc_id", "leaf", "altered", "idx", "n", "seg", "subroot", "root", "up_idx", "up_n", "up_seg").mapInArrow(
        run, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """DuckDB SQL for the crc32 of a short ASCII text, bit by bit."""
    bits = f"flatten(list_transform(range(1, len({text}) + 1), lambda i: [ascii({text}[i]) + 256, 0, 0, 0, 0, 0, 0, 0]))"
    step = "CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END"
    # An entry of 256 and more brings in the next byte, every entry shifts by one bit.
    mixed = "CASE WHEN b >= 256 THEN xor(c, b - 256) ELSE c END"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: {step.replace('v', f'({mixed})')}), 4294967295)"


def _field(c: str) -> str:
    return f"coalesce(strlen(cast({c} AS varchar)) || ':' || {c}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: Trees level by level from the leaves; proofs by walking up one level at a time.
ORACLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('+' || lang, '') AS grp, {_leaf('n_chars')} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {_crc32('cast(doc_id AS varchar)')} % {TAMPER} = 0
              THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS altered
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
low AS (
  SELECT grp, 0 AS level, idx, leaf AS h, count(*) OVER (PARTITION BY grp) AS n FROM placed
  UNION ALL
  SELECT grp, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY grp, level, idx // 2),
low_nodes AS MATERIALIZED (SELECT * FROM low),
subs AS MATERIALIZED (
  SELECT grp, h, level, row_number() OVER (ORDER BY encode(grp)) - 1 AS idx FROM low_nodes WHERE n = 1),
high AS (
  SELECT 0 AS level, idx, h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM high WHERE n > 1 GROUP BY level, idx // 2),
-- levels of the upper tree follow those of the group's own
nodes AS MATERIALIZED (
  SELECT grp, level, idx, h, n FROM low_nodes WHERE n > 1
  UNION ALL SELECT s.grp, s.level + u.level, u.idx, u.h, u.n FROM subs s, high u),
tiers AS (SELECT DISTINCT grp, level FROM nodes),
steps AS (
  SELECT p.doc_id, p.grp, p.leaf, 0 AS level, CASE WHEN s.level = 0 THEN s.idx ELSE p.idx END AS place,
         p.altered AS folded, '' AS proof
  FROM placed p JOIN subs s ON s.grp = p.grp
  UNION ALL
  SELECT t.doc_id, t.grp, t.leaf, t.level + 1, CASE WHEN t.level + 1 = s.level THEN s.idx ELSE t.place // 2 END,
         sha256(CASE WHEN b.h IS NULL THEN t.folded WHEN t.place % 2 = 1 THEN b.h || t.folded ELSE t.folded || b.h END),
         t.proof || coalesce(b.h, '')
  FROM steps t JOIN subs s ON s.grp = t.grp JOIN tiers i ON i.grp = t.grp AND i.level = t.level
  LEFT JOIN nodes b ON b.grp = t.grp AND b.level = t.level AND b.idx = xor(t.place, 1)),
top AS (SELECT h AS root, level FROM high WHERE n = 1)
SELECT t.doc_id, t.leaf, s.h AS subroot, top.root, sha256(t.proof) AS proof_sha256, t.folded AS folded_root,
       t.folded = top.root AS verified
FROM steps t JOIN subs s ON s.grp = t.grp JOIN top ON t.level = s.level + top.level
"""
