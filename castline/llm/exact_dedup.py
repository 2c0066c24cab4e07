"""Exact dedup on a cuckoo-filter index (operator 10).

The index is a table of shards in the shared folder.  A shard holds the live
digests that fall to it (the key table, ordered by home bucket) and a cuckoo
filter over them: 4 slots of 16-bit fingerprints a bucket, partial-key hashing,
so that a digest can be inserted, looked up and deleted.  A batch of documents
goes through four steps:

1. digest: SHA-256 of the text after each run of white space became one space;
2. pre-aggregation by digest (map-side combine): a group of copies of any size
   reaches the index as one row ``(digest, smallest id, count)``;
3. per shard, each digest asks the filter.  No hit: it is new and inserted.
   A hit is verified against the stored keys of its two buckets, so a
   fingerprint collision never drops a document.  A filter that overflows is
   rebuilt at twice the size from the stored keys;
4. the new shards are written as the next version of the index and a pointer is
   moved; decisions join back to the documents (hot groups by a bounded broadcast).

Shards are sized by the number of distinct digests, so no task holds more than
about ``KEYS_PER_SHARD`` of them; when an index has outgrown that, it is written
anew with more shards from its stored keys.

Defined results: null text counts as empty; rows that share a text keep the
smallest non-null id (all ids null: the id of the group is null and its rows
count as kept); an empty table gives an empty result; repeated rows of one id
and text are each returned (``distinct_kept`` gives one); other columns of the
input are ignored by ``decide`` and passed through by ``distinct_kept``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.common import hot_join, staged, table, without
from castline.session import scratch_path

KEYS_PER_SHARD = 8_000
SLOTS = 4
MAX_KICKS = 200

KEY_SCHEMA = "shard int, digest string, keep_id bigint, group_size bigint"
FILTER_SCHEMA = "shard int, n_buckets int, n_keys bigint, slots binary"
STEP_SCHEMA = KEY_SCHEMA + ", is_key boolean, is_new boolean, n_buckets int, slots binary"


class Overflow(Exception):
    """No free slot within MAX_KICKS moves."""


class CuckooFilter:
    """Cuckoo filter over hex digests (partial-key cuckoo hashing)."""

    def __init__(self, n_buckets: int, slots: np.ndarray | None = None) -> None:
        if n_buckets & (n_buckets - 1):
            raise ValueError("n_buckets is a power of two")
        self.n = n_buckets
        flat = np.zeros(n_buckets * SLOTS, np.uint16) if slots is None else slots
        self.rows: list[list[int]] = [[int(x) for x in r if x] for r in flat.reshape(-1, SLOTS)]

    @staticmethod
    def sized(n_keys: int) -> CuckooFilter:
        n = 1
        while n * SLOTS * 0.9 < max(n_keys, 1):
            n *= 2
        return CuckooFilter(n)

    def place(self, digest: str) -> tuple[int, int, int]:
        """Fingerprint (never 0) and the two buckets of a digest."""
        fp = int(digest[16:20], 16) or 1
        home = int(digest[20:28], 16) & (self.n - 1)
        return fp, home, self.other(home, fp)

    def other(self, bucket: int, fp: int) -> int:
        return bucket ^ ((fp * 0x5BD1E995 >> 7) & (self.n - 1))

    def might_have(self, digest: str) -> bool:
        fp, a, b = self.place(digest)
        return fp in self.rows[a] or fp in self.rows[b]

    def insert(self, digest: str) -> None:
        fp, a, b = self.place(digest)
        for at in (a, b):
            if len(self.rows[at]) < SLOTS:
                self.rows[at].append(fp)
                return
        at, moves = b, []
        for kick in range(MAX_KICKS):
            k = (fp + kick) % SLOTS
            moves.append((at, k, self.rows[at][k]))
            self.rows[at][k], fp = fp, self.rows[at][k]
            at = self.other(at, fp)
            if len(self.rows[at]) < SLOTS:
                self.rows[at].append(fp)
                return
        for at, k, old in reversed(moves):   # leave the filter as it was
            self.rows[at][k] = old
        raise Overflow

    def delete(self, digest: str) -> bool:
        """Remove one fingerprint of a digest that is known to be stored."""
        fp, a, b = self.place(digest)
        for at in (a, b):
            if fp in self.rows[at]:
                self.rows[at].remove(fp)
                return True
        return False

    def slots(self) -> bytes:
        out = np.zeros((self.n, SLOTS), np.uint16)
        for i, r in enumerate(self.rows):
            out[i, : len(r)] = r
        return out.tobytes()


class Shard:
    """One shard in a task: the filter, and the keys by home bucket."""

    def __init__(self, n_buckets: int = 1, slots: bytes | None = None) -> None:
        self.filter = CuckooFilter(n_buckets, None if slots is None else np.frombuffer(slots, np.uint16))
        self.content: dict[int, dict[str, list[int | None]]] = {}

    def store(self, digest: str, keep_id: int | None, size: int) -> None:
        home = self.filter.place(digest)[1]
        self.content.setdefault(home, {})[digest] = [keep_id, size]

    def find(self, digest: str) -> list[int | None] | None:
        """The stored entry; the filter answers first, a hit is verified."""
        if not self.filter.might_have(digest):
            return None
        return self.content.get(self.filter.place(digest)[1], {}).get(digest)

    def insert(self, digest: str, keep_id: int | None, size: int) -> None:
        while True:
            try:
                self.filter.insert(digest)
                break
            except Overflow:
                self.resize()
        self.store(digest, keep_id, size)

    def resize(self) -> None:
        """Twice the buckets, filled again from the stored keys."""
        entries, n = list(self.entries()), self.filter.n
        while True:
            n *= 2
            self.filter, self.content = CuckooFilter(n), {}
            try:
                for digest, _, _ in entries:
                    self.filter.insert(digest)
            except Overflow:
                continue
            break
        for digest, keep, size in entries:
            self.store(digest, keep, size)

    def remove(self, digest: str) -> None:
        self.filter.delete(digest)
        self.content[self.filter.place(digest)[1]].pop(digest)

    def entries(self) -> Iterator[tuple[str, int | None, int]]:
        for home in sorted(self.content):
            for digest, (keep, size) in self.content[home].items():
                yield digest, keep, size


def smallest(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _none(x):
    return None if x is None or pd.isna(x) else int(x)


def _open(stored: pd.DataFrame) -> Shard:
    """The shard from its stored rows: one row with the filter, the others are keys."""
    head = stored[~stored["is_key"]]
    shard = Shard(int(head["n_buckets"].iloc[0]), head["slots"].iloc[0]) if len(head) else Shard()
    for digest, keep, size in stored.loc[stored["is_key"], ["digest", "keep_id", "group_size"]].itertuples(index=False):
        shard.store(digest, _none(keep), int(size))
    return shard


def _rows(number: int, shard: Shard, new: set[str]) -> pd.DataFrame:
    out = pd.DataFrame([(number, d, k, s, True, d in new, None, None) for d, k, s in shard.entries()]
                       + [(number, None, None, sum(map(len, shard.content.values())), False, False,
                           shard.filter.n, shard.filter.slots())],
                       columns=["shard", "digest", "keep_id", "group_size", "is_key", "is_new", "n_buckets", "slots"])
    out["keep_id"] = out["keep_id"].astype("Int64")
    out["n_buckets"] = out["n_buckets"].astype("Int32")
    return out


def _insert_shard(key: tuple, batch: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    shard, new = _open(stored), set()
    for digest, first, size in batch[["digest", "first_id", "n"]].itertuples(index=False):
        entry = shard.find(digest)
        if entry is None:
            shard.insert(digest, _none(first), int(size))
            new.add(digest)
        else:
            entry[0], entry[1] = smallest(entry[0], _none(first)), entry[1] + int(size)
    return _rows(int(key[0]), shard, new)


def _delete_shard(key: tuple, batch: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    shard = _open(stored)
    for digest in batch["digest"]:
        if shard.find(digest) is not None:
            shard.remove(digest)
    return _rows(int(key[0]), shard, set())


def digests_of(text_col: str):
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest`` of every row; null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), digests_of(text_col).alias("digest"))


class CuckooIndex:
    """Live digests in versioned shard tables under one folder."""

    def __init__(self, spark: SparkSession, path: str, keys_per_shard: int = KEYS_PER_SHARD) -> None:
        self.spark, self.path, self.keys_per_shard = spark, path.rstrip("/"), keys_per_shard
        self.version, self.n_shards, self.n_keys = 0, 0, 0
        self._load()

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/current")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _load(self) -> None:
        path, fs = self._fs()
        if fs.exists(path):
            head = json.loads("".join(r[0] for r in self.spark.read.text(path.toString()).collect()))
            self.version, self.n_shards, self.n_keys = head["version"], head["n_shards"], head["n_keys"]

    def _publish(self, version: int, n_shards: int, n_keys: int) -> None:
        """Move the pointer once the whole version is written."""
        path, fs = self._fs()
        out = fs.create(path, True)
        out.write(bytearray(json.dumps({"version": version, "n_shards": n_shards, "n_keys": n_keys}).encode()))
        out.close()
        self.version, self.n_shards, self.n_keys = version, n_shards, n_keys

    def shards(self, version: int | None = None) -> DataFrame:
        v = self.version if version is None else version
        if not v:
            return self.spark.createDataFrame([], STEP_SCHEMA)
        return self.spark.read.schema(STEP_SCHEMA).parquet(f"{self.path}/v{v}")

    def keys(self) -> DataFrame:
        return self.shards().where("is_key").select("digest", "keep_id", "group_size", "is_new")

    def _shard_of(self, n: int):
        return F.pmod(F.conv(F.substring("digest", 1, 14), 16, 10).cast("long"), F.lit(n)).cast("int")

    def _step(self, batch: DataFrame, n_shards: int, fn) -> None:
        stored = self.shards()
        if n_shards != self.n_shards:   # outgrown: new shards from the stored keys, filters are rebuilt
            stored = stored.where("is_key").withColumn("shard", self._shard_of(n_shards))
            if self.n_shards:
                stored = stored.groupBy("shard").applyInPandas(_rebuild_shard, STEP_SCHEMA)
        version = self.version + 1
        out = (batch.withColumn("shard", self._shard_of(n_shards)).groupBy("shard")
               .cogroup(stored.groupBy("shard")).applyInPandas(fn, STEP_SCHEMA))
        out.write.mode("overwrite").parquet(f"{self.path}/v{version}")
        n_keys = self.shards(version).where("is_key").count()
        self._publish(version, n_shards, n_keys)

    def insert(self, rows: DataFrame) -> DataFrame:
        """Insert ``doc_id, digest`` rows; returns the live keys with their decisions."""
        batch = staged(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")),
                       "cuckoo-batch")
        need = self.n_keys + batch.count()
        n = max(self.n_shards, 1)
        while n * self.keys_per_shard < need:
            n *= 2
        self._step(batch, n, _insert_shard)
        return self.keys()

    def delete(self, rows: DataFrame) -> None:
        """Forget digests (``digest`` column); unknown ones change nothing."""
        if self.n_shards:
            self._step(rows.select("digest").distinct(), self.n_shards, _delete_shard)


def _rebuild_shard(key: tuple, stored: pd.DataFrame) -> pd.DataFrame:
    shard = Shard()
    for digest, keep, size in stored[["digest", "keep_id", "group_size"]].itertuples(index=False):
        shard.insert(digest, _none(keep), int(size))
    return _rows(int(key[0]), shard, set())


def decide(docs: DataFrame, index: CuckooIndex | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Without ``index`` an index of its own is built in the shared folder.
    """
    spark = docs.sparkSession
    index = index or CuckooIndex(spark, scratch_path(spark, "cuckoo"))
    rows = staged(digests(docs), "digests")
    keys = index.insert(rows).select("digest", "keep_id", "group_size")
    return hot_join(rows, keys, "digest", "group_size").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def distinct_kept(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies: one row of each group of equal texts.

    A row goes when its group keeps another id; of rows that repeat both id
    and text one stays.  Rows with a null id are told apart by their text.
    """
    verdict = staged(decide(docs).withColumnRenamed("text_sha256", "key"), "dedup-verdict")
    gone = staged(verdict.where("NOT kept").select("doc_id", "key").distinct(), "dedup-gone")
    again = staged(verdict.where("kept").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("doc_id", "key"), "dedup-again")
    return without(docs, digests_of("text"), gone, again)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM n
"""
