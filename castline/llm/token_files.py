"""Token ids in binary files with Elias-Fano boundaries (operator 5).

A file holds the concatenated ids of consecutive documents as one array of fixed
width, and two Elias-Fano sequences: the end of each document in that array, and
the document ids (ascending).  An Elias-Fano sequence of ``n`` values under ``u``
takes about ``2 + log2(u/n)`` bits a value: the low bits packed, the high bits in
unary, and one 32-bit count for each block of 512 unary bits, by which ``get``
finds a value without decoding the rest.  There is no table of 64-bit offsets.

Layout, little-endian: magic ``EFID1``, a JSON header of fixed width that gives
the size of each section, then the sections.

Writing is one range shuffle by id: each task sorts its range, encodes it and
writes files of at most ``FILE_IDS`` ids.  A task writes under a name of its own
attempt and reports the name in its output row; only names in the manifest are
ever read, so retried and speculative tasks leave nothing that counts.  A file's
offset is the sum of the counts of the files before it, one row a file.

Equal stretches of text between ASCII white space are encoded once a worker; the
tokenizer drops white space, so ids of a text are those of its stretches in
order.  The cache is bounded and changes no result.  Whether a tokenizer is of that kind is read from its
file; texts of others are encoded whole.

Defined results: null text counts as empty and gives the end id alone; null
document ids come first; rows that share an id follow each other in the order of
a hash of their text; an empty table writes no file and gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import gc
import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castline.llm.arrow import batch, sized
from castline.llm.common import partitions, staged, table
from castline.session import scratch_path

END_ID = 2
#: Ids in a file at most (one document more at the end).
FILE_IDS = 1 << 24
CACHE = 400_000
BLOCK = 512
#: Values that are packed, and boundaries that are selected, at a time (a multiple of eight).
RUN = 1 << 13
#: How the tokenizers whose stretches are encoded apart treat a text: in lower case, without white space, runs of letters, single
#: digits and runs of other characters each on their own.  Texts of any other tokenizer are encoded whole.
APART = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
MAGIC, HEAD = b"EFID1", 512
MANIFEST = "shard int, seq int, path string, n_docs bigint, n_ids bigint"


class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return EliasFano(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        steps = np.arange(bits, dtype=np.uint64)
        # A multiple of eight values at a time, so that no matrix of all bits is held.
        low = [np.packbits(((v[at:at + RUN, None] >> steps) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
               for at in range(0, n, RUN)]
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = -(-(int(ones[-1]) + 1) // BLOCK) * BLOCK
        unary = np.zeros(size, np.uint8)
        unary[ones] = 1
        ranks = np.concatenate([[0], np.cumsum(unary.reshape(-1, BLOCK).sum(1, dtype=np.int64))[:-1]]).astype(np.uint32)
        return EliasFano(n, bits, np.concatenate(low), np.packbits(unary, bitorder="little"), ranks)

    def select(self, i: int) -> int:
        """Position of the i-th one of the unary part."""
        block = int(np.searchsorted(self.ranks, i, "right")) - 1
        bits = np.unpackbits(self.high[block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits)[i - int(self.ranks[block])])

    def get(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low = 0
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            low |= (int(self.low[at >> 3]) >> (at & 7) & 1) << k
        return (self.select(i) - i) << self.low_bits | low

    def selected(self, first: int, stop: int) -> np.ndarray:
        """The values ``first`` to ``stop - 1``, by a select of the blocks that hold them."""
        stop = min(stop, self.n)
        if first >= stop:
            return np.zeros(0, np.uint64)
        begin, end = np.searchsorted(self.ranks, [first, stop - 1], "right") - 1
        unary = np.unpackbits(self.high[begin * BLOCK // 8:(end + 1) * BLOCK // 8], bitorder="little")
        skip = int(self.ranks[begin])
        high = np.flatnonzero(unary)[first - skip:stop - skip] + begin * BLOCK - np.arange(first, stop)
        if not self.low_bits:
            return high.astype(np.uint64)
        at = first * self.low_bits
        bits = np.unpackbits(self.low[at >> 3:-(-stop * self.low_bits // 8)], bitorder="little")[at & 7:]
        bits = bits[:(stop - first) * self.low_bits].reshape(stop - first, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return high.astype(np.uint64) << np.uint64(self.low_bits) | low

    def all(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(self.selected(at, at + RUN) for at in range(0, self.n, RUN))])

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.ranks.astype("<u4").tobytes()]


class TokenFile:
    """A file opened from its bytes."""

    def __init__(self, data: bytes) -> None:
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        head = json.loads(data[len(MAGIC):HEAD])
        self.width, self.base, self.n_null = head["width"], head["base"], head["n_null"]
        view, at, cut = memoryview(data), HEAD, []
        for size in head["sizes"]:
            cut.append(view[at:at + size])
            at += size
        self.ids = np.frombuffer(cut[0], f"<u{self.width}")

        def seq(n: int, bits: int, parts: list) -> EliasFano:
            return EliasFano(n, bits, np.frombuffer(parts[0], np.uint8), np.frombuffer(parts[1], np.uint8),
                             np.frombuffer(parts[2], "<u4"))

        self.ends = seq(head["n_docs"], head["end_bits"], cut[1:4])
        self.docs = seq(head["n_docs"] - self.n_null, head["doc_bits"], cut[4:7])

    @staticmethod
    def pack(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
        """Bytes of a file; ``doc_ids`` ascend, nulls first."""
        known = [d for d in doc_ids if d is not None]
        base = known[0] if known else 0
        ends = EliasFano.of(np.cumsum([len(i) // width for i in ids]))
        docs = EliasFano.of(np.array([d - base for d in known], np.uint64))
        parts = [b"".join(ids), *ends.parts(), *docs.parts()]
        head = MAGIC + json.dumps({"n_docs": len(ids), "n_null": len(ids) - len(known), "width": width, "base": base,
                                   "end_bits": ends.low_bits, "doc_bits": docs.low_bits,
                                   "sizes": [len(p) for p in parts]}).encode()
        return b"".join([head.ljust(HEAD), *parts])

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, by two selects."""
        return self.ids[self.ends.get(i - 1) if i else 0:self.ends.get(i)]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.base + self.docs.get(i - self.n_null)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.base + int(d) for d in self.docs.all()]


def filesystem(uri: str):
    """File system and path of a shared folder as the executors reach it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_file(uri: str, data: bytes) -> None:
    store, path = filesystem(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data)


def read_file(uri: str) -> bytes:
    store, path = filesystem(uri)
    with store.open_input_file(path) as f:
        return f.read()


class Encoder:
    """A tokenizer of the tokenizers library with a cache of stretches between white space."""

    #: ASCII marks of which a run before or after a letter or digit is a piece of its own (no apostrophe).
    MARKS = b'.,;:!?*#$%&|()[]{}"=+/@^~'

    def __init__(self, path: str) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        self.apart = all(told.get(k) == v for k, v in APART.items())
        # It begins with a mark, so that a search goes from mark to mark.
        self.after = re.compile(rb"([.,;:!?](?<=[a-z0-9].)[.,;:!?]*)(?!\S)")
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def stretches(self, text: str | None) -> list[bytes]:
        """A text between white space, in lower case and with the marks after a word apart (both ASCII only)."""
        data = (text or "").encode()
        if b"<|" not in data:             # else it may hold a special token, which case would change
            data = self.after.sub(rb" \1", data.lower())
        return data.split()

    def words(self, stretch: bytes) -> list[bytes]:
        """What to ask the tokenizer for: other marks around a word apart."""
        if not stretch.isascii() or b"<|" in stretch:
            return [stretch]
        head = stretch.rstrip(self.MARKS)
        body = head.lstrip(self.MARKS)
        if len(body) == len(stretch) or not body or not body[:1].isalnum() or not body[-1:].isalnum():
            return [stretch]
        return [w for w in (head[:len(head) - len(body)], body, stretch[len(head):]) if w]

    def learn(self, stretches: set[bytes]) -> dict[bytes, bytes]:
        """The ids of stretches that are not known yet; short ones are remembered."""
        if len(self.young) >= CACHE:      # two generations: what was used lately stays
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out, ask, parts = {}, set(), {}
        for s in stretches:
            ids = old.get(s)
            if ids is not None:
                out[s] = ids
                continue
            ws = self.words(s)
            if len(ws) == 1:
                ask.add(s)
            else:
                parts[s] = ws
                ask.update(w for w in ws if w not in young and w not in old)
        fresh = list(ask)
        got = self.tokenizer.encode_batch_fast([w.decode() for w in fresh], add_special_tokens=False)
        out.update((w, array(self.code, e.ids).tobytes()) for w, e in zip(fresh, got, strict=True))
        for s, ws in parts.items():
            out[s] = b"".join([out.get(w) or young.get(w) or old.get(w) or b"" for w in ws])
        young.update((s, ids) for s, ids in out.items() if len(s) <= 64)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.apart:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [array(self.code, e.ids).tobytes() for e in found]
        on = gc.isenabled()
        gc.disable()      # no cycles are made here, and each pass would go through the whole cache
        try:
            return self._joined(texts)
        finally:
            if on:
                gc.enable()

    def _joined(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.stretches(t) for t in texts]
        ids = [list(map(self.young.get, words)) for words in cut]
        gaps = list(map(gaps_of, ids))
        unknown = {words[i] for words, at in zip(cut, gaps, strict=True) for i in at}
        if unknown:
            new = self.learn(unknown)
            for words, found, at in zip(cut, ids, gaps, strict=True):
                for i in at:
                    found[i] = new[words[i]]
        return list(map(b"".join, ids))


def gaps_of(found: list[bytes | None]) -> list[int]:
    """Where a list holds None."""
    at, i = [], -1
    for _ in range(found.count(None)):
        i = found.index(None, i + 1)
        at.append(i)
    return at


_open: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """Write the documents' ids to files in ``folder``; returns the manifest with each file's ``start``."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    schema = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = b"" if end_id is None else np.array([end_id], f"<u{enc.width}").tobytes()
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{shard:06d}-{seq:04d}-{uuid.uuid4().hex[:12]}.efid"
            write_file(path, TokenFile.pack(doc_ids, ids, enc.width))
            return batch(schema, [shard], [seq], [path], [len(ids)], [held // enc.width])

        for b in sized(batches, 1):      # stretches of more texts are asked for once
            for doc_id, own in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                doc_ids.append(doc_id)
                ids.append(own + end)
                held += len(ids[-1])
                if held >= FILE_IDS * enc.width:
                    yield flush()
                    doc_ids, ids, held, seq = [], [], 0, seq + 1
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    files = staged(rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
                   .mapInArrow(run, MANIFEST), "token-files")
    before = Window.orderBy("shard", "seq").rowsBetween(Window.unboundedPreceding, -1)   # one row a file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = TokenFile(read_file(path))
                names, last = f.doc_ids(), 0
                for at in range(0, f.ends.n, RUN):
                    ends = f.ends.selected(at, at + RUN).astype(np.int64)
                    begins = np.concatenate([[last], ends[:-1]])
                    last = int(ends[-1])
                    crcs = [zlib.crc32(f.ids[a:e].astype("<u4").tobytes()) for a, e in zip(begins, ends, strict=True)]
                    yield batch(schema, names[at:at + RUN], begins + start, ends - begins, crcs)

    n = max(manifest.count(), 1)
    return manifest.select("path", "start").repartition(n).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = staged(write(table(spark, sf_dir, "documents"), scratch_path(spark, "efid")), "token-manifest")
    return read(manifest)
