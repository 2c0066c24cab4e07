"""Byte-level BPE encoding and decoding (operator 4).

The vocabulary's tokens, each byte mapped to the Latin-1 character of the same
number, form an Aho-Corasick automaton.  A piece of text is encoded from left to
right with the longest token that starts at a position; a token may follow
another only if the exact merges would leave the two side by side, which is
memoised for each pair; where none fits, the next shorter prefix token is tried,
and where none is left the last token is taken back and that position is never
entered again.  Each position is left at most once for each token that starts
there, so the work is linear in the piece.

Documents are handled whole in Arrow batches on the executors; equal chunks of
text between white space are encoded once a worker (a bounded cache that is
emptied when full, which changes no result).

Defined results: null text counts as empty and gives no tokens; empty text the
same; any Unicode text round-trips; texts of any length are encoded whole; null ids pass
through; repeated rows are each encoded, and equal texts get equal ids; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from castline.llm.arrow import slices
from castline.llm.common import table

#: Entries of a worker's caches (chunks: two generations of CACHE); they bound memory only.
CACHE = 400_000
PAIRS = 1_000_000
#: Unicode's White_Space, which the tokenizer's ``\s`` stands for.
WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_exactly(ranks: dict[bytes, int], data: bytes, below: int = 1 << 62) -> list[int]:
    """The definition: join the adjacent pair of the lowest rank (under ``below``) until none is left."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and rank < below and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Splitter:
    """The tokenizer's split pattern, with the character classes of the tokenizer's library.

    Characters that are not in Python's Unicode tables are asked of the library
    once each, and stand-ins of their class take their place while splitting.
    """

    STAND_IN = {"L": "ª", "N": "²", "S": " ", "O": "¦"}

    def __init__(self, pattern: str) -> None:
        import regex
        self.pattern = pattern
        self.rx = regex.compile(pattern.replace(r"[^\s", "[^" + WS).replace(r"\s", f"[{WS}]").replace(r"\S", f"[^{WS}]"))
        self.odd: dict[str, str] = {}

    def stand_in(self, c: str) -> str:
        if c not in self.odd:
            import tiktoken
            probes = {c: 256 + i for i, c in enumerate(k + c for k in "q7!")}
            ranks = {bytes([i]): i for i in range(256)} | {k.encode(): v for k, v in probes.items()}
            asked = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            joins = [len(asked.encode_ordinary(k + c)) == 1 for k in "q7!"]
            self.odd[c] = self.STAND_IN["LNO"[joins.index(True)] if any(joins) else "S"]
        return self.odd[c]

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not any(unicodedata.category(c) == "Cn" for c in text):
            return self.rx.findall(text)
        shadow = "".join(self.stand_in(c) if unicodedata.category(c) == "Cn" else c for c in text)
        return [text[m.start():m.end()] for m in self.rx.finditer(shadow)]


class ByteBPE:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import ahocorasick
        self.ranks = ranks
        self.splitter = Splitter(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # White-space runs exactly as the pattern cuts them; what stands between is independent of its neighbours.
        self.chunk_rx = re.compile(f" ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+")

    def split_of(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes a token; a single byte is (token, token)."""
        known = self.halves.get(token)
        if known is None:
            data = self.bytes_of[token]
            if len(data) == 1:
                known = (token, token)
            else:
                parts = merge_exactly(self.ranks, data, below=token)
                if len(parts) != 2:   # no merge reaches it: it never comes out of exact merges
                    known = (-1, -1)
                else:
                    known = (parts[0], parts[1])
            self.halves[token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Would the exact merges of both tokens' bytes end with just these two?

        Undoes merges from the latest on: at each step the two tokens that touch
        the border must not have merged before either was itself complete.
        """
        names, ranks, limit = self.bytes_of, self.ranks, 1 << 62
        while True:
            both = ranks.get(names[left] + names[right])
            if both is not None and both < limit:
                return False
            if left > right:
                half = self.split_of(left)
                limit = left
                if half[0] != half[1] or len(names[left]) > 1:
                    if half[1] < 0:
                        return False
                    left = half[1]
                    continue
                half = self.split_of(right)
                limit = right + 1
                if len(names[right]) == 1:
                    return True
                if half[0] < 0:
                    return False
                right = half[0]
            else:
                limit = right + 1
                if len(names[right]) > 1:
                    half = self.split_of(right)
                    if half[0] < 0:
                        return False
                    right = half[0]
                    continue
                limit = left
                if len(names[left]) == 1:
                    return True
                half = self.split_of(left)
                if half[1] < 0:
                    return False
                left = half[1]

    def prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of a token; -1 if none."""
        known = self.shorter.get(token)
        if known is None:
            data = self.bytes_of[token]
            known = next((self.ranks[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ranks), -1)
            self.shorter[token] = known
        return known

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size, pairs = len(data), self.pairs
        longest = [0] * (size + 1)
        lengths = [0] * (size + 1)
        for end, (length, token) in self.automaton.iter(data.decode("latin-1")):
            start = end + 1 - length      # ends come in order: the last match of a start is its longest
            longest[start], lengths[start] = token, length
        shut: set[int] = set()
        out: list[int] = []
        at, last, nxt, length = 0, -1, longest[0], lengths[0]
        while at < size:
            token = nxt
            while token >= 0:
                end = at + length
                if end not in shut:
                    if last < 0:
                        break
                    key = last << 24 | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self.compatible(last, token)
                    if fits:
                        break
                token = self.prefix(token)
                length = len(self.bytes_of[token]) if token >= 0 else 0
            if token >= 0:
                out.append(token)
                at, last = end, token
                nxt, length = longest[at], lengths[at]
            else:
                shut.add(at)
                nxt = out.pop()
                length = len(self.bytes_of[nxt])
                at -= length
                last = out[-1] if out else -1
        return out

    def chunk(self, text: str) -> bytes:
        """The ids of text between white space; remembered if it is short."""
        if len(self.young) >= CACHE:      # two generations: what was used lately stays
            self.old, self.young = self.young, {}
        ids = self.old.get(text)
        if ids is None:
            pieces = self.splitter.pieces(text)
            if len(pieces) > 1:           # the word of "word," is often known
                ids = b"".join([self.young.get(p) or self.chunk_of([p]) for p in pieces])
            else:
                ids = self.chunk_of(pieces)
        if len(text) <= 64:
            self.young[text] = ids
        return ids

    def chunk_of(self, pieces: list[str]) -> bytes:
        return array("I", [i for p in pieces for i in self.piece(p.encode())]).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        chunks = self.chunk_rx.findall(text)
        out = list(map(self.young.get, chunks))
        if None in out:
            out = [self.chunk(c) if ids is None else ids for c, ids in zip(chunks, out, strict=True)]
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_open: dict[tuple[str, str], ByteBPE] = {}


def encoder(path: str, pattern: str) -> ByteBPE:
    """One encoder a worker process and rank file."""
    if (path, pattern) not in _open:
        _open[path, pattern] = ByteBPE(load_ranks(path), pattern)
    return _open[path, pattern]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row; ``with_ids`` adds ``ids`` (binary)."""
    if path is None or pattern is None:
        import public_tokenizers
        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), *([("ids", pa.binary())] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for b in slices(batches):
            ids = [bpe.encode(t or "") for t in b.column(1).to_pylist()]
            cols = [b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array(ids, pa.binary())] if with_ids else [])], schema=schema)

    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                           + ", ids binary" * with_ids)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
