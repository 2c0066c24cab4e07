"""Secret scans (operator 9).

Three base patterns report on their own (assignments, access keys, long hex
runs).  Beyond them, parts of a credential that are too weak alone are linked:
an identifier (user, account, client id, access key), a secret (random-looking
word of any length from 20, by entropy and by how letters and digits alternate) and an endpoint (URL or
host setting).  Parts are disjoint: of two that overlap the longer one stays, so that no part is its own
complement.  Parts of one document with at most ``SCOPE`` code points between them, not counting those of
other parts, are joined by interval, as a running window over the part table, which
emits no pairs.  Of weak parts,

* a secret counts when an identifier or an access key is in its scope,
* an identifier counts when a secret (weak or base) is in its scope,
* an endpoint counts when both are in its scope.

Defined results: null text counts as empty and has no spans; repeated rows are
scanned and linked each on its own; a weak part that overlaps a base span is
not reported again; an empty table gives an empty result; other columns are
ignored.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import sha256_hex, staged, table

SCOPE = 240
#: Order of the kinds in a list of spans; the first three are the base.
KINDS = ["assign", "access", "hex", "ident", "secret", "endpoint"]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
IDENT = re.compile(r"""\b(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?"""
                   r"""[A-Za-z0-9_.@+-]{3,}""", re.I | re.A)
IDENT_WORDS = ("user", "login", "account", "client", "access")
ENDPOINT = re.compile(r"""\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp)://[^\s"'<>|]{3,}"""
                      r"""|\b(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+""",
                      re.I | re.A)
ENDPOINT_WORDS = ("://", "host", "endpoint", "server")
WEAK = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")

Span = tuple[str, int, int]

#: Bits a character from which a word looks random: with digits among its letters, and of letters alone from
#: LETTERS_LENGTH on.
MIXED_BITS, LETTERS_BITS, LETTERS_LENGTH = 3.0, 4.1, 32
#: Changes between letters and digits from which digits are among the letters.
ALTERNATIONS = 4
TURN = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def entropy(word: str) -> float:
    """Bits a character by the word's own frequencies."""
    return sum(n * math.log2(len(word) / n) for n in Counter(word).values()) / len(word)


def random_looking(word: str) -> bool:
    """Digits among the letters, or all of upper case, lower case and digits, or many different letters."""
    classes = sum(bool(re.search(c, word)) for c in ("[0-9]", "[A-Z]", "[a-z]"))
    if classes == 3 or len(TURN.findall(word)) >= ALTERNATIONS:
        return entropy(word) >= MIXED_BITS
    return len(word) >= LETTERS_LENGTH and not re.search("[_/-]", word) and entropy(word) >= LETTERS_BITS


def disjoint(parts: list[Span]) -> list[Span]:
    """Of parts that overlap the longest stays (of equally long ones the first, then the first kind); by start."""
    kept: list[Span] = []
    for part in sorted(parts, key=lambda p: (p[1] - p[2], p[1], KINDS.index(p[0]))):
        at = bisect_right(kept, part[1], key=lambda p: p[1])
        if (at == 0 or kept[at - 1][2] <= part[1]) and (at == len(kept) or kept[at][1] >= part[2]):
            kept.insert(at, part)
    return kept


def base_spans(text: str, low: str) -> list[Span]:
    """Base matches, leftmost without overlap for each kind, by start and kind."""
    out: list[Span] = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of hex digits is a match of its own; of at least 24 is all that counts.
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def weak_parts(text: str, low: str, base: list[Span]) -> list[Span]:
    """Identifiers, endpoints and random-looking words that overlap neither each other nor a base span."""
    out: list[Span] = []
    if any(w in low for w in IDENT_WORDS):
        out += [("ident", m.start(), m.end()) for m in IDENT.finditer(text)]
    if not out and not any(k == "access" for k, _, _ in base):
        return []           # no identifier at all: nothing can be linked
    out += [("secret", m.start(), m.end()) for m in WEAK.finditer(text) if random_looking(m[0])]
    if any(w in low for w in ENDPOINT_WORDS):
        out += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    free, k = [], 0
    for kind, s, e in sorted(out, key=lambda x: x[1]):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if k == len(taken) or taken[k][0] >= e:
            free.append((kind, s, e))
    return disjoint(free)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def placed(spans: list[Span]) -> list[str]:
    """Each span with its place: the code points before it that are in no span, so that a long one pushes none away."""
    out, inside, last = [], 0, 0
    for kind, s, e in sorted(spans, key=lambda x: x[1:]):
        out.append(f"{kind}:{s}:{e}:{max(s, last) - inside}")
        inside += max(e - max(s, last), 0)
        last = max(e, last)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Base counts, base spans and the parts that linking needs, one row per document; text does not leave the task."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_assign", "n_access", "n_hex")],
                        ("base_sha256", pa.string()), ("base_spans", pa.string()), ("parts", pa.list_(pa.string()))])

    def one(text: str | None) -> tuple:
        text = text or ""
        low = text.lower()
        base = base_spans(text, low)
        weak = weak_parts(text, low, base)
        kinds = [k for k, _, _ in base]
        line = joined(base)
        return (*map(kinds.count, KINDS[:3]), sha256_hex(line.encode()), line,
                placed(base + weak) if weak else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [one(t) for t in b.column(1).to_pylist()]
            yield batch(schema, b.column(0), *(map(list, zip(*rows, strict=True)) if rows else [[]] * 6))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, base_spans string, "
             "parts array<string>")


def link(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts whose complement lies within ``scope``: of ``row, kind, start, end, at`` those that count.

    Two parts are in scope when their places (``at``) are at most ``scope`` apart.
    The window is over one document's parts and keeps the furthest place so far of
    a part's complement, not pairs.
    """
    near = Window.partitionBy("row").orderBy("at").rangeBetween(Window.unboundedPreceding, scope)
    has = {name: F.max(F.when(F.col("kind").isin(*kinds), F.col("at"))).over(near) >= F.col("at") - scope for name, kinds in
           {"id": ("ident", "access"), "key": ("secret", "assign", "hex")}.items()}
    flagged = parts.withColumns({f"has_{k}": v for k, v in has.items()})
    return flagged.where(F.expr("(kind = 'secret' AND has_id) OR (kind = 'ident' AND has_key) "
                                "OR (kind = 'endpoint' AND has_id AND has_key)")).select("row", "kind", "start", "end")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked`` of every document."""
    rows = staged(scan(docs).withColumn("row", F.monotonically_increasing_id()), "secret-parts")
    piece = F.split("part", ":")
    parts = rows.where("size(parts) > 0").select("row", F.explode("parts").alias("part")).select(
        "row", piece[0].alias("kind"), piece[1].cast("int").alias("start"), piece[2].cast("int").alias("end"),
        piece[3].cast("int").alias("at"))
    linked = link(parts).groupBy("row").agg(
        F.collect_list(F.concat_ws(":", "kind", "start", "end")).alias("linked"))
    rank = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*map(F.lit, range(len(KINDS)))))
    every = F.concat(F.filter(F.split("base_spans", ","), lambda s: s != ""), "linked")
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"), rank[F.split(s, ":")[0]].alias("rank"), s.alias("span"))))
    spans = F.when(F.col("linked").isNull(), F.col("base_spans")).otherwise(
        F.array_join(F.transform(ordered, lambda s: s["span"]), ","))
    return rows.drop("parts").join(linked, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"),
        F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
