"""Operators 11 to 13 against brute force and on edge rows."""
import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from castline.llm import merkle, suffix_dedup, whitening
from castline.llm.suffix_groups import Texts, common_prefixes, suffix_arrays
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.conftest import pairs_of


def documents(folder):
    return duckdb.connect().execute(
        f"select doc_id, text, lang, source, n_chars from '{folder}/documents.parquet' order by 1").fetchall()


# ------------------------------------------------------------- 11 whitening
def plain_whitening(vectors, k=16):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    z = fit - s / n
    v = z.T @ z / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ axes / np.sqrt(values), values / v.trace()


def check_whitening(rows, vectors, k=16):
    n, deviation, white, explained = plain_whitening(vectors, k)
    got = sorted(rows, key=lambda r: (r["vec_id"], r["component"]))
    assert [r["component"] for r in got] == [c for _ in vectors for c in range(1, k + 1)]
    assert {r["n"] for r in got} == {n}
    assert [r["deviation"] for r in got[::k]] == deviation.tolist()
    own = np.array([r["whitened"] for r in got]).reshape(-1, k)
    assert np.allclose(own * np.sign((own * white).sum(0)), white, atol=1e-7)
    assert np.allclose([r["explained"] for r in got[:k]], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_of_the_embeddings(spark):
    vectors = duckdb.connect().execute(f"select embedding from '{SF_SMALL}/embeddings.parquet' order by vec_id").fetchall()
    check_whitening(E.queries()["op11_embedding_whitening"](spark, SF_SMALL).collect(), [v for v, in vectors])


def test_whitening_with_copies_and_scales_apart(spark):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(300, 20)) * np.geomspace(1e5, 2, 20)
    vectors = [*base.tolist(), *[base[0].tolist()] * 200]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    check_whitening(whitening.whiten(rows).collect(), vectors)


def test_whitening_of_collinear_and_constant_dimensions(spark):
    rnd = np.random.default_rng(4)
    a = rnd.integers(-50, 50, (200, 3))
    vectors = np.column_stack([a, a[:, 0], np.full(200, 7), a[:, 1] + a[:, 2], 2 * a[:, 2]]) / 64
    rows = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    got = whitening.whiten(rows).collect()
    assert {r["component"] for r in got} == {1, 2, 3}
    assert sum({r["component"]: r["explained"] for r in got}.values()) == pytest.approx(1)
    assert got[0]["identity_error"] < 1e-9


def test_whitening_edges(spark):
    schema = "vec_id bigint, embedding array<float>, label int, x int, n string"
    ok = [1.0, 2.0]
    data = [(1, ok), (2, None), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("inf"), 1.0]), (None, [3.0, 1.0]),
            (6, []), (7, [1.0]), (8, ok), (8, ok), (9, [0.0, 0.5])]
    rows = spark.createDataFrame([(*r, 0, 1, "n") for r in data], schema)
    got = whitening.whiten(rows).collect()
    assert collections.Counter(r["vec_id"] for r in got) == {1: 2, None: 2, 8: 4, 9: 2}
    assert {r["n"] for r in got} == {3}
    assert whitening.whiten(rows.limit(0)).collect() == []
    assert whitening.whiten(rows.where("vec_id in (1, 8)")).collect() == []      # one distinct vector has no component
    huge = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} == {None}


def test_jacobi_on_the_factor_is_accurate_for_graded_matrices():
    d = np.geomspace(1, 1e-9, 12)
    q = np.random.default_rng(5).normal(size=(12, 12)) * 0.05 + np.eye(12)
    a = (q * d) @ (q * d).T
    values, vectors = whitening.components_of(a)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose((vectors * values) @ vectors.T, a, rtol=0, atol=1e-14 * values[0])
    assert np.allclose(values, np.linalg.svd(q * d, compute_uv=False)[:len(values)] ** 2, rtol=1e-6)


# ------------------------------------------------------------ 12 suffix dedup
@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=20) | st.binary(max_size=8).map(lambda b: b.decode("latin1")), min_size=1, max_size=3),
                min_size=1, max_size=5))
def test_suffix_arrays_and_common_prefixes(groups):
    t = Texts([[p.encode("latin1") for p in g] for g in groups])
    order = suffix_arrays(t)
    shared = common_prefixes(t, order)
    for start, length in zip(t.start.tolist(), t.length.tolist(), strict=True):
        a, b = start + 1, start + length
        s = t.symbols[a:b].tolist()
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert (order[a:b] - a).tolist() == want
        for k, (x, y) in enumerate(zip(want, want[1:], strict=False)):
            same = next(j for j in range(len(s)) if s[x + j] != s[y + j])
            assert shared[a + k + 1] == same


def plain_removal(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:len(t)] > 0
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def check_removal(spark, docs, length, gram):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in suffix_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), length, gram).collect()}
    want = dict(zip([i for i, _ in docs], plain_removal([(t or "").encode() for _, t in docs], length), strict=True))
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def shared_passages(rnd, n):
    pool = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.randint(5, 60))) for _ in range(12)]

    def noise(letters, size):
        return "".join(rnd.choice(letters) for _ in range(size))

    docs = [(i, "".join(rnd.choice(pool) if rnd.random() < 0.7 else noise("xyzw", rnd.randint(1, 30)) for _ in range(rnd.randint(0, 14))))
            for i in range(n)]
    docs += [(500, "a" * 300), (501, "ab" * 200), (502, None), (503, ""), (504, docs[5][1]), (505, "a" * 39), (506, "a" * 40)]
    return docs + [(600 + i, noise("mnop", 30) + "".join(pool[2:5]) + noise("mnop", 30)) for i in range(n)]


@pytest.mark.parametrize("cell", [32, 2])
def test_suffix_removal_is_exact_with_and_without_divided_anchors(spark, monkeypatch, cell):
    monkeypatch.setattr(suffix_dedup, "CELL", cell)      # 2: blocks of 8 and of 1 offsets are reached
    check_removal(spark, shared_passages(random.Random(cell), 90), 40, 8)


def test_windows_have_the_same_anchors_in_slabs_of_any_size(monkeypatch):
    rnd = random.Random(5)
    data = "".join(t or "" for _, t in shared_passages(rnd, 20)).encode()

    def anchors():
        out = {}
        for anchor, _, first, at, count in zip(*suffix_dedup.pieces_of(data, 40, 8), strict=True):
            out |= {int(first) + k: (int(anchor), int(at) + k) for k in range(int(count))}
        return out

    whole = anchors()
    assert sorted(whole) == list(range(len(data) - 39))
    monkeypatch.setattr(suffix_dedup, "SLAB", 64)
    assert anchors() == whole


def test_suffix_removal_on_documents(spark):
    docs = documents(SF_SMALL)
    want = plain_removal([(d[1] or "").encode() for d in docs], 400)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in E.queries()["op12_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == {d[0]: (a, b, c, hashlib.sha256(kept).hexdigest()) for d, (a, b, c, kept) in zip(docs, want, strict=True)}


def test_suffix_edges(docs, odd_docs, no_docs):
    got = suffix_dedup.dedup(docs)
    rows = pairs_of(got, *got.columns)
    by = {(r["doc_id"], r["n_bytes"]): r for r in got.collect()}
    assert len(rows) == docs.count()
    assert pairs_of(suffix_dedup.dedup(odd_docs), *got.columns) == rows
    assert suffix_dedup.dedup(no_docs).collect() == []
    empty = hashlib.sha256(b"").hexdigest()
    for (doc_id, n), r in by.items():
        if doc_id in (4, 5):
            assert (r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) == (0, 0, empty)
        if doc_id in (7, 8):      # 8 is 7 with a tail; the tail stays but for what repeats with it
            assert n - 10 <= r["n_removed"] <= n and r["n_spans"] == 1
        if doc_id in (1, 2) and n > 400:      # equal texts and repeated rows go as a whole
            assert r["n_removed"] == n


# ---------------------------------------------------------------- 13 merkle
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(docs):
    """doc_id, text, lang, source, n_chars -> a row of the contract each."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, more=0):
        n = d[4] + more if d[4] is not None else None
        return h(field(d[0]), field(d[3]), field(d[2]), field(n), field(d[1]))

    def tree(level, paths):
        while len(level) > 1:
            for i, path in enumerate(paths):
                k = path["at"]
                if k ^ 1 < len(level):
                    path["steps"].append((level[k ^ 1], k % 2))
                else:
                    path["steps"].append(None)
                path["at"] //= 2
            level = [h(*level[k:k + 2]) for k in range(0, len(level), 2)]
        return level[0] if level else None

    groups = collections.defaultdict(list)
    for d in docs:
        groups[d[2]].append(d)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, paths = [], {}
    for g in order:
        rows = sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        own = [{"doc": d, "at": k, "steps": []} for k, d in enumerate(rows)]
        paths[g] = own
        subs.append(tree([leaf(d) for d in rows], own))
    tops = [{"at": k, "steps": []} for k in range(len(order))]
    root = tree(subs, tops)
    out = []
    for k, g in enumerate(order):
        for p in paths[g]:
            d, steps = p["doc"], p["steps"] + tops[k]["steps"]
            now = leaf(d, 1 if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 else 0)
            for s in steps:
                now = h(now) if s is None else h(s[0], now) if s[1] else h(now, s[0])
            out.append((d[0], leaf(d), subs[k], root, h(*[s[0] for s in steps if s]), now, now == root))
    return sorted(out, key=repr)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("bits", [10, 2, 1])
def test_manifest_by_chunks_of_any_size(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle, "CHUNK_BITS", bits)
    docs = documents(SF_SMALL)
    got = E.queries()["op13_merkle_manifest"](spark, SF_SMALL)
    assert pairs_of(got, *MANIFEST) == plain_manifest(docs)


def test_manifest_on_documents_of_the_next_size(spark):
    got = E.queries()["op13_merkle_manifest"](spark, SF_ORACLE)
    assert pairs_of(got, *MANIFEST) == plain_manifest(documents(SF_ORACLE))


def test_manifest_edges(docs, odd_docs, no_docs):
    plain = plain_manifest([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()])
    assert pairs_of(merkle.manifest(docs), *MANIFEST) == plain
    assert pairs_of(merkle.manifest(odd_docs), *MANIFEST) == plain
    assert merkle.manifest(no_docs).collect() == []
    one = docs.where("doc_id = 9")
    got = merkle.manifest(one).collect()[0]
    assert got["root"] == got["subroot"] == got["leaf"] and got["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pairs_of(merkle.manifest(one), *MANIFEST) == plain_manifest(
        [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in one.collect()])


def test_tampered_rows_are_the_only_ones_that_fail(spark):
    rows = E.queries()["op13_merkle_manifest"](spark, SF_SMALL).collect()
    hit = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
    assert {r["doc_id"] for r in rows if not r["verified"]} == hit and hit
