"""Defined results on edge rows, the empty table and clashing column names, for every operator and stage."""
import pytest

import corpus_pipeline
from castline.llm import (byte_bpe, exact_dedup, html_text, langid, line_dedup, mixing, ngram_join, quality, secrets,
                          token_files)
from castline.session import scratch_path
from tests.llm.conftest import pairs_of

N = 18   # rows of edge_rows()


def token_rows(docs):
    return token_files.read(token_files.write(docs, scratch_path(docs.sparkSession, "efid-test")))


OPERATORS = {
    "line_dedup": line_dedup.dedup_lines, "ngram_join": ngram_join.link, "byte_bpe": byte_bpe.encode, "token_files": token_rows,
    "langid": langid.identify, "mixing": mixing.mix, "secrets": secrets.find, "exact_dedup": exact_dedup.decide,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(name, docs, odd_docs, no_docs):
    got = OPERATORS[name](docs)
    rows = pairs_of(got, *got.columns)
    assert len(rows) >= N if name == "mixing" else len(rows) == N
    odd = OPERATORS[name](odd_docs)
    assert odd.columns == got.columns
    assert pairs_of(odd, *got.columns) == rows
    assert OPERATORS[name](no_docs).collect() == []


def test_quality(docs, odd_docs, no_docs, labels):
    got = quality.judge(docs, labels)
    rows = pairs_of(got, *got.columns)
    assert len(rows) == N
    assert pairs_of(quality.judge(odd_docs, labels), *got.columns) == rows
    assert quality.judge(no_docs, labels).collect() == []
    unlabelled = quality.judge(docs, labels.limit(0))
    assert all(r["kept"] == (not r["base_failed"]) for r in unlabelled.collect())


def test_stages_keep_columns_and_do_not_crash(spark, odd_docs, no_docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (odd_docs, no_docs):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            if name != "byte_bpe":
                assert out.columns == rows.columns
                assert set(pairs_of(out, *out.columns)) <= set(pairs_of(rows, *rows.columns))
                rows = out
            else:
                assert out.count() == rows.count()


def test_each_filter_stage_on_edge_rows(odd_docs):
    exact = exact_dedup.distinct_kept(odd_docs)
    ids = [r["doc_id"] for r in exact.collect()]
    # 1 stays once with each text, 2 and 3 go; null, empty and white-space texts: the empty one is a group of its own
    assert sorted(i for i in ids if i is not None) == [1, 1, 4, 6, 7, 8, 9, 10, 11, 12]
    assert ids.count(None) == 1     # both rows "text without an id" are one; the null text equals doc 4's
    near = ngram_join.one_of_each(odd_docs)
    ids = sorted(r["doc_id"] for r in near.where("doc_id IS NOT NULL").collect())
    assert ids == [1, 1, 4, 5, 6, 7, 9, 10, 12]     # 8 is near 7; 11 equals 10 in lower case
    assert near.where("doc_id IS NULL").count() == 2


def test_pages_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (None, "u", "<article><p>a &amp; b<p>c"), (3, "u", "<p>"),
            (4, "u", "<script>x"), (5, "u", "<div>" * 3000 + "deep text" + "</div>" * 10), (6, "u", "a" * 300_000)]
    pages = spark.createDataFrame([(*r, 0, 1) for r in rows], "page_id bigint, url string, html string, n_chars int, lines int")
    got = {(r["page_id"], r["text"][:20], r["n_chars"]) for r in html_text.extract(pages).collect()}
    assert got == {(1, "", 0), (2, "", 0), (3, "", 0), (None, "a & b\n\nc", 8), (4, "", 0), (5, "deep text", 9),
                   (6, "a" * 20, 300_000)}
    assert html_text.extract(pages.limit(0)).collect() == []
