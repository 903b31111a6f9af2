"""Nulls, empty texts, repeated rows, extra columns and empty tables, for every operator."""

import pytest

from tidepool.llm import embedding, fingerprint, html, ngram_join, packing, pieces, quality, spans, suffix_lm, toxicity
from tidepool.llm.queries import vocabulary

LONG = "word " * 3000 + "end."
ROWS = [(1, None, "x"), (2, "", "x"), (3, "One two three four five six.", None), (3, "One two three four five six.", None), (4, "one TWO three four five six.", "y"), (5, "<|endoftext|> <s> ▁ \u0000 日本 😀 É", "y"), (6, LONG, "z"), (None, "no id at all", "z"), (7, "\n \t ", "z")]
LABELS = [(1, 0, 1, "a"), (3, 1, 0, "b"), (4, 1, None, "c"), (6, None, 1, "d"), (99, 1, 1, "e")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, score string").withColumnRenamed("score", "component_id")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int, text string")


def operators(labels):
    bpe, sp = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return {
        "ngram_join": lambda d: ngram_join.ngram_join(d, 4, 85),
        "one_of_each": ngram_join.one_of_each,
        "quality": lambda d: quality.quality(d, labels),
        "good_only": lambda d: quality.good_only(d, labels),
        "suffix_lm": suffix_lm.score,
        "edits": fingerprint.edits,
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "without_toxic": lambda d: toxicity.without_toxic(d, labels),
        "round_trip": lambda d: pieces.round_trip(d, sp),
        "encode": lambda d: pieces.encode(d, sp),
        "dedup_spans": spans.dedup_spans,
        "without_repeats": spans.without_repeats,
        "pack": lambda d: packing.pack(d, bpe, with_ids=True),
    }


SAME_ROWS = {"ngram_join", "quality", "suffix_lm", "edits", "toxicity", "round_trip", "encode", "dedup_spans", "without_repeats"}


@pytest.mark.parametrize("name", sorted(operators(None)))
def test_odd_rows(docs, labels, name):
    out = operators(labels)[name](docs).toPandas()
    if name in SAME_ROWS:
        assert len(out) == len(ROWS)
        assert sorted(out.doc_id.fillna(-1).astype(int)) == sorted(-1 if r[0] is None else r[0] for r in ROWS)


@pytest.mark.parametrize("name", sorted(operators(None)))
def test_empty_table(docs, labels, name):
    assert operators(labels)[name](docs.limit(0)).count() == 0


def test_columns_survive_in_stages(docs, labels):
    for f in (lambda d: toxicity.without_toxic(d, labels), lambda d: quality.good_only(d, labels), ngram_join.one_of_each, spans.without_repeats):
        assert f(docs).columns == docs.columns


def test_html_odd_pages(spark):
    pages = [(1, "u", None, 1), (2, None, "", 2), (3, "u", "<p>", 3), (4, "u", "plain text with no tag at all and a < b", 4), (4, "u", "<article><p>a&nbsp;&lt;b<br>c <!-- x", 5), (5, "u", "<script>never closed <p>x</p>", 6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text int")
    out = html.extract(df).orderBy("page_id", "text").toPandas()
    assert len(out) == 6
    assert list(out.text[:3]) == ["", "", ""] and out.text.iloc[-1] == ""
    assert "a <b c" in set(out.text)
    assert html.extract(df.limit(0)).count() == 0


def test_embedding_odd_rows(spark):
    e = [1.0, 2.0, 0.0]
    rows = [(1, e, 1), (2, e, 1), (3, [2.0, 4.0, 0.0], 1), (4, e, 2), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, float("nan"), 0.0], 1), (9, [1.0, None, 0.0], 1), (10, e, None), (11, [1.0, 2.0], 1), (2, e, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = embedding.near_dedup(df).toPandas()
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.itertuples()}
    assert got[1] == got[2] == got[3] == (3, 1)
    assert all(got[i] == (0, i) for i in range(4, 12))
    assert len(out) == len(rows) and embedding.near_dedup(df.limit(0)).count() == 0


def test_ngram_defined_cases(docs):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs, 4, 85).collect()}
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 3, 3) in got and (4, 3, 3) in got


def test_ngram_join_repeated_ids_with_other_texts(spark):
    words = [f"w{i}" for i in range(100)]
    a, z = " ".join(words), " ".join(f"z{i}" for i in range(100))
    rows = [(1, a), (1, z), (2, a + " b"), (5, a + " b c"), (9, z + " y"), (None, z + " x"), (7, ""), (7, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs, 4, 85).collect())
    assert got == [(0, 98, 1), (1, 97, 1), (1, 97, 1), (2, 98, 1), (5, 99, 1), (7, 0, 1), (7, 97, 1), (9, 98, 1)]


def test_hot_spans_and_missing_ids(spark, monkeypatch):
    """A passage in all documents, one of them without an id, gives the same rows salted or not; large ids keep their digits."""
    line = "one two three four five six seven eight nine ten eleven twelve thirteen. "
    big = 2**53 + 1
    rows = [(None, line * 2 + "nobody has this id.")] + [(big + i, f"own words {i} here. " + line * 2) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen = []
    for least in (0, 10**9):
        monkeypatch.setattr(spans, "HOT_ROWS", least)
        seen.append({r.doc_id: (r.text, r.n_removed > 0) for r in spans.dedup_spans(df).collect()})
    assert seen[0] == seen[1]
    assert seen[0][None] == (rows[0][1], False)
    assert all(seen[0][big + i][1] and seen[0][big + i][0].startswith(f"own words {i} ") and "seven" not in seen[0][big + i][0] for i in range(50))
