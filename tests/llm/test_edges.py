"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import pytest

import corpus_pipeline
from strataload.llm import decontaminate, htmltext, langid, minhash, mixing, pii, quality_gam, quality_rules, toxicity, warc

LABELS = "doc_id long, label int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, 0), (None, 1), (7, None), (99, 1)], LABELS)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "one two three four"), (4, "one")]
    return spark.createDataFrame(rows, "item_id long, text string")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_near_duplicates(odd, odd_rows, empty):
    found = rows(minhash.near_duplicates(odd))
    assert len(found) == len(odd_rows)
    by = {r["doc_id"]: r for r in found}
    assert by[2]["component_id"] == 1 and not by[2]["kept"] and by[1]["kept"]
    assert by[8]["component_id"] == 7 and by[7]["n_shingles"] == 1
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[5]["n_shingles"] == 0
    assert by[9_007_199_254_740_993]["component_id"] == 9_007_199_254_740_993
    assert all(r["kept"] and r["component_id"] is None for r in found if r["doc_id"] is None)
    assert minhash.near_duplicates(empty).count() == 0


def test_one_id_with_two_texts_joins_their_groups(spark):
    a, b = "a b c d e f g h", "q r s t u v w x"
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b)], "doc_id long, text string")
    assert {r["component_id"] for r in rows(minhash.near_duplicates(df))} == {1}


def test_one_id_with_two_texts_loses_no_link(spark):
    words = [f"w{i}" for i in range(120)]
    other = [f"v{i}" for i in range(120)]
    near = [*other[:119], "x"]
    data = [(3, " ".join(words)), (3, " ".join(other)), (8, " ".join(near)), (9, " ".join([*words[:119], "y"]))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in rows_of(df)} == {3: 3, 8: 3, 9: 3}


def rows_of(df):
    return rows(minhash.near_duplicates(df))


def test_mix(odd, odd_rows, empty, spark):
    found = rows(mixing.mix(odd))
    assert len(found) == len(odd_rows)
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] or not r["taken"])
        assert r["target"] <= 2 * r["source_size"]
    assert mixing.mix(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in rows(mixing.mix(nothing))] == [0, 0]
    ordered = mixing.schedule(mixing.mix(odd)).select("finish").toPandas().finish
    assert ordered.is_monotonic_increasing


def test_targets_are_met(spark):
    sizes = {"a": 400, "b": 100, "c": 300, None: 50}
    data = [(i * 1000 + j, "w " * (1 + j % 5), s) for i, (s, n) in enumerate(sizes.items()) for j in range(n)]
    found = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string")).toPandas()
    for _, group in found.groupby("source", dropna=False):
        assert abs(group.taken.sum() - group.target.iloc[0]) <= 10
    assert abs(found.groupby("source", dropna=False).target.first().sum() - 1.5 * found["size"].sum()) < 1e-6


def test_decontamination(odd, empty, benchmark):
    found = rows(decontaminate.find_leaks(odd, benchmark))
    assert sorted((r["doc_id"] or 0, r["item"]) for r in found) == [(0, "1"), (1, "1"), (1, "1"), (2, "1")]
    left = decontaminate.without_leaks(odd, benchmark)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
    assert decontaminate.find_leaks(empty, benchmark).count() == 0
    assert decontaminate.find_leaks(odd, benchmark.limit(0)).count() == 0


def test_language(odd, odd_rows, empty):
    model = langid.fit(odd)
    found = rows(langid.identify(odd, model))
    assert len(found) == len(odd_rows)
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] == ("en" if letters else "und") and 0 <= r["score"] <= 1
        assert letters or r["rejected"]
    assert langid.identify(empty, model).count() == 0
    nothing = langid.fit(empty)
    assert {r["lang_pred"] for r in rows(langid.identify(odd, nothing))} == {"und"}


def test_pseudonyms(odd, odd_rows, empty):
    found = rows(pii.pseudonymised(odd))
    assert sorted(r["text"] or "" for r in found) == sorted(r[1] or "" for r in odd_rows)
    assert pii.private_text(odd).columns == odd.columns
    assert pii.private_text(empty).count() == 0


def test_quality_model(odd, empty, labels):
    model = quality_gam.fit(odd, labels)
    found = rows(quality_gam.score(odd, model))
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert quality_gam.score(empty, model).count() == 0
    assert {r["score"] for r in rows(quality_gam.score(odd, quality_gam.fit(odd, labels.limit(0))))} == {0.5}


def test_toxicity_model(odd, empty, labels):
    model = toxicity.fit(odd, labels)
    found = rows(toxicity.score(odd, model))
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score(empty, model).count() == 0
    assert {r["predicted"] for r in rows(toxicity.score(odd, toxicity.fit(odd, labels.limit(0))))} == {0}


def test_quality_rules(odd, odd_rows, empty, spark):
    trusted = spark.createDataFrame([(1,), (None,), (77,)], "doc_id long")
    found = rows(quality_rules.judge(odd, trusted))
    assert len(found) == len(odd_rows)
    by = {r["doc_id"]: r for r in found}
    assert by[3]["n_words"] == 0 and by[3]["base_failed"] and by[3]["score"] is None and not by[3]["kept"]
    assert by[6]["n_words"] == 120_000
    assert quality_rules.judge(empty, trusted).count() == 0
    assert all(r["score"] in (None, 0.0) for r in rows(quality_rules.judge(odd, trusted.limit(0))))


PAGES = "page_id long, url string, html string"


def test_main_text(spark):
    long = "<p>" + "word &amp; more, " * 30_000 + "</p>"
    data = [
        (1, "u", None), (2, None, ""), (3, "u", "plain &lt;text&gt;\n here"), (3, "u", "plain &lt;text&gt;\n here"),
        (None, "u", "<html><body><nav><a href=x>a</a></nav></body>"), (4, "u", f"<article><h1>T</h1>{long}</article>"),
        (5, "u", "<p <b <<>> &#0; <script>never closed"),
    ]
    pages = spark.createDataFrame(data, PAGES).selectExpr("*", "'x' as text", "1 as n_chars")
    found = rows(htmltext.main_text(pages, htmltext.fit(pages)))
    by = {r["page_id"]: r for r in found}
    assert len(found) == len(data) and by[1]["text"] == by[2]["text"] == ""
    assert by[3]["text"] == "plain <text> here"
    assert by[4]["text"].startswith("T\nword & more, word") and by[4]["n_chars"] == len(by[4]["text"])
    none = pages.limit(0)
    assert htmltext.main_text(none, htmltext.fit(none)).count() == 0


def test_archives(spark):
    big = "é" * 700
    data = [
        (1, "u1", big), (2, "u\r\n2", big), (5, None, big), (5, "again", big), (None, "n", big), (3, "u3", None),
        (4, "u4", ""), (6, "u6", "x" * 999), (7, "u7", "x" * 999), (8, "u8", "y" * 3_000_000),
        (9_007_199_254_740_993, "u9", "z"), (None, None, None),
    ]
    pages = spark.createDataFrame(data, PAGES).selectExpr("*", "'x' as digest", "2 as original")
    found = rows(warc.archived(pages))
    assert len(found) == len(data)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in found if r["payload_bytes"] == 1400)
    assert kinds == [(0, "revisit", 5), (1, "revisit", 5), (2, "revisit", 5), (5, "response", 0), (5, "response", 0)]
    assert all(r["record_type"] == "response" for r in found if r["payload_bytes"] < 1000)
    assert 9_007_199_254_740_993 in {r["page_id"] for r in found}
    assert {r["url"] for r in found if r["page_id"] == 2} == {"u%0D%0A2"}
    assert warc.archived(pages.limit(0)).count() == 0


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_and_empty_input(spark, odd, empty, folder, number):
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (odd, empty):
        out = stage(spark, docs, folder)
        if number < 4:
            assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
