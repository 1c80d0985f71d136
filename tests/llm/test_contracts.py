"""The registered queries against SQL, brute force, or held-out labels."""

import html
import os
import re
import zlib
from collections import Counter

import pandas as pd
import pytest

import __spark_entry__ as driver
from strataload.llm.catalog import ORACLES, QUERIES
from tools.compare import bag


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").toPandas()


@pytest.fixture(scope="module")
def labelled_folder(folder):
    """Models of rare labels need more rows than the smallest tables have."""
    larger = os.path.join(os.path.dirname(folder), "sf0.01")
    return larger if os.path.isdir(larger) else folder


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_all_are_registered():
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, cursor.fetchall())


def run(spark, folder, prefix):
    return QUERIES[next(n for n in QUERIES if n.startswith(prefix))](spark, folder).toPandas()


def test_op1_leaves_no_personal_value(spark, folder, docs):
    found = run(spark, folder, "op1_").merge(docs, on="doc_id", suffixes=("", "_before"))
    assert len(found) == len(docs) and found.n_replaced.sum() > 0
    mails = re.compile(r"[A-Za-z0-9.]+@[\w.]+\.com")
    for row in found.itertuples():
        for value in mails.findall(row.text_before):
            assert value not in row.text
        if row.n_replaced == 0:
            assert row.text == row.text_before
        assert len(row.kinds) == row.n_replaced


def test_op2_gives_the_article(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").toPandas()
    found = run(spark, folder, "op2_").merge(pages, on="page_id")
    assert len(found) == len(pages)

    def article(page):
        body = re.sub(r"</?b>|<br>", "", re.search(r"<article>(.*?)</article>", page, re.S).group(1))
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", body)]
        return "\n".join(b for b in blocks if b)

    same = [row.text == article(row.html) for row in found.itertuples()]
    assert sum(same) >= 0.99 * len(same)
    assert all(row.n_chars == len(row.text) for row in found.itertuples())


def test_op4_held_out_accuracy(spark, folder, docs):
    found = run(spark, folder, "op4_").merge(docs, on="doc_id")
    assert len(found) == len(docs) and found.score.between(0, 1).all()
    assert (found.held_out == (found.doc_id.map(lambda i: fold(i, 3)) == 1)).all()
    held = found[found.held_out & found.lang.notna()]
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert found.rejected.mean() < 0.05


@pytest.mark.parametrize(
    "prefix, label, folds, rest, least", [("op5_", "toxic", 3, 1, 0.7), ("op7_", "quality", 5, 0, 0.3)]
)
def test_held_out_labels(spark, labelled_folder, prefix, label, folds, rest, least):
    labels = spark.read.parquet(f"{labelled_folder}/labels.parquet").toPandas()
    rows = spark.read.parquet(f"{labelled_folder}/documents.parquet").count()
    found = run(spark, labelled_folder, prefix)
    assert len(found) == rows and found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= least)).all()
    assert (found.held_out == (found.doc_id.map(lambda i: fold(i, folds)) == rest)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held[label]).mean() > 0.9


def test_op9_base_counts(spark, folder, docs):
    def base(text):
        w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        often, covered = Counter(windows), set()
        for i, window in enumerate(windows):
            if often[window] > 1:
                covered.update(range(i, i + 8))
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed

    found = run(spark, folder, "op9_").merge(docs, on="doc_id")
    assert len(found) == len(docs)
    for row in found.itertuples():
        got = row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed
        assert got == base(row.text)
        assert not (row.kept and row.base_failed)
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    good = found.merge(labels[labels.quality == 1], on="doc_id")
    assert good[~good.base_failed].kept.mean() > 0.98


def test_op10_against_brute_force(spark, folder, docs):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").toPandas()
    tokens = {r.item_id: re.findall(r"\w+", r.text.casefold()) for r in bench.itertuples()}

    def covered(doc, item, least=4):
        """Greedy tiling by definition: the longest free common run, again and again."""
        used_doc, used_item, total = set(), set(), 0
        while True:
            best = (0, 0, 0)
            for i in range(len(item)):
                for j in range(len(doc)):
                    n = 0
                    while (
                        i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                        and i + n not in used_item and j + n not in used_doc
                    ):
                        n += 1
                    if n > best[0]:
                        best = (n, i, j)
            n, i, j = best
            if n < least:
                return total
            used_item.update(range(i, i + n))
            used_doc.update(range(j, j + n))
            total += n

    want = {}
    for row in docs.itertuples():
        doc = re.findall(r"\w+", (row.text or "").casefold())
        grams = {tuple(doc[i : i + 4]) for i in range(len(doc) - 3)}
        for item_id, item in tokens.items():
            shared = sum(tuple(item[i : i + 4]) in grams for i in range(len(item) - 3))
            if shared * 4 >= 0.6 * len(item) and (n := covered(doc, item)) >= 0.6 * len(item):
                want[row.doc_id, item_id] = n
    found = run(spark, folder, "op10_")
    assert {(r.doc_id, r.item_id): r.covered for r in found.itertuples()} == want and want


def test_pipeline_stages_take_effect(spark, folder, docs):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontaminate", "pseudonyms", "mixture",
    ]
    got = corpus_pipeline.run(spark, folder).toPandas()
    near = run(spark, folder, "op3_").set_index("doc_id")
    leaks = set(run(spark, folder, "op10_").doc_id)
    rejected = run(spark, folder, "op4_").set_index("doc_id").rejected
    assert len(got) and got.doc_id.is_unique
    assert not leaks & set(got.doc_id)
    assert near.loc[got.doc_id, "component_id"].is_unique
    assert not rejected.loc[got.doc_id].any()
    sizes = got.text.map(lambda t: len(words(t)))
    assert (got.taken == sizes * got.copies).all() and got.copies.between(1, 2).all()
    plain = pd.Series(dict(zip(docs.doc_id, docs.text)))
    hidden = run(spark, folder, "op1_").set_index("doc_id").text
    assert all(hidden[i] == t for i, t in zip(got.doc_id, got.text))
    assert any(plain[i] != t for i, t in zip(got.doc_id, got.text))
