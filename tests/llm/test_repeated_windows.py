"""Base counts of op9 against plain loops, and what they spend on a text."""

import random
from collections import Counter

import pytest

from strataload.llm import quality_rules
from strataload.llm.quality_rules import RuleSpec


def repeated(words, size):
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    often = Counter(windows)
    return len({k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + size)})


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8])
def test_words_in_repeated_windows(spark, size):
    rng = random.Random(size)
    texts = [" ".join(rng.choices(["a", "B", "b#", "é|", "x\ny"][: rng.randint(2, 5)], k=rng.randint(0, 60))) for _ in range(60)]
    line = "one two three four five six seven eight"
    texts += ["", " \t\n", f" {line}\n\n{line}\x0b", f"{line} nine {line.upper()}", f"{line} {line[4:]} z {line[:-6]}", "\U0001f600 %$ & <*>", None]
    found = quality_rules.base_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RuleSpec(window=size))
    for r in found.collect():
        text = texts[r["doc_id"]] or ""
        words = text.split()
        want = (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), repeated(words, size))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_repeat_words"]) == want, repr(text)


def test_no_comparator_and_no_list_per_window(spark):
    """Sorting by a function, copying each window and replacing each character took half of the time."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")
    plan = quality_rules.base_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort(" not in plan and "translate(" not in plan and "sequence(" not in plan
