"""The lattice of disguises: scripts, look-alikes, doubled letters, word breaks; Viterbi against all paths."""

import itertools

import numpy as np
import pytest

from strataload.llm import toxicity
from strataload.llm.toxicity import CharModel, Restorer, char_model, folded

WORDS = (
    "the idiot is an ass and stupid shit hello world see moron loser class letter soon book will all good people "
    "كلب غبي احمق هذا дурак глупый это самый тупой hoşça ngu quá 笨蛋"
).split()


@pytest.fixture(scope="module")
def restore(spark):
    docs = spark.createDataFrame([(" ".join(WORDS * 40),), (None,), ("",)], "text string")
    return Restorer(char_model(docs))


@pytest.mark.parametrize(
    "seen, word",
    [
        ("so stuupid now", "stupid"), ("st00pid", "stupid"), ("sssttuuupid", "stupid"), ("ｓｔｕｐｉｄ", "stupid"), ("ＩＤ1ＯＴ", "idiot"),
        ("ѕtupіd", "stupid"), ("idіоt", "idiot"), ("s  t  u  p  i  d", "stupid"), ("l o s e r", "loser"),
        ("дуууурак", "дурак"), ("غبيييي", "غبي"), ("د ح م ق ا ح م ق", None), ("тупо0й", "тупой"), ("笨笨笨蛋", "笨蛋"),
    ],
)
def test_restored(restore, seen, word):
    line = restore.line(seen)
    assert word is None or f" {word} " in line, line


def test_letters_apart_may_be_several_words(restore):
    assert {"loser", "stupid"} <= set(restore.line("l o s e r s t u p i d").split())


def test_plain_words_stay(restore):
    plain = "letter soon book class will all good people это самый كلب"
    assert set(restore.line(plain).split()) == set(plain.split())


def test_every_script_is_counted(restore):
    model = restore.model
    seen, unseen = (model.score(w) for w in ("غبي", "بيغ"))
    assert seen > unseen + 3 and model.score("дурак") > model.score("карду") + 3
    assert model.letters > 50


def test_probabilities_sum_to_one(restore):
    model = restore.model
    letters = sorted({ord(c) for w in WORDS for c in w} | {0})
    for a, b in ((0, 0), (0, ord("s")), (ord("s"), ord("t")), (ord("غ"), ord("ب"))):
        assert 0.95 < sum(np.exp(model.log(a, b, c)) for c in letters) < 1.05


def all_paths(model, seen, spaced):
    """The best word by trying every way through the lattice."""
    every, long = spaced or not any(c.isalpha() for c in seen), toxicity._RUN.search(seen) is not None
    parts = list(toxicity._PARTS.finditer(seen))
    choices = []
    for p in parts:
        first, last = p.start() == 0, p.end() == len(seen)
        some = model.choices(p.group(1), len(p.group()), first, last, spaced, every, long, seen[p.end() : p.end() + 1])
        if spaced and not first:
            some += [(cost + toxicity._LOG_BREAK, " " + x) for cost, x in some if x]
        choices.append(some)
    best = None
    for path in itertools.product(*choices):
        word, value = "".join(x for _, x in path), sum(cost for cost, _ in path)
        value += sum(model.score(w) for w in word.split(" ")) if word else model.log(0, 0, 0)
        best = max(best or (value, word), (value, word))
    return best


@pytest.mark.parametrize("seen, spaced", [("st00p1d", False), ("$h!t", False), ("a$$", False), ("iid1oot", False), ("idi0t", True), ("іd1оt", False), ("@$$", False), ("ssttup1d", False)])
def test_viterbi_finds_the_best_path(restore, seen, spaced):
    value, word = all_paths(restore.model, seen, spaced)
    found = restore.model.decode(seen, spaced)
    if found != word:  # a path with the same last two letters and the same value
        again = max(v for v, w in [all_paths(restore.model, seen, spaced)])
        assert abs(again - value) < 1e-9
    assert found == word


def test_hashed_counts_are_those_of_the_alphabet(spark):
    alphabet = "abcd"
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list(alphabet), 5)) for _ in range(200)]
    counts = np.zeros(125, np.int64)
    for w in words:
        places = [0, 0, *(alphabet.index(c) + 1 for c in w), 0]
        for a, b, c in zip(places, places[1:], places[2:]):
            counts[(a * 5 + b) * 5 + c] += 1
    one, two = CharModel(alphabet, counts), char_model(spark.createDataFrame([(w,) for w in words], "text string"))
    assert all(abs(one.score(w) - two.score(w)) < 1e-5 for w in words)


def test_folding():
    assert folded("ＡbC ﬁ Ⅷ") == "abc fi viii" and folded("ÉCOLE") == "école"
