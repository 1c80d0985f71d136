"""Disguised words of signs and digits only, behind outer signs, and spaced before punctuation."""

import numpy as np
import pytest

from strataload.llm import toxicity

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def restore():
    words = "the idiot is an ass and stupid shit hello world number you see that moron loser class as in it of he hit at".split()
    counts = np.zeros(27**3, np.int64)
    for word in words:
        places = [0, 0, *(ALPHABET.index(c) + 1 for c in word), 0]
        for a, b, c in zip(places, places[1:], places[2:]):
            counts[(a * 27 + b) * 27 + c] += 50
    return toxicity.Restorer(toxicity.CharModel(ALPHABET, counts))


@pytest.mark.parametrize(
    "seen, word",
    [
        ("you @$$ there", "ass"),
        ("you 455 there", "ass"),
        ("an !diot here", "idiot"),
        ("an \"!d!ot\" here", "idiot"),
        ("that $ h ! t again", "shit"),
        ("an i d i o t. Yes", "idiot"),
        ("an i d i o t! Yes", "idiot"),
        ("an 'i d i o t', yes", "idiot"),
        ("an i-d-i-o-t", "idiot"),
        ("an i_d_1_o_t?", "idiot"),
    ],
)
def test_disguise(restore, seen, word):
    assert f" {word} " in restore.line(seen)


def test_plain_words_keep_their_letters(restore):
    line = restore.line("Hello! (see the world) | you: *number* in it!!")
    assert set(line.split()) == {"hello", "see", "the", "world", "you", "number", "in", "it"}
    assert restore.text("call 455 + 1 1 2 now").startswith("call 455 + ")
