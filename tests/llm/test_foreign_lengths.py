"""Texts of a language that was not learned are rejected at every length."""

import random

from strataload.llm import langid

LETTERS = {"aa": "aeioulnrst", "bb": "aeioumdkgp", "cc": "aeiouzvfhb"}
SIZES = (40, 100, 400, 3_000, 12_000, 60_000, 300_000)


def _text(letters: str, size: int, r: random.Random) -> str:
    out, letters_left = [], size
    while letters_left > 0:
        out.append("".join(r.choice(letters[5:]) + r.choice(letters[:5]) for _ in range(r.randint(1, 4))))
        letters_left -= len(out[-1])
    return " ".join(out)


def test_foreign_texts_of_every_length(spark):
    r = random.Random(4)
    data = []
    for lang, letters in LETTERS.items():
        data += [(len(data) + i, _text(letters, r.choice((200, 500, 1_500)), r), lang) for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    spec = langid.LanguageSpec()
    model = langid.fit(docs, spec)
    for size in SIZES:
        foreign = [_text("\u0430\u0435\u0438\u043e\u0443\u043b\u043d\u0440\u0441\u0442", size, r) for _ in range(4)]
        foreign += [_text("yw\u00f8\u00e5\u00e6cjqx\u00df", size, r) for _ in range(4)]
        assert langid.classify(model, foreign, spec).rejected.all(), size
        own = [_text(letters, size, r) for letters in LETTERS.values() for _ in range(4)]
        assert not langid.classify(model, own, spec).rejected.any(), size
