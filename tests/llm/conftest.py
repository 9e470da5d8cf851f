from __future__ import annotations

import random

import pytest

WORDS = ["".join(random.Random(i).choice("abcde") for _ in range(1 + i % 4)) for i in range(40)]


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int, str]]:
    """(doc_id, text): random prose with copies, near copies and shared passages."""
    r = random.Random(11)
    passages = [prose(r, 60) for _ in range(3)]
    texts = ["", "a b", "a b", "x", "ab " * 300, "aaaa" * 150]
    for _ in range(120):
        text = prose(r, r.randint(0, 80))
        pick = r.random()
        if pick < 0.3:
            text = f"{text} {r.choice(passages)[: r.randint(20, 220)]} {text[:50]}"
        elif pick < 0.4:
            text = texts[-1]
        elif pick < 0.6:
            before = texts[-1].split()
            if len(before) > 5:
                before[r.randrange(len(before))] = "zzz"
            text = " ".join(before)
        texts.append(text)
    return list(enumerate(texts))


#: Nulls, empty and blank texts, repeated rows, a long text, other scripts.
ODD = [
    (1, "one two three four five six", "en", 3),
    (1, "one two three four five six", "en", 3),
    (None, "one two three four five six", None, None),
    (None, None, None, None),
    (None, None, None, None),
    (2, None, "en", None),
    (3, "", "", 0),
    (4, " \n\t ", "x", 4),
    (5, "palabra ñandú 日本語 😀 \x00 ▁ end" * 3, "es", 1),
    (6, "w" * 70_000, "en", 70_000),
    (7, "long words go on " * 4_000, "en", 1),
    (-8, "a", "en", 1),
]
#: Names that operators use inside, with values that must not come through.
CLASHES = ["n_words", "class", "component", "text_key", "keys", "tid", "places", "token_ids", "n_tokens", "shape", "words", "shard", "slot", "held_out", "score", "packed", "n", "key", "size"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(*x, *["clash"] * len(CLASHES)) for x in ODD]
    names = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, n_chars long, {names}").repartition(3)
