"""Inputs for the tests of this folder."""

from __future__ import annotations

import random

import pytest

PASSAGE = " ".join(f"shared{i}" for i in range(60))
LINES = "\n".join(f"a line that comes back {i}" for i in range(6))


def made_rows() -> list[tuple[int, str | None]]:
    """Ids and texts with nulls, empties, a long text, copies, near copies, ties and shared passages."""
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = text(160)
    near = [" ".join(w if r.random() > 0.01 else word() for w in base.split(" ")) for _ in range(40)]
    far = [" ".join(w if r.random() > 0.05 else word() for w in base.split(" ")) for _ in range(10)]
    texts = [
        None, "", "   ", "\n\n\n", "one", "one two three", "One TWO three", "É été naïve 中文 words here",
        text(30_000), "x" * 50_000, base, base, base.upper(), *near, *far,
        *[f"{text(40)} {PASSAGE} {text(30)}" for _ in range(30)],
        *[f"{text(9)}\n{LINES}\n\n{text(8)}\n{LINES.splitlines()[0]}" for _ in range(5)],
        "same line\n" * 9, "Licensed under CC BY-NC 4.0. All Rights Reserved, all rights-reserved",
        "This is under the GNU General Public License, version 3; cc\tby cc_by", "K Kelvin cc by İ",
        "mail a.b@c.example.com and 1.2.3.4 or 300.1.1.1, +1 (605) 555-9305 4078918989542222",
        "4111 1111 1111 1111 4111111111111111 +1 (605) 555-9305 x@y x@y.z@w.v",
        "<|endoftext|> it's 12 ½ ② \x1c tokens here don't", "!! ## $$ %% ?? " * 40,
        *[text(r.randint(1, 12)) for _ in range(20)],
    ]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


ITEMS = [
    (1, " ".join(PASSAGE.split()[5:30])), (2, "one two three"), (3, None), (4, ""), (5, PASSAGE.upper()),
    (5, PASSAGE), (6, "K kelvin CC by"), (7, "never found in any of these texts at all really not here"),
]

# Column names the operators use for themselves.
CLASHING = ("_k", "k1", "cls", "n", "words", "spans", "ids", "hit", "doc", "_starts", "x", "term", "c")


def frame(spark, rows, extra: bool = True):
    columns = [f"'{c}' AS {c}" for c in CLASHING] if extra else []
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *columns).repartition(3)


@pytest.fixture(scope="session")
def rows():
    return made_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, []).limit(0)
