from __future__ import annotations

import random

import pytest

NULL_ID = -(2**63)
#: The usual columns of documents, and some whose names the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "d long, k string, name string, row string, document string, spans string, kept boolean, n_words long, task long"
)
CLASH = (7, "x", "y", "z", "doc", "1:2", True, 3, 4)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    syllables = ["an", "ber", "cho", "de", "el", "fra", "go", "hin", "is", "ju", "ka", "lo"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(vocabulary)]
    out = []
    for i in range(n):
        out.append(rng.choice(words) + ("." if i % 11 == 10 else ""))
        out.append("\n" if i % 23 == 22 else " ")
    return "".join(out)


def near(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 9**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def odd_texts() -> dict[int, str | None]:
    """Texts by id: nulls, blanks, one word, non-ASCII, ties, copies, near copies, shared passages, a very long text."""
    long = prose(1, 9000)
    base = prose(2, 300)
    passage = prose(3, 60)
    texts: dict[int, str | None] = {
        NULL_ID: prose(4, 80) + passage,
        0: None,
        1: "",
        2: " \t\n\r\v\f ",
        3: "one",
        4: "one",
        5: "ONE two three",
        6: "one Two three",
        7: "Größe  ñandú  日本語 🙂 é́ " * 30,
        8: "Größe  ñandú  日本語 🙂 é́ " * 30,
        9: "a " * 500,
        10: "a" * 400,
        11: "a" * 399 + "b",
        12: base,
        13: base,
        14: base.upper(),
        15: long,
        16: long[:40000] + passage + long[40000:],
        17: passage,
        18: prose(5, 50) + passage + prose(6, 50),
        19: "x\n\ny\n\n x \ny\n",
    }
    texts |= {20 + i: near(base, 100 + i, 0.004 * i) for i in range(25)}
    texts |= {50 + i: prose(200 + i, 5 + 17 * i) for i in range(12)}
    return texts


def rows_of(texts):
    langs, sources = ["en", "de", None], ["s0", "s0", "s1", None]
    return [
        (None if i == NULL_ID else i, t, langs[n % 3], sources[n % 4], None if n % 5 == 0 else len(t or ""), *CLASH)
        for n, (i, t) in enumerate(texts.items())
    ]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_texts):
    """One row for each text, and some rows twice."""
    rows = rows_of(odd_texts)
    return spark.createDataFrame(rows + rows[::7], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows) -> dict:
    """Rows by id; those that come twice must be equal."""
    out: dict = {}
    for r in rows:
        i = NULL_ID if r.doc_id is None else r.doc_id
        assert out.setdefault(i, r) == r
    return out
