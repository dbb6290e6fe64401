from __future__ import annotations

import os
import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, bucket int, token string"


def row(doc_id, text, lang="en", source="s"):
    """A document with columns whose names clash with the operators' own."""
    return (doc_id, text, lang, source, None if text is None else len(text), "x", 7, None)


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: spark.createDataFrame([row(*r) for r in rows], SCHEMA)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéñß"
    known = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(known) + rng.choice(["", "", "", ",", "."]) for _ in range(words))


def odd_documents() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows and odd white space."""
    base = prose(1, 300)
    near = base.replace(base.split()[10], "changed", 1)
    return [
        (1, base),
        (2, near),
        (3, base),
        (3, base),
        (4, ""),
        (5, None),
        (6, " \t\n "),
        (7, "one two three"),
        (8, "One two three"),
        (9, prose(2, 20_000)),
        (10, "a" * 30_000),
        (11, "x\x0by\x0cz\u00a0w\u2003v \U0001f600 e\u0301 <|endoftext|> don't"),
        (12, prose(3, 60) + "\n" + prose(4, 60)),
        (12, prose(5, 60)),
        (None, prose(6, 80)),
        (None, None),
        (-5, base + " tail"),
    ]


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = WORD.findall((text or "").translate(up))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0
