"""Decontamination against a search of every window in every document."""

from __future__ import annotations

import random
import re

import pytest

from haulmart.llm import decontaminate
from tests.llm.conftest import odd_documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [(m.group(), m.start(), m.end()) for m in WORD.finditer((text or "").translate(LOWER))]


def brute_force(rows, items, window):
    windows = []
    for item_id, text in items:
        own = [w for w, _, _ in words(text)]
        for k in range(max(1, len(own) - window + 1) if own else 0):
            windows.append(("" if item_id is None else str(item_id), own[k : k + window]))
    out = []
    for doc_id, text in rows:
        own = words(text)
        plain = [w for w, _, _ in own]
        hit, ids = [False] * len(own), set()
        for item_id, wanted in windows:
            for k in range(len(plain) - len(wanted) + 1):
                if plain[k : k + len(wanted)] == wanted:
                    hit[k : k + len(wanted)] = [True] * len(wanted)
                    ids.add(item_id)
        spans = []
        for k, is_hit in enumerate(hit):
            if is_hit and k and hit[k - 1]:
                spans[-1] = (spans[-1][0], own[k][2])
            elif is_hit:
                spans.append(own[k][1:])
        out.append((doc_id, len(own), sum(hit), sorted(ids), spans))
    return sorted(out, key=str)


def found(docs, items, window):
    rows = decontaminate.find_items(docs, items, window).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items, [tuple(s) for s in r.spans]) for r in rows), key=str)


def asked():
    source = prose(11, 120, 40)
    parts = source.split()
    return [
        (1, " ".join(parts[:30])), (2, " ".join(parts[20:45]).upper()), (10, " ".join(parts[50:54])), (3, None), (4, " .,; "),
        (None, " ".join(parts[70:90])), (2, " ".join(parts[90:])), (5, "été \U0001f600 x"), (6, " ".join(parts[50:54])),
    ]


def corpus():
    rng = random.Random(4)
    source = prose(11, 120, 40)
    parts = source.split()
    rows = odd_documents()
    for k in range(40):
        start, stop = sorted(rng.sample(range(len(parts) + 1), 2))
        joined = rng.choice([" ", "\n", " — ", ", ", "--"]).join(parts[start:stop])
        rows.append((100 + k, rng.choice(["", "Éé\U0001f600 ", prose(k, 9), "..."]) + joined + rng.choice(["", "!", " \U0001f600x", prose(k, 5)])))
    # Words that only begin or end like those of an item, and an item cut in two by a new text.
    rows += [(300, "x" + " ".join(parts[:10])), (301, " ".join(parts[:10]) + "x"), (302, " ".join(parts[:5])), (303, " ".join(parts[5:10]))]
    return rows + [(304, "a été,\U0001f600 X b"), (304, "a été,\U0001f600 X b")]


@pytest.mark.parametrize("window,most", [(10, 1 << 21), (4, 1 << 21), (4, 300), (1, 1 << 21)])
def test_equals_brute_force(spark, docs_of, monkeypatch, window, most):
    """Over one automaton and over one per block of items."""
    monkeypatch.setattr(decontaminate, "MOST_CHARS", most)
    items = spark.createDataFrame([(i, t, "x") for i, t in asked()], "item_id long, text string, doc_id string")
    expected = brute_force(corpus(), asked(), window)
    assert found(docs_of(corpus()), items, window) == expected
    assert sum(n > 0 for _, _, n, _, _ in expected) > 10


def test_spans_are_places_in_the_original(spark, docs_of):
    text = "Été! One,  two x THREE... four\n"
    items = spark.createDataFrame([(7, "one two x three")], "item_id long, text string")
    (row,) = decontaminate.find_items(docs_of([(1, text)]), items).collect()
    assert [text[s.begin : s.end] for s in row.spans] == ["One,  two x THREE"] and row.items == ["7"]


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame(asked(), "item_id long, text string")
    assert found(docs_of([]), items, 10) == []
    rows = [(1, None), (2, ""), (3, "a b")]
    assert found(docs_of(rows), items.limit(0), 10) == [(1, 0, 0, [], []), (2, 0, 0, [], []), (3, 2, 0, [], [])]


def test_slices_of_few_bytes(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 50)
    items = spark.createDataFrame(asked(), "item_id long, text string")
    assert found(docs_of(corpus()), items, 4) == brute_force(corpus(), asked(), 4)
