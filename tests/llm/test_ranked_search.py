"""Ranked search against scores worked out term by term."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from haulmart.llm import ranked_search
from tests.llm.conftest import odd_documents, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute_force(rows, items, top=20):
    docs = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    docs = [(doc_id, c) for doc_id, c in docs if c]
    big_n, big_l = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in docs:
            m = 75 + 25 * sum(c.values()) * big_n // big_l
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item_id, k, doc_id, -score) for k, (score, _, _, doc_id) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted(map(tuple, ranked_search.rank(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus():
    return odd_documents() + [(100 + k, prose(k, 30 + 7 * k, 120)) for k in range(40)] + [(200 + k, "same words for all ties") for k in range(30)]


def asked():
    rng = random.Random(3)
    pool = terms(prose(3, 200, 120)) + terms(prose(1, 50))
    items = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 30)))) for k in range(30)]
    return items + [(90, "Same, WORDS all"), (91, None), (92, "  ,;"), (93, "unknown zzz"), (94, "words words words"), (None, "same"), (90, "one two"), (95, "w v \U0001f600")]


@pytest.mark.parametrize("most_terms", [1 << 16, 60])
def test_equals_brute_force(spark, docs_of, monkeypatch, most_terms):
    """In one block of items and in several."""
    monkeypatch.setattr(ranked_search, "MOST_TERMS", most_terms)
    items = spark.createDataFrame([(i, t, "x") for i, t in asked()], "item_id long, text string, doc_id string")
    assert found(docs_of(corpus()), items) == brute_force(corpus(), asked())


def test_few_documents_at_once_and_other_top(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ranked_search, "HELD_NUMBERS", 700)
    items = spark.createDataFrame(asked(), "item_id long, text string")
    assert found(docs_of(corpus()).repartition(3), items, top=3) == brute_force(corpus(), asked(), 3)


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame(asked(), "item_id long, text string")
    assert found(docs_of([]), items) == []
    assert found(docs_of([(1, None), (2, "")]), items) == []
    assert found(docs_of(corpus()), items.limit(0)) == []


def test_counts_beyond_two_bytes(spark, docs_of):
    rows = [(1, "often " * 70_000 + "rare"), (2, "often rare"), (3, "other")]
    items = [(1, "often rare"), (2, "rare rare")]
    assert found(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")) == brute_force(rows, items)


def test_shared_sums_are_made_once():
    """The DAG's rows expand to the items, and need fewer sums than the items term by term."""
    rng = random.Random(9)
    groups = [[rng.randrange(60) for _ in range(6)] for _ in range(5)]
    items = [rng.choice(groups) + rng.choice(groups) + [rng.randrange(60)] for _ in range(80)] + [[], [7], [7, 7, 7, 7]]
    dag = ranked_search.Sharing(items, 60)

    def expanded(node):
        return [node] if node < 60 else [t for child in dag.pairs[node - 60] for t in expanded(child)]

    for item, row in zip(items, dag.rows):
        assert sorted(t for node in row for t in expanded(node)) == sorted(item)
    assert len(dag.pairs) + sum(map(len, dag.rows)) < 0.6 * sum(map(len, items))
    assert all(x < 60 + k and y < 60 + k for k, (x, y) in enumerate(dag.pairs))
