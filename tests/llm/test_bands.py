"""Groups of near duplicates in families of templated texts, where a band's first text links with few others."""

from __future__ import annotations

import random

import pytest

from haulmart.llm import fingerprints, ngram_join, queries
from tests.llm.conftest import odd_documents, prose
from tests.llm.test_pairs import components_of


def family(members=60):
    """Variants of one template, about 0.7 alike, and of each a near copy."""
    rng = random.Random(8)
    template = prose(77, 400, 4000).split()
    rows = []
    for k in range(members):
        words = list(template)
        for place in rng.sample(range(4, 396), 7):
            words[place] = f"v{k}x{place}"
        rows.append((2 * k, " ".join(words)))
        words[rng.randrange(400)] = "copied"
        rows.append((2 * k + 1, " ".join(words)))
    return rows


@pytest.mark.parametrize(("leaf", "block"), [(ngram_join.LEAF_RUN, ngram_join.RUN_BLOCK), (2, 2048), (1, 7)])
def test_family_of_a_template(docs_of, monkeypatch, leaf, block):
    monkeypatch.setattr(ngram_join, "LEAF_RUN", leaf)
    monkeypatch.setattr(ngram_join, "RUN_BLOCK", block)
    rows = family()
    groups = sorted((r.doc_id, r.group_id) for r in fingerprints.near_duplicates(docs_of(rows).repartition(3)).collect())
    assert groups == sorted((int(i), int(c)) for i, _, c in components_of(rows))


@pytest.mark.parametrize("few", [500_000, 0])
def test_query_has_the_groups(spark, docs_of, monkeypatch, tmp_path, few):
    monkeypatch.setattr(fingerprints, "BROADCAST_NODES", few, raising=False)
    rows = odd_documents() + [(100 + i, t) for i, t in family(10)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    result = queries.op1_fingerprints(spark, str(tmp_path))
    alone = fingerprints.edited_fingerprints(docs_of(rows))
    assert result.columns == [*alone.columns, "group_id"]
    assert sorted(map(str, result.drop("group_id").collect())) == sorted(map(str, alone.collect()))
    own = sorted((str(r.doc_id), str(r.group_id)) for r in result.collect())
    assert own == sorted((i, c) for i, _, c in components_of(rows))
