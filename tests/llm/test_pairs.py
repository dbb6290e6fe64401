"""Near duplicates: fingerprints and the n-gram join against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from haulmart.llm import fingerprints, ngram_join
from tests.llm.conftest import jaccard, odd_documents, prose, shingle_set


def components_of(rows):
    """Smallest id per row by links of 0.75 between all pairs of rows."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    named = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        named.append((str(doc_id), len(sets[i]), str(min(group) if group else None)))
    return sorted(named)


def found(frame):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in frame.collect())


def test_join_with_odd_rows(docs_of):
    rows = odd_documents()
    assert found(ngram_join.similar_documents(docs_of(rows))) == components_of(rows)


def planted(n_groups=12, size=9):
    """Chains of copies, each with some words of the one before replaced, and a passage that all share."""
    rng = random.Random(5)
    passage = prose(99, 70)
    rows, doc_id = [], 0
    for g in range(n_groups):
        words = prose(1000 + g, 120, 4000).split()
        for _ in range(size):
            doc_id += 1
            rows.append((doc_id, " ".join(words) + " " + passage))
            words = list(words)
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return rows


def test_join_with_chains_and_a_shared_passage(docs_of, monkeypatch):
    rows = planted()
    expected = components_of(rows)
    frame = docs_of(rows).repartition(4)
    assert found(ngram_join.similar_documents(frame)) == expected
    # The same by way of leads and R-trees: every run counts as a long one.
    monkeypatch.setattr(ngram_join, "LEAF_RUN", 1)
    assert found(ngram_join.similar_documents(frame)) == expected


def test_frequent_tokens_change_no_link(docs_of, monkeypatch):
    rows = planted(4, 6)
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 2)
    assert found(ngram_join.similar_documents(docs_of(rows))) == components_of(rows)


def test_one_of_each_group(docs_of):
    rows = planted(3, 4) + [(50, ""), (51, None), (52, "")]
    kept = sorted(r.doc_id for r in ngram_join.one_of_each_group(docs_of(rows)).collect())
    assert kept == sorted({int(c) for _, _, c in components_of(rows)})


def test_rtree_finds_every_pair_within_the_bound():
    rng = np.random.default_rng(3)
    sizes = rng.integers(40, 120, 300)
    points = np.stack([np.bincount(rng.integers(0, 16, n), minlength=16) for n in sizes])
    points[150:] = np.maximum(points[:150] + rng.integers(-1, 2, (150, 16)), 0)
    sizes = points.sum(axis=1)
    tree = ngram_join.RTree(points, sizes)
    query, point, _ = tree.search(points, sizes)
    own = set(zip(query.tolist(), point.tolist()))
    expected = {
        (i, j)
        for i in range(300)
        for j in range(300)
        if np.minimum(points[i], points[j]).sum() >= ngram_join.least_overlap(sizes[i], sizes[j])
        and 100 * min(sizes[i], sizes[j]) >= 75 * max(sizes[i], sizes[j])
    }
    assert own == expected


def test_no_documents(docs_of):
    assert ngram_join.similar_documents(docs_of([])).count() == 0
    assert fingerprints.edited_fingerprints(docs_of([])).count() == 0
    assert fingerprints.near_duplicates(docs_of([])).count() == 0


def test_fingerprints_of_edited_texts(docs_of):
    rows = odd_documents()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        quarter = len(text) // 4
        expected.append((doc_id, text, text[: len(text) - quarter] + following[:quarter], following))
    result = fingerprints.edited_fingerprints(docs_of(rows).repartition(3)).collect()
    own = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in result)
    assert own == sorted((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in expected)
    by_text = {(str(i), hashlib.sha256(e.encode()).hexdigest()): (t, e, f) for i, t, e, f in expected}
    prints = {}
    for r in result:
        text, edited, following = by_text[str(r.doc_id), r.edited_sha256]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert abs(r.near_edited - jaccard(shingle_set(text), shingle_set(edited))) < 0.2
        assert abs(r.near_next - jaccard(shingle_set(text), shingle_set(following))) < 0.2


def test_near_duplicates_by_bands(docs_of):
    rows = planted(5, 4)
    groups = sorted((r.doc_id, r.group_id) for r in fingerprints.near_duplicates(docs_of(rows)).collect())
    assert groups == sorted((int(i), int(c)) for i, _, c in components_of(rows))


def test_group_counts_of_giant_sets_fit_16_bits():
    sizes = np.array([1, 64, 10**6, 2**26, 2**28, 2**34])
    groups = 1 << ngram_join.groups_of(sizes)
    assert (sizes / groups <= 65535 / 2).all()
    # Sets that may link are of one class or of neighbouring ones.
    for n in sizes.tolist():
        smaller = np.array([-(-75 * n // 100), n])
        assert np.ptp(ngram_join.groups_of(smaller)) <= 1


def test_odd_groups_keep_every_link_and_part_near_misses():
    rng = np.random.default_rng(5)
    for size in (6, 40, 300, 5000):
        ours = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for kept in (0.3, 0.6, 0.86, 0.95):
            theirs = np.unique(np.append(ours[: int(size * kept)], rng.integers(0, 2**63, size - int(size * kept)).astype(np.uint64)))
            n = np.array([len(ours), len(theirs)])
            odd = ngram_join.odd_groups(np.concatenate([ours, theirs]), n).to_pylist()
            words = min(map(len, odd)) // 8
            a, b = (ngram_join.folded_odd(o, words)[None] for o in odd)
            common = len(np.intersect1d(ours, theirs))
            passes = bool(ngram_join.may_link(a, b, n[:1], n[1:])[0])
            if 100 * common >= 75 * (n.sum() - common):
                assert passes
            # The sums of minima of the counts let through what has half of its shingles in common.
            elif kept <= 0.6 and size >= 40:
                assert not passes


def test_near_misses_of_a_family_are_not_paired(docs_of, monkeypatch):
    """Texts of one template, 0.6 alike or so, share runs; pairs of all of them grew with the square of the family."""
    template = prose(77, 400, 4000).split()
    rows = []
    for k in range(40):
        words = list(template)
        for place in range(k, 396, 40):
            words[place] = f"v{k}x{place}"
        rows.append((k, " ".join(words)))
    paired = []
    verified = ngram_join.Join.verified
    monkeypatch.setattr(ngram_join.Join, "verified", lambda self, pairs, name: paired.append((name, pairs.count())) or verified(self, pairs, name))
    named = ngram_join.similar_documents(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in named) == components_of(rows)
    # Of 780 pairs those whose changed places are neighbours remain.
    assert dict(paired)["all"] <= 3 * len(rows)


def test_texts_of_a_shared_passage_meet_in_few_runs(docs_of, monkeypatch):
    """Texts with one passage in common share many runs; R-trees need a row of each in that of the first common token."""
    passage = prose(5, 40, 4000)
    rows = [(k, f"{passage} " + " ".join(f"v{k}x{i}" for i in range(300))) for k in range(12)]
    rows += [(20 + k, rows[k][1].replace(f"v{k}x7 ", "copied ")) for k in range(2)]
    searched = []
    candidates = ngram_join.Join.candidates
    watched = lambda self, crossing, points, nearest: searched.append(crossing.count()) or candidates(self, crossing, points, nearest)
    monkeypatch.setattr(ngram_join.Join, "candidates", watched)
    assert found(ngram_join.similar_documents(docs_of(rows))) == components_of(rows)
    assert max(searched) <= 2 * len(rows)
