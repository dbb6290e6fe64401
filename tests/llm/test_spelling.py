"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from haulmart.llm import spelling
from tests.llm.conftest import odd_documents, prose

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, words[w], len(near[w]), words[forms[w]] if forms[w] else None))
    return out


def written(seed: int, texts: int) -> list[tuple]:
    """Texts over few words and their misspellings, so that many are one edit apart."""
    rng = random.Random(seed)
    letters = "abcehé÷ÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(40)]

    def spelled(word: str) -> str:
        at = rng.randrange(len(word))
        return rng.choice([word] * 6 + [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :], word.title()])

    return [(k, " ".join(spelled(rng.choice(base[: 1 + rng.randrange(len(base))])) for _ in range(150)) + ".") for k in range(texts)]


CASES = {"misspelt": written(1, 40), "odd": odd_documents(), "chains": [(k, f"wordy {'wordyx ' * 2} {'wordxyx ' * 4} {'wordxyxx ' * 9}") for k in range(5)]}


def found(docs):
    rows = spelling.spelling_variants(docs).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("case", sorted(CASES))
def test_equals_brute_force(docs_of, case):
    expected = brute_force(CASES[case])
    assert found(docs_of(CASES[case])) == expected
    if case == "chains":
        assert ("wordyx", "wordxyx") in {(w, r) for w, _, r, *_ in expected} or any(w != r for w, _, r, *_ in expected)


def test_crowded_reduced_words_go_through_finer_alphabets(docs_of, monkeypatch):
    """With few words allowed to meet, most pairs are found in a later round; none is lost or doubled."""
    monkeypatch.setattr(spelling, "MOST_MET", 30)
    monkeypatch.setattr(spelling, "ALPHABETS", (1, 2, 128))
    rows = written(2, 30)
    assert found(docs_of(rows)) == brute_force(rows)


def test_one_symbol_for_all_letters_and_blocks_of_few_keys(docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "ALPHABETS", (2,))
    rows = written(3, 20) + [(90, None), (91, ""), (None, prose(4, 400, 30))]
    assert found(docs_of(rows)) == brute_force(rows)


def test_no_documents_and_no_words(docs_of):
    assert found(docs_of([])) == set()
    assert found(docs_of([(1, None), (2, "a b c"), (3, "abcde abcde")])) == set()


def test_every_neighbour_is_generated():
    """Keys of the edits of a reduced word are the keys of the edited words."""
    import numpy as np

    rng = random.Random(5)
    word = [rng.randint(1, 4) for _ in range(7)]
    edits = [word] + [word[:k] + word[k + 1 :] for k in range(7)]
    edits += [word[:k] + [s] + word[k + j :] for k in range(8) for s in range(1, 5) for j in (0, 1) if k + j <= 7]
    expected = {int(spelling.finished(spelling.reduced_keys(np.array([e], np.uint64)), len(e))[0]) for e in edits}
    made = set()
    for block in spelling.neighbourhoods(np.array([word], np.uint64), 4):
        made |= set(block[0].tolist())
    assert made == expected and len(expected) == len({tuple(e) for e in edits})
