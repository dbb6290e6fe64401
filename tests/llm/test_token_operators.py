"""Token files, trie BPE and packing against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haulmart.llm import packing, token_files, trie_bpe
from haulmart.llm.encoders import Encoder
from haulmart.llm.queries import vocabulary
from tests.llm.conftest import odd_documents

WORDS, BYTES = (vocabulary(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


LIBRARY = {path: plain(path) for path in (WORDS, BYTES)}
ENCODERS = {
    (path, merges): Encoder(open(path, encoding="utf-8").read(), merges)
    for path in (WORDS, BYTES)
    for merges in (None, trie_bpe.TrieMerges)
}
DECODERS = {path: trie_bpe.Decoder(open(path, encoding="utf-8").read()) for path in (WORDS, BYTES)}


def ids_of(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("merges", [None, trie_bpe.TrieMerges])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aetnsAEé \t\n'.,1ßΣ\u00a0\u2003\x1c|<>😀ſ\u0301") | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_any_text_is_encoded_as_by_the_library(path, merges, texts):
    ids, counts = ENCODERS[path, merges](pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends.tolist(), counts.tolist()):
        own = ids[end - n : end].tolist()
        assert own == ids_of(path, text)
        assert DECODERS[path](own) == LIBRARY[path].decode(own, skip_special_tokens=False)


def test_encode_and_decode(docs_of):
    rows = odd_documents()
    found = trie_bpe.encode_and_decode(docs_of(rows), WORDS).collect()
    digests = trie_bpe.encode_and_decode(docs_of(rows), WORDS, digests=True).collect()
    assert len(found) == len(digests) == len(rows)
    own = sorted((str(r.doc_id), r.ids, r.decoded) for r in found)
    expected = []
    for doc_id, text in rows:
        ids = ids_of(WORDS, text)
        expected.append((str(doc_id), ids, LIBRARY[WORDS].decode(ids, skip_special_tokens=False)))
    assert own == sorted(expected)
    hashed = [
        (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for i, ids, t in expected
    ]
    assert sorted(tuple(map(str, r)) for r in digests) == sorted(tuple(map(str, r)) for r in hashed)


def test_token_files(docs_of):
    rows = odd_documents()
    files = token_files.write_token_files(docs_of(rows), WORDS, end_id=2)
    found = sorted(files.documents(ids=True).collect(), key=lambda r: r.start)
    start = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in found] == [i for i, _ in order]
    for r in found:
        texts = [t for i, t in rows if i == r.doc_id]
        assert r.ids in [[*ids_of(WORDS, t), 2] for t in texts]
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    # The flat files themselves: a part's ids one after the other, as 16-bit numbers.
    parts = files.parts().orderBy("bucket").collect()
    flat = [int(x) for p in parts for x in token_files.block(p.stem + ".bin", "<u2", 0, p.n_tokens)]
    assert flat == [x for r in found for x in r.ids]
    assert [p.base for p in parts] == np.cumsum([0, *[p.n_tokens for p in parts]])[:-1].tolist()


def test_no_documents(docs_of):
    assert token_files.write_token_files(docs_of([]), WORDS, 2).documents().count() == 0
    assert trie_bpe.encode_and_decode(docs_of([]), WORDS).count() == 0
    assert packing.pack(docs_of([]), BYTES).count() == 0


def checked_packing(rows, placed, capacity):
    expected = {}
    for k, (doc_id, text) in enumerate(rows):
        ids = [*ids_of(BYTES, text), 0]
        head = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.setdefault((str(doc_id), piece, a, b - a), []).append(ids[a:b])
    sequences = {}
    for r in placed:
        ids = np.frombuffer(r.ids, "<u2").tolist()
        assert ids in expected[str(r.doc_id), r.piece, r.start, r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(placed) == sum(map(len, expected.values()))
    for spans in sequences.values():
        place = 0
        for offset, length in sorted(spans):
            assert offset == place
            place += length
        assert place <= capacity
    return len(sequences), sum(r.length for r in placed)


def test_packing_places_every_piece_once(docs_of):
    rows = odd_documents() + [(100 + i, f"word{i} " * (i % 40)) for i in range(400)]
    for capacity in (2048, 64):
        placed = packing.pack(docs_of(rows).repartition(5), BYTES, capacity=capacity).collect()
        used, tokens = checked_packing(rows, placed, capacity)
        assert used <= 1.03 * (tokens / capacity) + 2


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=20))
def test_plan_covers_every_length_without_gaps(histogram):
    counts = np.zeros(41, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = packing.plan(counts, 40)
    room = np.zeros(plan.sequences, np.int64)
    for length, count, first, per in zip(plan.length, plan.count, plan.sequence, plan.per):
        assert count % per == 0
        room[first : first + count // per] += length * per
    assert (room <= 40).all() and (room > 0).all()
    assert room.sum() == (counts * np.arange(41)).sum()
    # Never more than plain best fit needs, never fewer than the dual allows.
    best = sum(n for _, n in packing.best_fit(counts, 40))
    tokens = int((counts * np.arange(41)).sum())
    assert -(-tokens // 40) <= plan.bound <= plan.sequences <= best


@pytest.mark.parametrize("low,high,pieces,capacity", [(20, 70, 500, 100), (26, 51, 1000, 100), (200, 500, 4000, 1000)])
def test_linear_program_comes_near_its_bound(low, high, pieces, capacity):
    """Lengths that best fit packs badly: the fractional cover is within a few percent of the dual, the plan below best fit."""
    lengths = np.random.default_rng(low).integers(low, high, pieces)
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    used, bound = packing.fractional_cover(counts, capacity)
    assert all(sum(length * n for length, n in key) <= capacity for key in used)
    assert bound <= packing.plan(counts, capacity).sequences < sum(n for _, n in packing.best_fit(counts, capacity))
    assert packing.plan(counts, capacity).sequences <= 1.06 * bound
    made, left = packing.rounded(used, counts)
    held = sum(n * np.bincount(list(c), list(c.values()), capacity + 1) for c, n in made)
    assert (held + left == counts).all() and left.sum() < 0.5 * counts.sum()


def test_dual_bound_is_below_the_least_number():
    """By hand: 7 pieces of 6 in sequences of 10 need 7, which only the dual sees; 3 pairs of 4 fill gaps."""
    counts = np.zeros(11, np.int64)
    counts[6], counts[4] = 7, 3
    assert packing.plan(counts, 10).sequences == 7 and 6 <= packing.plan(counts, 10).bound <= 7
