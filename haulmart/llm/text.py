"""Whole texts inside Arrow batches: slices, words, shingles.

Everything here works on one Arrow batch of one task. Words and chunks are never
turned into one Python string per occurrence: a batch is cut by offsets, its
distinct pieces are numbered, and the rest is numpy over the numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# The white space that separates words, and the narrower set at
# which every tokenizer pattern in use surely splits.
WORD_SPACE = b" \t\n\x0b\x0c\r"
PLAIN_SPACE = b" \t\n\r"
SLICE_BYTES = 12 << 20
# Odd multipliers of the shingle hash: powers of the 64-bit golden ratio.
GOLDEN = 0x9E3779B97F4A7C15


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch where its texts reach ``limit`` bytes; one longer text is a slice of its own."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def plain(texts: pa.Array) -> pa.Array:
    """A contiguous string array without nulls (null becomes empty) that starts at offset 0."""
    return pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])


def chunks(texts: pa.Array, space: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks, the chunk number at each place, and the number of places per text.

    A chunk is a run of white space and the run of other characters after it.
    Chunks of a text joined give the text.
    """
    texts = plain(texts)
    buffers = texts.buffers()
    first = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    low, high = int(first[0]), int(first[-1])
    if low == high:
        return pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    data = np.frombuffer(buffers[2], np.uint8, high - low, low)
    table = np.zeros(256, bool)
    table[list(space)] = True
    is_space = table[data]
    cut = np.zeros(high - low + 1, bool)
    cut[1:-1] = is_space[1:] & ~is_space[:-1]
    bounds = (first - low).astype(np.int64)
    cut[bounds] = True
    edges = np.flatnonzero(cut)
    places = np.searchsorted(edges, bounds)
    values = pa.Array.from_buffers(
        pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
    )
    coded = values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int32), np.diff(places)


def listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words ``[^\\x20\\x09-\\x0D]+``, the word number at each place, words per text."""
    pieces, codes, counts = chunks(texts, WORD_SPACE)
    coded = pc.utf8_ltrim(pieces, WORD_SPACE.decode()).dictionary_encode()
    vocabulary = listed(coded.dictionary)
    if len(codes):
        codes = coded.indices.to_numpy().astype(np.int32)[codes]
    if "" in vocabulary:  # white space at the end of a text is a chunk without a word
        real = codes != vocabulary.index("")
        text = np.repeat(np.arange(len(counts)), counts)
        codes, counts = codes[real], np.bincount(text[real], minlength=len(counts))
    return vocabulary, codes, counts.astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit shingle hashes of all texts, shingles per text, words per text.

    A text with fewer words than ``size`` has one shingle, its whole sequence;
    a text without words has none.
    """
    vocabulary, codes, counts = words(texts)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
    places = hashed[codes] if len(vocabulary) else np.zeros(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    factors = [np.uint64(pow(GOLDEN, k + 1, 2**64)) for k in range(size)]
    with np.errstate(over="ignore"):
        # A full shingle at every place, also over the ends of texts; those are not chosen below.
        total = np.full(len(places), size, np.uint64)
        for k, factor in enumerate(factors):
            total[: max(0, len(places) - k)] += places[k:] * factor
        for row in np.flatnonzero((counts > 0) & (counts < size)).tolist():
            first, n = starts[row], int(counts[row])
            total[first] = np.uint64(n) + sum(
                (places[first + k] * factors[k] for k in range(n)), np.uint64(0)
            )
    chosen = np.zeros(len(places) + 1, np.int8)
    np.add.at(chosen, starts[:-1][each > 0], 1)
    np.add.at(chosen, (starts[:-1] + each)[each > 0], -1)
    return mixed(total[np.cumsum(chosen[:-1]) > 0]), each.astype(np.int64), counts


def arange_each(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, joined."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - counts, counts)


def distinct_each(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and how many there are."""
    hashes = hashes.copy()
    ends = np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        hashes[start:end].sort()
    text = np.repeat(np.arange(len(counts)), counts)
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[fresh], np.bincount(text[fresh], minlength=len(counts)).astype(np.int64)
