"""Terms of whole texts inside Arrow batches: maximal runs of bytes of a kind, numbered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulmart.llm.text import listed, plain

# All of ASCII but digits and letters separates; other characters never do, nor do their UTF-8 bytes.
SEPARATES = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
# The first byte of U+00C0 to U+00FF in UTF-8; one more follows.
WIDE_LETTER = 0xC3


def is_term(data: np.ndarray) -> np.ndarray:
    return ~SEPARATES[data]


def is_letter(data: np.ndarray) -> np.ndarray:
    """A-Z, a-z and U+00C0 to U+00FF."""
    wide = data == WIDE_LETTER
    inside = LETTER[data] | wide
    inside[1:] |= wide[:-1]
    return inside


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: none) and the bounds of each text among them."""
    texts = plain(texts)
    buffers = texts.buffers()
    first = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    low, high = int(first[0]), int(first[-1])
    data = np.frombuffer(buffers[2], np.uint8, high - low, low) if high > low else np.zeros(0, np.uint8)
    return data, first - low


def runs(texts: pa.Array, inside: Callable[[np.ndarray], np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct runs, the run number at each place, and runs per text."""
    data, bounds = bytes_of(texts)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    member = inside(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = member[1:] != member[:-1]
    cut[bounds] = True
    edges = np.flatnonzero(cut)
    chosen = member[edges[:-1]]
    before = np.concatenate([[0], np.cumsum(chosen)])[np.searchsorted(edges, bounds)]
    pieces = pa.Array.from_buffers(
        pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
    )
    coded = pieces.filter(pa.array(chosen)).dictionary_encode()
    return listed(coded.dictionary), coded.indices.to_numpy().astype(np.int64), np.diff(before)


def item_blocks(items: DataFrame, size: Callable[[str], int], most: int) -> Iterator[list[tuple]]:
    """The items (id, text) in blocks whose sizes sum up to ``most``; a larger item is a block of its own.

    One block at a time is on the driver.
    """
    block, total = [], 0
    for item_id, text in items.toLocalIterator():
        own = size(text or "")
        if block and total + own > most:
            yield block
            block, total = [], 0
        block.append((item_id, text or ""))
        total += own
    if block:
        yield block
