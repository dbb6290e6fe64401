"""Benchmark decontamination: test items that occur word for word in documents.

One Aho-Corasick automaton holds every window of ``WINDOW`` consecutive words of
the test questions and answers, normalised: A-Z in lower case, words parted by
one space. Each document is normalised the same way and scanned once; whatever
ends at a place is found there, also windows that overlap. The places of the
bytes that normalisation keeps map a match back to the original text.

Only the items go to the driver and, as a broadcast, to the tasks, in blocks of
at most ``MOST_CHARS`` window characters (about 100 bytes of automaton each). A
larger set of items is scanned for block by block, with the words hit so far
written as a table in between.
"""

from __future__ import annotations

import re
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.llm.frames import texts, workspace
from haulmart.llm.terms import SEPARATES, bytes_of, item_blocks
from haulmart.llm.text import plain, slices

WINDOW = 10
MOST_CHARS = 1 << 21
SLICE = 4 << 20
# Fixed value: words after A-Z have been lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE, BREAK = 32, 10
FOUND = "doc_id long, text string, hits array<struct<first:int,last:int>>, items array<string>"


def windows_of(text: str, window: int) -> list[str]:
    """Windows of a normalised item, with a space before and after; one if it has fewer words."""
    words = WORD.findall(text.translate(LOWER))
    return [f" {' '.join(words[k : k + window])} " for k in range(max(1, len(words) - window + 1))] if words else []


class Windows:
    """Windows of a block of items; the automaton is made once in each Python worker."""

    def __init__(self, items: list[tuple], window: int):
        owners: dict[str, set[str]] = defaultdict(set)
        for item_id, text in items:
            for w in windows_of(text, window):
                owners[w].add("" if item_id is None else str(item_id))
        self.windows = list(owners)
        self.owners = [sorted(o) for o in owners.values()]
        self.words = np.array([w.count(" ") - 1 for w in self.windows], np.int64)
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            made = ahocorasick.Automaton()
            for k, w in enumerate(self.windows):
                made.add_word(w.encode().decode("latin-1"), k)
            made.make_automaton()
            self._automaton = made
        return self._automaton

    def matches(self, normal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows end, and which."""
        if not self.windows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # A character a byte, so that the automaton's places are places of bytes.
        found = np.array(list(self.automaton.iter(normal.tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]


def normalised(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as words between single spaces, a line break before each text and at the end;
    the places kept of what was normalised, and the texts' bounds in their own bytes."""
    data, bounds = bytes_of(pc.ascii_lower(strings))
    marks = np.tile(np.array([SPACE, BREAK, SPACE], np.uint8), len(bounds))
    flat = np.insert(np.where(SEPARATES[data], np.uint8(SPACE), data), np.repeat(bounds, 3), marks)
    space = flat == SPACE
    kept = ~space
    kept[1:] |= ~space[:-1]
    places = np.flatnonzero(kept)
    return flat[places], places, bounds


def original_places(strings: pa.Array, bounds: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of each text before places of what was normalised."""
    data, _ = bytes_of(strings)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points[at - 3 * (doc + 1)] - points[bounds[doc]]


def scan_batches(batches, windows, last: bool):
    """Adds the word ranges hit and the items found to those that each row has.

    At the last block the text goes and counts and places come.
    """
    known = windows.value
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            strings = plain(part.column("text"))
            normal, places, bounds = normalised(strings)
            rows = part.num_rows
            breaks = np.flatnonzero(normal == BREAK)
            outside = (normal == SPACE) | (normal == BREAK)
            begins = np.flatnonzero(~outside[1:] & outside[:-1]) + 1
            doc = np.searchsorted(breaks, begins) - 1
            n_words = np.bincount(doc, minlength=rows)
            first_word = np.cumsum(n_words) - n_words
            ends, which = known.matches(normal)
            stop = np.searchsorted(begins, ends)
            start = stop - known.words[which]
            change = np.zeros(len(begins) + 1, np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, stop, -1)
            names: dict[int, set[str]] = defaultdict(set)
            for row, k in np.unique(np.column_stack([doc[start], which]), axis=0).tolist():
                names[row].update(known.owners[k])
            before = part.column("hits").to_pylist(), part.column("items").to_pylist()
            for row, (hits, items) in enumerate(zip(*before)):
                for hit in hits or []:
                    change[first_word[row] + hit["first"]] += 1
                    change[first_word[row] + hit["last"] + 1] -= 1
                names[row].update(items or [])
            hit = np.cumsum(change[:-1]) > 0
            # Ranges of hit words within one text.
            fresh = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
            opens = np.flatnonzero(hit & (fresh | ~np.concatenate([[False], hit[:-1]])[: len(hit)]))
            closes = np.flatnonzero(hit & (np.append(fresh[1:], True) | ~np.append(hit[1:], False))[: len(hit)])
            of = doc[opens]
            per_row = np.bincount(of, minlength=rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32())
            listed = [sorted(names[row]) for row in range(rows)]
            if not last:
                pair = [opens - first_word[of], closes - first_word[of]]
                ranges = pa.StructArray.from_arrays([pa.array(p, pa.int32()) for p in pair], ["first", "last"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.ListArray.from_arrays(offsets, ranges), pa.array(listed, pa.list_(pa.string()))],
                    ["doc_id", "text", "hits", "items"],
                )
                continue
            spans = [np.zeros(0, np.int64)] * 2
            if len(opens):
                # The word's last byte is the one before the space that follows.
                word_ends = np.flatnonzero(~outside[:-1] & outside[1:])
                spans = [
                    original_places(strings, bounds, of, places[begins[opens]]),
                    original_places(strings, bounds, of, places[word_ends[closes]] + 1),
                ]
            spans = pa.StructArray.from_arrays([pa.array(s, pa.int64()) for s in spans], ["begin", "end"])
            n_hit = np.bincount(doc[hit], minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(listed, pa.list_(pa.string())),
                    pa.ListArray.from_arrays(offsets, spans),
                ],
                ["doc_id", "n_words", "n_hit", "items", "spans"],
            )


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` for every row of ``docs``.

    ``n_hit`` words stand inside an occurrence of a window of ``window`` consecutive
    words of an item (of the whole item, if it has fewer). ``items`` are the ids, as
    strings in their order, of the items with an occurring window, and ``spans``
    where hit words that follow each other begin and end in the original text, in
    code points. A null or empty text has no words; a null item id is an empty
    string; an item without words has no window; rows with equal ids keep a row
    each, items with equal ids count once. Without items nothing is hit, without
    documents there are no rows. Extra columns are not read. There is no shuffle.
    """
    spark = docs.sparkSession
    place = workspace(docs)
    asked = items.select(items[item_id_col].cast("string"), items[item_text_col])
    rows = texts(docs, id_col, text_col).select(
        "doc_id", "text", F.expr("cast(null as array<struct<first:int,last:int>>)").alias("hits"),
        F.expr("cast(null as array<string>)").alias("items"),
    )
    held = None
    for block in item_blocks(asked, lambda text: sum(map(len, windows_of(text, window))), MOST_CHARS):
        if held is not None:
            rows = place.materialize(_scanned(rows, held, FOUND), "hits")
        held = spark.sparkContext.broadcast(Windows(block, window))
    if held is None:
        held = spark.sparkContext.broadcast(Windows([], window))
    return _scanned(rows, held, None)


def _scanned(rows: DataFrame, windows, schema: str | None) -> DataFrame:
    done = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<begin:long,end:long>>"
    return rows.mapInArrow(lambda batches: scan_batches(batches, windows, schema is None), schema or done)
