"""Token ids of whole texts with the tokenizers library, one encoding per distinct chunk.

Both vocabularies split surely where a character that is no white space is
followed by a plain space, tab or line break. A text is cut there; equal chunks
are encoded once and the ids are put together by numbers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import SparkSession

from haulmart.llm.text import PLAIN_SPACE, arange_each, chunks, listed

KEPT_CHUNKS = 800_000
# The splitting patterns of the two public vocabularies.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
# Up to here letters, digits and cases are the same in all versions of Unicode in use.
PLAIN_LETTERS = re.compile(r"[\x20-\x7e\t\n\r\xa1-\xac\xae-\u012f\u0132-\u0148\u014a-\u017e]*")


class Vocabulary:
    """A tokenizer's file; keeps what is made of it in each Python worker."""

    def __init__(self, text: str):
        self.text = text
        self.made: dict = {}

    def size(self) -> int:
        described = json.loads(self.text)
        ids = [*described["model"]["vocab"].values(), *(t["id"] for t in described["added_tokens"])]
        return max(ids, default=-1) + 1

    def kept(self, name: str, make: Callable):
        if name not in self.made:
            self.made[name] = make(self.text)
        return self.made[name]

    def encoder(self, merges: Callable | None = None) -> Encoder:
        return self.kept(f"encoder {merges and merges.__name__}", lambda text: Encoder(text, merges))


def read_vocabulary(spark: SparkSession, path: str):
    """The tokenizer's file, about 2 MB, as a broadcast."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(Vocabulary(file.read()))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Pieces:
    """Splits chunks into the byte-level words that the merges see.

    Chunks of plain letters are split here, all at once; others by the library's
    own normalizer and pre-tokenizer. A special token is a piece of its own.
    """

    def __init__(self, tokenizer, word_ends: bool):
        self.tokenizer = tokenizer
        self.word_ends = word_ends
        # NUL is no plain letter: it parts the chunks.
        self.pattern = regex.compile("\0|" + (WORD_PATTERN if word_ends else BYTE_PATTERN).replace(r"[^\s", r"[^\s\0"))
        self.letters = {b: ord(c) for b, c in byte_letters().items()}
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")

    def __call__(self, given: list[str]) -> tuple[list[str], list[str]]:
        """The chunks in the order in which they were split, and their pieces, each chunk's closed by NUL."""
        easy, hard = [], []
        for c in given:
            (easy if "<|" not in c and PLAIN_LETTERS.fullmatch(c) and c[-1] not in " \t\n\r" else hard).append(c)
        joined = "\0".join([*easy, ""])
        letters = self.letters
        found = self.pattern.findall(joined.lower() if self.word_ends else joined)
        pieces = [
            p if p == "\0" or (p[0] > " " and p.isascii()) else p.encode().decode("latin-1").translate(letters)
            for p in found
        ]
        for c in hard:
            pieces += [*self._whole(c), "\0"]
        return easy + hard, pieces

    def _whole(self, chunk: str) -> list[str]:
        found: list[str] = []
        place = 0
        for mark in self.marks.finditer(chunk):
            found += [*self._by_library(chunk[place : mark.start()]), mark.group()]
            place = mark.end()
        return found + self._by_library(chunk[place:])

    def _by_library(self, chunk: str) -> list[str]:
        if self.tokenizer.normalizer is not None:
            chunk = self.tokenizer.normalizer.normalize_str(chunk)
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]


class LibraryMerges:
    """Ids of pieces by the library's own model."""

    def __init__(self, tokenizer):
        self.tokenize = tokenizer.model.tokenize

    def __call__(self, pieces: list[str]) -> list[list[int]]:
        tokenize = self.tokenize
        return [[t.id for t in tokenize(p)] for p in pieces]


class Encoder:
    """Ids of many texts at once; remembers a bounded number of chunks."""

    def __init__(self, text: str, merges: Callable | None = None):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(text)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer = tokenizer
        self.pieces = Pieces(tokenizer, bool(getattr(tokenizer.model, "end_of_word_suffix", None)))
        self.merges = merges(text) if merges else LibraryMerges(tokenizer)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.piece_ids: dict[str, list[int]] = {"\0": []}
        self.flat = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)

    def _learn(self, fresh: list[str]) -> None:
        order, pieces = self.pieces(fresh)
        ids = self.piece_ids
        unknown = [p for p in dict.fromkeys(pieces) if p not in ids]
        for p, i in self.pieces.special.items():
            ids[p] = [i]
        unknown = [p for p in unknown if p not in ids]
        ids.update(zip(unknown, self.merges(unknown), strict=True))
        each = list(map(ids.__getitem__, pieces))
        size = np.fromiter(map(len, each), np.int64, len(each))
        ends = np.cumsum(size)[[i for i, p in enumerate(pieces) if p == "\0"]] if each else size
        self.number.update(zip(order, range(len(self.number), len(self.number) + len(order))))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(each), np.uint32, int(size.sum()))])
        self.size = np.concatenate([self.size, np.diff(ends, prepend=0)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids joined, and the number of ids of each text."""
        distinct, codes, counts = chunks(texts, PLAIN_SPACE)
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(counts), np.int64)
        pieces = listed(distinct)
        fresh = [c for c in pieces if c not in self.number]
        if len(self.number) + len(fresh) > KEPT_CHUNKS or len(self.flat) > 16 * KEPT_CHUNKS:
            self.forget()
            fresh = pieces
        if fresh:
            self._learn(fresh)
        start = np.cumsum(self.size) - self.size
        codes = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))[codes]
        each = self.size[codes]
        ids = self.flat[np.repeat(start[codes], each) + arange_each(each)]
        ends = np.concatenate([[0], np.cumsum(each)])
        places = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[places[1:]] - ends[places[:-1]]
