"""BPE by prefix-sharing trie traversal, and its decoding.

For a given prefix of a word exactly one token can come last: the one that its
predecessor's last token leaves alone. So a depth-first walk over the trie of
the distinct words passes a *last-token state* down each edge and every shared
prefix is computed once. The words sorted, with the common prefix of neighbours,
are that trie in walking order; the states on the path are a stack.

Whether two neighbouring tokens leave each other alone is told by undoing their
merges, latest first: if a pair of pieces that meet at the seam merges before one
of the two is used up, the tokens can't stand side by side.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulmart.llm.encoders import byte_letters, read_vocabulary
from haulmart.llm.frames import texts
from haulmart.llm.text import slices

KEPT_PAIRS = 4_000_000


class TrieMerges:
    """Ids of the pieces of a batch, from the merge list alone."""

    def __init__(self, text: str):
        model = json.loads(text)["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.end = bool(end)
        self.inner = {t: i for t, i in vocab.items() if not end or not t.endswith(end)}
        self.final = {t[: len(t) - len(end)]: i for t, i in vocab.items() if t.endswith(end)} if end else self.inner
        self.longest = max(map(len, [*self.inner, *self.final]), default=1)
        size = max(vocab.values(), default=-1) + 1
        self.born = [-1] * size
        self.left, self.right = [0] * size, [0] * size
        self.rank: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = vocab[a + b]
            if self.born[made] >= 0:
                raise ValueError(f"two merges make the same token: {a + b}")
            self.born[made], self.left[made], self.right[made] = r, vocab[a], vocab[b]
            self.rank[vocab[a], vocab[b]] = r
        # A token that its own text doesn't encode to never occurs.
        self.proper = [True] * size
        for _, made in sorted((r, i) for i, r in enumerate(self.born) if r >= 0):
            a, b = self.left[made], self.right[made]
            self.proper[made] = self.proper[a] and self.proper[b] and self._apart(a, b, self.born[made])
        self.pairs: dict[tuple[int, int], bool] = {}

    def _apart(self, x: int, y: int, own: int = -1) -> bool:
        """Whether nothing merges over the seam between tokens x and y, but for the merge of rank ``own``."""
        born, rank = self.born, self.rank
        limit = len(rank) + 1
        while True:
            r = rank.get((x, y))
            if r is not None and r < limit and r != own:
                return False
            # Undo the later of the two; of equal ones the right one, as merges go from left to right.
            if born[x] > born[y]:
                limit = born[x]
                x = self.right[x]
            elif born[y] >= 0:
                limit = born[y] + 1
                y = self.left[y]
            else:
                return True

    def _last(self, word: str, stop: int, table: dict[str, int], ids: list[int]) -> tuple[int, int]:
        """The last token of word[:stop] and its length; ids holds the last tokens of the shorter prefixes."""
        pairs, proper = self.pairs, self.proper
        for start in range(max(0, stop - self.longest), stop):
            t = table.get(word[start:stop])
            if t is None or not proper[t]:
                continue
            if not start:
                return t, stop
            key = ids[start], t
            fits = pairs.get(key)
            if fits is None:
                fits = pairs[key] = self._apart(*key)
            if fits:
                return t, stop - start
        raise ValueError(f"no token ends {word[:stop]!r}")

    def __call__(self, pieces: list[str]) -> list[list[int]]:
        if len(self.pairs) > KEPT_PAIRS:
            self.pairs.clear()
        found: dict[str, list[int]] = {}
        ids, sizes = [0], [0]  # of the prefixes on the path, by length
        before = ""
        for word in sorted(set(pieces)):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            n = len(word)
            inner = n - 1 if self.end else n
            del ids[min(shared, inner) + 1 :], sizes[min(shared, inner) + 1 :]
            for stop in range(len(ids), inner + 1):
                t, size = self._last(word, stop, self.inner, ids)
                ids.append(t)
                sizes.append(size)
            tokens = []
            place = n
            if self.end and n:
                t, size = self._last(word, n, self.final, ids)
                tokens.append(t)
                place -= size
            while place:
                tokens.append(ids[place])
                place -= sizes[place]
            found[word] = tokens[::-1]
            before = word
        return [found[p] for p in pieces]


class Decoder:
    """Text of ids, special tokens included."""

    def __init__(self, text: str):
        described = json.loads(text)
        names = {i: t for t, i in described["model"]["vocab"].items()}
        names |= {t["id"]: t["content"] for t in described["added_tokens"]}
        self.names = [names.get(i, "") for i in range(max(names, default=-1) + 1)]
        kind = (described.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"no decoding for {kind}")
        self.by_bytes = kind == "ByteLevel"
        if self.by_bytes:
            byte_of = {c: b for b, c in byte_letters().items()}
            self.bytes = [
                bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in self.names
            ]

    def __call__(self, ids: list[int]) -> str:
        if self.by_bytes:
            return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return " ".join(map(self.names.__getitem__, ids))


def coded_batches(batches, vocabulary, real: bool):
    encoder = vocabulary.value.encoder(TrieMerges)
    decode = vocabulary.value.kept("decoder", Decoder)
    names = ["doc_id", "n_tokens", "ids", "decoded"] if real else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for batch in batches:
        for part in slices(batch, "text"):
            ids, counts = encoder(part.column("text"))
            ends = np.cumsum(counts)
            of_ids, of_texts = [], []
            for stop, n in zip(ends.tolist(), counts.tolist()):
                own = ids[stop - n : stop]
                text = decode(own.tolist())
                of_ids.append(own.astype(np.int32) if real else hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                of_texts.append(text if real else hashlib.sha256(text.encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.list_(pa.int32()) if real else pa.string()),
                    pa.array(of_texts, pa.string()),
                ],
                names,
            )


def encode_and_decode(
    docs: DataFrame, vocabulary_path: str, digests: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every whole text and the text that they decode to, one row per row of ``docs``.

    ``digests`` gives the SHA-256 of both in place of the values, made in the same
    task. A null text is empty: no ids, an empty text. Extra columns are not read.
    There is no shuffle: a task shares prefixes among the distinct words of its
    slices and remembers a bounded number of them.
    """
    vocabulary = read_vocabulary(docs.sparkSession, vocabulary_path)
    schema = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    )
    return texts(docs, id_col, text_col).mapInArrow(
        lambda batches: coded_batches(batches, vocabulary, not digests), schema
    )
