"""Spelling variants: words of a corpus grouped under the most frequent form one edit away.

Reduced-alphabet generation. Letters are hashed to a few symbols, so that each
symbol is about as frequent as the others; of each word so reduced the full one-edit neighbourhood is generated (every inserted, deleted and
replaced symbol, and the reduced word itself) and joined with the reduced
vocabulary; what meets is verified on the words themselves. Two words one edit
apart are, reduced, at most one edit apart, so no pair is lost.

Reduced words are 64-bit polynomial hashes, so that each edit is one sum. A pair
is generated from the smaller hash alone. Neighbours that no word of the
vocabulary has are mostly left out in the generating task by a bitmap of fixed
size. Where many words share a reduced word, the words that meet there go on to a
finer alphabet, in the last round to that of all letters, instead of being paired.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.llm.frames import texts, workspace
from haulmart.llm.terms import is_letter, runs
from haulmart.llm.text import GOLDEN, mixed, plain, slices

# Fixed values of the vocabulary.
DROP_EVERY = 97
LEAST_CHARS, LEAST_TIMES = 5, 3
FORM_TIMES = 2
# Symbols of each round; all letters (a-z, U+00C0 to U+00FF) have symbols of their own in the last.
ALPHABETS = (8, 32, 128)
# Words that meet at one reduced word, as a product of both sides, up to which they are paired at once.
MOST_MET = 200_000
BITMAP_BITS = 1 << 27
# Bits of one row of Spark's bitmap functions.
BITMAP_ROW = 32768
KEPT_WORDS = 400_000
HELD_KEYS = 2_000_000


def word_batches(batches):
    """``word, n`` of the runs of a task's documents, each with one letter dropped where its hash says so."""
    counts: dict[str, int] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            vocabulary, codes, each = runs(pc.ascii_lower(plain(part.column("text"))), is_letter)
            doc = np.repeat(np.arange(len(each)), each)
            keys, times = np.unique(doc * max(1, len(vocabulary)) + codes, return_counts=True)
            names = ["" if i is None else str(i) for i in part.column("doc_id").to_pylist()]
            starts = [zlib.crc32(f"{name}:".encode()) for name in names]
            encoded = [w.encode() for w in vocabulary]
            size = max(1, len(vocabulary))
            for row, code, n in zip((keys // size).tolist(), (keys % size).tolist(), times.tolist()):
                word = vocabulary[code]
                h = zlib.crc32(encoded[code], starts[row])
                if h % DROP_EVERY == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                if len(word) >= LEAST_CHARS:
                    counts[word] = counts.get(word, 0) + n
            if len(counts) >= KEPT_WORDS:
                yield counted(counts)
                counts = {}
    yield counted(counts)


def counted(counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def vocabulary_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    words = texts(docs, id_col, text_col).mapInArrow(word_batches, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


def alphabet(letters: np.ndarray, many: int) -> np.ndarray:
    """The symbol, from 1 on, of each code point: letters are dealt, the most frequent first, to the symbol that is least in use."""
    table = np.zeros(256, np.uint64)
    used = np.zeros(min(many, max(1, int((letters > 0).sum()))))
    for letter in sorted(np.flatnonzero(letters).tolist(), key=lambda c: (-letters[c], c)):
        symbol = int(used.argmin())
        table[letter] = symbol + 1
        used[symbol] += letters[letter]
    return table


def letter_batches(batches):
    """How often the words of a task have each letter."""
    counts = np.zeros(256, np.int64)
    for batch in batches:
        joined = "".join(batch.column("word").to_pylist()).encode("latin-1")
        counts += np.bincount(np.frombuffer(joined, np.uint8), minlength=256)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["letter", "n"])


def by_length(words: pa.Array):
    """Places and code points of the words of each length."""
    lengths = pc.utf8_length(words).to_numpy().astype(np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        step = max(1, HELD_KEYS // max(1, length))
        for start in range(0, len(at), step):
            own = at[start : start + step]
            joined = "".join(words.take(pa.array(own)).to_pylist())
            yield own, np.frombuffer(joined.encode("utf-32-le"), "<u4").reshape(len(own), length)


def powers(count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.array([1] + [GOLDEN] * count, np.uint64), dtype=np.uint64)


def reduced_keys(reduced: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (reduced * powers(reduced.shape[1] - 1)).sum(axis=1, dtype=np.uint64)


def finished(sums: np.ndarray, length) -> np.ndarray:
    """Keys that are told apart by length too, as signed numbers."""
    with np.errstate(over="ignore"):
        return mixed(sums + np.uint64(length) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)


def neighbourhoods(reduced: np.ndarray, many: int):
    """Blocks of keys of the words' reduced one-edit neighbours, a row per word; with repeats."""
    rows, length = reduced.shape
    back = np.uint64(pow(GOLDEN, -1, 2**64))
    factor = powers(length)
    with np.errstate(over="ignore"):
        parts = reduced * factor[:-1]
        upto = np.concatenate([np.zeros((rows, 1), np.uint64), np.cumsum(parts, axis=1, dtype=np.uint64)], axis=1)
        total = upto[:, -1:]
        yield finished(total, length)
        # Places by blocks, so that a very long word needs no more at once than many short ones.
        step = max(1, HELD_KEYS // max(1, rows * many))
        for start in range(0, length + 1, step):
            stop = min(length, start + step)
            at = np.arange(start, stop)
            if len(at):
                yield finished(upto[:, at] + (total - upto[:, at + 1]) * back, length - 1)
            inserted = np.arange(start, min(length + 1, start + step))
            for symbol in range(1, many + 1):
                new = np.uint64(symbol)
                if len(at):
                    yield finished(total + (new - reduced[:, at]) * factor[at], length)
                yield finished(upto[:, inserted] + new * factor[inserted] + (total - upto[:, inserted]) * np.uint64(GOLDEN), length + 1)


def key_batches(batches, table: np.ndarray):
    for batch in batches:
        words = batch.column("word")
        keys = np.zeros(batch.num_rows, np.int64)
        for own, letters in by_length(words):
            keys[own] = finished(reduced_keys(table[letters]), letters.shape[1])
        yield pa.RecordBatch.from_arrays([words, batch.column("n"), pa.array(keys)], ["word", "n", "key"])


def bit_of(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint64) & np.uint64(BITMAP_BITS - 1)


def probe_batches(batches, table: np.ndarray, bitmap):
    """``key, near, word, n``: a word with its own key and the key of each reduced neighbour that a word may have."""
    bits = bitmap.value
    many = int(table.max())
    for batch in batches:
        words, counts = batch.column("word"), batch.column("n")
        for whole, letters in by_length(words):
            step = max(1, HELD_KEYS // (letters.shape[1] * many))
            for start in range(0, len(whole), step):
                own = whole[start : start + step]
                reduced = table[letters[start : start + step]]
                key = finished(reduced_keys(reduced), letters.shape[1])
                found = []
                for near in neighbourhoods(reduced, many):
                    bit = bit_of(near)
                    known = (near >= key[:, None]) & (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 > 0)
                    row, at = np.nonzero(known)
                    found.append((row, near[row, at]))
                row, near = map(np.concatenate, zip(*found))
                order = np.lexsort((near, row))
                row, near = row[order], near[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (near[1:] != near[:-1])
                row, near = row[fresh], near[fresh]
                at = pa.array(own[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[row]), pa.array(near), words.take(at), counts.take(at)], ["key", "near", "word", "n"]
                )


def bitmap_of(keyed: DataFrame) -> np.ndarray:
    """One bit per value of a key's lowest bits, of ``BITMAP_BITS``; built in the tasks, 16 MB in all."""
    place = F.col("key").bitwiseAND(BITMAP_BITS - 1)
    rows = keyed.select((place / BITMAP_ROW).cast("int").alias("row"), (place % BITMAP_ROW).alias("bit"))
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for found in rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        own = np.frombuffer(bytes(found.bits), np.uint8)
        bits[found.row * BITMAP_ROW // 8 :][: len(own)] = own
    return bits


def near_pairs(words: DataFrame, place) -> DataFrame:
    """``a, n_a, b, n_b``: every two words that are exactly one edit apart, once."""
    spark = words.sparkSession
    found = None
    for round_, many in enumerate(ALPHABETS):
        letters = np.zeros(256, np.int64)
        for row in words.mapInArrow(letter_batches, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
            letters[row.letter] = row.n
        table = alphabet(letters, many)
        keyed = place.materialize(words.mapInArrow(lambda b, t=table: key_batches(b, t), "word string, n long, key long"), "reduced")
        bitmap = spark.sparkContext.broadcast(bitmap_of(keyed))
        probes = place.materialize(
            words.mapInArrow(lambda b, t=table, s=bitmap: probe_batches(b, t, s), "key long, near long, word string, n long"), "neighbours"
        )
        last = round_ == len(ALPHABETS) - 1
        own, met = keyed, probes
        if not last:
            sizes = keyed.groupBy("key").agg(F.count("*").alias("here"))
            asked = probes.groupBy(F.col("near").alias("near_key")).agg(F.count("*").alias("asking"))
            crowded = sizes.join(asked, F.col("key") == F.col("near_key")).where(F.col("here") * F.col("asking") > MOST_MET)
            crowded = place.materialize(crowded.select(F.col("key").alias("crowded")), "crowded")
            if crowded.isEmpty():
                last = True
            else:
                own = keyed.join(crowded, F.col("key") == F.col("crowded"), "left_anti")
                met = probes.join(crowded, F.col("near") == F.col("crowded"), "left_anti")
        sided = met.select(F.col("key").alias("key_a"), "near", F.col("word").alias("a"), F.col("n").alias("n_a")).join(
            own.select(F.col("key").alias("key_b"), F.col("word").alias("b"), F.col("n").alias("n_b")),
            F.expr("near = key_b and (key_a != key_b or a < b) and levenshtein(a, b, 1) = 1"),
        )
        pairs = place.materialize(sided.select("a", "n_a", "b", "n_b"), "near")
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        go_on = keyed.join(crowded, F.col("key") == F.col("crowded"), "left_semi").select("word", "n")
        go_on = go_on.unionByName(probes.join(crowded, F.col("near") == F.col("crowded"), "left_semi").select("word", "n"))
        words = place.materialize(go_on.dropDuplicates(["word"]), "crowded_words")
    # Very long words give a neighbour in several blocks, and rounds may repeat a pair, perhaps the other way round.
    low, high = (F.struct(F.col(w).alias("w"), F.col(n).alias("n")) for w, n in (("a", "n_a"), ("b", "n_b")))
    found = found.select(F.least(low, high).alias("low"), F.greatest(low, high).alias("high"))
    found = found.selectExpr("low.w AS a", "low.n AS n_a", "high.w AS b", "high.n AS n_b")
    return found.dropDuplicates(["a", "b"])


def roots_of(forms: DataFrame, place) -> DataFrame:
    """``word, root`` of the words that have a form: where the chain of forms ends.

    A form has at least twice the count of its word, so a chain is short; its length
    halves in every turn. Only words whose form has a form are joined.
    """
    current = place.materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = current.join(ahead, F.col("root") == F.col("_word"), "left")
        moved = place.materialize(
            moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots"
        )
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        current = moved.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n``: the words of all documents and what they may be variants of.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z in lower
    case, of at least ``LEAST_CHARS`` code points with at least ``LEAST_TIMES``
    occurrences; in one of ``DROP_EVERY`` cases, by a hash of document id and run, a
    run first loses a letter. ``n_near`` counts the words exactly one edit apart.
    ``form`` is the most frequent of those (ties: the smallest) if it has at least
    ``FORM_TIMES`` times the occurrences, and ``root`` the end of the chain of forms.
    A null or empty text has no words; a null id is empty in the hash; repeated rows
    count each. Without words there are no rows. Extra columns are not read.
    """
    place = workspace(docs)
    words = place.materialize(vocabulary_of(docs, id_col, text_col), "words")
    pairs = place.materialize(near_pairs(words, place), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("other")).alias("near"))
    both = both.unionByName(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("other")).alias("near"))
    )
    near = both.groupBy(F.col("word").alias("_word")).agg(F.min("near").alias("first"), F.count("*").alias("n_near"))
    is_form = -F.col("first.less") >= FORM_TIMES * F.col("n")
    judged = words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word",
        F.when(is_form, F.col("first.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("first.less")).alias("form_n"),
    )
    judged = place.materialize(judged, "forms")
    roots = roots_of(judged.where("form is not null"), place).withColumnRenamed("word", "_word")
    joined = judged.join(roots, F.col("word") == F.col("_word"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
