"""Ranked lexical search of many items at once, with common sums worked out once.

An item's score is a sum over its terms, so items that share terms share partial
sums. The items' terms stand in one order, the most shared first; pairs of
neighbours that two items or more have are mined, the most frequent first, and
replaced by a node of their own, again and again. What results is a query-sharing
DAG: leaves are terms, a node adds up two others, an item is a short row of nodes.

Documents are read once. A first pass keeps of each its length and how often it
has the items' terms, and counts over all documents; the second makes, for a block
of documents at a time, the accumulators of the leaves, then of each node once,
then the items' scores. A task keeps the best few documents of each item.

Only the items go to the driver, in blocks of at most ``MOST_TERMS`` terms, and as
a broadcast to the tasks; a larger set of items is scored block by block.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.frames import texts, workspace
from haulmart.llm.terms import is_term, item_blocks, runs
from haulmart.llm.text import plain, slices

# Fixed values of the score.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCALE, LENGTH_PERCENT, SATURATION = 10**9, 25, 12
TOP = 20
MOST_TERMS = 1 << 16
# Documents whose accumulators a task has at once, by the numbers that it may hold.
HELD_NUMBERS = 8_000_000
KEPT = "doc_id long, n long, terms binary, times binary, term int, seen long"


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.translate(LOWER))


class Sharing:
    """The DAG over terms 0..n-1: node n + k adds up ``pairs[k]``; an item sums up its ``rows`` of nodes."""

    def __init__(self, items: list[list[int]], n_terms: int):
        used = Counter(t for item in items for t in set(item))
        rows = [sorted(item, key=lambda t: (-used[t], t)) for item in items]
        owners: dict[tuple[int, int], set[int]] = defaultdict(set)
        for k, row in enumerate(rows):
            for pair in zip(row, row[1:]):
                owners[pair].add(k)
        queue = [(-len(own), pair) for pair, own in owners.items() if len(own) > 1]
        heapq.heapify(queue)
        self.pairs: list[tuple[int, int]] = []
        while queue:
            count, pair = heapq.heappop(queue)
            own = owners[pair]
            if len(own) != -count:  # counted anew since
                if len(own) > 1:
                    heapq.heappush(queue, (-len(own), pair))
                continue
            node = n_terms + len(self.pairs)
            self.pairs.append(pair)
            changed = set()
            for k in sorted(own):
                row = rows[k]
                for old in zip(row, row[1:]):
                    owners[old].discard(k)
                made, at = [], 0
                while at < len(row):
                    if tuple(row[at : at + 2]) == pair:
                        made.append(node)
                        at += 2
                    else:
                        made.append(row[at])
                        at += 1
                rows[k] = made
                for new in zip(made, made[1:]):
                    owners[new].add(k)
                    changed.add(new)
            for new in changed:
                if len(owners[new]) > 1:
                    heapq.heappush(queue, (-len(owners[new]), new))
        self.rows = rows


class Queries:
    """A block of items: its terms' numbers and its DAG."""

    def __init__(self, texts_: list[str]):
        listed = [terms_of(t) for t in texts_]
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(t for item in listed for t in item))}
        self.sharing = Sharing([[self.terms[t] for t in item] for item in listed], len(self.terms))


def count_batches(batches, queries):
    """A row per document, and at the end one per term with the documents of this task that have it."""
    known = queries.value.terms
    seen = np.zeros(len(known), np.int64)
    width = 2 if len(known) <= 1 << 16 else 4
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("times", pa.binary()), ("term", pa.int32()), ("seen", pa.int64())]
    )
    for batch in batches:
        for part in slices(batch, "text"):
            vocabulary, codes, n = runs(pc.ascii_lower(plain(part.column("text"))), is_term)
            own = np.array([known.get(t, -1) for t in vocabulary], np.int64)[codes] if len(codes) else codes
            doc = np.repeat(np.arange(len(n)), n)[own >= 0]
            keys, times = np.unique(doc * max(1, len(known)) + own[own >= 0], return_counts=True)
            doc, term = keys // max(1, len(known)), keys % max(1, len(known))
            seen += np.bincount(term, minlength=len(known))
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(n)))])
            # Two bytes a number of times, or four in a slice with more.
            wide = 2 if times.max(initial=0) < 1 << 16 else 4
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n, pa.int64()),
                    packed(term, ends, width),
                    packed(times, ends, wide),
                    none.cast(pa.int32()),
                    none,
                ],
                schema=schema,
            )
    found = np.flatnonzero(seen)
    none = pa.nulls(len(found))
    yield pa.RecordBatch.from_arrays(
        [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.binary()), pa.array(found, pa.int32()), pa.array(seen[found])],
        schema=schema,
    )


def packed(values: np.ndarray, ends: np.ndarray, width: int) -> pa.Array:
    data = pa.py_buffer(values.astype(f"<u{width}"))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int32)), data])


class Scorer:
    """Weights of a block's terms and the lengths' mean, from counts over all documents."""

    def __init__(self, sharing: Sharing, n_terms: int, documents: int, terms: int, having: dict[int, int]):
        self.sharing, self.n_terms = sharing, n_terms
        self.documents, self.terms = documents, terms
        self.weights = np.zeros(n_terms, np.int64)
        for term, df in having.items():
            self.weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        self.at_once = max(1, HELD_NUMBERS // max(1, n_terms + len(sharing.pairs)))

    def leaves(self, sums: np.ndarray, n: np.ndarray, term: np.ndarray, times: np.ndarray, doc: np.ndarray) -> None:
        length = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * self.documents // max(1, self.terms)
        sums[: self.n_terms] = 0
        sums[term, doc] = self.weights[term] * (SCALE * times // (1000 * times + SATURATION * length[doc]))

    def scores(self, sums: np.ndarray):
        """Each node once, then the scores of every item that has a term."""
        for k, (x, y) in enumerate(self.sharing.pairs, self.n_terms):
            np.add(sums[x], sums[y], out=sums[k])
        for item, row in enumerate(self.sharing.rows):
            if row:
                yield item, sums[row[0]] if len(row) == 1 else sums[row].sum(axis=0)


def score_batches(batches, scorer, top: int):
    """The best documents of this task for each item: ``item, doc_id, score``, ties by id, a null id last."""
    own = scorer.value
    nodes = own.n_terms + len(own.sharing.pairs)
    last = np.iinfo(np.int64).max
    best: dict[int, tuple] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, own.at_once):
            part = batch.slice(at, own.at_once)
            n = part.column("n").to_numpy()
            ids = part.column("doc_id")
            unknown = ids.is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(ids, last).to_numpy()
            bytes_ = [(t, m) for t, m in zip(part.column("terms").to_pylist(), part.column("times").to_pylist())]
            width = 2 if own.n_terms <= 1 << 16 else 4
            each = np.array([len(t) // width for t, _ in bytes_], np.int64)
            term = np.frombuffer(b"".join(t for t, _ in bytes_), f"<u{width}").astype(np.int64)
            times = [np.frombuffer(m, f"<u{len(m) // max(1, k)}") if k else np.zeros(0, int) for (_, m), k in zip(bytes_, each.tolist())]
            times = np.concatenate([np.zeros(0, np.int64), *times]).astype(np.int64)
            sums = np.empty((nodes, part.num_rows), np.int64)
            own.leaves(sums, n, term, times, np.repeat(np.arange(part.num_rows), each))
            for item, score in own.scores(sums):
                had = best.get(item)
                least = max(1, int(had[0][-1]) if had is not None and len(had[0]) == top else 1)
                found = np.flatnonzero(score >= least)
                if not len(found):
                    continue
                rows = score[found], unknown[found], ids[found]
                if had is not None:
                    rows = tuple(map(np.concatenate, zip(had, rows)))
                order = np.lexsort((rows[2], rows[1], -rows[0]))[:top]
                best[item] = tuple(c[order] for c in rows)
    for item, (score, unknown, ids) in best.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), item), pa.int64()), pa.array(ids, mask=unknown), pa.array(score)], ["item", "doc_id", "score"]
        )


def rank(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its ``top`` documents of the highest scores above 0.

    Equal scores come in the order of ids, null ids last. A null or empty text has
    no terms: such a document is in no count and no result, such an item has no
    rows. Rows with equal ids are ranked each on its own, items with equal ids too.
    No documents or no items give no rows. Extra columns are not read. Weights need
    counts over all documents, so each block of items takes two passes, the second
    over what the first has kept. Scores are 64-bit integers.
    """
    spark = docs.sparkSession
    place = workspace(docs)
    read = texts(docs, id_col, text_col)
    asked = items.select(items[item_id_col].alias("item_id"), items[item_text_col])
    kind = asked.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(asked, lambda text: len(terms_of(text)), MOST_TERMS):
        queries = Queries([text for _, text in block])
        sent = spark.sparkContext.broadcast(queries)
        kept = place.materialize(read.mapInArrow(lambda b, sent=sent: count_batches(b, sent), KEPT), "kept_terms")
        totals = kept.where("n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
        # A row per term of this block.
        having = kept.where("term is not null").groupBy("term").agg(F.sum("seen").alias("df")).collect()
        own = Scorer(queries.sharing, len(queries.terms), totals.documents, totals.terms or 0, {r.term: r.df for r in having})
        scorer = spark.sparkContext.broadcast(own)
        rows = kept.where("n > 0 and length(terms) > 0").select("doc_id", "n", "terms", "times")
        best = rows.mapInArrow(lambda b, s=scorer: score_batches(b, s, top), "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(block)], f"item long, item_id {kind}")
        found = found.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return found
