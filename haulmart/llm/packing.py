"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only the histogram of piece lengths reaches the driver, at most ``capacity``
numbers whatever the corpus. There the configuration linear program (the least sum
of sequences, of any configuration of lengths, that covers each length's count) is
solved by multiplicative weights: a length's price is its tokens times a weight that
falls as the length is covered, and a knapsack dynamic program prices the best
configurations. All prices over the best configuration's are a solution of the dual,
so each round also bounds the number of sequences from below. The fractional counts
are rounded to whole sequences, what is left of the histogram is solved again a few
times, and the last rest goes by best fit decreasing, also by counts; if best fit
alone needs fewer sequences, it is the plan. The plan, whose size depends on the capacity alone, says which ranks of each length go
to which sequences; each task looks its pieces up in it.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.encoders import read_vocabulary
from haulmart.llm.frames import texts, workspace
from haulmart.llm.text import arange_each, slices

# Of the multiplicative weights: rounds, how steeply a weight falls with the share covered,
# how near to the best price a configuration must be, and the share of a length's count
# that a round covers with its own configuration.
ROUNDS = 60
FALL = 3.0
NEAR = 0.02
STEP = 0.05
# Above 1, longer pieces have the higher price a token, and short ones, which fill gaps well, stay for the end.
LARGE = 1.05
# Times that what rounding leaves over is solved once more.
AGAIN = 3
# Bytes of text that are tokenized at once; ids, pieces and their orders take many times as much.
SLICE = 4 << 20
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, "


@dataclass
class Plan:
    """Rows of ranges: ranks ``first`` to ``first + count`` of a length fill ``per`` places each of
    the sequences from ``sequence`` on, the first of these places at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: int  # fewer sequences can't hold the pieces


def knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to capacity, the best price that fills it and the last length taken (0: none)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    own = price[lengths]
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fits[room]
        best[room] = best[room - 1]
        if n:
            value = best[room - lengths[:n]] + own[:n]
            k = int(value.argmax())
            if value[k] > best[room]:
                best[room], taken[room] = value[k], lengths[k]
    return best, taken


def fractional_cover(histogram: np.ndarray, capacity: int) -> tuple[dict[tuple, float], int]:
    """A number of sequences, perhaps not whole, for each configuration used, and the dual's bound.

    In each round the weights of the lengths fall with their share covered and the
    knapsack prices configurations. For every length the best one that holds it
    covers a little of the length's count, if its price is within ``NEAR`` of the
    best of all. At the end the counts are scaled so that no length is covered twice.
    """
    lengths = np.flatnonzero(histogram)
    demand = histogram.astype(float)
    covered = np.zeros(capacity + 1)
    tokens = np.arange(capacity + 1, dtype=float)
    first = tokens**LARGE
    used: dict[tuple, float] = {}
    bound = -(-int((histogram * np.arange(capacity + 1)).sum()) // capacity)
    for _ in range(ROUNDS if len(lengths) else 0):
        share = covered[lengths] / demand[lengths]
        price = np.zeros(capacity + 1)
        price[lengths] = first[lengths] * np.exp(-FALL * np.minimum(share - share.min(), 10))
        best, taken = knapsack(price, lengths, capacity)
        # A little less, as the sums are rounded.
        bound = max(bound, math.ceil(float(demand @ price) / best[capacity] * (1 - 1e-9) - 1e-6))
        for length in lengths[::-1].tolist():
            if price[length] + best[capacity - length] < (1 - NEAR) * best[capacity]:
                continue
            found = {length: 1}
            room = capacity - length
            while room:
                other = int(taken[room])
                if other:
                    found[other] = found.get(other, 0) + 1
                room -= other or 1
            key = tuple(sorted(found.items(), reverse=True))
            times = STEP * demand[length] / found[length]
            used[key] = used.get(key, 0.0) + times
            for other, n in key:
                covered[other] += n * times
    scale = max((covered[k] / demand[k] for k in lengths.tolist()), default=1.0)
    # Of lengths covered unevenly the mean: rounding takes no more of a length than there is.
    scale = min(scale, float((covered[lengths] * lengths).sum() / max(1.0, (demand * tokens).sum())) or 1.0)
    return {key: times / max(scale, 1e-12) for key, times in used.items()}, bound


def rounded(used: dict[tuple, float], histogram: np.ndarray) -> tuple[list[tuple[dict, int]], np.ndarray]:
    """Whole numbers of sequences and the histogram of what they leave over.

    The configurations, longest lengths first, are rounded so that the sum up to
    each is the whole part of the fractional sum; none takes more than there is.
    """
    left = histogram.astype(np.int64).copy()
    made: list[tuple[dict, int]] = []
    due = 0.0
    for key in sorted(used, reverse=True):
        due += used[key]
        times = min(int(due + 1e-9), *(int(left[length]) // n for length, n in key))
        if times > 0:
            due -= times
            made.append((dict(key), times))
            for length, n in key:
                left[length] -= n * times
        due = min(due, 1.0)
    return made, left


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[dict, int]]:
    """Best fit decreasing over counts; sequences of equal content are one entry."""
    classes: dict[int, list[list]] = {}  # by room left: entries of (content, how many)
    for length in np.flatnonzero(histogram)[::-1].tolist():
        n = int(histogram[length])
        while n:
            room = min((r for r in classes if r >= length), default=capacity)
            entries = classes.get(room)
            content, many = entries.pop() if entries else ({}, n)
            if entries is not None and not entries:
                del classes[room]
            fit = min(room // length, n)
            used = min(many, n // fit)
            if many > used and room in classes or many > used and content:
                classes.setdefault(room, []).append([content, many - used])
            n -= used * fit
            filled = dict(content)
            filled[length] = filled.get(length, 0) + fit
            classes.setdefault(room - fit * length, []).append([filled, used])
    return [(content, many) for entries in classes.values() for content, many in entries]


def plan(histogram: np.ndarray, capacity: int) -> Plan:
    used, bound = fractional_cover(histogram, capacity)
    made, left = rounded(used, histogram)
    for _ in range(AGAIN):
        more, left = rounded(fractional_cover(left, capacity)[0], left)
        made += more
    made += best_fit(left, capacity)
    plainly = best_fit(histogram, capacity)
    if sum(n for _, n in plainly) < sum(n for _, n in made):
        made = plainly
    rows = []
    taken = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for content, many in made:
        offset = 0
        for length, per in sorted(content.items(), reverse=True):
            rows.append((length, taken[length], per * many, sequence, per, offset))
            taken[length] += per * many
            offset += per * length
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 6)
    assert (taken == histogram).all()
    return Plan(*table.T, sequence, bound)


def cut_batches(batches, vocabulary, end_id: int, capacity: int, with_ids: bool):
    """Pieces with their ids, numbered within each length of this task."""
    encoder = vocabulary.value.encoder()
    task = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    width = 2 if vocabulary.value.size() <= 2**16 > end_id else 4
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            ids, counts = encoder(part.column("text"))
            joined = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            pieces = -(-counts // capacity)
            head = counts - (pieces - 1) * capacity
            nth_piece = arange_each(pieces)
            row = np.repeat(np.arange(len(counts)), pieces)
            length = np.where(nth_piece == 0, head[row], capacity)
            start = np.where(nth_piece == 0, 0, head[row] + (nth_piece - 1) * capacity)
            order = np.argsort(length, kind="stable")
            values, each = np.unique(length, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.repeat(seen[values], each) + arange_each(each)
            seen[values] += each
            bounds = np.concatenate([[0], np.cumsum(length)])
            crc = [zlib.crc32(joined[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            columns = {
                "doc_id": part.column("doc_id").take(pa.array(row)),
                "piece": pa.array(nth_piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                flat = pa.py_buffer(joined.astype(f"<u{width}"))
                places = pa.py_buffer((bounds * width).astype(np.int64))
                data = pa.Array.from_buffers(pa.large_binary(), len(length), [None, places, flat])
                columns["ids"] = data.cast(pa.binary())
            columns["task"] = pa.array(np.full(len(row), task), pa.int32())
            columns["nth"] = pa.array(nth)
            yield pa.RecordBatch.from_pydict(columns)


def place_batches(batches, ranges: Plan, kept: list[str]):
    """Look each piece up: the last range of its length that begins at or before its rank."""
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        # Ranges are sorted by length and rank; lengths differ, so compare in two steps.
        low = np.searchsorted(ranges.length, length, side="left")
        high = np.searchsorted(ranges.length, length, side="right")
        while (high - low > 1).any():
            middle = (low + high) // 2
            right = (high - low > 1) & (ranges.first[np.minimum(middle, len(ranges.first) - 1)] <= rank)
            left = (high - low > 1) & ~right
            low, high = np.where(right, middle, low), np.where(left, middle, high)
        inside = rank - ranges.first[low]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name) for name in kept],
                pa.array(ranges.sequence[low] + inside // ranges.per[low], pa.int64()),
                pa.array(ranges.offset[low] + inside % ranges.per[low] * length, pa.int64()),
            ],
            [*kept, "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int = 0,
    capacity: int = 2048,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A row per piece: ``doc_id, piece, start, length, ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers) ``, sequence_id, offset`` and, unless
    ``with_ids`` is false, ``ids``, little-endian unsigned integers of 2 or 4 bytes. A null text is empty and has
    the end id alone. Rows with equal or null ids are packed each on its own. No
    documents give no rows. Only documents longer than ``capacity`` are cut; their
    first piece takes the remainder. Extra columns are not read.
    """
    spark = docs.sparkSession
    place = workspace(docs)
    vocabulary = read_vocabulary(spark, vocabulary_path)
    pieces = place.materialize(
        texts(docs, id_col, text_col).mapInArrow(
            lambda batches: cut_batches(batches, vocabulary, end_id, capacity, with_ids),
            PIECE + "ids binary, " * with_ids + "task int, nth long",
        ),
        "pieces",
    )
    # A row per task and length: the ranks of a length run through the tasks in order.
    counts = place.materialize(pieces.groupBy("length", "task").count(), "lengths")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():
        histogram[row.length] = row.n
    ranges = plan(histogram, capacity)
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = pieces.join(bases, ["length", "task"]).select(*kept, (F.col("base") + F.col("nth")).alias("rank"))
    schema = PIECE + "ids binary, " * with_ids + "sequence_id long, offset long"
    return ranked.mapInArrow(lambda batches: place_batches(batches, ranges, kept), schema)
