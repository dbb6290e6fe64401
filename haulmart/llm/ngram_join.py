"""N-gram Jaccard join with a count-vector R-tree.

Texts with equal shingle sets are one *node*. Two nodes with a Jaccard similarity
of 0.75 have a token (a shingle's hash) in common among the first quarter of
each, in any order of the tokens that all nodes follow; the order is by hash, the
most frequent tokens last. Nodes that share such a token stand in one *run*.

Linking needs one path between any two nodes of a component, not all pairs:

1. Tokens are hashed into groups; the counts of the groups are a node's point,
   and the sum of the coordinates' minima bounds the overlap of two nodes. So does
   the number of finer groups in which one node has an odd count and the other an
   even one, for each of these takes a token that only one has. A run of at most
   ``LEAF_RUN`` nodes is one leaf: its pairs, a bounded number per node, meet once
   however many runs they share, and those within the bounds are verified. In a
   longer run so is each node with the node that leads most of its runs. What is
   verified is joined into components.
2. Runs within one component are done with. Of the others a node stays in a run
   only if a node of another component has enough left from the shared token on and
   shares none of the first ones before it: a pair that links does so in the run of
   its first common token. Of what stays R-trees are made, one for each block of
   ``RUN_BLOCK`` nodes or so, in which the maxima of a subtree's points bound the
   overlap with all of them. One turn looks for each point's nearest one of another
   component in a block, the last for all that may still link.

Every pair of nodes of different components that can reach the similarity is
verified on whole texts, so no link between components is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.llm.frames import free_names, partitions, texts, workspace
from haulmart.llm.text import arange_each, distinct_each, shingles, slices

WORDS = 5
# Link when LINK_PERCENT * union <= 100 * intersection.
LINK_PERCENT = 75
# Tokens that a slice of texts has often are counted over the corpus; the most frequent ones come
# last in the order. Any such list gives the same links, so a bounded one will do.
OFTEN_IN_SLICE = 2
FREQUENT_FROM = 24
FREQUENT_TOKENS = 1 << 17
LEAF_RUN = 8
LEAF, FANOUT = 16, 8
# Points of one R-tree, about; a longer run is dealt to several. Points that are looked up at once.
RUN_BLOCK, ASKED_AT_ONCE = 2048, 1024
# Rows of runs that are paired at once.
PAIRED_ROWS = 100_000
LEAST_GROUPS, MOST_GROUPS = 16, 4096
# Hashes of a group on average, at most.
GROUP_COUNT = 1 << 14
# Groups whose odd counts are marked, per group that is counted, and their least number. Bytes of marks that
# are compared at once.
ODD_PER_GROUP, LEAST_ODD = 4, 512
COMPARED_AT_ONCE = 16 << 20
# First tokens that a point carries, to meet another one in few of the runs they share.
FIRST_TOKENS = 4
# Nodes of a run whose pairs are looked at to leave out those that cannot link; in a longer run, or one of
# more than a block, all stay. Pairs looked at at once.
PRUNED_RUN, PRUNED_AT_ONCE = 1024, 500_000
BROADCAST_NODES = 500_000
VERIFIED_AT_ONCE = 1000


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest intersection with which sets of sizes a and b link."""
    return -(-LINK_PERCENT * (a + b) // (100 + LINK_PERCENT))


def prefix_size(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n - -(-LINK_PERCENT * n // 100) + 1, 0)


def groups_of(n: np.ndarray) -> np.ndarray:
    """Binary logarithm of the number of groups: about a quarter of the set's size."""
    wanted = np.ceil(np.log2(np.maximum(n, 4) / 4)).astype(np.int64)
    # Beyond the usual most, so many that a group's count stays far below 16 bits.
    needed = np.ceil(np.log2(np.maximum(n, 1) / GROUP_COUNT)).astype(np.int64)
    return np.maximum(np.clip(wanted, LEAST_GROUPS.bit_length() - 1, MOST_GROUPS.bit_length() - 1), needed)


def node_ids(hashes: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    ends = np.cumsum(counts)
    data = hashes.tobytes()
    return np.array(
        [xxhash.xxh3_64_intdigest(data[8 * (e - n) : 8 * e], seed) for e, n in zip(ends.tolist(), counts.tolist())], np.uint64
    ).view(np.int64)


def profile_batches(batches, seed: int):
    """A row per document, and rows of the tokens that are frequent in a slice."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("other", pa.int64()), ("token", pa.int64()), ("seen", pa.int64())]
    )
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, each, _ = shingles(part.column("text"), WORDS)
            hashes, n = distinct_each(hashes, each)
            nodes, others = node_ids(hashes, n, seed), node_ids(hashes, n, seed + 1)
            tokens, seen = np.unique(hashes, return_counts=True)
            # A text has a token once here, so this counts texts.
            often = seen >= OFTEN_IN_SLICE
            tokens, seen = tokens[often].view(np.int64), seen[often]
            none = pa.nulls(len(tokens), pa.int64())
            empty = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(nodes, mask=n == 0), pa.array(others), empty, empty], schema=schema
            )
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(tokens), pa.array(seen)], schema=schema)


def group_counts(hashes: np.ndarray, n: np.ndarray) -> pa.Array:
    """Each set's number of hashes a group, as 16-bit integers."""
    row = np.repeat(np.arange(len(n)), n)
    groups = 1 << groups_of(n)
    base = np.cumsum(groups) - groups
    place = base[row] + (hashes & (groups[row] - 1).astype(np.uint64)).astype(np.int64)
    counts = np.minimum(np.bincount(place, minlength=int(groups.sum())), 65535).astype("<u2")
    bounds = np.concatenate([[0], np.cumsum(groups) * 2]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(counts)])


def odd_bits(level: np.ndarray) -> np.ndarray:
    """The number of groups whose odd counts are marked, a power of two as the number of counted ones, 1 << level."""
    return np.maximum(ODD_PER_GROUP << level, LEAST_ODD)


def odd_groups(hashes: np.ndarray, n: np.ndarray) -> pa.Array:
    """Each set's groups with an odd number of hashes, as bits."""
    row = np.repeat(np.arange(len(n)), n)
    bits = odd_bits(groups_of(n))
    base = np.cumsum(bits) - bits
    place = base[row] + (hashes & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8)
    bounds = np.concatenate([[0], np.cumsum(bits) // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(np.packbits(odd, bitorder="little"))])


def may_link(odd_a: np.ndarray, odd_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes a and b with these odd groups, in words of 64, can link.

    A group that is odd in one set and even in the other has a hash that only one of them has.
    """
    apart = np.bitwise_count(odd_a ^ odd_b).sum(axis=1, dtype=np.int64)
    return apart <= a + b - 2 * least_overlap(a, b)


def signature_batches(batches, seed: int, frequent):
    """``node, n, tokens, counts, odd`` of each node of a task: its first tokens, group counts and odd groups."""
    last = frequent.value
    done: set[int] = set()
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, each, _ = shingles(part.column("text"), WORDS)
            hashes, n = distinct_each(hashes, each)
            nodes = node_ids(hashes, n, seed)
            text = np.repeat(np.arange(len(n)), n)
            fresh = np.array([k > 0 and not (i in done or done.add(i)) for i, k in zip(nodes.tolist(), n.tolist())], bool)
            hashes, text = hashes[fresh[text]], text[fresh[text]]
            nodes, n = nodes[fresh], n[fresh]
            if not len(n):
                continue
            row = np.repeat(np.arange(len(n)), n)
            if len(last):
                late = last[np.minimum(np.searchsorted(last, hashes), len(last) - 1)] == hashes
                order = np.lexsort((hashes, late, row))
            else:
                order = np.arange(len(hashes))
            starts = np.cumsum(n) - n
            size = prefix_size(n)
            chosen = hashes[order][np.repeat(starts, size) + arange_each(size)].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(chosen)),
                    group_counts(hashes, n),
                    odd_groups(hashes, n),
                ],
                ["node", "n", "tokens", "counts", "odd"],
            )


def run_batches(batches):
    """Rows sorted by token and node in. Out: the pairs of short runs, and the rows of long ones with their lead."""
    kept: list[np.ndarray] = []
    size = 0
    long_token: int | None = None
    lead = (0, 0)

    def given(rows: np.ndarray, last: bool):
        """Work off whole runs; the last one may go on, unless nothing follows."""
        nonlocal long_token, lead
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[fresh]
        begins = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        lengths = np.diff(np.append(begins, len(rows)))
        rest = rows[:0]
        if not last:
            if lengths[-1] <= LEAF_RUN and rows[-1, 0] != long_token:
                rest = rows[begins[-1] :]
                rows, begins, lengths = rows[: begins[-1]], begins[:-1], lengths[:-1]
            elif len(rows) > 1:
                rest = rows[-1:]  # repeated by the next row, perhaps
        out = []
        if len(begins):
            is_long = lengths > LEAF_RUN
            if long_token is not None and rows[0, 0] == long_token:
                is_long[0] = True
            else:
                long_token = None
            if is_long.any():
                first = np.repeat(begins, lengths)
                leads, lead_ns = rows[first, 1], rows[first, 2]
                if long_token is not None:
                    leads[: lengths[0]], lead_ns[: lengths[0]] = lead
                of_long = np.repeat(is_long, lengths)
                empty = pa.nulls(int(of_long.sum()), pa.int64())
                long_rows = [rows[of_long, c] for c in range(4)]
                out.append([empty, empty, *map(pa.array, [*long_rows, leads[of_long], lead_ns[of_long]])])
            if is_long[-1]:
                if rows[begins[-1], 0] != long_token:
                    lead = int(rows[begins[-1], 1]), int(rows[begins[-1], 2])
                long_token = int(rows[begins[-1], 0])
            pairs = short_pairs(rows, begins[~is_long], lengths[~is_long])
            empty = pa.nulls(len(pairs), pa.int64())
            out.append([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), *[empty] * 6])
        return rest, [pa.RecordBatch.from_arrays(columns, schema=RUN_SCHEMA) for columns in out]

    for batch in batches:
        kept.append(np.column_stack([batch.column(c).to_numpy() for c in ("token", "node", "n", "rest")]))
        size += batch.num_rows
        if size >= PAIRED_ROWS:
            rest, found = given(np.concatenate(kept), False)
            kept, size = [rest], len(rest)
            yield from found
    if size:
        yield from given(np.concatenate(kept), True)[1]


RUN_SCHEMA = pa.schema([(c, pa.int64()) for c in ("a", "b", "token", "node", "n", "rest", "lead", "lead_n")])


def short_pairs(rows: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Distinct pairs of nodes of one run whose sizes, and what they have left from its token on, allow a link."""
    found = [np.zeros((0, 2), np.int64)]
    for length in np.unique(lengths[lengths > 1]).tolist():
        own = begins[lengths == length]
        left, right = np.triu_indices(length, 1)
        # A block of runs of one length at a time.
        step = max(1, 500_000 // len(left))
        for start in range(0, len(own), step):
            first = own[start : start + step, None]
            i, j = (first + left).ravel(), (first + right).ravel()
            fits = np.minimum(rows[i, 3], rows[j, 3]) >= least_overlap(rows[i, 2], rows[j, 2])
            i, j = i[fits], j[fits]
            pairs = np.column_stack([np.minimum(rows[i, 1], rows[j, 1]), np.maximum(rows[i, 1], rows[j, 1])])
            found.append(distinct_rows(pairs))
    return distinct_rows(np.concatenate(found))


def distinct_rows(pairs: np.ndarray) -> np.ndarray:
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    return pairs[fresh]


def upper_bits(tokens: np.ndarray) -> np.ndarray:
    """Tokens are compared by their upper 63 bits, so that -1 can stand for none."""
    return (tokens.view(np.uint64) >> np.uint64(1)).view(np.int64)


def first_tokens(rows: pa.Table) -> np.ndarray:
    return rows["firsts"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, FIRST_TOKENS)


def meets_here(upper, firsts: np.ndarray, other_firsts: np.ndarray) -> np.ndarray:
    """Two points meet in the run of their first common token; if none is known, in every run."""
    known = np.full(len(firsts), -1)
    for k in range(FIRST_TOKENS):
        own = firsts[:, k]
        same = (own[:, None] == other_firsts).any(axis=1) & (own >= 0)
        known = np.where((known < 0) & same, own, known)
    return (known < 0) | (known == upper)


def needed_batches(batches):
    """Whole runs sorted by token in. Out: the rows that may link with a row of their run and another component.

    ``asks`` tells whether one of those is of the class of sizes below.
    """

    def needed(rows: pa.Table) -> pa.Table:
        token, n, rest, component = (rows[c].to_numpy() for c in ("token", "n", "rest", "component"))
        firsts, level, upper = first_tokens(rows), groups_of(n), upper_bits(token)
        stays, asks = np.zeros(len(n), bool), np.zeros(len(n), bool)
        begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        lengths = np.diff(np.append(begins, len(token)))
        for length in np.unique(lengths[lengths > 1]).tolist():
            own = begins[lengths == length]
            left, right = np.triu_indices(length, 1)
            step = max(1, PRUNED_AT_ONCE // len(left))
            for start in range(0, len(own), step):
                first = own[start : start + step, None]
                i, j = (first + left).ravel(), (first + right).ravel()
                fits = (component[i] != component[j]) & (np.minimum(rest[i], rest[j]) >= least_overlap(n[i], n[j]))
                i, j = i[fits], j[fits]
                fits = meets_here(upper[i], firsts[i], firsts[j])
                i, j = i[fits], j[fits]
                stays[i] = stays[j] = True
                asks[i[level[i] > level[j]]] = True
                asks[j[level[j] > level[i]]] = True
        rows = rows.select([c for c in rows.column_names if c != "asks"]).append_column("asks", pa.array(asks))
        return rows.filter(pa.array(stays))

    kept, size = [], 0
    for batch in batches:
        kept.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= PAIRED_ROWS:
            rows = pa.concat_tables(kept)
            tokens = rows["token"].to_numpy()
            # The last run may go on.
            before = np.flatnonzero(tokens != tokens[-1])
            stop = int(before[-1]) + 1 if len(before) else 0
            if stop:
                yield from needed(rows.slice(0, stop)).to_batches()
            kept, size = [rows.slice(stop)], len(tokens) - stop
    if size:
        yield from needed(pa.concat_tables(kept)).to_batches()


def bound_batches(batches):
    """The pairs of points whose sum of minima reaches the least overlap, and whose odd groups allow it."""
    for batch in batches:
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        need = least_overlap(n_a, n_b)
        fits = np.zeros(batch.num_rows, bool)
        for k, (x, y) in enumerate(zip(batch.column("counts_a").to_pylist(), batch.column("counts_b").to_pylist())):
            x, y = np.frombuffer(x, "<u2").astype(np.int64), np.frombuffer(y, "<u2").astype(np.int64)
            groups = min(len(x), len(y))
            x, y = folded(x[None], groups)[0], folded(y[None], groups)[0]
            fits[k] = np.minimum(x, y).sum() >= need[k]
        at = np.flatnonzero(fits)
        odd_a, odd_b = (batch.column(c).take(pa.array(at)).to_pylist() for c in ("odd_a", "odd_b"))
        for k, x, y in zip(at.tolist(), odd_a, odd_b):
            groups = min(len(x), len(y)) // 8
            x, y = folded_odd(x, groups)[None], folded_odd(y, groups)[None]
            fits[k] = may_link(x, y, n_a[k : k + 1], n_b[k : k + 1])[0]
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(fits)) for c in ("a", "b")], ["a", "b"])


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Group counts over fewer groups: a group is the hash's lowest bits, so the upper parts add."""
    return counts.reshape(len(counts), -1, groups).sum(axis=1)


def folded_odd(odd: bytes, words: int) -> np.ndarray:
    """The same for marks of odd groups, in words of 64."""
    return np.bitwise_xor.reduce(np.frombuffer(odd, "<u8").reshape(-1, words), axis=0)


class RTree:
    """Points packed by size and then by their largest coordinates; each node has the maxima and sizes of its points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        order = np.lexsort((points.argmax(axis=1), sizes))
        self.order = order
        bounds = np.append(np.arange(0, len(order), LEAF), len(order))
        self.levels = [self._level(points[order], sizes[order], sizes[order], bounds)]
        while len(self.levels[-1][0]) > FANOUT:
            high, low_size, high_size, _ = self.levels[-1]
            bounds = np.append(np.arange(0, len(high), FANOUT), len(high))
            self.levels.append(self._level(high, low_size, high_size, bounds))

    @staticmethod
    def _level(high, low_size, high_size, bounds):
        return (
            np.maximum.reduceat(high, bounds[:-1]),
            np.minimum.reduceat(low_size, bounds[:-1]),
            np.maximum.reduceat(high_size, bounds[:-1]),
            bounds,
        )

    def search(self, queries: np.ndarray, sizes: np.ndarray):
        """Pairs (query, point, bound of the overlap) that may link."""
        found = []
        top = len(self.levels) - 1
        stack = [(top, k, np.arange(len(queries))) for k in range(len(self.levels[top][0]))]
        while stack:
            level, k, who = stack.pop()
            high, low_size, high_size, bounds = self.levels[level]
            n = sizes[who]
            fits = (100 * high_size[k] >= LINK_PERCENT * n) & (100 * n >= LINK_PERCENT * low_size[k])
            who, n = who[fits], n[fits]
            bound = np.minimum(queries[who], high[k]).sum(axis=1)
            who = who[bound >= least_overlap(n, np.maximum(low_size[k], -(-LINK_PERCENT * n // 100)))]
            if not len(who):
                continue
            if level:
                stack += [(level - 1, child, who) for child in range(bounds[k], bounds[k + 1])]
                continue
            for point in self.order[bounds[k] : bounds[k + 1]].tolist():
                bound = np.minimum(queries[who], self.points[point]).sum(axis=1)
                fits = bound >= least_overlap(sizes[who], self.sizes[point])
                if fits.any():
                    found.append((who[fits], np.full(int(fits.sum()), point), bound[fits]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))


def tree_batches(batches, nearest: bool):
    """Blocks of runs sorted by token, group class and block, those of the tree first, in; pairs of different components out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def columns_of(rows: pa.Table, level: int):
        points = np.stack([folded(np.frombuffer(c, "<u2").astype(np.int32)[None], 1 << level)[0] for c in rows["counts"].to_pylist()])
        odd = np.stack([folded_odd(o, int(odd_bits(level)) // 64) for o in rows["odd"].to_pylist()])
        return points, *(rows[c].to_numpy() for c in ("n", "node", "component", "rest")), first_tokens(rows), odd

    def asked(tree: RTree, known, rows, of_tree: bool, token: int) -> pa.RecordBatch:
        points, n, node, component, rest, firsts, odd = rows
        _, known_n, known_node, known_component, known_rest, known_firsts, known_odd = known
        query, point, bound = tree.search(points, n)
        fits = component[query] != known_component[point]
        if of_tree and not nearest:
            # Two points of the tree would meet twice.
            fits &= node[query] < known_node[point]
        query, point, bound = query[fits], point[fits], bound[fits]
        fits = np.minimum(rest[query], known_rest[point]) >= least_overlap(n[query], known_n[point])
        query, point, bound = query[fits], point[fits], bound[fits]
        fits = meets_here((token & (2**64 - 1)) >> 1, firsts[query], known_firsts[point])
        query, point, bound = query[fits], point[fits], bound[fits]
        step = max(1, COMPARED_AT_ONCE // odd[:1].nbytes)
        fits = np.zeros(len(query), bool)
        for at in range(0, len(query), step):
            q, p = query[at : at + step], point[at : at + step]
            fits[at : at + step] = may_link(odd[q], known_odd[p], n[q], known_n[p])
        query, point, bound = query[fits], point[fits], bound[fits]
        if nearest and len(query):
            order = np.lexsort((known_node[point], -bound / (n[query] + known_n[point]), query))
            query, point = query[order], point[order]
            first = np.ones(len(query), bool)
            first[1:] = query[1:] != query[:-1]
            query, point = query[first], point[first]
        a, b = np.minimum(node[query], known_node[point]), np.maximum(node[query], known_node[point])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    key, gathered, tree, known = None, [], None, None

    def closed():
        """Makes the tree of the rows gathered and looks each of them up."""
        nonlocal gathered, tree, known
        if gathered:
            known = columns_of(pa.concat_tables(gathered), key[1])
            gathered, tree = [], RTree(known[0], known[1])
            if len(np.unique(known[3])) > 1:
                for at in range(0, len(known[1]), ASKED_AT_ONCE):
                    yield asked(tree, known, [c[at : at + ASKED_AT_ONCE] for c in known], True, key[0])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = np.column_stack([table[c].to_numpy() for c in ("token", "level", "block")])
        own = table["own"].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (own[1:] != own[:-1])) + 1
        cuts = [0, *cuts.tolist(), len(keys)]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if start == stop:
                continue
            here = tuple(keys[start].tolist())
            if here != key:
                yield from closed()
                key, tree, known = here, None, None
            if own[start]:
                gathered.append(table.slice(start, stop - start))
                continue
            yield from closed()
            if tree is None:
                continue
            for at in range(start, stop, ASKED_AT_ONCE):
                rows = columns_of(table.slice(at, min(ASKED_AT_ONCE, stop - at)), key[1])
                yield asked(tree, known, rows, False, key[0])
    yield from closed()


def text_batches(batches, seed: int):
    """The texts that are asked for, compressed; a row with a like id and another text is left out."""
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, each, _ = shingles(part.column("text"), WORDS)
            hashes, n = distinct_each(hashes, each)
            right = node_ids(hashes, n, seed) == part.column("wanted").to_numpy()
            packed = [zlib.compress(t.encode(), 1) for t, r in zip(part.column("text").to_pylist(), right) if r]
            yield pa.RecordBatch.from_arrays(
                [part.column("wanted").filter(pa.array(right)), pa.array(packed, pa.binary())], ["node", "packed"]
            )


def verify_batches(batches):
    """The pairs whose shingle sets reach the similarity."""
    for whole in batches:
        for start in range(0, whole.num_rows, VERIFIED_AT_ONCE):
            batch = whole.slice(start, VERIFIED_AT_ONCE)
            sets = []
            for side in ("packed_a", "packed_b"):
                unpacked = pa.array([zlib.decompress(p).decode() for p in batch.column(side).to_pylist()], pa.large_string())
                hashes, each, _ = shingles(unpacked, WORDS)
                hashes, n = distinct_each(hashes, each)
                sets.append((np.repeat(np.arange(len(n)), n), hashes, n))
            (row_a, a, n_a), (row_b, b, n_b) = sets
            rows, both = np.concatenate([row_a, row_b]), np.concatenate([a, b])
            order = np.lexsort((both, rows))
            rows, both = rows[order], both[order]
            twice = (rows[1:] == rows[:-1]) & (both[1:] == both[:-1])
            common = np.bincount(rows[1:][twice], minlength=len(n_a))
            links = 100 * common >= LINK_PERCENT * (n_a + n_b - common)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(links)) for c in ("a", "b")], ["a", "b"])


def components(edges: DataFrame, place) -> DataFrame:
    """``node, component`` of every node of the edges (a, b): the smallest node it reaches.

    Large-star and small-star turns until no edge changes; each turn is a written table.
    """
    current = place.materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: larger neighbours move to the least of the neighbourhood.
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = place.materialize(moved, "large_star")
        # Small star: a node and its smaller neighbours move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        current = place.materialize(small.where("u != v").distinct(), "small_star")
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            break
        state = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    named = current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
    named = place.materialize(named, "components")
    place.drop("edges", "large_star", "small_star")
    return named


class Join:
    """One join over one frame of documents, and its working tables."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        self.place = workspace(docs)
        self.docs = texts(docs, id_col, text_col)
        self.seed = 0
        while not self._profiled():
            self.seed += 2

    def _profiled(self) -> bool:
        seed = self.seed
        schema = "doc_id long, n long, node long, other long, token long, seen long"
        self.profiles = self.place.materialize(self.docs.mapInArrow(lambda b: profile_batches(b, seed), schema), "profiles")
        self.members = self.profiles.where("n is not null").select("doc_id", "n", "node")
        # Two sets with one node would be taken for equal: then all nodes are numbered anew.
        twice = self.profiles.where("node is not null").groupBy("node").agg((F.min("other") != F.max("other")).alias("clash"))
        return twice.where("clash").isEmpty()

    def signatures(self) -> DataFrame:
        counts = self.profiles.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
        most = counts.where(F.col("seen") >= FREQUENT_FROM).orderBy(F.desc("seen"), "token").limit(FREQUENT_TOKENS)
        found = np.array([row.token for row in most.select("token").collect()], np.int64).view(np.uint64)
        frequent = self.spark.sparkContext.broadcast(np.sort(found))
        seed = self.seed
        schema = "node long, n long, tokens array<long>, counts binary, odd binary"
        return self.place.materialize(self.docs.mapInArrow(lambda b: signature_batches(b, seed, frequent), schema), "signatures")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The linked ones of the pairs (a, b), from whole texts."""
        pairs = self.place.materialize(pairs, f"pairs_{name}")
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        first = self.members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
        wanted = self.place.materialize(
            nodes.join(first, "node").select(F.col("node").alias("wanted"), "first_id"), f"wanted_{name}"
        )
        few = wanted.count() <= BROADCAST_NODES
        seed = self.seed
        asked = self.docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("first_id")))
        packed = self.place.materialize(
            asked.select("text", "wanted").mapInArrow(lambda b: text_batches(b, seed), "node long, packed binary").dropDuplicates(["node"]),
            f"texts_{name}",
        )
        sided = pairs.join(packed.select(F.col("node").alias("a"), F.col("packed").alias("packed_a")), "a").join(
            packed.select(F.col("node").alias("b"), F.col("packed").alias("packed_b")), "b"
        )
        links = sided.select("a", "b", "packed_a", "packed_b").mapInArrow(verify_batches, "a long, b long")
        links = self.place.materialize(links, f"links_{name}")
        self.place.drop(f"pairs_{name}", f"wanted_{name}", f"texts_{name}")
        return links

    def linked(self, signatures: DataFrame, ordered: bool = False) -> DataFrame:
        """``node, component`` of every node that links with another.

        Nodes meet where they have one of their ``tokens`` in common; of ``self.signatures()``
        any two that link have, of other ``node, n, tokens, counts, odd`` those of the caller's choice.
        ``ordered``: the tokens are the first ones of the set in an order that all nodes follow, so two
        nodes have nothing in common before the first token that they share.
        """
        points = self.place.materialize(signatures.select("node", "n", "counts", "odd").dropDuplicates(["node"]), "points")
        rows = signatures.select(F.posexplode("tokens").alias("place", "token"), "node", "n")
        rows = rows.select("token", "node", "n", (F.col("n") - F.col("place") if ordered else F.col("n")).alias("rest"))
        sorted_rows = rows.repartition(partitions(self.spark), "token").sortWithinPartitions("token", "node")
        schema = "a long, b long, token long, node long, n long, rest long, lead long, lead_n long"
        runs = self.place.materialize(sorted_rows.mapInArrow(run_batches, schema), "runs")
        self.place.drop("signatures")

        short = runs.where("a is not null").select("a", "b")
        runs = runs.where("token is not null")
        votes = (
            runs.where(
                (F.col("node") != F.col("lead"))
                & (100 * F.least("lead_n", "n") >= LINK_PERCENT * F.greatest("lead_n", "n"))
            )
            .groupBy("node", "lead")
            .count()
            .groupBy("node")
            .agg(F.max_by("lead", F.struct("count", "lead")).alias("lead"))
        )
        led = votes.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
        pairs = self.place.materialize(short.unionByName(led).distinct(), "met")
        found = components(self.verified(self.within_bound(pairs, points), "met_in_bound"), self.place)
        self.place.drop("met")
        for nearest in (True, False):
            # Runs that have become one component are done with for good.
            runs = self.crossing(runs, found)
            self.place.drop("runs", "all_crossing")
            fresh = self.verified(self.candidates(runs, points, nearest), "nearest" if nearest else "all")
            if not fresh.isEmpty():
                edges = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(fresh)
                found = components(edges, self.place)
        self.place.drop("points", "crossing_runs", "long_runs")
        return found

    def within_bound(self, pairs: DataFrame, points: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("_node")).unionByName(pairs.select(F.col("b").alias("_node"))).distinct()
        if nodes.count() <= BROADCAST_NODES:
            points = points.join(F.broadcast(nodes), F.col("node") == F.col("_node"), "left_semi")
        sided = pairs
        for side in ("a", "b"):
            own = points.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "counts", "odd")])
            sided = sided.join(own, side)
        columns = sided.select("a", "b", "n_a", "n_b", "counts_a", "counts_b", "odd_a", "odd_b")
        return columns.mapInArrow(bound_batches, "a long, b long")

    def crossing(self, runs: DataFrame, found: DataFrame) -> DataFrame:
        """The rows of runs that may link with one of another component, with the component of each node.

        ``firsts`` are the node's first tokens of these runs, ``asks`` tells whether it may link
        with a node of the class of sizes below.
        """
        label = found.select(F.col("node").alias("_node"), "component")
        labelled = runs.select("token", "node", "n", "rest").join(label, F.col("node") == F.col("_node"), "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "node")).drop("_node")
        spans = labelled.groupBy("token").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("many")
        )
        spans = spans.where("low != high").select(F.col("token").alias("_token"), "many")
        crossing = self.place.materialize(
            labelled.join(spans, F.col("token") == F.col("_token")).drop("_token"), "all_crossing"
        )
        # The more is left from a token on, the earlier it comes.
        tokens = F.array_sort(F.collect_list(F.struct((-F.col("rest")).alias("late"), F.shiftrightunsigned("token", 1).alias("upper"))))
        none = F.array_repeat(F.lit(-1).cast("long"), FIRST_TOKENS)
        firsts = F.slice(F.concat(F.slice(tokens, 1, FIRST_TOKENS)["upper"], none), 1, FIRST_TOKENS)
        crossing = crossing.join(crossing.groupBy("node").agg(firsts.alias("firsts")), "node")
        crossing = crossing.select("token", "node", "n", "rest", "component", "firsts", F.lit(True).alias("asks"), "many")
        short = F.col("many") <= min(PRUNED_RUN, RUN_BLOCK)
        whole = crossing.where(short).drop("many").repartition(partitions(self.spark), "token").sortWithinPartitions("token")
        schema = "token long, node long, n long, rest long, component long, firsts array<long>, asks boolean"
        needed = whole.mapInArrow(needed_batches, schema).unionByName(crossing.where(~short).drop("many"))
        return self.place.materialize(needed, "crossing_runs")

    def blocks(self, crossing: DataFrame, points: DataFrame, nearest: bool) -> DataFrame:
        """The runs' rows by block: ``own`` ones make its R-tree, the others are looked up in it."""
        level = F.round(F.log2(F.length("counts") / 2)).cast("int")
        classed = points.select("node", "counts", "odd", level.alias("level"))
        lengths = crossing.join(classed.select("node", "level"), "node").groupBy("token", "level").agg(F.count("*").alias("many"))
        long = self.place.materialize(
            lengths.where(F.col("many") > RUN_BLOCK).select(F.col("token").alias("_token"), F.col("level").alias("_level"), "many"),
            "long_runs",
        )
        few = long.count() <= BROADCAST_NODES
        placed = crossing.join(classed, "node")
        # A set links with sets of its own class or of a neighbouring one; it also asks the class below, if it may link there.
        lowest = LEAST_GROUPS.bit_length() - 1
        roles = F.expr(
            f"if(asks and level > {lowest}, array(struct(level, true as own), struct(level - 1 as level, false as own)),"
            " array(struct(level, true as own)))"
        )
        spread = placed.withColumn("role", F.explode(roles)).select(
            "token", F.col("role.level").alias("level"), F.col("role.own").alias("own"), "node", "n", "component", "rest", "counts", "odd", "firsts"
        )
        dealt = spread.join(
            F.broadcast(long) if few else long, (F.col("token") == F.col("_token")) & (F.col("level") == F.col("_level")), "left"
        )
        dealt = dealt.withColumn("last", F.coalesce(F.ceil(F.col("many") / RUN_BLOCK), F.lit(1)).cast("int") - 1)
        dealt = dealt.withColumn("home", F.when(F.col("own"), F.pmod(F.xxhash64("node"), F.col("last") + 1)).otherwise(-1).cast("int"))
        # Of two blocks of a run the lower one's points ask the higher one; for the nearest ones all ask all.
        asked = f"filter(sequence(0, last), x -> x >= home or {'true' if nearest else 'false'})"
        return dealt.withColumn("block", F.explode(F.expr(asked))).select(
            "token", "level", "block", (F.col("block") == F.col("home")).alias("own"), "node", "n", "component", "rest", "counts", "odd", "firsts"
        )

    def candidates(self, crossing: DataFrame, points: DataFrame, nearest: bool) -> DataFrame:
        """Distinct pairs of nodes of different components that the R-trees of the runs let through."""
        grouped = self.blocks(crossing, points, nearest).repartition(partitions(self.spark), "token", "level", "block")
        grouped = grouped.sortWithinPartitions("token", "level", "block", F.desc("own"))
        pairs = grouped.mapInArrow(lambda b: tree_batches(b, nearest), "a long, b long")
        return pairs.distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a set has the
    distinct shingles of five words, or the whole sequence if there are fewer; a
    null text or one without words has an empty set and is its own component.
    ``component_id`` is the smallest id that links reach (null ids only if there is
    no other). Rows with equal ids keep a row each. Extra columns are not read.
    """
    low = F.translate(docs[text_col], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    join = Join(docs.select(docs[id_col].alias("doc_id"), low.alias("text")))
    found = join.linked(join.signatures(), ordered=True).select(F.col("node").alias("_node"), "component")
    members = join.members.join(found, F.col("node") == F.col("_node"), "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    members = join.place.materialize(members.select("doc_id", "n", "component"), "members")
    join.place.drop("profiles", "components", *[name for name in join.place.paths if name.startswith("links_")])
    least = members.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    least = least.withColumnRenamed("component", "_component")
    named = members.join(least, F.col("component") == F.col("_component"), "left")
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that belong to a component of a smaller id, all columns as they are.

    Of rows with the component's own id each with a different text stays, as ids should be
    unique; rows without an id stay unless their component has one.
    """
    named = similar_documents(docs, id_col, text_col)
    gone = named.where(F.col("component_id").isNotNull() & ~F.col("component_id").eqNullSafe(F.col("doc_id")))
    (own,) = free_names(docs, "gone")
    gone = gone.select(F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own)), "left_anti")
