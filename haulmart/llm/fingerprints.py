"""Document fingerprints: MinHash over word shingles.

A fingerprint has ``PERMUTATIONS`` components, each the lowest value that one
universal hash function (multiply, add, in 32 bits) takes over the distinct
five-word shingles of the text, of which 16 bits are kept. The share of equal
components estimates the Jaccard similarity of two texts. For near duplicates,
texts with a band of components in common meet and are verified on whole texts:
each with the one that leads most of its bands, then, of the bands whose texts are
in different components still, all that the group counts of their shingles let through.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.llm.frames import id_buckets, partitions, texts, with_bucket
from haulmart.llm.ngram_join import Join, group_counts, node_ids, odd_groups
from haulmart.llm.text import distinct_each, shingles, slices

WORDS = 5
PERMUTATIONS = 128
SEED = 20240229
# Four components a band: a pair of similarity 0.75 shares a band of 32 but for 5 in a million.
BAND = 4
BROADCAST_NODES = 500_000
# Shingles hashed at once, so that a block of all permutations stays in the cache.
BLOCK = 1024
FINGERPRINT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return (
        random.integers(0, 2**31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1),
        random.integers(0, 2**32, PERMUTATIONS, np.uint32),
    )


def minima(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of ``PERMUTATIONS`` 16-bit components per text; a text without shingles has the highest value."""
    factor, term = (x[:, None] for x in functions())
    low = np.full((PERMUTATIONS, len(counts)), 2**32 - 1, np.uint32)
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    text = np.repeat(np.arange(len(counts)), counts)
    for start in range(0, len(values), BLOCK):
        own = text[start : start + BLOCK]
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        block = values[start : start + BLOCK] * factor + term
        least = np.minimum.reduceat(block, begins, axis=1)
        low[:, own[begins]] = np.minimum(low[:, own[begins]], least)
    return (low & np.uint32(0xFFFF)).astype("<u2").T


def fingerprints_of(strings: list[str]) -> np.ndarray:
    lower = pc.ascii_lower(pa.array(strings, pa.large_string()))
    hashes, counts, _ = shingles(lower, WORDS)
    return minima(hashes, counts)


def nodes_of(strings: list[str], seed: int) -> list[int | None]:
    hashes, counts, _ = shingles(pc.ascii_lower(pa.array(strings, pa.large_string())), WORDS)
    hashes, n = distinct_each(hashes, counts)
    return [node if k else None for node, k in zip(node_ids(hashes, n, seed).tolist(), n.tolist())]


def shown(components_: np.ndarray) -> list[str]:
    return [base64.b64encode(row.tobytes()).decode() for row in np.ascontiguousarray(components_)]


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def edit_batches(batches, seed: int | None = None):
    """Rows sorted by bucket and id in, the last of each bucket standing for the first of the next.

    With a seed, each row also has its node.
    """
    held = None
    for batch in batches:
        for part in slices(batch, "text", 4 << 20):
            rows = list(zip(*[part.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "outside")]))
            prints = fingerprints_of([r[2] for r in rows])
            if held is not None:
                rows = [held[0], *rows]
                prints = np.concatenate([held[1][None], prints])
            held = rows[-1], prints[-1]
            at = [k for k in range(len(rows) - 1) if not rows[k][3]]
            if not at:
                continue
            changed = [edited(rows[k][2], rows[k + 1][2]) for k in at]
            of_changed = fingerprints_of(changed)
            own, following = prints[at], prints[[k + 1 for k in at]]
            nodes = [] if seed is None else [pa.array(nodes_of([rows[k][2] for k in at], seed), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k][1] for k in at], pa.int64()),
                    pa.array([len(rows[k][2]) for k in at], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array(shown(own)),
                    pa.array(shown(of_changed)),
                    pa.array((own == of_changed).mean(axis=1)),
                    pa.array((own == following).mean(axis=1)),
                    *nodes,
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", *["node"] * len(nodes)],
            )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, one row per row of ``docs``.

    The next document is the one that follows by id, null ids first and equal ids
    by text; the first follows the last. A null text is empty; texts without words
    have one fingerprint in common. No documents give no rows. Extra columns are
    not read. Texts are shuffled once, into ranges of ids; each range is followed
    by a copy of the next one's first document.
    """
    return _edited(texts(docs, id_col, text_col), None)


def _edited(read: DataFrame, seed: int | None) -> DataFrame:
    spark = read.sparkSession
    schema = FINGERPRINT if seed is None else f"{FINGERPRINT}, node long"
    buckets, n = id_buckets(read)
    placed = with_bucket(read, buckets)
    # One row per range, whatever the number of documents.
    firsts = placed.groupBy("bucket").agg(F.min("doc_id").alias("first_id")).orderBy("bucket").collect()
    if not firsts:
        return spark.createDataFrame([], schema)
    after = [(here.bucket, there.first_id) for here, there in zip(firsts, firsts[1:] + firsts[:1])]
    ids = [first for _, first in after if first is not None]
    among = F.col("doc_id").isin(ids) | (F.lit(len(ids) < len(after)) & F.col("doc_id").isNull())
    edges = F.broadcast(spark.createDataFrame(after, "edge int, first_id long"))
    outside = (
        read.where(among)
        .join(edges, F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy(F.col("edge").alias("bucket"), "doc_id")
        .agg(F.min("text").alias("text"))
    )
    rows = placed.withColumn("outside", F.lit(False)).unionByName(outside.withColumn("outside", F.lit(True)))
    ordered = rows.repartition(max(1, min(n + 1, partitions(spark))), "bucket").sortWithinPartitions(
        "bucket", "outside", "doc_id", "text"
    )
    return ordered.select("bucket", "doc_id", "text", "outside").mapInArrow(lambda b: edit_batches(b, seed), schema)


def band_batches(batches, seed: int):
    """``node, n, tokens, counts, odd`` of each node of a task: a token per band, its group counts and odd groups."""
    done: set[int] = set()
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, each, _ = shingles(part.column("text"), WORDS)
            hashes, n = distinct_each(hashes, each)
            nodes = node_ids(hashes, n, seed)
            fresh = np.array([k > 0 and not (i in done or done.add(i)) for i, k in zip(nodes.tolist(), n.tolist())], bool)
            hashes = hashes[np.repeat(fresh, n)]
            nodes, n = nodes[fresh], n[fresh]
            if not len(n):
                continue
            width = 2 * BAND
            keys = [
                [xxhash.xxh3_64_intdigest(row[at : at + width], at) for at in range(0, 2 * PERMUTATIONS, width)]
                for row in map(bytes, np.ascontiguousarray(minima(hashes, n)))
            ]
            many = PERMUTATIONS // BAND
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1) * many, pa.int32()), pa.array(np.array(keys, np.uint64).ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(n), listed, group_counts(hashes, n), odd_groups(hashes, n)],
                ["node", "n", "tokens", "counts", "odd"],
            )


def near_nodes(join: Join) -> DataFrame:
    """``node, component`` of every node that verified pairs of a shared band connect with another."""
    seed = join.seed
    schema = "node long, n long, tokens array<long>, counts binary, odd binary"
    return join.linked(join.place.materialize(join.docs.mapInArrow(lambda b: band_batches(b, seed), schema), "signatures"))


def joined_texts(docs: DataFrame, id_col: str, text_col: str) -> Join:
    lower = F.translate(docs[text_col], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return Join(docs.select(docs[id_col].alias("doc_id"), lower.alias("text")))


def named_nodes(join: Join) -> DataFrame:
    """``_node, group_id`` of the nodes that are not a row's own group."""
    found = near_nodes(join).withColumnRenamed("node", "_node")
    named = join.members.where("node is not null").join(found, F.col("node") == F.col("_node"), "left")
    named = named.select("doc_id", "node", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("rows")).where("rows > 1")
    least = least.select(F.col("component").alias("_component"), "group_id")
    named = named.select(F.col("node").alias("_node"), "component").distinct()
    groups = join.place.materialize(
        named.join(least, F.col("component") == F.col("_component")).select("_node", "group_id"), "groups"
    )
    join.place.drop("components", *[name for name in join.place.paths if name.startswith("links_")])
    return groups


def with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with ``group_id`` in place of their ``node``."""
    few = groups.count() <= BROADCAST_NODES
    joined = rows.join(F.broadcast(groups) if few else groups, F.col("node") == F.col("_node"), "left")
    own = F.coalesce("group_id", "doc_id").alias("group_id")
    return joined.select(*[c for c in rows.columns if c != "node"], own)


def grouped_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``edited_fingerprints`` and each one's ``group_id`` of ``near_duplicates``."""
    join = joined_texts(docs, id_col, text_col)
    groups = named_nodes(join)
    join.place.drop("profiles")
    return with_groups(_edited(texts(docs, id_col, text_col), join.seed), groups)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, group_id``: groups of documents that verified pairs of a shared band connect.

    Bands of few nodes are paired at once; of longer ones each node is verified
    against the node that leads most of its bands, then those whose nodes are in
    several components still are searched in blocks of bounded size. Pairs whose
    sizes, group counts or odd groups exclude a link are not read. ``group_id`` is the smallest
    id of the group; a document without words is its own group.
    """
    join = joined_texts(docs, id_col, text_col)
    return with_groups(join.members.select("doc_id", "node"), named_nodes(join))
