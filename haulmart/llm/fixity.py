"""Fixity audit of WARC replicas by Merkle trees.

A leaf is a record's digest at its offset. A node covers a fixed range of byte
offsets of one file and hashes, in order, what lies in it: records in the ranges
of the first level, ``FANOUT`` ranges of the level below in those above, up to
one root per file. An audit compares roots and descends, level by level, only
below nodes that differ. Ranges hold a bounded number of records, since a record
takes at least its header's bytes, so no group grows with the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.frames import workspace

RANGE_BYTES = 1 << 16
FANOUT = 16
RECORDS_PER_FILE = 256
UNNUMBERED_FILES = 64


def record_text(url: Column, body: Column) -> Column:
    """One resource record; null URL and body are empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def placed_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``file, offset, length, page_id, digest`` of the records that the pages make, in id order within a file.

    A file takes a fixed number of consecutive ids. Pages without an id go to files
    of their own, by a hash of their record. Pages with equal ids stand in one
    file, in the order of their digests. Bodies are hashed where they are read and
    never shuffled.
    """
    record = record_text(pages[url_col], pages[body_col])
    leaves = pages.select(pages[id_col].cast("long").alias("page_id"), record.alias("record")).select(
        "page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest")
    )
    number = F.floor(F.col("page_id") / RECORDS_PER_FILE).cast("string")
    loose = F.concat(F.lit("x"), F.pmod(F.crc32("digest"), F.lit(UNNUMBERED_FILES)).cast("string"))
    filed = leaves.withColumn("file", F.concat(F.lit("warc-"), F.coalesce(number, loose)))
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return filed.select(
        "file", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "page_id", "digest"
    )


@dataclass
class Tree:
    """Levels from the records up: ``file, position, digest`` (level 0 also ``length, page_id``)."""

    levels: list[DataFrame]


def build_tree(records: DataFrame, top: int, place, name: str) -> Tree:
    """A tree of ``top`` levels above the records; every level is a written table."""
    leaves = place.materialize(records.withColumnRenamed("offset", "position"), f"{name}_records")
    levels = [leaves]
    for level in range(1, top + 1):
        below = levels[-1]
        width = RANGE_BYTES if level == 1 else FANOUT
        parts = [F.col("position"), F.col("length") if level == 1 else F.lit(0).alias("length"), F.col("digest")]
        ordered = F.array_sort(F.collect_list(F.struct(*parts)))
        listed = F.array_join(
            F.transform(ordered, lambda x: F.concat_ws(":", x["position"].cast("string"), x["length"].cast("string"), x["digest"])),
            ",",
        )
        node = below.groupBy("file", F.floor(F.col("position") / width).cast("long").alias("range")).agg(
            F.sha2(listed, 256).alias("digest")
        )
        levels.append(place.materialize(node.withColumnRenamed("range", "position"), f"{name}_level_{level}"))
    return Tree(levels)


def levels_for(*records: DataFrame) -> int:
    """Levels until the longest file is one range."""
    longest = max((r.agg(F.max("offset").alias("m")).first().m or 0) for r in records)
    ranges, levels = longest // RANGE_BYTES, 1
    while ranges:
        ranges, levels = ranges // FANOUT, levels + 1
    return levels


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places whose digests differ or that one side lacks."""
    a = left.select("file", "position", F.col("digest").alias("expected"))
    b = right.select("file", "position", F.col("digest").alias("found"))
    return a.join(b, ["file", "position"], "full").where(~F.col("expected").eqNullSafe(F.col("found")))


def audit(records: DataFrame, replica: DataFrame) -> DataFrame:
    """``file, offset, page_id, damage, expected_sha256, found_sha256`` of the records where the replica is not as it should be.

    ``damage`` is ``changed`` (other bytes at this offset), ``missing`` or ``extra``. What
    a record of another length shifts differs from there on. Tables without rows,
    or without differences, give no rows.
    """
    place = workspace(records)
    records = place.materialize(records, "records")
    replica = place.materialize(replica, "replica")
    top = levels_for(records, replica)
    ours, theirs = (build_tree(r, top, place, n) for r, n in ((records, "ours"), (replica, "theirs")))
    suspects = differing(ours.levels[top], theirs.levels[top]).select("file", "position")
    for level in range(top - 1, -1, -1):
        suspects = place.materialize(suspects, f"suspects_{level + 1}")
        above = suspects.select(F.col("file").alias("_file"), F.col("position").alias("_above"))
        width = RANGE_BYTES if level == 0 else FANOUT

        def below(tree: Tree, level=level, above=above, width=width) -> DataFrame:
            node = tree.levels[level]
            inside = (node["file"] == F.col("_file")) & (F.floor(node["position"] / width) == F.col("_above"))
            return node.join(above, inside, "left_semi")

        branches = below(ours), below(theirs)
        found = differing(*branches)
        suspects = found.select("file", "position")
    ids = branches[0].select("file", "position", F.col("page_id").alias("own_id"))
    other = branches[1].select("file", "position", F.col("page_id").alias("other_id"))
    damage = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("changed")
    return (
        found.join(ids, ["file", "position"], "left")
        .join(other, ["file", "position"], "left")
        .select(
            "file",
            F.col("position").alias("offset"),
            F.coalesce("own_id", "other_id").alias("page_id"),
            damage.alias("damage"),
            F.col("expected").alias("expected_sha256"),
            F.col("found").alias("found_sha256"),
        )
    )
