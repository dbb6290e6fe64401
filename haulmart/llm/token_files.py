"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

A set of token files is a folder of parts. Part ``k`` holds the documents of one
range of ids, in ascending id order (null ids first, equal ids by their tokens):

* ``*.bin``: the ids of all its documents, little-endian unsigned integers of 2
  bytes if the vocabulary fits, else 4;
* ``*.idx``: where each document starts in the part, and the part's length, as
  little-endian signed 64-bit integers;
* ``*.ids``: the document ids as 64-bit integers, the lowest one for null.

The manifest, a Parquet table, names the files of each part. A task that is run
again writes new files and only those of the run that Spark keeps are named, so
lost executors leave orphans, never wrong parts. The global place of a document
is its part's base, a prefix sum over the parts, plus its offset.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmart.llm.encoders import read_vocabulary
from haulmart.llm.frames import id_buckets, partitions, texts, with_bucket, workspace
from haulmart.llm.text import slices

NULL_ID = -(2**63)
READ_DOCUMENTS = 4096
MANIFEST = "bucket int, stem string, n_docs long, n_tokens long"


@dataclass(frozen=True)
class TokenFiles:
    spark: SparkSession
    manifest_path: str
    width: int

    def parts(self) -> DataFrame:
        """A row per part with its base: the ids of all parts before it."""
        before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        manifest = self.spark.read.schema(MANIFEST).parquet(self.manifest_path)
        # A few rows per task of the writing job, so one task sums them.
        return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))

    def documents(self, ids: bool = False) -> DataFrame:
        """Every document read back from the files: place, length, checksum and, if asked, its ids."""
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
        width = self.width
        parts = self.parts().repartition(partitions(self.spark), "stem")
        return parts.mapInArrow(lambda batches: read_parts(batches, width, ids), schema)


def file_system(uri: str):
    """pyarrow's file system of a URI or a plain path, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def block(uri: str, kind: str, start: int, stop: int) -> np.ndarray:
    """Numbers ``start`` to ``stop`` of a flat file, memory-mapped where the file system allows."""
    from pyarrow import fs

    system, path = file_system(uri)
    size = np.dtype(kind).itemsize
    if stop <= start:
        return np.zeros(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r", start * size, (stop - start,))
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read_at((stop - start) * size, start * size), kind)


def encode_batches(batches, vocabulary, end_id: int, width: int):
    encoder = vocabulary.value.encoder()
    for batch in batches:
        for part in slices(batch, "text"):
            ids, counts = encoder(part.column("text"))
            ends = np.cumsum(counts)
            joined = np.insert(ids, ends, end_id).astype(f"<u{width}")
            bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * width
            data = pa.Array.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(joined)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), data], ["doc_id", "tokens"])


class PartWriter:
    def __init__(self, folder: str, bucket: int, width: int):
        self.bucket, self.width = bucket, width
        self.stem = f"{folder}/part-{bucket + 1:06d}-{uuid.uuid4().hex}"
        system, path = file_system(self.stem)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.files = [system.open_output_stream(f"{path}.{kind}") for kind in ("bin", "idx", "ids")]
        self.n_docs = self.n_tokens = 0

    def add(self, doc_ids: pa.Array, tokens: pa.Array) -> None:
        sizes = np.array([len(t) for t in (v.as_buffer() for v in tokens)], np.int64) // self.width
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        for value in tokens:
            self.files[0].write(value.as_buffer())
        self.files[1].write(starts.astype("<i8").tobytes())
        self.files[2].write(doc_ids.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.n_docs += len(sizes)
        self.n_tokens += int(sizes.sum())

    def close(self) -> pa.RecordBatch:
        self.files[1].write(np.array([self.n_tokens], "<i8").tobytes())
        for file in self.files:
            file.close()
        row = {"bucket": [self.bucket], "stem": [self.stem], "n_docs": [self.n_docs], "n_tokens": [self.n_tokens]}
        return pa.RecordBatch.from_pydict(
            row, pa.schema([("bucket", pa.int32()), ("stem", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        )


def write_parts(batches, folder: str, width: int):
    """Rows sorted by bucket and id in, files out; yields the manifest rows."""
    writer = None
    for batch in batches:
        buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(buckets)]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            if writer is None or writer.bucket != buckets[start]:
                if writer is not None:
                    yield writer.close()
                writer = PartWriter(folder, int(buckets[start]), width)
            rows = batch.slice(start, stop - start)
            writer.add(rows.column("doc_id"), rows.column("tokens"))
    if writer is not None:
        yield writer.close()


def read_parts(batches, width: int, with_ids: bool):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    for batch in batches:
        for row in batch.to_pylist():
            for first in range(0, row["n_docs"], READ_DOCUMENTS):
                last = min(row["n_docs"], first + READ_DOCUMENTS)
                offsets = block(row["stem"] + ".idx", "<i8", first, last + 1)
                doc_ids = block(row["stem"] + ".ids", "<i8", first, last)
                low, high = int(offsets[0]), int(offsets[-1])
                tokens = block(row["stem"] + ".bin", f"<u{width}", low, high)
                crc = [
                    zlib.crc32(tokens[a - low : b - low].astype("<u4").tobytes())
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                ]
                columns = [
                    pa.array(np.array(doc_ids), mask=np.array(doc_ids) == NULL_ID),
                    pa.array(np.array(offsets[:-1]) + row["base"]),
                    pa.array(np.diff(offsets)),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(
                        pa.ListArray.from_arrays(pa.array(offsets - low, pa.int32()), pa.array(tokens.astype(np.int32)))
                    )
                yield pa.RecordBatch.from_arrays(columns, names)


def write_token_files(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> TokenFiles:
    """Encode every whole text, append ``end_id``, and write the ids in ascending id order.

    A null text is empty and yields the end id alone. Rows with equal ids are all
    kept. Documents without a row give a set without parts. Extra columns are not
    read. Ids are encoded before the one shuffle, so that moves 2 bytes a token;
    the ranges come from quantiles of the ids, hence are even whatever the ids are.
    """
    spark = docs.sparkSession
    place = workspace(docs)
    folder = folder or place.new_path("tokens")
    vocabulary = read_vocabulary(spark, vocabulary_path)
    width = 2 if max(end_id, vocabulary.value.size() - 1) < 2**16 else 4
    read = texts(docs, id_col, text_col)
    buckets, n = id_buckets(read)
    encoded = read.mapInArrow(
        lambda batches: encode_batches(batches, vocabulary, end_id, width), "doc_id long, tokens binary"
    )
    ordered = (
        with_bucket(encoded, buckets)
        .repartition(min(n + 1, partitions(spark)), "bucket")
        .sortWithinPartitions("bucket", "doc_id", "tokens")
    )
    manifest = ordered.mapInArrow(lambda batches: write_parts(batches, folder, width), MANIFEST)
    return TokenFiles(spark, place.store(manifest, "manifest"), width)
