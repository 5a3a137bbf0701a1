"""Token ids in ORC: integer run-length encoding, stripes, row indexes and Bloom filters."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_strings, by_bytes, gives_back
from .tokens import encoder, with_end

SCHEMA = "doc_id long, part_start long, n_tokens int, ids array<int>"


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    stripe_bytes: int = 16 << 20, index_stride: int = 1000, bloom_fpp: float = 0.01, compression: str = "snappy",
) -> None:
    """Encode every whole text and write ``doc_id, part_start, n_tokens, ids`` to ORC at ``path``.

    Rows are range-partitioned and sorted by identifier (nulls first, ties by a hash of the text),
    so a stripe's and row group's statistics bound its identifiers, and file ``part-k`` holds what
    follows ``part-(k-1)``. ``ids`` ends with ``end_id``; null texts count as empty. Ids are ORC
    integers (run-length encoding, version 2). ``part_start`` counts the ids before the row in its
    file, so the place of every document follows from one number a file. Other columns are ignored.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, before = encoder(vocabulary), 0
        for batch in batches:
            texts = as_strings(batch, "t")
            for a, b in by_bytes(texts, 4 << 20):
                ids, bounds = with_end(*coder.encode(texts.slice(a, b - a)), end_id)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(before + bounds[:-1]), pa.array(np.diff(bounds).astype(np.int32)), lists],
                    names=["doc_id", "part_start", "n_tokens", "ids"],
                )
                before += int(bounds[-1])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # the hash is a splitter too: texts that share an identifier (or have none) fill several files
    rows = rows.withColumn("h", F.xxhash64("t"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "t")
    ordered.mapInArrow(run, SCHEMA).write.options(
        **{
            "compression": compression, "orc.stripe.size": stripe_bytes, "orc.create.index": "true", "orc.row.index.stride": index_stride,
            "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": bloom_fpp,
        }
    ).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written table with ``start``, the ids of all documents before; splits are by stripe.

    A filter on ``doc_id`` reaches the reader, which skips stripes and row groups by their
    statistics and Bloom filters. ``start`` needs one number a file (a broadcast bounded by the
    number of files).
    """
    table = spark.read.schema(SCHEMA).orc(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("part")
    sizes = table.select(part, (F.col("part_start") + F.col("n_tokens")).alias("n")).groupBy("part").agg(F.max("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rows = table.select("doc_id", "part_start", "n_tokens", "ids", part)
    return rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: crc32 over the ids as little-endian unsigned 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ids = np.ascontiguousarray(np.asarray(lists.flatten()), dtype="<i4")
            bounds = np.asarray(lists.offsets, dtype=np.int64)
            bounds = (bounds - bounds[0]).tolist()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
