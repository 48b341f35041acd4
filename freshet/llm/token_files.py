"""Token-id output: Parquet list columns, dictionary or delta encoded, with small row groups and page indexes.

Documents are range-partitioned and sorted by id, so the files in name order hold ascending ids, and row-group and page
statistics on ``doc_id`` and ``n_tokens`` let a reader fetch few pages for a selection. ``n_tokens`` lies beside the
list, so metadata is read without ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm import tokens
from freshet.llm.storage import shuffle_partitions
from freshet.session import ensure_importable

#: Encoding of the ids: a dictionary of the ids in a row group, or version-2 pages with delta binary packing.
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(2 << 20)},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2"},
}


def _list_batches(ids: pa.Array, column: pa.Array, path: str) -> Iterator[pa.RecordBatch]:
    for lo, hi, flat, counts in tokens.encoded(column, path):
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(counts), lists], ["doc_id", "n_tokens", "input_ids"])


def write_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_rows: int = 512,
) -> None:
    """Encodes every text of ``docs`` and writes it at ``path`` in ascending id order (null ids first, ties by text).

    A null or empty text has the end id alone. Rows that repeat stay repeated. An empty table makes a readable table
    without rows. Other columns are not written.
    """
    vocabulary = vocabulary or tokens.tokenizer_path()
    spark = ensure_importable(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = given.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches):
        for batch in batches:
            yield from _list_batches(batch.column(0), batch.column(1), vocabulary)

    writer = dealt.mapInArrow(encode, "doc_id long, n_tokens long, input_ids array<int>").write.option("compression", "snappy")
    for key, value in (ENCODINGS[encoding] | {"parquet.block.size": str(row_group_bytes), "parquet.page.row.count.limit": str(page_rows)}).items():
        writer = writer.option(key, value)
    writer.parquet(path)


def _part() -> Column:
    """A file's number as a number: names of more than five digits would not sort as text."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, input_ids`` with the place of each row: ``file``, the number of its part, and ``row``. Null ids,
    empty texts and repeated rows come back as written; a table without rows has none."""
    return spark.read.schema("doc_id long, n_tokens long, input_ids array<int>").parquet(path).select(
        "doc_id", "n_tokens", "input_ids", _part().alias("file"), F.col("_metadata.row_index").alias("row")
    )


def _checksums(batches):
    for batch in batches:
        lists = batch.column(2)
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        at = lists.offsets.to_numpy()
        view = memoryview(np.ascontiguousarray(values)).cast("B")
        crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()), batch.column(3), batch.column(4)],
            ["doc_id", "n_tokens", "ids_crc32", "file", "row"],
        )


def digest_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a written table, from its files: a running sum inside each file, and
    over one total for each file to place the files. Edge cases as in :func:`write_tokens`."""
    ensure_importable(spark)
    rows = read_tokens(spark, path).mapInArrow(_checksums, "doc_id long, n_tokens long, ids_crc32 long, file long, row long")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    totals = spark.read.parquet(path).select(_part().alias("file"), "n_tokens").groupBy("file").agg(F.sum("n_tokens").alias("total"))
    over = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("base"))
    return placed.join(bases, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
