"""Token ids as Parquet files with list columns.

One row for each document, in ascending id order over the files (range
partitions, sorted within). Columns: ``doc_id``; ``file_no``, the file's place
in the order; ``first``, the document's first token counted in its file;
``n_tokens``; ``tokens``, a list of ints. Token lists are dictionary encoded
(17 bits an id at a vocabulary of 50k, before compression); the four metadata
columns are delta encoded. Row groups, pages and page rows are bounded, and the
writer adds page indexes, so a reader can take the metadata alone, or the pages
of a few documents, without touching the rest of the tokens.

Defined results: a null text is empty and holds the end id alone; rows with
equal ids keep one row each, ordered by the first 64 characters of their texts,
then by a hash, then by their place in the input, so an id with a large share of
all rows lies in several consecutive files; null ids and texts come first; an
empty table gives files without rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.llm.storage import share_code
from daypulse.llm.tokens import default_tokenizer, document_crc, encoder, with_end

SCHEMA = "doc_id long, file_no int, first long, n_tokens long, tokens array<int>"
#: Row groups of at most 64 MB, pages of at most 256 kB or 1,000 documents.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(64 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#file_no": "false",
    "parquet.enable.dictionary#first": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}


def token_rows(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the files; partition order is id order."""
    share_code(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    order = ["doc_id", "head", "h", "place"]  # all of a row's text in a range key would go through the driver
    rows = rows.select("*", F.substring("text", 1, 64).alias("head"), F.xxhash64("text").alias("h"),
                       F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, ids, ends in coder.batches(batch.column(1)):
                n = len(ends) - 1
                flat, stops = with_end(ids, ends, end_id)
                lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array(np.full(n, task, np.int32)), pa.array(before + stops[:-1]),
                     pa.array(np.diff(stops)), lists], names=["doc_id", "file_no", "first", "n_tokens", "tokens"])
                before += int(stops[-1])

    return rows.mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, id_col: str = "doc_id",
                 text: str = "text") -> None:
    """Encode ``docs`` and write the files under ``path`` (a new folder in
    storage that all executors share)."""
    token_rows(docs, tokenizer or default_tokenizer(), end_id, id_col, text).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The files' rows, or of those columns alone (only they are read)."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.select(*columns) if columns else rows


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(file_no, base): ids in all files before it. Reads two metadata columns."""
    total = read_tokens(spark, path, ["file_no", "n_tokens"]).groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return total.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it over all
    files), n_tokens and ids_crc32 over its ids as little-endian unsigned
    32-bit integers."""
    share_code(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            ends = np.asarray(lists.offsets)
            crc = document_crc(np.asarray(lists.values).view(np.uint32), ends)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.diff(ends).astype(np.int64)),
                                              pa.array(crc, pa.int64())],
                                             names=["doc_id", "file_no", "first", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path, ["doc_id", "file_no", "first", "tokens"]).mapInArrow(
        run, "doc_id long, file_no int, first long, n_tokens long, ids_crc32 long")
    return rows.join(offsets(spark, path), "file_no").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
