"""Parquet footers as rows: what a layout lets a scan skip (op 41).

A Parquet file ends in a footer with the sizes, value ranges and NULL counts of every column of every row group; a scan
with a filter reads only the row groups whose range meets it. The files are listed by Spark and their footers read in
tasks, a few kilobytes of each file. Files must lie where pyarrow's file systems reach them (local or shared folders, HDFS,
object stores).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("file string, row_group int, row_group_rows bigint, column string, compressed_bytes bigint, uncompressed_bytes bigint, "
          "codec string, has_range boolean, min string, max string, min_number double, max_number double, n_nulls bigint")


def _number(value) -> float | None:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


def _footer_batches(batches):
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem
    names = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string(),
             pa.float64(), pa.float64(), pa.int64()]
    for b in batches:
        for path in b.column(0).to_pylist():
            out = []
            system, inner = FileSystem.from_uri(path.replace("file:///", "/").replace("file:/", "/"))
            with system.open_input_file(inner) as f:
                meta = pq.read_metadata(f)
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    column = group.column(c)
                    s = column.statistics
                    told = s is not None and s.has_min_max
                    low, high = (s.min, s.max) if told else (None, None)
                    out.append((path, g, group.num_rows, column.path_in_schema, column.total_compressed_size, column.total_uncompressed_size,
                                column.compression, told, None if low is None else str(low), None if high is None else str(high),
                                _number(low), _number(high), s.null_count if s is not None and s.has_null_count else None))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """One row per (file, row group, column) of the Parquet files under ``path``, from their footers alone.

    ``min`` and ``max`` are the range as text, ``min_number`` and ``max_number`` as numbers for numeric columns; they are NULL
    where the writer kept none (``has_range`` is false).
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))
    return files.mapInArrow(_footer_batches, SCHEMA)


def column_report(footers: DataFrame) -> DataFrame:
    """(column, n_rows, n_nulls, n_row_groups, compressed_bytes, uncompressed_bytes, min_number, max_number) of a table."""
    return footers.groupBy("column").agg(
        F.sum("row_group_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.count(F.lit(1)).alias("n_row_groups"),
        F.sum("compressed_bytes").alias("compressed_bytes"), F.sum("uncompressed_bytes").alias("uncompressed_bytes"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"))


def _meets(low: float, high: float) -> Column:
    """Row groups that a filter ``low <= column <= high`` must read: those without a range, too, unless all is NULL."""
    all_null = F.coalesce(F.col("n_nulls") == F.col("row_group_rows"), F.lit(False))
    return ~all_null & (F.col("min_number").isNull() | ((F.col("min_number") <= high) & (F.col("max_number") >= low)))


def skipped(footers: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """One row: what a filter ``low <= column <= high`` lets a scan skip (row groups, rows, bytes of all columns), of how much."""
    groups = footers.groupBy("file", "row_group").agg(F.sum("compressed_bytes").alias("bytes"))
    own = footers.where(F.col("column") == column).withColumn("read", _meets(low, high))
    j = own.select("file", "row_group", "row_group_rows", "read").join(groups, ["file", "row_group"])
    out = F.col("read") == F.lit(False)
    return j.agg(F.count(F.lit(1)).alias("n_row_groups"), F.count_if(out).alias("skipped_row_groups"),
                 F.coalesce(F.sum("row_group_rows"), F.lit(0)).alias("n_rows"),
                 F.coalesce(F.sum(F.when(out, F.col("row_group_rows"))), F.lit(0)).alias("skipped_rows"),
                 F.coalesce(F.sum("bytes"), F.lit(0)).alias("n_bytes"),
                 F.coalesce(F.sum(F.when(out, F.col("bytes"))), F.lit(0)).alias("skipped_bytes"))
