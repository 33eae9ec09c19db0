"""Physical layout: bucketed tables, date-partitioned bucketed tables, layout report.

Bucketed tables let later joins on the bucket key skip the shuffle on both
sides (the scan reports ``HashPartitioning(key, n)``). Writes go to an explicit
location inside the shared scratch folder (external tables), never a
machine-local warehouse.

Sizing: a table has ``bucket_count`` buckets, from its bytes; tables that are joined
on the key share the largest count. ``spread`` deals every bucket to several tasks
(and files); with ``max_rows`` a histogram of the rows says which buckets (of which dates)
need several, where one key or date holds much of the table.

A table that is written again replaces the one of its name; the files of the version before the one
replaced are deleted (the replaced one's stay, for readers that hold it), so at most
two versions lie in the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tessera.plans.joins import broadcast_if_small, measured_bytes

# table property: where the version before this one lies
BEFORE = "tessera.before"


def bucket_id(key: str, n: int):
    """The bucket a key falls in (same hash as ``bucketBy``)."""
    return F.pmod(F.hash(F.col(key)), F.lit(n))


def bucket_count(n_bytes: int, per_bucket: int = 1 << 30, at_least: int = 1) -> int:
    """Buckets of about ``per_bucket`` bytes."""
    return max(at_least, math.ceil(n_bytes / per_bucket))


def _dealt(df: DataFrame, tasks: int, keys: Sequence, spread: int) -> DataFrame:
    if spread > 1:
        keys = [*keys, F.pmod(F.xxhash64(*df.columns), F.lit(spread))]
    return df.repartition(tasks, *keys)


def write_bucketed(df: DataFrame, table: str, key: str, n: int, path: str, spread: int = 1,
                   max_rows: int | None = None) -> DataFrame:
    """``bucketBy(n, key).sortBy(key)`` parquet table at ``path`` (op 35).

    With ``spread`` 1 a bucket is one task and one file: ``repartition(n, key)``
    hashes as the bucketing does. With ``max_rows`` a histogram of the buckets deals those with more rows, and only
    those, to as many tasks and files as they need. A table of that name is replaced.
    """
    if max_rows is not None:
        dealt = _by_histogram(df, None, key, n, max_rows, n)
    else:
        dealt = df.repartition(n, key) if spread == 1 else _dealt(df, n * spread, [bucket_id(key, n)], spread)
    writer = dealt.write.format("parquet").bucketBy(n, key).sortBy(key)
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    return _save(writer, df.sparkSession, table, path)


def _save(writer: DataFrameWriter, spark: SparkSession, table: str, path: str) -> DataFrame:
    """The table written at ``path``. It takes the place of one of its name, whose predecessor's files are deleted."""
    old, older = _places(spark, table)
    writer.mode("overwrite").option("path", path).saveAsTable(table)
    if old and old != _places(spark, table)[0]:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BEFORE}' = '{old}')")
        if older and older != old:
            at = spark._jvm.org.apache.hadoop.fs.Path(older)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.table(table)


def _places(spark: SparkSession, table: str) -> tuple[str | None, str | None]:
    """(where the table lies, where its predecessor lies) of a table written here."""
    if not spark.catalog.tableExists(table):
        return None, None
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    before = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == BEFORE).first()
    return rows.get("Location"), before.value if before else None


def rows_per_file(df: DataFrame, file_bytes: int) -> int:
    """Rows that stay within ``file_bytes``, from the measured size of the rows' text (Parquet is smaller); one aggregate."""
    rows = df.count()
    return max(1, file_bytes * rows // max(1, measured_bytes(df))) if rows else 1


def file_histogram(df: DataFrame, part: str | None, key: str, n: int, max_rows: int) -> DataFrame:
    """(part, bucket, rows, files): the files that each date's buckets need, where they need more than one.

    Without ``part`` those of the table's buckets. A tenth of a file is left free, as rows are dealt to files by a hash.
    At most rows / max_rows rows.
    """
    return (df.groupBy(*([part] if part else []), bucket_id(key, n).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > max_rows)
            .withColumn("_files", F.ceil(F.col("_rows") * 10 / (max_rows * 9)).cast("int")))


def _by_histogram(df: DataFrame, part: str | None, key: str, n: int, max_rows: int, tasks: int) -> DataFrame:
    """Rows dealt by (part, bucket), and large ones by a hash of the row as well."""
    large = broadcast_if_small(file_histogram(df, part, key, n, max_rows))
    mine = bucket_id(key, n) == F.col("_bucket")
    if part:
        large = large.withColumnRenamed(part, "_part")
        mine = mine & F.col(part).eqNullSafe(F.col("_part"))
    turn = F.pmod(F.xxhash64(*df.columns), F.coalesce("_files", F.lit(1)))
    return (df.join(large, mine, "left").withColumn("_file", turn)
            .repartition(max(tasks, -(-df.count() // max_rows)), *([F.col(part)] if part else []), bucket_id(key, n), F.col("_file"))
            .select(*df.columns))


def write_partitioned(df: DataFrame, table: str, part: str, key: str, n: int, path: str,
                      tasks: int | None = None, spread: int = 1, max_rows: int | None = None) -> DataFrame:
    """Partition by ``part`` and bucket by ``key`` in ONE distributed write (op 36).

    Rows are shuffled on (partition value, bucket id), so each (date, bucket)
    file is written by one task; no per-date driver loop and no ``collect`` of the dates. ``n`` is
    sized to a date's bytes, not the table's. ``tasks`` defaults to the session's shuffle partitions.

    With ``max_rows`` a histogram of the rows per (date, bucket) drives the layout: a bucket of a date with more
    rows is dealt to as many files and tasks as it needs, all others are one file each, and no file holds more than
    ``max_rows`` rows (see ``rows_per_file``). Without it, ``spread`` deals every bucket to so many tasks.
    """
    spark = df.sparkSession
    t = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if max_rows is None:
        dealt = _dealt(df, t, [F.col(part), bucket_id(key, n)], spread)
    else:
        dealt = _by_histogram(df, part, key, n, max_rows, t)
    writer = dealt.sortWithinPartitions(part).write.format("parquet").partitionBy(part).bucketBy(n, key).sortBy(key)
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    return _save(writer, spark, table, path)


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number of files and bytes of a folder, from its listing: no row or footer is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))
    return files.agg(F.count(F.lit(1)).alias("n_files"),
                     F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))


def layout_report(spark: SparkSession, tables: Mapping[str, DataFrame],
                  candidates: Mapping[str, Sequence[str]], base_path: str,
                  at_once: int = 4) -> DataFrame:
    """Written size of each table per candidate sort column (op 41).

    For each table and candidate (plus no sort), the table is written with
    ``sortWithinPartitions(col)`` (no shuffle); rows come from the written footers and
    the real bytes from the file listing -- unlike a plan's size estimate, this
    shows what the sort does to compression. The (few) writes are distributed
    jobs, ``at_once`` submitted together.
    """
    cases = [(name, df, col) for name, df in tables.items() for col in [None, *candidates.get(name, [])]]

    def write(case) -> str:
        name, df, col = case
        p = f"{base_path}/{name}/{col or '_unsorted'}"
        (df.sortWithinPartitions(col) if col else df).write.mode("overwrite").parquet(p)
        return p

    with ThreadPoolExecutor(at_once) as pool:
        paths = list(pool.map(write, cases))
    out = None
    for (name, _, col), p in zip(cases, paths):
        rows = spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows"))
        one = rows.unionByName(file_stats(spark, p), allowMissingColumns=True).agg(
            F.max("n_rows").alias("n_rows"), F.max("n_files").alias("n_files"),
            F.max("total_bytes").alias("total_bytes")).select(
            F.lit(name).alias("table"), F.lit(col or "").alias("sort_column"),
            "n_rows", "n_files", "total_bytes")
        out = one if out is None else out.unionByName(one)
    return out
