"""Tables that are published atomically: a folder per load, a manifest per version.

``path/data/load_id=<id>/<partition folders>`` holds what one load wrote; ``path/manifest/<n>.json`` names, for every
partition, the load that holds its rows. A load writes to a folder of its own, which no manifest names yet, and is
published by one rename of a finished manifest file. Until then readers see the version before; a load that is killed or
fails at any point leaves nothing but a folder that nobody reads (``vacuum`` removes it). A load based on version n can
only become version n + 1: of two loads at the same time the second is refused, and can be run again.

A version costs one small file whose size follows the number of partitions; unchanged partitions are shared between versions, not
copied. Readers list only the folders of their version, and filters on the partition column prune among them. The
folder's file system must rename without overwriting (HDFS and local folders do).

Checks are part of the write: metrics of the written rows (``observe``) count NULL and repeated keys and values
outside their lists in the same pass, and a load with any fault isn't published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.upsert import merged_partitions, refusal

LOAD = "load_id"


class ConcurrentLoad(RuntimeError):
    """Another load was published since this one read its version."""


class DirtyLoad(ValueError):
    """A load's rows broke its checks; ``faults`` has the number of each."""

    def __init__(self, faults: dict[str, int]):
        super().__init__(f"not published: {faults}")
        self.faults = faults


@dataclass(frozen=True)
class Checks:
    """What the rows of a load must satisfy (op 43 as a gate).

    ``keys``: no NULL in them and no key twice among the rows written (all rows of the touched partitions);
    ``not_null``: columns without NULL; ``values``: the allowed values of a column (NULL is allowed).
    """

    keys: Sequence[str] = ()
    not_null: Sequence[str] = ()
    values: Mapping[str, Sequence] = field(default_factory=dict)

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation | None]:
        """``df`` with its faults counted while it is written."""
        faults: dict[str, Column] = {}
        columns = df.columns
        if self.keys:
            turn = Window.partitionBy(*self.keys).orderBy(F.lit(0))
            df = df.withColumn("_turn", F.row_number().over(turn))
            faults["null_keys"] = reduce(or_, (F.col(k).isNull() for k in self.keys))
            faults["repeated_keys"] = F.col("_turn") > 1
        for c in self.not_null:
            faults[f"null:{c}"] = F.col(c).isNull()
        for c, allowed in self.values.items():
            faults[f"value:{c}"] = F.coalesce(~F.col(c).isin(list(allowed)), F.lit(False))
        if not faults:
            return df, None
        seen = Observation()
        return df.observe(seen, *(F.count_if(x).alias(n) for n, x in faults.items())).select(*columns), seen


class VersionedTable:
    """A Parquet table at ``path``, partitioned by ``partition_col``, whose loads are published atomically."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        root = self._path(self.path)
        self._fs = root.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._rename = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    # ---- versions

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        return sorted(int(n[:-5]) for n in self._names("manifest") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version (the last one by default; None before the first load)."""
        published = self.versions()
        if version is None:
            version = published[-1] if published else None
        if version is None:
            return None
        if version not in published:
            raise ValueError(f"no version {version} of {self.path}")
        stream = self._fs.open(self._path(f"{self.path}/manifest/{version:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> int:
        """Make the manifest its version's, in one rename that fails where that version is there already."""
        number = manifest["version"]
        # a name that no reader takes for a version
        draft = self._path(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        try:
            self._context.rename(draft, self._path(f"{self.path}/manifest/{number:010d}.json"), self._rename)
        except Exception as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise ConcurrentLoad(f"version {number} of {self.path} was published by another load") from None
            raise
        return number

    # ---- reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last one by default)."""
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"nothing is published at {self.path}")
        return self._rows(manifest)

    def _rows(self, manifest: dict) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/data/{LOAD}={load}/{part}" for part, load in sorted(manifest["partitions"].items())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])) \
            .option("basePath", f"{self.path}/data").parquet(*folders)
        return found.select(*schema.fieldNames())

    # ---- loading

    def replace(self, df: DataFrame, checks: Checks | None = None, whole: bool = False) -> int:
        """Publish ``df`` as the content of the partitions it has rows in (``whole``: of the table). Returns the version."""
        return self._load(df, self.manifest(), checks, whole)

    def upsert(self, updates: DataFrame, keys: Sequence[str], partitions: Sequence | None = None,
               resolve: Sequence[str | Column] | None = None, checks: Checks | None = None) -> int:
        """Publish an upsert (see ``operators.upsert``) of the last version. Returns the new version."""
        manifest = self.manifest()
        if manifest is None:
            existing = self.spark.createDataFrame([], updates.schema)
        else:
            existing = self._rows(manifest)
        merged = merged_partitions(existing, updates, list(keys), self.partition_col, partitions, resolve)
        return self._load(merged.sortWithinPartitions(self.partition_col), manifest, checks, False)

    def _load(self, df: DataFrame, base: dict | None, checks: Checks | None, whole: bool) -> int:
        if LOAD in df.columns:
            raise ValueError(f"a column is named {LOAD}")
        load = uuid.uuid4().hex
        folder = f"{self.path}/data/{LOAD}={load}"
        schema = json.loads(df.schema.json())
        df, seen = checks.observed(df) if checks else (df, None)
        try:
            df.write.partitionBy(self.partition_col).parquet(folder)
        except PySparkException as e:
            if refusal(e):
                raise ValueError(refusal(e)) from e
            raise
        faults = {k: v for k, v in seen.get.items() if v} if seen else {}
        if faults:
            self._fs.delete(self._path(folder), True)
            raise DirtyLoad(faults)
        kept = {} if whole or base is None else base["partitions"]
        written = {n: load for n in self._names(f"data/{LOAD}={load}") if n.startswith(f"{self.partition_col}=")}
        number = 1 if base is None else base["version"] + 1
        return self._publish({"version": number, "partitions": {**kept, **written}, "schema": schema})

    # ---- care

    def rollback(self, version: int) -> int:
        """Publish an earlier version's content as a new version."""
        return self._publish({**self.manifest(version), "version": self.versions()[-1] + 1})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` versions, and loads that no version left names. Must not run beside a load."""
        old, live = self.versions()[:-keep], self.versions()[-keep:]
        used = {load for v in live for load in self.manifest(v)["partitions"].values()}
        for v in old:
            self._fs.delete(self._path(f"{self.path}/manifest/{v:010d}.json"), False)
        gone = [n for n in self._names("data") if n.removeprefix(f"{LOAD}=") not in used]
        for n in gone:
            self._fs.delete(self._path(f"{self.path}/data/{n}"), True)
        return gone
