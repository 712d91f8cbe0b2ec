"""A mart as a base and newer versions in the same buckets: reading and compacting them shuffles nothing.

All parts are partitions of one bucketed table, numbered in the order they were written, so the same bucket of every part is
one task. A pointer lists the parts that count and is replaced by one rename: until then readers see what was there before,
and a crash at any moment leaves a whole mart behind.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.keys import latest_by_key
from martloom.sources.marts import publish

POINTER, PART = "current", "_part"


@dataclass(frozen=True)
class VersionedMart:
    """One mart under ``folder``/``name``. ``key`` must not be NULL; one writer at a time."""

    spark: SparkSession
    name: str
    folder: str
    key: str
    buckets: int

    @property
    def path(self) -> str:
        return f"{self.folder.rstrip('/')}/{self.name}"

    @property
    def _hadoop(self):
        return self.spark._jvm.org.apache.hadoop.fs

    def _files(self):
        return self._hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ parts
    @property
    def table(self) -> str:
        return f"versions_{hashlib.md5(self.path.encode()).hexdigest()}"

    def written(self) -> list[int]:
        """The numbers of all parts there are, those that do not count included."""
        root = self._hadoop.Path(f"{self.path}/rows")
        if not self._files().exists(root):
            return []
        names = [s.getPath().getName() for s in self._files().listStatus(root)]
        return sorted(int(n.removeprefix(f"{PART}=")) for n in names if n.startswith(f"{PART}="))

    def _write(self, df: DataFrame) -> int:
        number = max(self.written(), default=0) + 1
        if number > 1:
            self._entered()
        dealt = df.withColumn(PART, F.lit(number)).repartition(self.buckets, self.key)
        writer = dealt.write.mode("append").option("path", f"{self.path}/rows").partitionBy(PART)
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.table)
        return number

    def _entered(self) -> None:
        """A new session does not know the table or its buckets; its files do not tell."""
        if not self.spark.catalog.tableExists(self.table):
            files = self.spark.read.parquet(f"{self.path}/rows").drop(PART)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {self.table} ({columns}, {PART} INT) USING parquet PARTITIONED BY ({PART}) "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'"
            )
            self.spark.catalog.recoverPartitions(self.table)

    # ------------------------------------------------------------ pointer
    def parts(self) -> list[int]:
        """The numbers of the base and of the versions after it; none before the first write."""
        if not self._files().exists(self._hadoop.Path(f"{self.path}/{POINTER}")):
            return []
        return json.loads(self.spark.read.text(f"{self.path}/{POINTER}", wholetext=True).first()[0])

    def _point(self, parts: list[int]) -> None:
        """Replace the pointer by one rename."""
        new, old = self._hadoop.Path(f"{self.path}/{POINTER}-{uuid.uuid4().hex}"), self._hadoop.Path(f"{self.path}/{POINTER}")
        out = self._files().create(new)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        rename = getattr(self._hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._hadoop.FileContext.getFileContext(self._files().getUri(), self.spark._jsc.hadoopConfiguration()).rename(new, old, options)

    # ------------------------------------------------------------ the mart
    def refresh(self, df: DataFrame, updated_at: Column | None = None) -> None:
        """A new base with these rows, without any version."""
        self._point([self._write(publish(df, self.name, updated_at))])

    def append(self, df: DataFrame, updated_at: Column | None = None) -> None:
        """A newer version of some rows."""
        self._point([*self.parts(), self._write(publish(df, self.name, updated_at))])

    def read(self) -> DataFrame:
        """The newest row per key, of equal stamps the one appended last, found bucket by bucket."""
        parts = self.parts()
        if not parts:
            raise FileNotFoundError(f"no version of {self.name} in {self.folder}")
        self._entered()
        counting = self.spark.table(self.table).where(F.col(PART).isin(parts))
        return latest_by_key(counting, [self.key], [F.desc("updated_at"), F.desc(PART)]).drop(PART)

    def compact(self) -> None:
        """One base in place of base and versions, with the same rows."""
        if len(self.parts()) > 1:
            self._point([self._write(self.read())])

    def clean(self) -> list[int]:
        """Remove the parts that do not count any more, once nobody reads them. Returns their numbers."""
        gone = sorted(set(self.written()) - set(self.parts()))
        self._entered()
        for number in gone:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({PART} = {number})")
            self._files().delete(self._hadoop.Path(f"{self.path}/rows/{PART}={number}"), True)
        return gone
