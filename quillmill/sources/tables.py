"""Keyed Parquet tables whose versions never change: an edit writes new folders, and one small file says which ones count.

A store is a folder of tables. Every table is cut into buckets by the hash of its key; a bucket's rows are the
Parquet files of one folder, which is written once. Which folder holds which bucket stands in a pointer, a numbered file, of which
the greatest number counts. A batch of edits writes the folders of the buckets that it touches and then
the next pointer for all its tables: readers see all of the batch or nothing, whatever the batch dies of, and a
reader keeps the folders that it began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.session import written

BUCKET = "key_bucket"
DEFAULT_BUCKETS = 64
POINTERS = "_pointers"

#: Rows that one task holds in an aggregate by keys that are nearly all different
ROWS_A_TASK = 250_000


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for work that is heavy per row: dealt out when it comes in fewer pieces than there are cores.

    Large tables come in many pieces and are read as they are, without a shuffle.
    """
    df = driver_table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt_out(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys``, to a task for every ``ROWS_A_TASK`` of its ``rows``, so that what a task holds does not grow with the table.

    For aggregates by (at least) these keys that leave nearly every row: combining before the shuffle gains nothing there, and Spark
    would put as many keys into a task as its bytes allow. An aggregate over it needs no further shuffle.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)), *keys)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class _Folder:
    """The file system that a path is in, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self._paths, self.path = spark._jvm.org.apache.hadoop.fs.Path, path
        self._fs = self._paths(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, under: str) -> list[str]:
        path = self._paths(f"{self.path}/{under}")
        return [status.getPath().getName() for status in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._paths(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """The whole file or none: it is written aside and renamed, which fails if another writer was there first."""
        aside, place = self._paths(f"{self.path}/{name}.{uuid.uuid4().hex}"), self._paths(f"{self.path}/{name}")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(place) or not self._fs.rename(aside, place):
            self._fs.delete(aside, False)
            raise RuntimeError(f"{place} was written by another batch in the meantime")

    def delete(self, name: str) -> None:
        self._fs.delete(self._paths(f"{self.path}/{name}"), True)


@dataclass(frozen=True)
class Table:
    """What a table of a store is: its columns, what its rows are known by, and the column of its serial ids, if it has any."""

    schema: str | StructType
    keys: Sequence[str]
    ids: str | None = None


@dataclass
class Store:
    """Tables that are edited together."""

    folder: str
    tables: dict[str, Table]
    buckets: int = DEFAULT_BUCKETS

    def create(self, spark: SparkSession) -> None:
        """Make the empty tables; there must be no store in the folder yet."""
        state = {name: {"folders": {}, "last_id": 0} for name in self.tables}
        _Folder(spark, self.folder).write_new(f"{POINTERS}/{0:012d}.json", json.dumps(state))

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        place = _Folder(spark, self.folder)
        numbers = [name for name in place.names(POINTERS) if name.endswith(".json")]
        if not numbers:
            raise FileNotFoundError(f"no store in {self.folder}")
        last = max(numbers)
        return int(last.split(".")[0]), json.loads(place.read(f"{POINTERS}/{last}"))

    def _rows(self, spark: SparkSession, name: str, state: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        schema, folders = _declared(self.tables[name].schema), state[name]["folders"]
        paths = [f"{self.folder}/{path}" for bucket, path in sorted(folders.items()) if buckets is None or int(bucket) in buckets]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table as the last whole batch left it."""
        return self._rows(spark, name, self._state(spark)[1])

    def begin(self, spark: SparkSession) -> Batch:
        number, state = self._state(spark)
        return Batch(self, spark, number, state)

    def forget(self, spark: SparkSession, keep: int = 10) -> int:
        """Delete the folders that none of the last ``keep`` pointers names, and older pointers; returns how many folders.

        For a time when no batch is being written: folders of a batch that is not finished are in no pointer yet.
        """
        place = _Folder(spark, self.folder)
        pointers = sorted(name for name in place.names(POINTERS) if name.endswith(".json"))
        old, new = pointers[:-keep], pointers[-keep:]
        states = [json.loads(place.read(f"{POINTERS}/{p}")) for p in new]
        used = {path for state in states for table in state.values() for path in table["folders"].values()}
        gone = 0
        for name in self.tables:
            for version in place.names(name):
                for bucket in place.names(f"{name}/{version}"):
                    if bucket.startswith(BUCKET) and f"{name}/{version}/{bucket}" not in used:
                        place.delete(f"{name}/{version}/{bucket}")
                        gone += 1
        for p in old:
            place.delete(f"{POINTERS}/{p}")
        return gone


@dataclass
class Batch:
    """Edits that count together, once ``commit`` has written the next pointer.

    A batch that is dropped before leaves folders that nothing names. Two batches begun from the same
    state do not both commit: the second one raises.
    """

    store: Store
    spark: SparkSession
    number: int
    state: dict
    touched: dict[str, set[int]] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        """A table as this batch has it so far."""
        return self.store._rows(self.spark, name, self.state)

    def last_id(self, name: str) -> int:
        return self.state[name]["last_id"]

    def edit(self, name: str, incoming: DataFrame, edit: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Write the buckets that the keys of ``incoming`` fall into as ``edit(existing, incoming)``; others are neither read nor written.

        ``incoming`` is computed once, into the work folder. A bucket that is left without rows is forgotten.
        """
        table, store = self.store.tables[name], self.store
        incoming = written(incoming, "incoming")
        found = incoming.select(key_bucket(table.keys, store.buckets).alias(BUCKET)).distinct().collect()  # at most `buckets` rows
        numbers = sorted(row[BUCKET] for row in found)
        if numbers:
            self.replace(name, edit(store._rows(self.spark, name, self.state, numbers), incoming), numbers)

    def replace(self, name: str, rows: DataFrame, buckets: Sequence[int] | None = None) -> None:
        """Write a table, or some buckets of it, anew."""
        table, store = self.store.tables[name], self.store
        version = f"{name}/{self.number + 1:012d}-{uuid.uuid4().hex}"
        path = f"{store.folder}/{version}"
        # rebalancing gives each bucket few files of a good size, and splits a bucket that is large
        placed = rows.withColumn(BUCKET, key_bucket(table.keys, store.buckets)).hint("rebalance", BUCKET)
        placed.write.partitionBy(BUCKET).parquet(path)
        made = {f.split("=")[1]: f"{version}/{f}" for f in _Folder(self.spark, store.folder).names(version) if f.startswith(f"{BUCKET}=")}
        rewritten = range(store.buckets) if buckets is None else buckets
        folders = {b: p for b, p in self.state[name]["folders"].items() if int(b) not in set(rewritten)}
        strange = set(map(int, made)) - set(rewritten)
        if strange:
            raise ValueError(f"the edit of {name} moved rows to buckets {sorted(strange)}, which it did not read")
        last = self.state[name]["last_id"]
        if table.ids and made:
            new = self.spark.read.schema(_declared(table.schema)).parquet(*[f"{store.folder}/{p}" for p in made.values()])
            last = max(last, new.agg(F.coalesce(F.max(table.ids), F.lit(0))).first()[0])
        self.state = {**self.state, name: {"folders": {**folders, **made}, "last_id": last}}
        self.touched.setdefault(name, set()).update(rewritten)

    def commit(self) -> None:
        if self.touched:
            place = _Folder(self.spark, self.store.folder)
            place.write_new(f"{POINTERS}/{self.number + 1:012d}.json", json.dumps(self.state))
            self.number, self.touched = self.number + 1, {}


# -- a single table --------------------------------------------------------------------------------------


def _single(path: str, schema: str | StructType, keys: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS) -> Store:
    return Store(path, {"rows": Table(schema, keys)}, buckets)


def create_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int = DEFAULT_BUCKETS) -> None:
    store = _single(path, df.schema, keys, buckets)
    store.create(df.sparkSession)
    batch = store.begin(df.sparkSession)
    batch.replace("rows", df)
    batch.commit()


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of a table made by ``create_table``."""
    return _single(path, schema).read(spark, "rows")


def edit_table(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    keys: Sequence[str],
    incoming: DataFrame,
    edit: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = DEFAULT_BUCKETS,
) -> None:
    """``edit(existing, incoming)`` of the buckets that the keys of ``incoming`` fall into. Running an upsert again gives the same table."""
    batch = _single(path, schema, keys, buckets).begin(spark)
    batch.edit("rows", incoming, edit)
    batch.commit()


def _declared(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
