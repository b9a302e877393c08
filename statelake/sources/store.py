"""Keyed merges into Parquet tables, one partition per UTC day.

A merge reads and rewrites only the days its batch touches. It writes them to folders of its
own and publishes a version that names the folders of every day (``versions``): a job or a
driver lost at any step leaves the table as it was, and readers that have begun go on reading
what they began with. A batch that names its source and number is merged once, however often
it is delivered. Dimensions use the same path with the single partition ``slot=0``.

Each version also knows the newest instant of every entity, kept up by merging a batch's with
those before, so that newest snapshots are read from the days that hold them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statelake.operators.dedupe import keep_one
from statelake.tables import TABLES, TableSpec

from .versions import Version, Versions

_GUARD = "null in key column"


def coerce(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project a batch to the declared schema: absent columns become NULL,
    unknown ones are dropped, values are cast (an exact integer beyond 38 digits
    raises). A NULL in the guard column fails the whole batch when it runs."""
    have = set(df.columns)
    cols = []
    for f in spec.schema:
        value = F.col(f.name) if f.name in have else F.lit(None)
        value = value.cast(f.dataType)
        if f.name == spec.guard_column:
            complaint = F.raise_error(F.lit(f"{spec.name}: {_GUARD} {f.name}"))
            value = F.coalesce(value, complaint.cast(f.dataType))
        cols.append(value.alias(f.name))
    return df.select(*cols)


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anti join that treats NULL key parts as equal."""
    probe = other.select(*[F.col(k).alias(f"_o_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return df.join(probe, same, "left_anti")


def merge_rows(current: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Upsert as a relation: batch rows replace equal keys, the batch's last row wins. No ``current``: nothing is stored."""
    winners = keep_one(batch.withColumn("_o", order), keys, F.col("_o"), last=True).drop("_o")
    return winners if current is None else without_keys(current, winners, keys).unionByName(winners)


def missing_rows(current: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Insert-missing as a relation: the batch rows whose key is absent, first row wins."""
    winners = keep_one(batch.withColumn("_o", order), keys, F.col("_o"), last=False).drop("_o")
    return winners if current is None else without_keys(winners, current, keys)


class Stored(dict):
    """Tables by name; ``newest`` has, of the day-partitioned ones, the newest instant of each entity and the days of these."""

    def __init__(self, tables: dict[str, DataFrame], newest: dict[str, tuple[DataFrame, list[str]]]) -> None:
        super().__init__(tables)
        self.newest = newest


class Lake:
    """A folder of stored tables."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = str(root).rstrip("/")

    def path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def versions(self, spec: TableSpec) -> Versions:
        return Versions(self.spark, self.path(spec))

    def has_data(self, spec: TableSpec) -> bool:
        """True when a version with rows is published; absence is no error."""
        return bool(self.versions(spec).current().folders)

    def available(self) -> list[str]:
        return [name for name, spec in TABLES.items() if self.has_data(spec)]

    def scan(self, spec: TableSpec, version: Version | None = None) -> DataFrame:
        """The stored rows, of the current version unless told otherwise; day-partitioned tables also expose ``date``."""
        version = self.versions(spec).current() if version is None else version
        df = self._folders(spec, version.folders)
        return df if spec.partitioned else df.drop("slot")

    def _folders(self, spec: TableSpec, folders: dict[str, list[str]]) -> DataFrame:
        kind = T.DateType() if spec.partitioned else T.IntegerType()
        schema = T.StructType([*spec.schema, T.StructField(spec.partition_column, kind)])
        paths = [f"{self.path(spec)}/{spec.partition_column}={day}/batch={batch}" for day, batches in folders.items() for batch in batches]
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(T.StructType([*schema, T.StructField("batch", T.StringType())]))
        return read.option("basePath", self.path(spec)).parquet(*paths).drop("batch")

    def newest(self, spec: TableSpec, version: Version | None = None) -> DataFrame:
        """Newest ``ts`` of each entity, and its ``date``: a row an entity, however many rows are stored."""
        version = self.versions(spec).current() if version is None else version
        schema = T.StructType([*[spec.schema[c] for c in spec.entity], T.StructField("ts", T.TimestampType()), T.StructField("date", T.DateType())])
        if version.newest is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path(spec)}/_newest/{version.newest}")

    def tables(self) -> Stored:
        current = {name: self.versions(spec).current() for name, spec in TABLES.items()}
        current = {name: version for name, version in current.items() if version.folders}
        newest = {
            name: (self.newest(TABLES[name], version), version.newest_days) for name, version in current.items() if TABLES[name].partitioned
        }
        return Stored({name: self.scan(TABLES[name], version) for name, version in current.items()}, newest)

    def upsert(self, spec: TableSpec, batch: DataFrame, order: Column | None = None, source: tuple[str, int] | None = None) -> int:
        """Insert or replace by key; returns the number of batch rows.

        ``order`` ranks rows of equal key inside the batch. Without it they rank by their
        place in the batch's partitions, which only a batch read from files defines: give
        it wherever equal keys can meet in a batch that was shuffled.

        ``source`` is the batch's origin and its number there; numbers rise, and a number
        that the table has merged already is left out (0 rows).
        """
        version = self.versions(spec).current()
        if source is not None and source[1] <= version.merged.get(source[0], -1):
            return 0
        rows, touched, total = self._prepare(spec, batch, order)
        if total == 0:
            return 0
        keys = [*spec.key, spec.partition_column]
        merged = merge_rows(self._current(spec, version, touched, rows), rows, keys, F.col("_order"))
        if source is not None:
            version = replace(version, merged={**version.merged, source[0]: source[1]})
        self._write(spec, merged.drop("_order"), version, replaces=True)
        return total

    def insert_missing(self, spec: TableSpec, batch: DataFrame, order: Column | None = None) -> int:
        """Insert only rows whose key is absent; returns how many were added."""
        version = self.versions(spec).current()
        rows, touched, total = self._prepare(spec, batch, order)
        if total == 0:
            return 0
        keys = [*spec.key, spec.partition_column]
        new = missing_rows(self._current(spec, version, touched, rows), rows, keys, F.col("_order")).drop("_order")
        return self._write(spec, new, version, replaces=False)

    def prune(self, spec: TableSpec, keep: int = 1) -> int:
        """Delete what the newest ``keep`` versions do not name; returns the number of folders and documents."""
        return self.versions(spec).prune(spec.partition_column, keep)

    def _partitioned(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        day = F.to_date("ts") if spec.partitioned else F.lit(0)
        return df.withColumn(spec.partition_column, day)

    def _prepare(self, spec: TableSpec, batch: DataFrame, order: Column | None):
        ranked = batch.withColumn("_order", F.monotonically_increasing_id() if order is None else order)
        typed = coerce(ranked, _with_order(spec, ranked))
        rows = self._partitioned(spec, typed)
        # One value per calendar day comes to the driver, to prune partitions.
        try:
            days = rows.groupBy(spec.partition_column).agg(
                F.count(F.lit(1)).alias("n"), F.max(spec.guard_column).alias("_guard")
            ).collect()
        except PySparkException as exc:
            raise _rejected(exc) from exc
        return rows, [r[0] for r in days], sum(r["n"] for r in days)

    def _current(self, spec: TableSpec, version: Version, touched: list, rows: DataFrame) -> DataFrame | None:
        """Stored rows of the touched partitions, in the columns of the batch's ``rows``; None where nothing is stored."""
        touched = {str(day) for day in touched}
        folders = {day: batches for day, batches in version.folders.items() if day in touched}
        if not folders:
            return None
        return self._folders(spec, folders).withColumn("_order", F.lit(None).cast(rows.schema["_order"].dataType))

    def _write(self, spec: TableSpec, df: DataFrame, before: Version, replaces: bool) -> int:
        """Write the rows of a batch and publish the version that has them; returns how many were written."""
        batch, versions, written = uuid.uuid4().hex, self.versions(spec), Observation()
        # Rebalance: one exchange by day, hot days split and small ones merged
        # by the adaptive planner.
        laid_out = (
            df.withColumn("batch", F.lit(batch)).hint("rebalance", spec.partition_column)
            .observe(written, F.count(F.lit(1)).alias("n")).sortWithinPartitions(spec.partition_column, "batch", *spec.key)
        )
        try:
            laid_out.write.mode("append").partitionBy(spec.partition_column, "batch").parquet(self.path(spec))
        except PySparkException as exc:
            raise _rejected(exc) from exc
        count = written.get.get("n", 0)
        if count:
            version = before.after(batch, versions.days_of(batch, spec.partition_column), replaces)
            versions.publish(self._with_newest(spec, version, batch) if spec.partitioned else version)
        return count

    def _with_newest(self, spec: TableSpec, version: Version, batch: str) -> Version:
        """The version with newest instants that also cover a batch; a merge never takes a key away, so they only rise."""
        own = self._folders(spec, {day: [batch] for day, batches in version.folders.items() if batch in batches}).select(*spec.entity, "ts", "date")
        per_entity = self.newest(spec, version).unionByName(own).groupBy(*spec.entity).agg(F.max("ts").alias("ts"))
        per_entity.withColumn("date", F.to_date("ts")).write.parquet(f"{self.path(spec)}/_newest/{batch}")
        version = replace(version, newest=batch)
        days = self.newest(spec, version).select("date").distinct().collect()
        return replace(version, newest_days=sorted(str(d[0]) for d in days))


def _with_order(spec: TableSpec, ranked: DataFrame) -> TableSpec:
    """The spec plus the carried ranking column."""
    extended = TableSpec(spec.name, spec.ddl, spec.key, spec.entity, spec.partitioned)
    object.__setattr__(extended, "schema", T.StructType([*spec.schema, ranked.schema["_order"]]))
    return extended


def _rejected(exc: PySparkException) -> Exception:
    """The guard's complaint as a ValueError, anything else unchanged."""
    text = str(exc)
    return ValueError(text.splitlines()[0]) if _GUARD in text else exc
