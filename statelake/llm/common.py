"""Helpers shared by the corpus operators: written intermediates, keys, packed columns."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.session import shared_dir

# White space of every contract of this package: space and the controls \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def small_batches(spark: SparkSession, rows: int = 250) -> None:
    """Arrow batches of long texts must fit a Python worker."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(rows):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column], F.lit(""))


def plain(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed c0, c1, ..., so that no helper column clashes, and the new names by old."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def text_key(text: Column) -> Column:
    """64-bit key of a text, taken from its SHA-256."""
    return F.xxhash64(F.sha2(text, 256))


def first_seen(df: DataFrame, key: str = "key") -> DataFrame:
    """Drop rows whose key the same task has already passed on, so that a hot key
    leaves at most one row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(key).to_pylist()
            fresh = []
            for k in keys:
                fresh.append(k not in seen)
                seen.add(k)
            yield batch.filter(pa.array(fresh, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined to tables of at least so many rows (the last may be smaller)."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], column: str, rows: int) -> Iterator[pa.Table]:
    """Tables of at least so many rows that never cut a group; the input is sorted by ``column``."""
    rest: pa.Table | None = None
    for table in chunks(batches, rows):
        if rest is not None:
            table = pa.concat_tables([rest, table])
        keys = table.column(column).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def bounded_sample(rows: DataFrame, column: str, count: int, size: int) -> list[str]:
    """About ``size`` different values of ``count`` rows, never over twice as many, chosen by
    their hash and sorted: copies of a value are collapsed before they leave their task."""
    span = 1 << 31
    below = int(span * min(1.0, size / max(1, count)))
    chosen = rows.where(F.pmod(F.xxhash64(column), F.lit(span)) < below).select(column).distinct().limit(2 * size)
    return sorted(r[0] for r in chosen.collect() if r[0] is not None)


class Memo(dict):
    """A dictionary that fills itself and is emptied when it has grown to ``most``."""

    def __init__(self, make: Callable, most: int = 100_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def lasting(name: str, make: Callable):
    """An object that a Python worker keeps for its later tasks: a tokenizer, the words it has met."""
    kept = sys.modules.setdefault("_statelake_lasting", types.ModuleType("_statelake_lasting"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


class Lately(dict):
    """A dictionary filled batch by batch. When it has grown to ``most`` it starts anew and
    takes over what it is asked for again, so that frequent keys stay."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.before = most, {}

    def provide(self, keys: set, make: Callable[[list], Iterable]) -> None:
        """See that all ``keys`` are there; ``make`` gives the values of a list of new ones."""
        new = keys - self.keys()
        if len(self) + len(new) > self.most:
            self.before = dict(self)
            self.clear()
            new = set(keys)
        known = new & self.before.keys()
        self.update((k, self.before[k]) for k in known)
        new = list(new - known)
        for at in range(0, len(new), 5000):
            part = new[at:at + 5000]
            self.update(zip(part, make(part), strict=True))


def first_of_runs(values: np.ndarray) -> np.ndarray:
    """Start of every run of equal values."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
