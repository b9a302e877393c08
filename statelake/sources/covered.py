"""Bucket coverage kept beside a stored table, merge by merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.operators.coverage import coverage, merged
from statelake.tables import TableSpec

from .store import Lake


def coverage_table(spec: TableSpec, entity: Sequence[str]) -> TableSpec:
    """The stored table of a table's coverage by entity."""
    kinds = {"int": "int", "string": "text"}
    columns = [f"{c} {kinds[spec.schema[c].dataType.simpleString()]}" for c in entity]
    return TableSpec(f"{spec.name}_coverage", ", ".join([*columns, "span long, bits bytes, first_ts ts, last_ts ts"]), (*entity, "span"), partitioned=False)


def cover(lake: Lake, spec: TableSpec, batch: DataFrame, entity: Sequence[str], bucket_seconds: int) -> None:
    """Add a batch to the stored coverage: only rows of its entities and spans are read and replaced.

    The table's rows are not read. A batch that is added twice changes nothing, as bits are merged by OR.
    """
    kept = coverage_table(spec, entity)
    new = coverage(batch, entity, bucket_seconds)
    keys = [*entity, "span"]
    probe = new.select(*[F.col(c).alias(f"_n_{c}") for c in keys])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_n_{c}"))
    known = lake.scan(kept).join(probe, same, "left_semi")
    lake.upsert(kept, merged(known, new, entity), F.lit(0))
