"""Data-quality report: row counts, null rates, missing time buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from statelake.operators.coverage import coverage, gaps, holes

# Checked tables, their entity columns, bucket length in seconds,
# and how many entities the report lists.
GAP_CHECKS = [
    ("market_state", ["chain_id", "market_id"], 3600),
    ("vault_allocations", ["chain_id", "vault", "market_id"], 3600),
    ("prices", ["chain_id", "token_address"], 3600),
    ("bot_scores", ["vault", "market_id"], 1800),
]
REPORT_ROWS = 15


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_rows, null_rate) in one pass over the table."""
    names = list(columns or df.columns)
    nulls = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in names]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *nulls)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_nulls")) for c in names])
    return one.select(F.col("_n").alias("n_rows"), F.inline(entries)).select(
        "column_name", "n_rows", F.try_divide(F.col("_nulls"), F.col("n_rows")).alias("null_rate")
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Only the columns that hold NULLs."""
    return column_profile(df, columns).where("null_rate > 0").select("column_name", "null_rate")


def bucket_gaps(df: DataFrame, entity: Sequence[str], bucket_seconds: int) -> DataFrame:
    """Entities with fewer buckets than their first and last sample span."""
    return day_names(gaps(coverage(df, entity, bucket_seconds), entity, bucket_seconds))


def day_names(found: DataFrame) -> DataFrame:
    """Holes with their first and last day as text."""
    return found.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if c in ("first_ts", "last_ts") else c for c in found.columns])


def missing_buckets(df: DataFrame, entity: Sequence[str], bucket_seconds: int) -> DataFrame:
    """The absent buckets themselves."""
    return holes(coverage(df, entity, bucket_seconds), entity, bucket_seconds)


def largest(gaps: DataFrame, entity: Sequence[str]) -> tuple[int, list[Row]]:
    """Number of entities with holes and the REPORT_ROWS with the largest, in one run of the plan:
    the rows are counted on their way to the bounded top."""
    counted = Observation()
    rows = gaps.observe(counted, F.count(F.lit(1)).alias("n"))
    first = rows.orderBy((F.col("expected") - F.col("actual")).desc(), *entity).limit(REPORT_ROWS).collect()
    return counted.get.get("n", 0), first


def report(tables: Mapping[str, DataFrame]) -> str:
    """Markdown: a table of columns with NULLs per stored table, then the entities with the largest holes.

    Only counts and the first gap rows reach the driver; no task holds more than REPORT_ROWS of them.
    """
    parts: list[str] = []
    for name, df in tables.items():
        profile = column_profile(df, [c for c in df.columns if c != "date"]).collect()
        parts.append(f"## {name}: {profile[0]['n_rows']} rows\n")
        parts += ["| column | NULL share |", "|---|---|"]
        parts += [f"| {r['column_name']} | {100 * r['null_rate']:.2f} |" for r in profile if r["null_rate"]] + [""]
    for name, entity, seconds in GAP_CHECKS:
        if name not in tables:
            continue
        total, first = largest(bucket_gaps(tables[name], entity, seconds), entity)
        parts.append(f"## {name}: holes of {seconds} s buckets in {total} entities\n")
        parts += [f"* {', '.join(str(r[c]) for c in entity)}: {r['actual']} of {r['expected']} buckets between {r['first_ts']} and {r['last_ts']}" for r in first]
        parts += [f"* and {total - len(first)} others" for _ in [0] if total > len(first)] + [""]
    return "\n".join(parts)
