"""A registered query: how Spark computes it and how SQL does."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .adapters import Given, given


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Given], DataFrame]
    sql: str | None
    # Engines sum doubles in different orders: rounded columns and their digits.
    # Both sides add the same hundredth of the last digit first, so that an exact
    # half (an average of 64 two-digit numbers, say) does not fall either way.
    digits: dict[str, int] = field(default_factory=dict)
    # Exact integers are compared as text.
    exact: tuple[str, ...] = ()

    def spark(self, spark, sf_dir: str) -> DataFrame:
        df = self.run(given(spark, sf_dir))
        cols = []
        for f in df.schema:
            c = F.col(f"`{f.name}`")
            if f.name in self.digits:
                d = self.digits[f.name]
                c = F.round(c.cast("double") + F.lit(float(f"1.37e-{d + 2}")), d) + F.lit(0.0)
            elif f.name in self.exact:
                c = c.cast("string")
            elif isinstance(f.dataType, T.TimestampType):
                c = c.cast("timestamp_ntz")
            cols.append(c.alias(f.name))
        return df.select(*cols)

    def oracle(self) -> str | None:
        if self.sql is None or not (self.digits or self.exact):
            return self.sql
        changes = [f"round(CAST({c} AS DOUBLE) + 1.37e-{d + 2}, {d}) + 0.0 AS {c}" for c, d in self.digits.items()]
        changes += [f"CAST({c} AS VARCHAR) AS {c}" for c in self.exact]
        return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({self.sql}) AS answer"
