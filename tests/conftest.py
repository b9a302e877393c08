from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from statelake.session import local_session  # noqa: E402
from statelake.tables import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=2, app="statelake-tests")
    # Compiling generated code costs more than running these tiny plans.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture()
def table(spark):
    """Rows (dicts with any subset of columns) as a stored table's DataFrame."""

    def make(name: str, rows: list[dict]):
        spec = TABLES[name]
        exact = {f.name for f in spec.schema if f.dataType.simpleString().startswith("decimal")}
        full = [
            tuple(
                Decimal(r[c]) if c in exact and r.get(c) is not None else r.get(c)
                for c in spec.columns
            )
            for r in rows
        ]
        return spark.createDataFrame(full, spec.schema)

    return make
