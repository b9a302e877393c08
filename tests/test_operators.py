"""Operators against brute force, and their laws."""

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from helpers import T0, hours
from pyspark.sql import functions as F

from statelake.functions import floor_to, whole_minutes
from statelake.operators import asof_join, keep_one, latest_rows, rolling_volatility, threshold_runs, top_k_sum, with_fallback, with_leader_spread
from statelake.operators.asof import split_bins


@pytest.mark.parametrize("chunk_seconds,max_rows", [(86400, None), (86400, 4_000_000), (3600, 1), (60, 2), (10**9, 3), (10**9, 40)])
def test_asof_equals_brute_force(spark, chunk_seconds, max_rows):
    rng = random.Random(5)
    start = datetime(2026, 1, 1)
    at = lambda: start + timedelta(seconds=rng.randrange(4 * 86400))
    # One key holds most rows; some left keys are NULL or unknown on the right.
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b"])
    right = sorted({(key(), at()) for _ in range(60)})
    right = [(k, t, None if i % 9 == 0 else float(i)) for i, (k, t) in enumerate(right)]
    left = [(i, rng.choice([key(), None, "nowhere"]), at()) for i in range(300)]
    left += [(1000 + i, "hot", right[-1][1]) for i in range(40)]  # copies of one instant
    left += [(2000, "a", start - timedelta(days=3)), (2001, "a", start + timedelta(days=900))]

    want = {}
    for i, k, t in left:
        before = [(rt, v) for rk, rt, v in right if rk == k and rt <= t]
        want[i] = max(before)[1] if before else None

    ldf = spark.createDataFrame(left, "i int, k string, ts timestamp")
    rdf = spark.createDataFrame(right, "k string, ts timestamp, v double")
    got = asof_join(ldf, rdf, [("k", "k")], {"v": "hit"}, chunk_seconds=chunk_seconds, max_rows=max_rows).collect()
    assert len(got) == len(left)
    assert {r["i"]: r["hit"] for r in got} == want


def test_a_hot_key_is_split_in_time_on_both_sides(spark):
    rng = random.Random(7)
    day = datetime(2026, 1, 1)
    left = [("hot", day + timedelta(seconds=rng.randrange(86_400)), i) for i in range(1500)] + [("hot", day + timedelta(hours=5), i) for i in range(900)]
    right = [("hot", day + timedelta(seconds=23 * i), float(i)) for i in range(3000)] + [("cold", day, 1.0)]
    keyed = spark.createDataFrame(left, "k string, ts timestamp, i int").select("k", F.unix_micros("ts").alias("_asof_t"))
    samples = spark.createDataFrame(right, "k string, ts timestamp, v double").select(
        "k", F.unix_micros("ts").alias("_asof_t"), F.struct("v").alias("_asof_v"), F.struct(F.lit(0)).alias("_asof_rank"))
    width, limit = 86_400_000_000, 300
    keyed, samples = (df.withColumn("_asof_chunk", F.floor(F.col("_asof_t") / F.lit(width))) for df in (keyed, samples))
    group = ["k", "_asof_chunk"]
    groups = keyed.groupBy(*group).agg(F.count("*").alias("_asof_n")).withColumn("_asof_v", F.lit(None).cast("struct<v:double>"))
    bins = split_bins(keyed, samples, groups, group, width, limit).collect()
    fullest = max(b["_n"] - b["_n_left"] for b in bins)
    parts = {}
    for b in bins:
        parts.setdefault(b["_asof_part"], []).append(b)
    assert len(parts) >= 12
    for part in parts.values():
        # A part ends with the bin that fills it; only the bin of one instant's copies is dealt by hash.
        assert sum(b["_n"] for b in part[:-1]) <= limit or any(b["_n_left"] > limit for b in part)
        assert sum(b["_n"] - b["_n_left"] for b in part) <= limit + fullest
        assert (part[0]["_asof_shares"] > 1) == any(b["_n_left"] > limit for b in part)
    assert sum(part[0]["_asof_shares"] > 1 for part in parts.values()) == 1


def test_asof_tie_break_and_empty_right(spark):
    left = spark.createDataFrame([(1, "k", T0)], "i int, k string, ts timestamp")
    right = spark.createDataFrame([("k", T0, 1, "x"), ("k", T0, 2, "y"), ("k", T0, 0, "z")], "k string, ts timestamp, n int, v string")
    for chunk in (60, 86400):
        (r,) = asof_join(left, right, [("k", "k")], {"v": "v"}, tie_break=["n"], chunk_seconds=chunk).collect()
        assert r["v"] == "y"
    (r,) = asof_join(left, right.where("n > 5"), [("k", "k")], {"v": "v"}).collect()
    assert r["v"] is None


def test_runs_partition_the_rows_at_or_above(spark):
    rng = random.Random(3)
    data = [(e, T0 + hours(h), rng.choice([None, rng.random()])) for e in ("a", "b") for h in range(0, 60, rng.choice([1, 2])) if rng.random() > 0.2]
    panel = spark.createDataFrame(data, "e string, ts timestamp, u double")
    runs = threshold_runs(panel, ["e"], F.col("u"), [0.3, 0.6], 7200).collect()
    for th in (0.3, 0.6):
        expected, last = [], {}
        for e, ts, u in sorted(data, key=lambda r: (r[0], r[1])):
            prev = last.get(e)
            inside = u is not None and u >= th
            if inside:
                fresh = not (prev and prev[1] and ts - prev[0] <= hours(2))
                if fresh:
                    expected.append(set())
                expected[-1].add((e, ts.replace(tzinfo=None)))
            last[e] = (ts, inside)
        got = {}
        for r in runs:
            if r["threshold"] == th:
                got.setdefault((r["e"], r["run_id"]), set()).add((r["e"], r["ts"]))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected))


def test_latest_rows_keeps_ties_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 2, 21), ("b", 1, 30)], "k string, ts int, v int")
    newest = latest_rows(df, ["k"])
    assert sorted(r["v"] for r in newest.collect()) == [20, 21, 30]
    assert "WindowGroupLimit" in newest._jdf.queryExecution().toString()


def test_top_k_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 3.0), ("a", None), ("a", 2.0), ("a", 1.0), ("b", None)], "k string, v double")
    assert {r["k"]: r["s"] for r in top_k_sum(df, ["k"], "v", 3, "s").collect()} == {"a": 10.0}


def test_keep_one_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), (None, 2, "m")], "k string, o int, v string")
    assert sorted(r["v"] for r in keep_one(df, ["k"], F.col("o")).collect()) == ["m", "y"]
    assert sorted(r["v"] for r in keep_one(df, ["k"], F.col("o"), last=False).collect()) == ["n", "x"]


def test_minutes_count_boundaries_and_floor_is_utc(spark):
    df = spark.sql("SELECT timestamp '2026-01-01 00:00:50' a, timestamp '2026-01-01 00:01:10' b")
    r = df.select(whole_minutes("a", "b").alias("m"), floor_to("b", 86400).cast("string").alias("d"), floor_to("b", 60).cast("string").alias("n")).first()
    assert (r["m"], r["d"], r["n"]) == (1, "2026-01-01 00:00:00", "2026-01-01 00:01:00")


def test_fallback_replaces_weak_prices_only_where_it_can(spark):
    schema = "k string, price double, confidence double"
    primary = spark.createDataFrame([("strong", 1.0, 0.9), ("weak", 2.0, 0.5), ("unknown", 3.0, None), ("alone", 4.0, 0.1)], schema)
    secondary = spark.createDataFrame([("strong", 10.0, None), ("weak", 20.0, None), ("unknown", 30.0, None), ("missing", 50.0, None)], schema)
    got = {r["k"]: r["price"] for r in with_fallback(primary, secondary, ["k"]).collect()}
    assert got == {"strong": 1.0, "weak": 20.0, "unknown": 30.0, "alone": 4.0, "missing": 50.0}


def test_volatility_over_trailing_days(spark):
    rnd = random.Random(9)
    at, series = 0, []
    for _ in range(400):
        at += rnd.choice([1, 1, 1, 2, 30, 24])
        series.append((rnd.choice(["a", "b"]), at, rnd.choice([None, rnd.gauss(0, 0.02), 1e-9, 3.0, -0.5])))
    df = spark.createDataFrame([(k, T0 + hours(h), v) for k, h, v in series], "k string, ts timestamp, v double")
    out = rolling_volatility(df, "v", ["k"], {"short": 2, "long": 30})
    assert out.columns == ["k", "ts", "v", "short", "long"]
    got = {(r.k, r.ts): (r.short, r.long) for r in out.collect()}
    for k, h, _ in series:
        for days, value in zip((2, 30), got[k, (T0 + hours(h)).replace(tzinfo=None)], strict=True):
            inside = [v for k2, h2, v in series if k2 == k and h - 24 * days <= h2 <= h and v is not None]
            expected = statistics.stdev(inside) * math.sqrt(8760) if len(inside) > 1 else None
            assert value is None if expected is None else math.isclose(value, expected, rel_tol=1e-9, abs_tol=1e-8)
    # Only running frames: no row is added up again for every window it is in.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame, unboundedpreceding$" in plan and "specifiedwindowframe(RangeFrame, -" not in plan


def test_spread_to_the_best_eligible_peer(spark):
    rows = [("a", 1, 5.0, True), ("a", 1, 7.0, False), ("a", 1, 4.0, True), ("a", 2, 3.0, False), (None, 1, 2.0, True), ("b", 1, None, True)]
    df = spark.createDataFrame(rows, "g string, t int, v double, ok boolean")
    out = with_leader_spread(df, "spread", "v", F.col("ok"), ["g", "t"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(*r, s) for r, s in zip(rows, [0.0, 2.0, -1.0, None, 0.0, None], strict=True)], key=repr)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
