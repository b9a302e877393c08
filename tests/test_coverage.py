"""Bucket bitmaps against sets of buckets."""

import random
from datetime import datetime, timedelta, timezone

from helpers import T0, hours, rows, state

from statelake.operators.coverage import SPAN, coverage, gaps, holes, merged
from statelake.sources import Lake
from statelake.sources.covered import cover, coverage_table
from statelake.tables import MARKET_STATE

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
SECONDS = 900


def bucket(ts):
    return int((ts - EPOCH).total_seconds()) // SECONDS


def test_holes_and_gaps_equal_sets_of_buckets(spark):
    rnd = random.Random(2)
    # Within a byte, over bytes, over borders of spans, over a span without any sample, before 1970.
    border = EPOCH + timedelta(seconds=SPAN * SECONDS * 60)
    series = {
        "dense": [T0 + timedelta(seconds=SECONDS * i) for i in range(200)], "one": [T0], "byte": [T0, T0 + timedelta(seconds=SECONDS * 3)],
        "border": [border + timedelta(seconds=SECONDS * d) for d in (-20, -2, 5, 30)], "far": [T0, T0 + timedelta(seconds=SECONDS * 2 * SPAN + 5000)],
        "old": [EPOCH - timedelta(seconds=100), EPOCH + timedelta(seconds=SECONDS * 5)],
        None: [T0 + timedelta(seconds=rnd.randrange(10**6)) for _ in range(300)],
    }
    df = spark.createDataFrame([(k, t) for k, ts in series.items() for t in ts] + [("dense", None)], "k string, ts timestamp")
    whole = coverage(df, ["k"], SECONDS)
    parts = [coverage(df.where(f"pmod(unix_seconds(ts), 3) = {i}"), ["k"], SECONDS) for i in range(3)]
    for found in (whole, merged(merged(*parts[:2], ["k"]), parts[2], ["k"])):
        got = {}
        for r in holes(found, ["k"], SECONDS).collect():
            got.setdefault(r.k, []).append(bucket(r.ts.replace(tzinfo=timezone.utc)))
        expected = {k: sorted(set(range(min(map(bucket, ts)), max(map(bucket, ts)))) - set(map(bucket, ts))) for k, ts in series.items()}
        assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}
        counted = {r.k: (r.expected, r.actual) for r in gaps(found, ["k"], SECONDS).collect()}
        assert counted == {
            k: (max(map(bucket, ts)) - min(map(bucket, ts)) + 1, len(set(map(bucket, ts)))) for k, ts in series.items() if expected[k]}


def test_coverage_is_kept_up_by_merges(spark, table, tmp_path):
    lake, entity = Lake(spark, str(tmp_path / "lake")), ["chain_id", "market_id"]
    batches = [table("market_state", [state(m, T0 + hours(h), 0.5) for h in part for m in ("m", "n") if m == "m" or h < 6]) for part in ([0, 1], [4, 5, 9], [1, 2])]
    for batch in [*batches, batches[0]]:
        cover(lake, MARKET_STATE, batch, entity, 3600)
    kept = lake.scan(coverage_table(MARKET_STATE, entity))
    assert kept.count() == 2
    assert [(r["market_id"], r["ts"].hour) for r in rows(holes(kept, entity, 3600), "market_id", "ts")] == [("m", h) for h in (3, 6, 7, 8)] + [("n", 3)]
