"""Log files that grow between two runs."""

import json
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from statelake.sources import Lake, log_tail, store
from statelake.sources.event_log import split_lines
from statelake.sources.log_tail import LOG_PROGRESS, TASKS, TailReader
from statelake.streaming import ingest, ingest_growing_logs
from statelake.tables import BOT_EVENTS, BOT_SCORES


def line(n: int, kind: str = "tick_end", **more) -> str:
    return json.dumps({"ts": "2025-11-03T04:17:31.250Z", "bot": "b", "chainId": 7, "tickId": f"t{n}", "type": kind, **more}) + "\n"


def chunks(reader, start, end):
    parts = reader.partitions(start, end)
    return [(r["source_file"], r["nth"], r["ended"], r["line"]) for p in parts for b in reader.read(p) for r in b.to_pylist()]


@pytest.mark.parametrize("step", [1, 3, 7, 1 << 20])
def test_chunks_have_every_line_once(tmp_path, step):
    texts = {"events-a.jsonl": "one\n\ntwo é\nthree\nfo", "events-b.jsonl": "", "events-c.jsonl": "no end", "other.txt": "x\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    reader = TailReader(str(tmp_path), "events-*.jsonl", step)
    first = reader.latestOffset()
    assert first == {"events-a.jsonl": len("one\n\ntwo é\nthree\n".encode())}
    got = chunks(reader, {}, first)
    assert [x[3] for x in got] == ["one", "", "two é", "three"] and got[-1][2] == first["events-a.jsonl"]
    (tmp_path / "events-a.jsonl").write_text(texts["events-a.jsonl"] + "ur\nfive\n")
    (tmp_path / "events-c.jsonl").write_text("no end\n")
    assert [x[3] for x in chunks(reader, first, reader.latestOffset())] == ["four", "five", "no end"]
    assert reader.partitions(first, first) == [] and TailReader(f"{tmp_path}/none", "*", 9).latestOffset() == {}


def test_tasks_do_not_follow_small_chunks():
    """A task for each chunk of 64 KB made 58,000 tasks of 3.6 GB, each with a Python worker's start."""
    step, sizes = 1 << 16, {f"events-{n:02}.jsonl": (120 << 20) + n for n in range(30)}
    begun = {"events-07.jsonl": 1000, "events-08.jsonl": sizes["events-08.jsonl"]}
    tasks = TailReader("/none", "*", step).partitions(begun, sizes)
    assert len(tasks) <= TASKS + 1
    for name, to in sizes.items():
        at = begun.get(name, 0)
        for span in (s for t in tasks for s in t.spans if s.name == name):
            assert (span.began, span.low, span.end) == (begun.get(name, 0), at, to) and (span.low - span.began) % step == 0
            at = span.high
        assert at == to
    # Small files share a task, large chunks do not.
    assert len(TailReader("/none", "*", step).partitions({}, {f"events-{n}.jsonl": 99 for n in range(5000)})) == 1
    assert len(TailReader("/none", "*", 64 << 20).partitions({}, {"events-a.jsonl": 300 << 20})) == 5


@pytest.mark.parametrize(("step", "block"), [(1, 1), (5, 3), (16, 1 << 20), (33, 40), (1 << 20, 64)])
def test_lines_are_numbered_by_chunk(tmp_path, monkeypatch, step, block):
    monkeypatch.setattr(log_tail, "BLOCK", block)
    texts = {"events-a.jsonl": [b"x" * (7 * n % 23) for n in range(60)], "events-b.jsonl": [b"", b"\r", b"a\xff\xe2\x82", "é\u2028é".encode(), b""]}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(b"".join(t + b"\n" for t in text))
    expected, skipped = [], len(texts["events-b.jsonl"][0]) + 1
    for name, began in (("events-a.jsonl", 0), ("events-b.jsonl", skipped)):
        at, seen = 0, {}
        for text in texts[name]:
            if at >= began:
                chunk = began + (at - began) // step * step
                expected.append((name, began, chunk, seen.setdefault(chunk, 0), at + len(text) + 1, text.decode("utf-8", "replace")))
                seen[chunk] += 1
            at += len(text) + 1
    reader = TailReader(str(tmp_path), "events-*.jsonl", step)
    parts = reader.partitions({"events-b.jsonl": skipped}, reader.latestOffset())
    assert [tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()] == expected


def test_a_file_that_lost_bytes_is_an_error(tmp_path):
    (tmp_path / "events-a.jsonl").write_text("one\ntwo\n")
    reader = TailReader(str(tmp_path), "events-*.jsonl", 100)
    parts = reader.partitions({}, reader.latestOffset())
    (tmp_path / "events-a.jsonl").write_text("one\ntw")
    with pytest.raises(EOFError, match="events-a.jsonl"):
        [b for p in parts for b in reader.read(p)]


def test_lines_stay_where_they_were_read(spark, monkeypatch):
    """Few offsets are broadcast; many are met by an exchange, with the same numbers."""
    batch = spark.createDataFrame(
        [("events-a.jsonl", 0, chunk, nth, chunk + nth + 1, f"{chunk} {nth}") for chunk in (0, 100, 200) for nth in range(3)]
        + [("events-b.jsonl", 7, 7, 0, 9, "b")], log_tail.TAIL)
    progress = spark.createDataFrame([("events-b.jsonl", Decimal(0), Decimal(0), Decimal(7), Decimal(5))], LOG_PROGRESS.schema)
    placed = log_tail.stretches(batch, progress)
    expected = [("events-a.jsonl", n, f"{100 * (n // 3)} {n % 3}") for n in range(9)] + [("events-b.jsonl", 5, "b")]
    for few, hinted in ((4, True), (3, False)):
        monkeypatch.setattr(log_tail, "FEW_CHUNKS", few)
        df = log_tail.numbered(batch, placed)
        assert ("strategy=broadcast" in df._jdf.queryExecution().toString()) == hinted
        assert sorted(map(tuple, df.collect())) == expected


def test_a_first_merge_joins_nothing(spark, tmp_path, monkeypatch):
    lake, joined = Lake(spark, str(tmp_path / "lake")), []
    without = store.without_keys
    monkeypatch.setattr(store, "without_keys", lambda *a: joined.append(1) or without(*a))
    batch = spark.createDataFrame([("2025-11-03 04:17:31", "t0", 0), ("2025-11-03 04:17:31", "t0", 0), ("2025-11-04 00:00:00", None, 1)], "ts string, tick_id string, seq int")
    assert lake.upsert(BOT_EVENTS, batch, F.col("seq")) == 3 and not joined
    assert lake.upsert(BOT_EVENTS, batch.where("seq = 1"), F.col("seq")) == 1 and joined
    assert [(r["tick_id"], r["seq"]) for r in rows(lake.scan(BOT_EVENTS), "seq")] == [("t0", 0), (None, 1)]
    # Days that hold nothing yet are not joined either.
    joined.clear()
    assert lake.insert_missing(BOT_EVENTS, batch.withColumn("ts", F.lit("2025-11-05 00:00:00")), F.col("seq")) == 2 and not joined


def test_last_newline_far_from_the_end(tmp_path):
    (tmp_path / "events-a.jsonl").write_text("a\n" + "x" * 200_000)
    assert TailReader(str(tmp_path), "events-*.jsonl", 100).latestOffset() == {"events-a.jsonl": 2}


def test_appended_lines_arrive_once(spark, tmp_path):
    folder, lake = tmp_path / "log", Lake(spark, str(tmp_path / "lake"))

    def run(checkpoint="cp"):
        ingest_growing_logs(spark, str(folder), lake, str(tmp_path / "bad"), str(tmp_path / checkpoint), chunk_bytes=200).awaitTermination()
        return [(r["source_file"], r["seq"], r["tick_id"]) for r in rows(lake.scan(BOT_EVENTS), "source_file", "seq")]

    a, b = folder / "events-a.jsonl", folder / "events-b.jsonl"
    assert run() == []
    folder.mkdir()
    scores = {"vault": "0xV", "scores": [{"marketId": "m1", "u": 0.5}]}
    a.write_text(line(0) + "junk\n" + line(2) + line(3, "scores", **scores) + line(4)[:30])
    expected = [("events-a.jsonl", 0, "t0"), ("events-a.jsonl", 2, "t2")]
    assert run() == expected and run() == expected
    with a.open("a") as f:
        f.write(line(4)[30:] + "".join(line(n) for n in range(5, 20)))
    b.write_text(line(100))
    expected += [("events-a.jsonl", n, f"t{n}") for n in range(4, 20)] + [("events-b.jsonl", 0, "t100")]
    assert run() == expected
    with b.open("a") as f:
        f.write("junk\n" + line(102))
    expected += [("events-b.jsonl", 2, "t102")]
    assert run() == expected and lake.scan(BOT_SCORES).count() == 1
    assert {(r["source_file"], int(r["lines"])) for r in rows(lake.scan(LOG_PROGRESS))} == {("events-a.jsonl", 20), ("events-b.jsonl", 3)}
    assert sorted((r["source_file"], r["seq"]) for r in spark.read.json(str(tmp_path / "bad")).collect()) == [("events-a.jsonl", 1), ("events-b.jsonl", 1)]
    # A new checkpoint starts over; the merge is keyed.
    assert run("another") == expected


def test_a_batch_that_failed_is_run_again_with_the_same_numbers(spark, tmp_path, monkeypatch):
    folder, lake = tmp_path / "log", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    a = folder / "events-a.jsonl"

    def run():
        ingest_growing_logs(spark, str(folder), lake, str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()

    a.write_text(line(0) + line(1))
    run()
    with a.open("a") as f:
        f.write(line(2) + line(3))
    upsert = Lake.upsert
    for dies in ("bot_scores", "bot_events", "log_progress"):
        def failing(self, spec, *args, dies=dies):
            if spec.name == dies:
                raise RuntimeError("lost")
            return upsert(self, spec, *args)

        with monkeypatch.context() as patched:
            patched.setattr(Lake, "upsert", failing)
            with pytest.raises(Exception, match="lost"):
                run()
    # The failed batch comes first, as it was.
    run()
    with a.open("a") as f:
        f.write(line(4))
    run()
    assert [(r["seq"], r["tick_id"]) for r in rows(lake.scan(BOT_EVENTS), "seq")] == [(n, f"t{n}") for n in range(5)]


def test_lines_are_kept_without_what_nobody_reads(spark):
    texts = [line(0), line(1, "scores", vault="0xV", scores=[]), line(2, "mystery"), "junk\n"]
    lines = spark.createDataFrame([("events-a.jsonl", n, text[:-1]) for n, text in enumerate(texts)], "source_file string, seq int, line string")
    kept = ingest._needed(split_lines(lines)).selectExpr("seq", "ok", "line", "event.tickId AS tick", "fields IS NOT NULL AS fields").orderBy("seq").collect()
    assert [tuple(r) for r in kept[:3]] == [(0, True, None, "t0", True), (1, True, None, "t1", False), (2, False, texts[2][:-1], "t2", False)]
    assert (kept[3]["ok"], kept[3]["line"], kept[3]["fields"]) == (False, "junk", False)
