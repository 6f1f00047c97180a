"""Streams of several batches: rows out of order, restarts, expiry. Each result is that of the batch form."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from roadflow.operators import completion, flow
from roadflow.operators.roads import Roads
from roadflow.sources import sinks
from roadflow.streaming import jobs, keyed, ticks
from roadflow.streaming.ordered import arrivals

FRAME = "vehicle_id long, frame long, mileage long, direction int, speed double, plate string, road string"


class Feed:
    """A folder that batches are put into, one file a trigger, and the table that a stream writes."""

    def __init__(self, spark, schema, job):
        self.spark, self.schema, self.job = spark, schema, job
        self.into, self.out = sinks.work_path(spark, "in"), sinks.work_path(spark, "out")
        jobs.use_rocksdb(spark)

    def put(self, *batches):
        for rows in batches:
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.into)
        return self

    def run(self):
        stream = self.spark.readStream.schema(self.spark.createDataFrame([], self.schema).schema).option("maxFilesPerTrigger", 1).parquet(self.into)
        return jobs.run_to_table(self.job(stream), self.out)


def seconds(*times):
    return [dt.datetime(2025, 1, 1, 8) + dt.timedelta(seconds=t) for t in times]


def test_sections_out_of_order_and_a_restart(spark):
    """A row between two others comes after them; the stream stops and goes on from its checkpoint."""
    rows = [(k, 1, ts, s) for k, (ts, s) in enumerate(zip(seconds(0, 10, 20, 30, 3500, 3700, 9000, 9001), [100, 101, 101, 100, 100, 100, 7, 7], strict=True))]
    feed = Feed(spark, "event_id long, vehicle_id long, ts timestamp, section int", lambda s: jobs.section_changes(s, delay="1 minute", slice_ms=5000))
    first = feed.put([rows[0], rows[2]], [rows[1]]).run()
    assert first.count() == 0
    got = feed.put([rows[4], rows[3]], [rows[6]], [rows[7]], [rows[5]]).run()  # the last is late: an hour and more behind
    batch = flow.section_changes(spark.createDataFrame(rows[:5], feed.schema))
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in batch.collect()) == [0, 1, 3]


def timed(rows):
    return [(*r, dt.datetime.fromtimestamp(r[1] * 60, dt.UTC).replace(tzinfo=None)) for r in rows]


def test_completion_out_of_order(spark):
    """Frames that come late but in time are sightings; none of them is predicted."""
    rows = [(1, 100 + f, 1050000 + f, 1, 36.0, "P", "K") for f in (0, 1, 5, 3, 4, 9)] + [(2, 100 + f, 1050000, 1, 3.6, "P", "K") for f in (0, 40)]
    feed = Feed(spark, FRAME + ", ts timestamp", lambda s: jobs.completed(s, frame_ms=60_000, delay="5 minutes"))
    got = feed.put(timed([*rows[:3], rows[6]]), timed(rows[3:5]), timed([rows[5]]), timed([rows[7]])).run()
    batch = completion.completed(spark.createDataFrame(rows, FRAME), until=134).where("frame <= 134")
    key = lambda r: (r.vehicle_id, r.frame, r.mileage, r.plate, r.stake)
    assert sorted(map(key, got.collect())) == sorted(map(key, batch.collect()))
    assert [r.frame for r in got.where("vehicle_id = 1 AND frame < 109").orderBy("frame").collect()] == [102, 106, 107, 108]


def test_a_vehicle_expires(spark):
    """After ``max_gap`` frames its state is gone: a later sighting starts anew, nothing is predicted in between."""
    rows = [(1, 100, 1050000, 1, 36.0, "P", "K"), (2, 108, 1050000, 1, 36.0, "P", "K"), (1, 130, 1060000, 1, 36.0, "P", "K"), (2, 140, 1050000, 1, 36.0, "P", "K")]
    feed = Feed(spark, FRAME + ", ts timestamp", lambda s: jobs.completed(s, frame_ms=60_000, max_gap=3, delay="1 minute"))
    got = feed.put(*[timed([r]) for r in rows]).run()
    assert sorted((r.vehicle_id, r.frame, r.mileage) for r in got.collect()) == [(1, 100 + k, 1050000 + 2 * k) for k in (1, 2, 3)] + [(1, 130 + k, 1060000 + 2 * k) for k in (1, 2, 3)] + [(2, 108 + k, 1050000 + 2 * k) for k in (1, 2, 3)]


def test_sessions_close_in_later_batches(spark):
    """The first row of a new batch closes the session of an earlier one; rows inside the delay are sorted in."""
    schema = "event_id long, vehicle_id long, ms long, ts timestamp, plate string, vehicle_type int, longitude double, latitude double, lane int, direction int, speed double"
    at = lambda k, s: (k, 7, int(s * 1000), dt.datetime.fromtimestamp(s, dt.UTC).replace(tzinfo=None), "P", 1, 1.0, 2.0, 1, 1, 50.0)
    feed = Feed(spark, schema, lambda s: jobs.sampled_sessions(s, 10_000, 5_000, delay="8 seconds"))
    got = feed.put([at(1, 100), at(3, 106)], [at(2, 103)], [at(4, 130)], [at(5, 135), at(6, 131)], [at(7, 300)]).run()
    assert sorted((r.start_ms, r.last_ms, r.points, r.kept) for r in got.collect()) == [(100_000, 106_000, 3, 2), (130_000, 135_000, 3, 2)]


def test_reorder_over_batches(spark):
    rows = [(k, k * 300, t) for k, t in enumerate(seconds(*[0.3 * k for k in range(40)]))]
    feed = Feed(spark, "event_id long, ms long, ts timestamp", lambda s: jobs.reordered(s.withColumn("source", F.lit(1)), "source", slice_ms=1000))
    rows = [(k, int(t.replace(tzinfo=dt.UTC).timestamp() * 1000), t) for k, _, t in rows]
    got = feed.put(rows[0:10:2], rows[1:14:2], rows[10:20:2], rows[15:30:2] + rows[20:30:2], rows[30:]).run()
    numbered = flow.numbered(got, "source", F.col("slice"), ["place"]).orderBy("no").collect()
    assert [r.event_id for r in numbered] == list(range(len(numbered))) and len(numbered) >= 25


def test_arrivals_are_late_by_less_than_the_jitter(spark):
    rows = spark.range(500).select(F.col("id").alias("event_id"), F.timestamp_millis(F.col("id") * 1000).alias("ts"))
    path = sinks.work_path(spark, "arrivals")
    arrivals(rows, path, 60_000)
    parts = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_modification_time")).groupBy("file").agg(F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("file").collect()
    assert len(parts) == 5 and spark.read.parquet(path).count() == 500
    for before, after in zip(parts, parts[1:], strict=False):
        assert after.low < before.high and (before.high - after.low).total_seconds() < 60


def test_ramps_end_after_their_own_rows(spark):
    """Four ramps of different length: each vehicle goes to its ramp's last rows and is removed there; unknown roads end at once."""
    size = {"AK": 9, "BK": 21, "CK": 33, "DK": 5}
    net = [("K", k, 1050000 + k, 110 + k / 1000, 30.0) for k in range(50)] + [(r, k, k // 2, 111.0, 30 + k / 1000) for r, n in size.items() for k in range(n)]
    roads = Roads.of(spark.createDataFrame(net, "road string, road_seq long, mileage long, longitude double, latitude double"), 1050000, 1050049)
    first = [(k, 0, 0, 2, 18.0, "P", r, 111.0, 30.0) for k, r in enumerate(size)] + [(7, 0, 1050003, 2, 18.0, "P", "K", 110.003, 30.0), (8, 0, 5, 1, 18.0, "P", "EK", None, None)]
    points = spark.createDataFrame(first, FRAME + ", longitude double, latitude double")
    got = completion.completed(points, until=20, removals=True, roads=roads).orderBy("vehicle_id", "frame").collect()
    for k, (road, n) in enumerate(size.items()):
        own = [r for r in got if r.vehicle_id == k]
        steps = (n - 1 - 1) // 2  # from row 1, two rows a metre, a metre a step
        assert [r.removed for r in own] == [False] * steps + [True] and own[-1].stake is None and own[-1].plate == "0"
        assert [(r.stake, round(r.latitude, 3), round(r.heading, 3)) for r in own[:-1]] == [(f"{road}0+{j:03d}", round(30 + (1 + 2 * j) / 1000, 3), 0.0) for j in range(1, steps + 1)]
    main = [(r.frame, r.mileage, r.removed, round(r.heading)) for r in got if r.vehicle_id == 7]
    assert main == [(1, 1050002, False, 270), (2, 1050001, False, 270), (3, 1050000, False, 270), (4, 0, True, 0)]
    assert [(r.frame, r.removed) for r in got if r.vehicle_id == 8] == [(1, True)]
    with pytest.raises(ValueError, match="road rows"):
        Roads.of(spark.range(3).selectExpr("'K' road", "id road_seq", "id mileage", "1.0D longitude", "1.0D latitude"), 0, 9, most=2)


def test_outer_join_of_two_streams(spark):
    """A pair within twenty seconds, an image a second too late, a read without image that time has passed, one still open."""
    jobs.use_rocksdb(spark)
    sides = []
    batches = {
        "read_id long, plate string, upload long, ts timestamp": [[(1, "A", 1, 0), (2, "B", 1, 0)], [(3, "C", 1, 30)], [(4, "D", 1, 5000)], [(5, "E", 1, 5100)]],
        "image_id long, plate string, upload long, ts timestamp": [[(9, "Z", 1, 0)], [(11, "A", 1, 20), (12, "B", 1, 21)], [(13, "A", 2, 25)], [(14, "D", 1, 5010)]],
    }
    for schema, parts in batches.items():
        path = sinks.work_path(spark, "side")
        for rows in parts:
            spark.createDataFrame([(*r[:3], seconds(r[3])[0]) for r in rows], schema).coalesce(1).write.mode("append").parquet(path)
        sides.append(spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path))
    got = jobs.run_to_table(jobs.reads_to_images(*sides, delay="1 minute"), sinks.work_path(spark, "out"))
    assert sorted((r.read_id, r.image_id or 0) for r in got.collect()) == [(1, 11), (2, 0), (3, 0), (4, 14)]


def test_late_rows_are_kept_and_a_batch_may_come_again(spark):
    path, schema = sinks.work_path(spark, "split"), "event_id long, ts timestamp"
    write = jobs.late_splitter(path, 10_000)
    batches = [[(1, 0), (2, 100)], [(3, 95), (4, 89), (5, 90)], [], [(6, 200)], [(7, 150), (8, None)]]
    frames = [spark.createDataFrame([(k, None if t is None else seconds(t)[0]) for k, t in rows], schema) for rows in batches]
    for number in (0, 1, 1, 2, 3, 4, 1):
        write(frames[number], number)
    got = {r.event_id: r.late in (True, "true") for r in spark.read.parquet(f"{path}/rows").collect()}
    assert got == {1: False, 2: False, 3: False, 4: True, 5: True, 6: False, 7: True, 8: False}
    marks = spark.read.parquet(f"{path}/marks").orderBy("batch").collect()
    assert [(m.batch, m.late_rows) for m in marks] == [(0, 0), (1, 2), (2, 0), (3, 0), (4, 1)]


def test_merge_is_safe_from_repeats_and_broken_batches(spark):
    path, schema = sinks.work_path(spark, "merge"), "plate string, ts long, mileage long"
    merge = sinks.merge_latest(path, "plate", ["ts"], buckets=8)
    batch = lambda rows: spark.createDataFrame(rows, schema)
    read = lambda: sorted(((r.plate, r.mileage) for r in sinks.merged_rows(spark, path, schema).collect()), key=str)
    assert read() == []
    merge(batch([("a", 1, 10), ("a", 3, 30), ("b", 1, 1), (None, 1, 5)]), 0)
    first = spark.read.parquet(f"{path}/ledger").collect()
    merge(batch([("a", 2, 20), ("c", 1, 7)]), 1)
    assert read() == sorted([(None, 5), ("a", 30), ("b", 1), ("c", 7)], key=str)
    merge(batch([("a", 9, 99)]), 1)  # sent again: its line is there
    sinks.overwrite_partitions(batch([("a", 99, 0)]).withColumns({"version": F.lit(2).cast("long"), "bucket": sinks.bucket_of("plate", 8)}), f"{path}/rows", "version", "bucket")  # broken off before its line
    assert read() == sorted([(None, 5), ("a", 30), ("b", 1), ("c", 7)], key=str)
    merge(batch([("a", 4, 40)]), 2)
    assert ("a", 40) in read() and ("b", 1) in read()
    assert len(first) < 8 and len(spark.read.parquet(f"{path}/ledger").where("version = 2").collect()) == 1
    some = sinks.merged_rows(spark, path, schema, ["a", "zz"], "plate", buckets=8)
    assert [(r.plate, r.mileage) for r in some.collect()] == [("a", 40)] and len(some.inputFiles()) <= 2


def test_reads_by_key_open_only_their_buckets(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("vehicle_id"), F.to_json(F.array(F.struct("id"))).alias("cell"))
    path = sinks.work_path(spark, "cells")
    table = sinks.store_by_key(rows, "cells_" + path.rsplit("-", 1)[-1], path, "vehicle_id", 16)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the scan prunes, but doesn't say so
    try:
        picked = sinks.rows_of_keys(table, "vehicle_id", [3, 77])
        assert picked.count() == 20 and "SelectedBucketsCount: 2 out of 16" in plan(picked)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    keys = spark.range(0, 100, 10).withColumnRenamed("id", "vehicle_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = sinks.get_rows(table, keys, "vehicle_id")
        text = plan(joined)
        assert joined.count() == 100 and not any("Exchange" in line for line in text.split("FileScan parquet")[0].splitlines() if "cell" in line)
        assert text.count("Exchange hashpartitioning") <= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_votes_settle_and_expire(spark):
    """Ties go to the plate read first; a settled plate is carried; votes and the settled plate end after their times."""
    reads = [(0, "x"), (1, "y"), (2, "y"), (3, "x"), (4, "x"), (5, "y"), (200, "z"), (900, "y")]
    rows = [(k, 1, seconds(t)[0], p) for k, (t, p) in enumerate(reads)] + [(99, 2, seconds(5000)[0], None)]
    job = lambda s: keyed.plate_votes(s, settle=3, votes_ms=80_000, settled_ms=600_000, delay="10 seconds", slice_ms=1000)
    got = Feed(spark, "event_id long, vehicle_id long, ts timestamp, plate string", job).put(rows[0:6:2], rows[1:6:2], rows[6:7], rows[7:8], rows[8:]).run()
    assert [(r.event_id, r.plate, r.votes, r.carried) for r in got.orderBy("event_id").collect()] == [
        (0, "x", 1, "x"), (1, "x", 1, "x"), (2, "y", 2, "y"), (3, "x", 2, "x"), (4, "x", 3, "x"), (5, "x", 3, "x"), (6, "z", 1, "x"), (7, "y", 1, "y")
    ]


SEGMENTS = "event_id long, vehicle_id long, ts timestamp, mileage long, speed double, plate string, direction int, lane int"


def test_flush_after_the_first_row(spark):
    at = lambda k, v, t: (k, v, seconds(t)[0], 1000, 10.0, f"P{k}", 1, 1)
    rows = [at(0, 1, 0), at(1, 2, 30), at(2, 1, 59), at(3, 1, 60), at(4, 1, 119.5), at(5, 1, 500)]
    got = Feed(spark, SEGMENTS, lambda s: keyed.flushed_segments(s, delay="1 minute")).put([rows[1]], [rows[0], rows[3]], [rows[2]], [rows[4]], [rows[5]]).run()
    start = min(r.start_us for r in got.collect())
    assert sorted(((r.start_us - start) // 10**6, r.vehicle_id, r.points, r.plate) for r in got.collect()) == [(0, 1, 2, "P0"), (0, 2, 1, "P1"), (60, 1, 2, "P3")]


def test_flush_by_the_clock(spark):
    """A processing-time timer flushes what has come; such a stream doesn't end, so it is stopped."""
    feed = Feed(spark, SEGMENTS, None).put([(k, k % 2, seconds(k)[0], 1000, 1.0, "P", 1, 1) for k in range(5)])
    stream = spark.readStream.schema(spark.createDataFrame([], SEGMENTS).schema).parquet(feed.into)
    q = keyed.flushed_segments(stream, 1000, delay=None).writeStream.format("parquet").option("checkpointLocation", feed.out + "-c").start(feed.out)
    schema = "km long, start_us long, vehicle_id long, points long"
    try:
        for _ in range(60):
            time.sleep(1)
            if sinks.read_or_empty(spark, feed.out, schema).count() >= 2:
                break
    finally:
        q.stop()
    assert sorted((r.km, r.vehicle_id, r.points) for r in sinks.read_or_empty(spark, feed.out, schema).collect()) == [(1, 0, 3), (1, 1, 2)]


def test_capture_and_minute_tables(spark):
    """Raw values of a stream as text; rows by day and hour, whose scan prunes."""
    path, out = sinks.work_path(spark, "raw"), sinks.work_path(spark, "text")
    spark.createDataFrame([("a b",), ("c",)], "value string").write.text(path)
    sinks.capture_text(spark.readStream.text(path), out, out + "-c").awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a b", "c"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(seconds(0, 10, 4000, 90_000))], "event_id long, ts timestamp")
    table = sinks.work_path(spark, "hours")
    sinks.by_day_and_hour(rows, table)
    kept = spark.read.parquet(table).where("day = 20250101 AND hour = 9")
    assert [r.event_id for r in kept.collect()] == [2] and "PartitionFilters: [isnotnull(day" in kept._jdf.queryExecution().executedPlan().toString()


def test_topic_rows(spark):
    """What a topic gets: the key as text and the whole row as JSON."""
    rows = spark.createDataFrame([(1, "P"), (2, None)], "vehicle_id long, plate string")
    assert [tuple(r) for r in sinks.to_json_values(rows, "vehicle_id").orderBy("key").collect()] == [("1", '{"vehicle_id":1,"plate":"P"}'), ("2", '{"vehicle_id":2}')]


def plain_ticks(reads, points, wait, step, guard, end):
    """Tick by tick over reads (id, ms, mileage, lane, env) and points (vehicle, ms, mileage, lane, known) of one gantry, direction 1."""
    waiting, matched, out = {}, {}, []
    for tick in range(min(r[1] for r in reads) // step, end):
        waiting |= {r[0]: r for r in reads if r[1] // step == tick}
        here = [p for p in points if p[1] // step == tick]
        for number in (1, 2, 3):
            wishes = {}
            for read, ms, mileage, lane, env in waiting.values():
                best = None
                for vehicle, at, place, own, known in here:
                    if not ms <= at <= ms + wait or vehicle in matched and abs(at - matched[vehicle]) < guard or (env == "99") != (number == 3):
                        continue
                    if number == 1 and (own != lane or place > mileage) or number == 2 and abs(own - lane) > 1 and own != 5:
                        continue
                    order = (not known, own != lane) if number == 2 else ()
                    best = min(filter(None, [best, ((*order, abs(place - mileage)), vehicle, at)]))
                if best:
                    wishes.setdefault(best[1], []).append((best[0][-1], read, best[2]))
            for vehicle, asking in wishes.items():
                far, read, at = min(asking)
                matched[vehicle] = at
                del waiting[read]
                out.append((read, vehicle, number, far, at, tick))
        for read in [r for r, x in waiting.items() if (x[1] + wait) // step == tick]:
            del waiting[read]
            out.append((read, None, None, None, None, tick))
    return out


def test_ticks_equal_a_plain_walk(spark):
    """Two streams out of order over several batches, many wishes for the same vehicles; the summary counts the same run."""
    import random

    rng, jitter = random.Random(4), 20_000
    base = 1_000_000
    reads = [(k, base + rng.randrange(200_000), 10_000, rng.randint(1, 4), "99" if rng.random() < 0.15 else "1") for k in range(120)]
    points = [(rng.randrange(25), base + rng.randrange(210_000), 10_000 + rng.randint(-100, 100), rng.randint(1, 5), rng.random() < 0.3) for _ in range(400)]
    points.append((99, base + 400_000, 10_000, 1, False))
    last = [(900, base + 400_000, 10_000, 1, "1")]
    jobs.use_rocksdb(spark)
    sides = []
    for rows, schema in ((reads + last, "read_id long, ms long, mileage long, lane int, env string"), (points, "vehicle_id long, ms long, mileage long, lane int, known boolean")):
        df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], f"{schema}, event_id long").withColumns({"ts": F.timestamp_millis("ms"), "direction": F.lit(1)})
        sides.append(arrivals(df, sinks.work_path(spark, "side"), jitter))
    gantries = spark.createDataFrame([(7, 10_000, 1)], "id long, mileage long, direction int")
    path = sinks.work_path(spark, "ticks")
    stream = ticks.settled_by_tick(*sides, gantries, delay="20 seconds")
    jobs.run_batches(stream, ticks.tick_writer(path), path + "-c")
    want = plain_ticks(reads, points, 6000, 400, 15_000, (base + 400_000) // 400)
    got = spark.read.parquet(f"{path}/reads")
    key = lambda r: [-1 if x is None else x for x in r]
    assert sorted(map(key, got.select("read_id", "vehicle_id", "pass", "distance", "match_ms", "tick").collect())) == sorted(map(key, want))
    assert {w[2] for w in want} == {1, 2, 3, None} and len({w[5] - next(r[1] for r in reads if r[0] == w[0]) // 400 for w in want}) > 3
    assert sorted(map(tuple, spark.read.parquet(f"{path}/summary").select("tick", "reads", "anomalies").collect())) == sorted(
        (t, sum(w[5] == t for w in want), sum(w[5] == t and w[1] is None for w in want)) for t in {w[5] for w in want}
    )
