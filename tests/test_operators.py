"""Hand-computed cases of the road operators."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from roadflow.functions import scalars as S
from roadflow.operators import completion, flow, fusion, lookup, trajectory
from roadflow.sources import decode, sinks
from roadflow.streaming import jobs


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).head()


def test_stakes(spark):
    r = one(
        spark, a=S.stake_to_metres(F.lit("K1122+849.5")), b=S.stake_to_metres(F.lit("AK0+649.5")), c=S.section_id(F.lit("K1016+020")), d=S.section_id(F.lit("AK1+0")),
        e=S.metres_to_stake(F.lit(1122009)), f=S.metres_to_stake(F.lit(1122009), padded=False), g=S.stake_to_metres(F.lit("bad")), h=S.section_id(F.lit("K1016+20")),
    )
    assert tuple(r) == (1122849, 649, 101, -1, "K1122+009", "K1122+9", None, 101)


def test_times(spark):
    text = F.lit("2025-03-28 08:08:26:12")
    r = one(spark, a=F.unix_millis(S.parse_frame_time(text)) % 1000, b=F.unix_millis(S.parse_frame_time(text, pad_ms=True)) % 1000, c=S.parse_frame_time(F.lit("bad")), d=S.to_second(text))
    assert tuple(r) == (120, 12, None, "2025-03-28 08:08:26")


def test_classes(spark):
    kinds = [1, 4, 7, 15, 8, 10, 11, 170, 177, 0, 5, 9, 178]
    d = spark.createDataFrame([(k,) for k in kinds], "k int").select("k", S.vehicle_class(F.col("k")).alias("c"))
    assert [r.c for r in sorted(d.collect(), key=lambda r: kinds.index(r.k))] == [0] * 4 + [1] * 5 + [-1] * 4


def test_distance_and_angles(spark):
    r = one(
        spark, a=S.travelled_metres(F.lit(90.0), 200), b=S.travelled_metres(F.lit(-1.0), 200), c=F.round(S.bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), 6),
        d=F.round(S.segment_angle(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(2.0)), 6), e=S.segment_angle(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(2.0)),
        f=F.round(S.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)), 3), g=S.mark_predicted(F.lit("鄂A12345 预测值")), h=S.decimals(F.lit(0.25), 1),
    )
    assert tuple(r) == (5.0, None, 90.0, 90.0, None, round(3.141592653589793 * 6371.393, 3), "鄂A12345 预测值", "0.2")


def test_sampling(spark):
    r = one(spark, a=trajectory.sampled(F.array(*[F.lit(x) for x in (0, 2, 5, 7, 9, 10, 16)]), 5))
    assert r.a == [0, 5, 10, 16]


def points(spark, rows):
    return spark.createDataFrame(rows, "event_id long, vehicle_id long, ts timestamp_ntz, section int, mileage long, direction int, speed double")


def at(seconds):
    return dt.datetime(2025, 1, 1, 8) + dt.timedelta(seconds=seconds)


def test_session_boundary(spark):
    p = points(spark, [(1, 1, at(0), 1, 0, 1, 1.0), (2, 1, at(10), 1, 0, 1, 1.0), (3, 1, at(20.001), 1, 0, 1, 1.0)])
    assert [r.session for r in trajectory.sessions(p, 10).orderBy("event_id").collect()] == [1, 1, 2]


def test_section_changes(spark):
    p = points(spark, [(k, 1, at(k), s, 0, 1, 1.0) for k, s in enumerate([1, 2, 1, 1, 2])])
    assert flow.section_changes(p).count() == 4
    assert flow.section_changes(p, distinct=True).count() == 2


FRAME = "vehicle_id long, frame long, mileage long, direction int, speed double, plate string, road string"


def test_completion(spark):
    f = spark.createDataFrame([(1, 1, 1050000, 1, 33.3, "P", "K"), (1, 5, 1050009, 1, 33.3, "P", "K"), (2, 1, 1050000, 2, 33.3, "P", "K"), (2, 5, 1049900, 2, 33.3, "P", "K"), (3, 1, 1016020, 2, 33.3, "P", "K"), (3, 9, 1016020, 2, 33.3, "P", "K"), (4, 1, 1050000, 1, None, "P", "K"), (4, 9, 1, 1, 1.0, "P", "K")], FRAME)
    got = {(r.vehicle_id, r.frame): r.mileage for r in completion.completed(f).collect()}
    assert got == {(1, 2): 1050001, (1, 3): 1050002, (1, 4): 1050003, (2, 2): 1049998, (2, 3): 1049996, (2, 4): 1049994}
    assert completion.completed(f.limit(0)).count() == 0


def test_completion_rules(spark):
    """Ramps go forward in either direction; leaving the road gives one removal row; a timeout delays; the end is a frame."""
    f = spark.createDataFrame([(1, 1, 1050000, 2, 36.0, "P", "AK"), (2, 1, 1016021, 2, 36.0, "P", "K"), (3, 1, 1050000, 1, 36.0, "P", "K"), (3, 4, 1050000, 1, 36.0, "P", "K")], FRAME)
    rows = completion.completed(f, by_road=True, until=4, removals=True).collect()
    assert sorted((r.vehicle_id, r.frame, r.mileage, r.removed, r.plate) for r in rows) == [
        (1, 2, 1050002, False, "P 预测值"), (1, 3, 1050004, False, "P 预测值"), (1, 4, 1050006, False, "P 预测值"), (2, 2, 0, True, "0"), (3, 2, 1050002, False, "P 预测值"), (3, 3, 1050004, False, "P 预测值")
    ]
    late = completion.completed(f, until=9, wait=2).where("vehicle_id = 3").orderBy("frame").collect()
    assert [(r.frame, r.mileage) for r in late] == [(7, 1050002), (8, 1050004), (9, 1050006)]


def test_completion_means_the_last_speeds_of_a_run(spark):
    """Runs longer and shorter than the window, speeds and vehicles that are null, against a plain fold of each vehicle."""
    import random

    rng = random.Random(5)
    rows = []
    for vehicle in (1, 2, None):
        frame = 0
        for _ in range(6):
            for _ in range(rng.choice((1, 3, 20, 21, 47))):
                frame += 1
                rows.append((vehicle, frame, 1050000 + 2 * frame, 1 + rng.randint(0, 1), rng.choice((None, 20.0, 33.3, 71.7, 90.1)), f"P{frame}", "K"))
            frame += rng.choice((2, 5, 9))
    want = []
    for vehicle in (1, 2, None):
        own = [r for r in rows if r[0] == vehicle]
        run: list = []
        for r, after in zip(own, [*own[1:], None]):
            run = [*run, r]
            end = after[1] if after else 400
            if end - r[1] == 1:
                continue
            speeds, at = [x[4] for x in run[-20:] if x[4] is not None], r[2]
            for k in range(1, end - r[1] + (0 if after else 1)):
                if not speeds:
                    break
                total = 0.0
                for v in speeds:
                    total += v
                mean = total / len(speeds)
                at = int(at + mean * 200 / 3600 if r[3] == 1 else at - mean * 200 / 3600)
                speeds = [*speeds, mean][-20:]
                want.append((vehicle or 0, r[1] + k, at, round(mean, 9), r[5]))
            run = []
    shuffled = rng.sample(rows, len(rows))
    got = completion.completed(spark.createDataFrame(shuffled, FRAME), until=400).collect()
    assert sorted((r.vehicle_id or 0, r.frame, r.mileage, round(r.speed, 9), r.plate.split(" ")[0]) for r in got) == sorted(want)


def test_gate_edges(spark):
    p = points(spark, [(1, 1, at(0), 1, 1000 + 21, 1, 1.0), (2, 1, at(1), 1, 1000 + 20, 1, 1.0), (3, 1, at(2), 1, 1000, 1, 1.0), (4, 2, at(2), 1, 1000, 2, 1.0)])
    gates = spark.createDataFrame([(7, 1000, 1)], "id long, mileage long, direction int")
    assert [r.event_id for r in lookup.gate_passages(p, gates, 20).collect()] == [2]


def test_fusion_passes(spark):
    reads = spark.createDataFrame([(1, 0, 1, 1000, 2, "1"), (2, 0, 1, 5000, 1, "1"), (3, 0, 1, 9000, 1, "99"), (4, 0, 1, 20000, 1, "1")], "read_id long, ms long, direction int, mileage long, lane int, env string")
    tracks = spark.createDataFrame([(11, 100, 1, 900, 2), (12, 100, 1, 4950, 2), (13, 100, 1, 9100, 4), (14, 100, 1, 19899, 1)], "vehicle_id long, ms long, direction int, mileage long, lane int")
    got = {r.read_id: (r.vehicle_id, r["pass"]) for r in fusion.reads_to_tracks(reads, tracks).collect()}
    assert got == {1: (11, 1), 2: (12, 2), 3: (13, 3), 4: (None, None)}


def test_a_vehicle_passes_several_gantries(spark):
    """One vehicle under three gantries an hour apart matches each of them; two reads within the guard don't both."""
    reads = spark.createDataFrame([(k, k * 3_600_000, 1, 1000 + 5000 * k, 2, "1") for k in range(3)] + [(9, 1000, 1, 1000, 2, "1")], "read_id long, ms long, direction int, mileage long, lane int, env string")
    tracks = spark.createDataFrame([(11, k * 3_600_000 + 1200, 1, 990 + 5000 * k, 2) for k in range(3)], "vehicle_id long, ms long, direction int, mileage long, lane int")
    got = {r.read_id: r.vehicle_id for r in fusion.reads_to_tracks(reads, tracks).collect()}
    assert got == {0: 11, 1: 11, 2: 11, 9: None}
    _, summary = fusion.fused_and_summed(reads, tracks, F.floor(F.col("ms") / 60_000))
    assert {r.tick: (r.reads, r.anomalies, r.unmatched) for r in summary.collect()} == {0: (2, 1, "9"), 60: (1, 0, ""), 120: (1, 0, "")}


def test_streaming_fusion_equals_batch(spark):
    import random

    rng = random.Random(2)
    gantries = spark.createDataFrame([(g, 10_000 * g, 1) for g in range(1, 6)], "id long, mileage long, direction int")
    reads, points, read = [], [], 0
    for v in range(60):
        start, lane = v * 40_000, rng.randint(1, 4)
        for g in range(1, 6):
            ms = start + g * 600_000
            if rng.random() < 0.9:
                read += 1
                reads.append((read, ms, 1, 10_000 * g, lane if rng.random() < 0.8 else lane + 1, "99" if rng.random() < 0.1 else "1"))
            if rng.random() < 0.85:
                points += [(v, ms + 400 * k, 1, 10_000 * g - 40 + 20 * k, lane) for k in range(4)]
    r = spark.createDataFrame(reads, "read_id long, ms long, direction int, mileage long, lane int, env string")
    p = spark.createDataFrame(points, "vehicle_id long, ms long, direction int, mileage long, lane int")
    batch = sorted(tuple(x) for x in fusion.reads_to_tracks(r, p).select("read_id", "vehicle_id", "pass", "distance", "match_ms").na.fill(-1).collect())
    assert sum(x[1] >= 0 for x in batch) > 150 and any(x[1] < 0 for x in batch)
    jobs.use_rocksdb(spark)
    end = spark.createDataFrame([(-1, 10**9, 1, 10_000, 1)], p.schema)  # event time moves on
    streams = []
    for rows, extra in ((r, F.col("read_id") > 0), (p.unionByName(end), F.lit(True))):
        path = sinks.work_path(spark, "in")
        sinks.put(rows.where(extra).withColumns({"ts": F.timestamp_millis("ms"), "known": F.lit(False)}), path)
        streams.append(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path))
    out = jobs.run_to_table(jobs.reads_to_tracks(*streams, gantries), sinks.work_path(spark, "out"))
    assert sorted(tuple(x) for x in out.na.fill(-1).select("read_id", "vehicle_id", "pass", "distance", "match_ms").collect()) == batch


def test_section_state_with_time_to_live(spark):
    """State that expires runs in processing time, where there is always another batch: the stream is stopped once it has
    written its rows."""
    jobs.use_rocksdb(spark)
    p = points(spark, [(k, 1, at(k), s, 0, 1, 1.0) for k, s in enumerate([1, 2, 1, 1, 2])])
    path, out = sinks.work_path(spark, "in"), sinks.work_path(spark, "out")
    sinks.put(p, path)
    schema = "vehicle_id long, event_id long, ts timestamp, section int"
    q = jobs.section_changes(spark.readStream.schema(p.schema).parquet(path), keep_ms=3_600_000).writeStream.format("parquet").option("checkpointLocation", out + "-c").start(out)
    try:
        for _ in range(60):
            time.sleep(1)
            if sinks.read_or_empty(spark, out, schema).count() >= 4:
                break
    finally:
        q.stop()
    assert sinks.read_or_empty(spark, out, schema).count() == 4


def test_dimension_files(spark, tmp_path):
    (tmp_path / "stakes.json").write_text('[{"stake":"K1122+849","lnglat":[110.5,30.1],"direction":1},{"stake":"bad","lnglat":[1,2],"direction":1}]')
    (tmp_path / "road.json").write_text('[{"ramp":"AK","location":"AK0+1","longitude":1.5,"latitude":2.5},{"road_seq":7,"location":"K1+1"}]')
    (tmp_path / "gantries.csv").write_text("id,mileage,direction\nb,2000,2\na,1000,1\n")
    (tmp_path / "checkpoints.csv").write_text("longitude,latitude\n110.1,30.2\n110.2,31.3\n,\n")
    assert [(r.mileage, r.direction) for r in decode.read_stakes(spark, str(tmp_path / "stakes.json")).collect()] == [(1122849, 1)]
    assert [(r.road_seq, r.location) for r in decode.read_road_points(spark, str(tmp_path / "road.json")).orderBy("road_seq").collect()] == [(0, "AK0+1"), (7, "K1+1")]
    assert [r.id for r in decode.read_gantries(spark, str(tmp_path / "gantries.csv")).collect()] == ["a", "b"]
    assert [(r["rank"], r.latitude) for r in decode.read_checkpoints(spark, str(tmp_path / "checkpoints.csv")).orderBy("rank").collect()] == [(0, 31.3), (1, 30.2)]


def test_fibre_json(spark):
    good, bad = decode.decode_fibre_json(spark.createDataFrame([('{"SN":1,"DEVICEIP":"x","TIME":5,"COUNT":1,"TDATA":[{"ID":3,"Speed":2.5,"Tpointno":9}]}',), ("no",), ('{"SN":1}',)], "value string"))
    assert [(r.frame.SN, r.frame.TDATA[0].ID, r.frame.TDATA[0].Tpointno) for r in good.collect()] == [(1, 3, 9)] and bad.count() == 2


def test_fills(spark):
    stakes = spark.createDataFrame([(f"K1+{k:03d}", 1000 + k, 110.0 + k, 30.0 + k) for k in (0, 1, 2)], "stake string, mileage long, longitude double, latitude double")
    p = spark.createDataFrame([(1, "", None, 110.0, 31.0), (2, "K1+002", 5, 0.0, 0.0), (3, None, None, None, -1.0), (4, "K1+001", None, 7.0, 8.0)], "event_id long, stake string, mileage long, longitude double, latitude double")
    got = {r.event_id: (r.stake, r.longitude, r.latitude) for r in completion.filled(p, stakes).collect()}
    assert got == {1: ("K1+001", 110.0, 31.0), 2: ("K1+002", 112.0, 32.0), 3: (None, None, None), 4: ("K1+001", 7.0, 8.0)}


def test_as_of_lookup(spark):
    dim = spark.createDataFrame([(0, 0), (1, 100), (2, 5000)], "road_seq long, mileage long")
    p = spark.createDataFrame([(1, -5), (2, 50), (3, 51), (4, 9000), (5, 3000)], "event_id long, mileage long")
    got = {r.event_id: r.closest for r in lookup.closest_position(p, dim, "mileage", "mileage", "road_seq", 1000).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 2, 5: 2}


def test_decoders_reject(spark):
    bad = spark.createDataFrame([("zz",), ("00",), (None,)], "hex string")
    good, quarantine = decode.decode_fibre_hex(bad)
    assert good.count() == 0 and quarantine.count() == 3
    packets = spark.createDataFrame([(bytearray(b"\xff\xff\x01\xe1\x05\x00\x00\x00\xe5\xff"),), (bytearray(b"\x00"),), (None,)], "packet binary")
    good, quarantine = decode.decode_e1(packets)
    assert good.count() == 0 and quarantine.count() == 2


def test_recorded_fibre_frame(spark):
    row = "912B7700644117F03EE052849501000001000000A75D00000000000020202020202020202020202020202020000000000000000000D4D4194201C73800000001"
    p = decode.decode_fibre_hex(spark.createDataFrame([(row,)], "hex string"))[0].head()
    assert (p.SN, p.DEVICEIP, p.COUNT, p.ID, p.Carnumber, p.Wayno, p.Tpointno, p.Direct) == (7809937, "100.65.23.240", 1, 23975, "", 1, 14535, 1)
    assert abs(p.Speed - 38.4578) < 1e-3


def test_chunks(spark):
    rows = [(1, k) for k in range(120)] + [(2, k) for k in range(1201)] + [(None, 5)]
    d = spark.createDataFrame(rows, "k int, item int")
    got = {(r.k, r.chunk): r["items"] for r in flow.chunked(d, "k", F.floor(F.col("item") / 37), ["item"], "item").collect()}
    assert {k: len(v) for k, v in got.items()} == {(1, 0): 60, (1, 1): 60, (2, 0): 300, (2, 1): 300, (2, 2): 300, (2, 3): 300, (2, 4): 1, (None, 0): 1}
    assert got[2, 1] == list(range(300, 600))


def test_missing_table_is_empty(spark):
    assert sinks.read_or_empty(spark, sinks.work_path(spark, "none"), "a long").count() == 0


def test_fan_out(spark):
    seen = []
    sinks.fan_out(lambda b, n: seen.append(("a", b.count())), lambda b, n: seen.append(("b", b.count())))(spark.range(3), 0)
    assert seen == [("a", 3), ("b", 3)]


def test_e1_takes_all_events(spark, sf_dir, tmp_path):
    """Ids of more than 16 bits are encoded and decoded too."""
    from roadflow.plans import queries as plans

    events = spark.read.parquet(f"{sf_dir}/events.parquet").orderBy("event_id").limit(6)
    events.withColumn("event_id", F.lit(65533) + F.col("event_id") - events.agg(F.min("event_id")).head()[0]).write.parquet(f"{tmp_path}/events.parquet")
    n = spark.read.parquet(f"{tmp_path}/events.parquet").select("event_id").collect()
    got = plans.QUERIES["decode_e1"](spark, str(tmp_path)).collect()
    assert sorted(r.id16 for r in got) == sorted(r.event_id % 65536 for r in n) and max(r.event_id for r in n) >= 65536


def test_check_bytes_take_time_in_proportion(spark):
    """Exclusive-or of short and odd texts, and of half a megabyte in far less time than its square."""
    import functools
    import operator
    import random
    import time

    rng = random.Random(5)
    data = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 7, 8, 9, 100, 500_000)]
    rows = spark.createDataFrame([(k, d.hex()) for k, d in enumerate(data)], "id int, digits string").cache()
    rows.count()
    began = time.time()
    got = {r.id: r.x for r in rows.select("id", S.xor_of_hex(F.col("digits")).alias("x")).collect()}
    assert got == {k: functools.reduce(operator.xor, d, 0) for k, d in enumerate(data)} and time.time() - began < 8
    assert spark.range(1).select(S.xor_of_hex(F.lit("FF0"))).head()[0] == 0xFF
