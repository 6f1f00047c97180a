"""State partitions of streams go by cores, and streams stage the columns that they use."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from roadflow.plans import queries as plans
from roadflow.sources import sinks
from roadflow.streaming import jobs
from roadflow.streaming.ordered import arrivals


def stores(checkpoint: str) -> int:
    return sum(name.isdigit() for name in os.listdir(f"{checkpoint.removeprefix('file://')}/state/0"))


def test_state_partitions_follow_the_cores(spark):
    """Many shuffle partitions don't make many stores, and the session's number stays; a small one is kept."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    jobs.use_rocksdb(spark)
    rows = spark.range(300).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("vehicle_id"), F.timestamp_millis((F.col("id") + 60) * 60_000).alias("ts"), (F.col("id") % 3).cast("int").alias("section"))
    try:
        for asked, kept in ((40, 12), (3, 3)):
            spark.conf.set(name, asked)
            changes = lambda: jobs.section_changes(arrivals(rows, sinks.work_path(spark, "arrivals"), 60_000, batches=2), slice_ms=60_000)
            table, written = sinks.work_path(spark, "changes"), sinks.work_path(spark, "written")
            got = jobs.run_to_table(changes(), table).count()
            jobs.run_batches(changes(), lambda batch, number, to=written: sinks.put(batch, to), f"{written}-checkpoint")
            assert stores(f"{table}-checkpoint") == stores(f"{written}-checkpoint") == kept and spark.conf.get(name) == str(asked)
            assert got == spark.read.parquet(written).count() == 294  # all but the newest minutes
    finally:
        spark.conf.set(name, before)


def staged_columns(spark, sf_dir, monkeypatch, query: str) -> set[str]:
    """Columns of the rows that a query's stream writes before it reads them."""
    seen: list[str] = []

    def note(rows, *_, **__):
        seen.extend(rows.columns)
        raise InterruptedError

    monkeypatch.setattr(plans, "arrivals", note)
    try:
        plans.QUERIES[query](spark, sf_dir)
    except InterruptedError:
        pass
    return set(seen)


def test_section_changes_stage_their_columns(spark, sf_dir, monkeypatch):
    assert staged_columns(spark, sf_dir, monkeypatch, "stream_section_changes") == {"event_id", "ts", "vehicle_id", "class", "section"}


def test_votes_stage_their_columns(spark, sf_dir, monkeypatch):
    for query in ("stream_plate_vote", "stream_plate_carry_over"):
        assert staged_columns(spark, sf_dir, monkeypatch, query) == {"event_id", "ts", "vehicle_id"}


def test_sessions_and_segments_stage_their_columns(spark, sf_dir, monkeypatch):
    place = {"event_id", "ts", "vehicle_id", "plate", "lane", "direction", "speed"}
    assert staged_columns(spark, sf_dir, monkeypatch, "stream_sampled_sessions") == place | {"ms", "vehicle_type", "longitude", "latitude"}
    assert staged_columns(spark, sf_dir, monkeypatch, "stream_flushed_segments") == place | {"mileage"}
    assert staged_columns(spark, sf_dir, monkeypatch, "stream_reorder") == {"event_id", "ts", "device", "ms"}
