"""Calls to the state store don't grow with rows, slices and keys; open gaps go on where they were left."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from roadflow.operators import completion
from roadflow.sources import sinks
from roadflow.streaming import jobs, keyed, ordered, ticks


class Store:
    """A handle and its states in memory; ``calls`` counts what would go to the state store."""

    def __init__(self):
        self.calls, self.timers = 0, []

    def getListState(self, *_, **__):
        return State(self, [])

    def getMapState(self, *_, **__):
        return State(self, {})

    def getValueState(self, *_, **__):
        return State(self, [])

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)


class State:
    def __init__(self, store, rows):
        self.store, self.rows, self.empty = store, rows, type(rows)

    def exists(self):
        self.store.calls += 1
        return bool(self.rows)

    def get(self):
        self.store.calls += 1
        return list(self.rows) if self.empty is list and self.rows and isinstance(self.rows[0], tuple) else self.rows

    def appendValue(self, row):
        self.store.calls += 1
        self.rows.append(row)

    def put(self, rows):
        self.store.calls += 1
        self.rows = list(rows)

    def clear(self):
        self.store.calls += 1
        self.rows = self.empty()

    def update(self, row):
        self.store.calls += 1
        self.rows = tuple(row)

    def keys(self):
        self.store.calls += 1
        return list(self.rows)

    def iterator(self):
        self.store.calls += 1
        return iter(list(self.rows.items()))

    def getValue(self, key):
        self.store.calls += 1
        return self.rows.get(key)

    def updateValue(self, key, row):
        self.store.calls += 1
        self.rows[key] = row

    def removeKey(self, key):
        self.store.calls += 1
        self.rows.pop(key, None)


class Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def feed(processor, keys, columns, frame, upto):
    """All rows in one batch, then the watermark at ``upto``; what comes out."""
    store, processor.keys, processor.columns = Store(), keys, columns
    processor.init(store)
    key = tuple(frame[k.split()[0]].iloc[0] for k in keys)
    out = [*processor.handleInputRows(key, iter([frame]), Mark(0))]
    out += [f for _ in sorted(set(store.timers)) for f in processor.handleExpiredTimer(key, Mark(upto), None)]
    return store, pd.concat([f for f in out if len(f)])


def test_calls_to_the_store_are_few_for_many_slices():
    n, minute = 500, 60_000
    rows = pd.DataFrame({"vehicle_id": 7, "us": [k * minute * 1000 for k in range(n)], "event_id": range(n)})
    sections = rows.assign(section=[k // 2 for k in range(n)])
    store, got = feed(jobs.SectionChange(minute), ["vehicle_id long"], ["vehicle_id", "event_id", "us", "section"], sections, n * minute)
    assert len(got) >= n // 2 and store.calls < 20
    votes = rows.assign(plate=["x", "y"] * (n // 2))
    store, got = feed(keyed.PlateVotes(10, None, None, minute), ["vehicle_id long"], ["vehicle_id", "event_id", "us", "plate", "votes", "carried"], votes, n * minute)
    assert len(got) == n and store.calls < 20 and set(got["plate"]) == {"x"} and got["votes"].max() == n // 2


def test_reads_that_are_over_meet_no_points():
    """One read and one point a second over ten minutes: a tick compares points with what waits then, not with all reads of the batch."""
    calls = [0]

    class Counted(ticks.TickFusion):
        def _fits(self, *args):
            calls[0] += 1
            return super()._fits(*args)

    n = 600
    side = lambda read: pd.DataFrame({
        "direction": 1, "gantry_id": 5, "us": [k * 1_000_000 + (not read) for k in range(n)], "id": [k + 1000 * read for k in range(n)], "is_read": read, "mileage": 100 if read else 90, "lane": 1,
        "env": "1" if read else None, "known": False,
    })
    columns = ["read_id", "vehicle_id", "pass", "distance", "match_ms", "tick"]
    store, got = feed(Counted(3000, 1000, 100), ["direction int", "gantry_id long"], columns, pd.concat([side(True), side(False)]), n * 1000 + 10_000)
    assert len(got) == n and calls[0] <= 6 * n and store.calls < 20
    assert sorted(got["read_id"] - 1000) == sorted(got["vehicle_id"]) == list(range(n))


def test_an_open_gap_gives_its_new_steps_only():
    one = {"vehicle_id": 1, "frame": 100, "speeds": [3600.0], "mileage": 1000, "up": True, "plate": "P", "direction": 1, "road": "K", "longitude": 5.0, "latitude": 6.0, "low": 0, "high": 1900}
    walk = lambda done, gap: pd.concat([pd.DataFrame(), *completion.predicted(iter([pd.DataFrame([{**one, "done": done, "gap": gap}])]), 200, 20, 0, True, carry=True)])
    whole, parts = walk(0, 9), pd.concat([walk(0, 3), walk(3, 4), walk(4, 9), walk(9, 20)])
    assert list(whole["frame"]) == [101, 102, 103, 104, 105] and list(whole["removed"]) == [False] * 4 + [True]
    assert list(parts["frame"]) == list(whole["frame"]) and list(parts["mileage"]) == list(whole["mileage"]) and list(parts["longitude"]) == [5.0] * 4 + [0.0]


def test_large_batches_come_in_several_files(spark, monkeypatch):
    """Every batch has as many files, none empty, and all rows."""
    monkeypatch.setattr(ordered, "FILE_ROWS", 30)
    rows = spark.range(500).select(F.col("id").alias("event_id"), F.timestamp_millis(F.col("id") * 1000).alias("ts"))
    path = sinks.work_path(spark, "arrivals")
    ordered.arrivals(rows, path, 60_000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).collect()
    assert len(files) % 5 == 0 and len(files) > 5 and sum(f.n for f in files) == 500
