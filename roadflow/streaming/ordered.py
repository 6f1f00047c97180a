"""Event-time order in keyed state: a base for processors that must see a key's rows one after the other."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources import sinks

#: Spreads ids over the time that rows may be late in ``arrivals``; rows that go into one of its files.
SPREAD, FILE_ROWS = 104_729, 100_000
#: Buckets of keys that share their calls to the state store, and rows in one entry of the buffer.
BUCKETS, CHUNK = 512, 10_000


class Ordered(StatefulProcessor):
    """Rows of a key in order of event time, whatever the order and the batches in which they come.

    Rows wait, column by column, in a list state until the watermark has passed the end of their slice of time: no row of it
    can come any more, as Spark drops those. Then ``take`` gets a key's rows that are due, sorted by ``us`` (microseconds of
    event time, the first field) and the other fields, and after that ``passed`` gets the time that is over, a slice's end.
    Both are given what the key remembers (None: nothing) and return it. So what a processor gives depends on the rows
    and the final watermark alone, and the buffer holds the rows of the allowed delay, a batch and one slice only.

    State is kept by bucket of keys: a batch costs some calls to the state store for each bucket, whatever the number of
    its rows, slices and keys, and one timer.
    """

    #: DDL of a row in the buffer, ``us`` first, and of what a key remembers; the key's DDL and the columns that go out.
    fields = ""
    memory = ""
    keys: Sequence[str] = ()
    columns: Sequence[str] = ()

    def __init__(self, slice_ms: int):
        self.slice_ms = slice_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done: dict[Any, int] = {}
        self.kinds = dict(f.split() for f in [*self.keys, *self.fields.split(", ")])
        self.held = handle.getListState("held", ", ".join(f"{n} array<{kind}>" for n, kind in self.kinds.items()))
        self.known = handle.getListState("known", ", ".join([*self.keys, self.memory]))

    def load(self, remembered: tuple) -> Any:
        """What a key remembers, from its row in the state; ``save`` is the way back."""
        return remembered

    def save(self, s: Any) -> tuple:
        return s

    def take(self, key: tuple, rows: list[tuple], s: Any, out: list[tuple]) -> Any:
        raise NotImplementedError

    def passed(self, key: tuple, over_ms: int, s: Any, out: list[tuple]) -> Any:
        """Event time is over up to ``over_ms``; None ends what the key remembers."""
        return s

    def due(self, s: Any, over_ms: int) -> int | None:
        """When ``passed`` has something to do even if no row comes."""
        return None

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            if len(pdf):
                self.held.appendValue(tuple(_plain(pdf[n], kind) for n, kind in self.kinds.items()))
                low = int(pdf["us"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer((first // (self.slice_ms * 1000) + 1) * self.slice_ms)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        over = timerValues.getCurrentWatermarkInMs() // self.slice_ms
        if self.done.get(key) == over:  # an earlier timer of this batch has taken all that is due
            return iter(())
        self.done[key] = over
        n, end_us, end_ms = len(self.keys), over * self.slice_ms * 1000, over * self.slice_ms
        due: dict[tuple, list[tuple]] = {}
        later: list[tuple] = []
        for chunk in self.held.get() if self.held.exists() else ():
            for row in zip(*chunk, strict=True):
                if row[n] < end_us:
                    due.setdefault(row[:n], []).append(row[n:])
                else:
                    later.append(row)
        known = {tuple(r[:n]): self.load(tuple(r[n:])) for r in (self.known.get() if self.known.exists() else ())}
        out: list[tuple] = []
        for k, rows in due.items():
            known[k] = self.take(k, _sorted(rows), known.get(k), out)
        known = {k: self.passed(k, end_ms, s, out) for k, s in known.items()}
        known = {k: s for k, s in known.items() if s is not None}
        _put(self.held, [tuple(map(list, zip(*part, strict=True))) for part in itertools.batched(later, CHUNK)])
        _put(self.known, [(*k, *self.save(s)) for k, s in known.items()])
        times = [t for t in (self.due(s, end_ms) for s in known.values()) if t is not None]
        if later:
            times.append((min(r[n] for r in later) // (self.slice_ms * 1000) + 1) * self.slice_ms)
        if times:
            self.handle.registerTimer(max(min(times), end_ms + self.slice_ms))
        return iter([self._frame(out)] if out else ())

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=list(self.columns))

    def close(self) -> None:
        pass


def _plain(values: pd.Series, kind: str) -> list:
    """A column as plain values; whole numbers stay whole beside nulls."""
    gone = values.isna()
    if not gone.any():
        return values.tolist()
    cast = int if kind in ("int", "long", "bigint") else lambda v: v
    return [None if g else cast(v) for v, g in zip(values.tolist(), gone.tolist(), strict=True)]


def _sorted(rows: list[tuple]) -> list[tuple]:
    try:
        return sorted(rows)
    except TypeError:  # a null beside a value: nulls last
        return sorted(rows, key=lambda r: [(v is None, 0 if v is None else v) for v in r])


def _put(state: Any, rows: list[tuple]) -> None:
    if rows:  # a list state takes no empty list
        state.put(rows)
    else:
        state.clear()


def ordered(rows: DataFrame, by: Sequence[str], processor: Ordered, schema: str, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` (with ``ts`` and the processor's fields but ``us``) through the processor, by key."""
    us = F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    names = [f.split()[0] for f in processor.fields.split(", ")][1:]
    keep = list(dict.fromkeys([*by, *names]))
    bucket = F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int").alias("bucket")
    marked = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).select("ts", bucket, us, *keep)
    processor.keys = [f"{c} {marked.schema[c].dataType.simpleString()}" for c in by]
    processor.columns = [f.split()[0] for f in schema.split(", ")]
    return marked.groupBy("bucket").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def arrivals(rows: DataFrame, path: str, jitter_ms: int, batches: int = 5, ident: str = "event_id", files: int | None = None) -> DataFrame:
    """A stream of ``rows`` that come out of order, in ``batches`` batches: each row arrives up to ``jitter_ms`` (by its id)
    after its time, and the range of arrival times is cut into equal parts, which are written one after the other, ``files`` files
    each (unless given, so many that each holds FILE_ROWS rows or more), and read one part a trigger. Rows are behind others
    that came before by less than ``jitter_ms``."""
    at = F.unix_millis(F.col("ts").cast("timestamp")) + F.pmod(F.col(ident) * SPREAD, F.lit(jitter_ms))
    every = sinks.staged(rows.withColumn("_at", at), "arriving")
    first, last = every.agg(F.min("_at"), F.max("_at")).head()
    bounds = [(first or 0) + ((last or 0) - (first or 0) + 1) * k // batches for k in range(batches + 1)]
    parts = [_between(F.col("_at"), low, high) for low, high in itertools.pairwise(bounds)]
    # Every part must have the same number of files, none of them empty, as triggers count files.
    files = files or max(1, min(every.agg(*[F.count_if(p) for p in parts]).head()) // FILE_ROWS)
    for part in parts:
        every.where(part).drop("_at").repartition(files).write.mode("append").parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _between(at: Column, low: int, high: int) -> Column:
    return (at >= low) & (at < high)
