"""Flow statistics: counts and speeds by time, section, direction and class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def word_counts(texts: DataFrame, col: str = "text") -> DataFrame:
    """Words between white space and how often they occur."""
    return texts.select(F.explode(F.regexp_extract_all(col, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word")).groupBy("word").count()


def section_changes(events: DataFrame, distinct: bool = False, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Events at which a vehicle enters a section within an hour: the section differs from the one before. A, B, A are
    three; with ``distinct`` a section counts once an hour."""
    hour = events.withColumn("hour", F.date_trunc("hour", "ts"))
    if distinct:
        n = F.row_number().over(Window.partitionBy("vehicle_id", "hour", "section").orderBy(*order))
        return hour.withColumn("_n", n).where("_n = 1").drop("_n")
    before = F.lag("section").over(Window.partitionBy("vehicle_id", "hour").orderBy(*order))
    return hour.withColumn("_before", before).where("NOT (section <=> _before)").drop("_before")


def hourly_section_flow(changes: DataFrame) -> DataFrame:
    """Per hour and section: counts by direction and class, mean speeds by direction (0 if there is none)."""
    n = lambda d, c: F.count_if((F.col("direction") == d) & (F.col("class") == c))
    speed = lambda d: F.coalesce(F.avg(F.when(F.col("direction") == d, F.col("speed"))), F.lit(0.0))
    return changes.groupBy("hour", "section").agg(
        n(1, 0).alias("up_bus"), n(1, 1).alias("up_truck"), n(2, 0).alias("down_bus"), n(2, 1).alias("down_truck"),
        speed(1).alias("up_speed"), speed(2).alias("down_speed"),
    )


def daily_directions(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows of each direction a day; a null direction counts in neither."""
    return rows.groupBy(F.to_date(ts).alias("day")).agg(F.count_if(F.col("direction") == 1).alias("up"), F.count_if(F.col("direction") == 2).alias("down"))


def zero_filled(rows: DataFrame, unit: str, value: str, start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Sums of ``value`` by hour or day for every unit from that of ``start`` to that of ``end``; rows outside are left out."""
    calendar = rows.sparkSession.range(1).select(F.explode(F.sequence(F.date_trunc(unit, start), F.date_trunc(unit, end), F.expr(f"INTERVAL 1 {unit}"))).alias("slot"))
    sums = rows.where((F.date_trunc(unit, ts) >= F.date_trunc(unit, start)) & (F.date_trunc(unit, ts) <= F.date_trunc(unit, end))).groupBy(F.date_trunc(unit, ts).alias("slot")).agg(F.sum(value).alias("total"))
    return calendar.join(sums, "slot", "left").withColumn("total", F.coalesce("total", F.lit(0)))


def minute_km_plates(points: DataFrame) -> DataFrame:
    """Distinct plates for each minute and kilometre, sorted and comma-joined."""
    return points.groupBy(F.date_trunc("minute", "ts").alias("minute"), F.floor(F.col("mileage") / 1000).alias("km")).agg(
        F.array_join(F.array_sort(F.collect_set("plate")), ",").alias("plates")
    )


def vehicle_minute_segments(points: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Per minute, kilometre and vehicle: sum of speeds, number of points, attributes of the first."""
    first = lambda c: F.min_by(c, F.struct(*order)).alias(c)
    return points.groupBy(F.date_trunc("minute", "ts").alias("minute"), F.floor(F.col("mileage") / 1000).alias("km"), "vehicle_id").agg(
        F.sum("speed").alias("speed_sum"), F.count("*").alias("points"), first("plate"), first("direction"), first("lane"), first("vehicle_type")
    )


def minute_segment_lists(segments: DataFrame) -> DataFrame:
    """One row for each minute and kilometre with its vehicles' segments as an array."""
    return segments.groupBy("minute", "km").agg(F.sort_array(F.collect_list(F.struct("vehicle_id", "plate", "speed_sum", "points", "direction", "lane", "vehicle_type"))).alias("vehicles"))


def segment_status(segments: DataFrame, classes: Column) -> DataFrame:
    """Per minute, kilometre and direction: mean speed, vehicles per km, counts and mean speeds by class, vehicles by lane."""
    mean = F.col("speed_sum") / F.col("points")
    s = segments.withColumns({"_v": mean, "_c": classes})
    of = lambda k: F.col("_c") == k
    lanes = [F.count_if(F.col("lane") == k).alias(f"lane{k}") for k in range(1, 5)]
    return s.groupBy("minute", "km", "direction").agg(
        (F.sum("speed_sum") / F.sum("points")).alias("avg_speed"), F.count("*").alias("density"), F.count_if(of(0)).alias("buses"), F.count_if(of(1)).alias("trucks"),
        F.coalesce(F.avg(F.when(of(0), F.col("_v"))), F.lit(0.0)).alias("bus_speed"), F.coalesce(F.avg(F.when(of(1), F.col("_v"))), F.lit(0.0)).alias("truck_speed"), *lanes,
    )


def station_up_down(points: DataFrame, station: Column, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Hourly up and down counts of a station: each vehicle's first sighting there, odd lanes up, even lanes down."""
    first = points.where(station).groupBy("vehicle_id").agg(F.min_by(F.struct("ts", "lane"), F.struct(*order)).alias("f"))
    return first.groupBy(F.date_trunc("hour", "f.ts").alias("hour")).agg(F.count_if(F.col("f.lane") % 2 == 1).alias("up"), F.count_if(F.col("f.lane") % 2 == 0).alias("down"))


def slot_device_plates(points: DataFrame, slot: Column, first_frame_only: bool = False) -> DataFrame:
    """Distinct plates of each slot and device as a sorted list, and their number; optionally of the slot's first frame only."""
    p = points.withColumn("slot", slot)
    if first_frame_only:
        p = p.withColumn("_f", F.min("frame").over(Window.partitionBy("slot", "device"))).where("frame = _f").drop("_f")
    return p.groupBy("slot", "device").agg(F.array_join(F.array_sort(F.collect_set("plate")), ",").alias("plates"), F.count_distinct("plate").alias("n"))


def slot_unique(points: DataFrame, width: str, origin: str, ts: str = "ts") -> DataFrame:
    """Number of distinct vehicles in each slot of fixed width from an origin (an offset such as `5 minutes`)."""
    return points.groupBy(F.window(ts, width, width, origin).alias("w")).agg(F.count_distinct("vehicle_id").alias("vehicles")).select(F.col("w.start").alias("slot"), "vehicles")


def plate_votes(reads: DataFrame, settle: int = 10, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Each vehicle's most frequent plate (ties: the one read first), its votes, and whether it is settled."""
    n = reads.groupBy("vehicle_id", "plate").agg(F.count("*").alias("votes"), F.min(F.struct(*order)).alias("first"))
    best = F.row_number().over(Window.partitionBy("vehicle_id").orderBy(F.desc("votes"), "first"))
    return n.withColumn("_n", best).where("_n = 1").select("vehicle_id", "plate", "votes", (F.col("votes") >= settle).alias("settled"))


def carried_plates(votes: DataFrame, points: DataFrame) -> DataFrame:
    """Points with the settled plate, else the best so far, else their own."""
    v = votes.select("vehicle_id", F.col("plate").alias("_p"))
    return points.join(v, "vehicle_id", "left").withColumn("plate", F.coalesce("_p", "plate")).drop("_p")


def match_summary(matches: DataFrame) -> DataFrame:
    """Per tick: reads, unmatched reads, and the sorted list of those."""
    missed = F.col("vehicle_id").isNull()
    return matches.groupBy("tick").agg(
        F.count("*").alias("reads"), F.count_if(missed).alias("anomalies"), F.array_join(F.array_sort(F.collect_list(F.when(missed, F.col("read_id").cast("string")))), ",").alias("unmatched")
    )


def bounding_boxes(points: DataFrame, by: str, x: str, y: str) -> DataFrame:
    return points.groupBy(by).agg(F.min(x).alias("min_x"), F.max(x).alias("max_x"), F.min(y).alias("min_y"), F.max(y).alias("max_y"))


def monotonicity(rows: DataFrame, by: str, value: str, order: Sequence[str]) -> DataFrame:
    """INCREASING if a sequence never falls, DECREASING if it never rises, else (or with one row) NOT_MONOTONIC."""
    before = rows.withColumn("_b", F.lag(value).over(Window.partitionBy(by).orderBy(*order)))
    up, down = F.bool_and(F.col(value) >= F.col("_b")), F.bool_and(F.col(value) <= F.col("_b"))
    return before.groupBy(by).agg(F.when(up, "INCREASING").when(down, "DECREASING").otherwise("NOT_MONOTONIC").alias("trend"))


def numbered(rows: DataFrame, by: str, bucket: Column, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``no`` (from 0) in their order within ``by``, and ``of``, the number of rows there. Numbers are taken in
    two levels: ``bucket`` grows with the order, counts of buckets are summed up first, and rows are numbered within
    buckets, so that no task sorts all rows of a hot ``by``."""
    r = rows.withColumn("_bucket", bucket)
    counts = r.groupBy(by, "_bucket").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(by)
    base = counts.select(
        F.col(by).alias("_by"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_c").over(w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.sum("_c").over(w).alias("of")
    )
    inside = F.row_number().over(Window.partitionBy(by, "_bucket").orderBy(*order)) - 1
    same = F.col(by).eqNullSafe(F.col("_by")) & F.col("_bucket").eqNullSafe(F.col("_b"))
    return r.withColumn("_in", inside).join(base, same).withColumn("no", F.col("_base") + F.col("_in")).drop("_bucket", "_b", "_by", "_in", "_base")


def running_total(frames: DataFrame, n: str, order: str, bucket: Column) -> DataFrame:
    """``frames`` with ``total``, the sum of ``n`` so far in the given order; bucket totals first, then within buckets, so
    that no window spans the table."""
    f = frames.withColumn("_bucket", bucket)
    totals = f.groupBy("_bucket").agg(F.sum(n).alias("_t"))
    base = totals.select("_bucket", F.coalesce(F.sum("_t").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.sum(n).over(Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return f.withColumn("_in", inside).join(base, "_bucket").withColumn("total", F.col("_base") + F.col("_in")).drop("_bucket", "_in", "_base")


def packed_frames(frames: DataFrame, least: int, bucket: Column) -> DataFrame:
    """Frames numbered into packs of about ``least`` points by the points of all frames before them."""
    return running_total(frames, "n", "frame", bucket).withColumn("pack", F.floor((F.col("total") - F.col("n")) / least)).drop("total")


def renumbered(points: DataFrame, by: str, bucket: Column, order: Sequence[str], first: int = 10000) -> DataFrame:
    """Points of each pack with new ids from ``first`` and plates padded from them; ``bucket`` as in ``numbered``."""
    n = numbered(points, by, bucket, order).withColumn("new_id", F.col("no") + first).drop("no", "of")
    return n.withColumn("new_plate", F.lpad(F.col("new_id").cast("string"), 7, "0"))


def chunked(points: DataFrame, by: str, bucket: Column, order: Sequence[str], item: str) -> DataFrame:
    """``by, chunk, items``: the items of each frame cut into chunks of max(50, n / 2) items up to 1000, 300 up to 5000,
    500 up to 10000, else 1000. Only chunks are gathered, never a frame."""
    n = F.col("of")
    width = F.when(n <= 1000, F.greatest(F.lit(50), F.floor(n / 2).cast("int"))).when(n <= 5000, 300).when(n <= 10000, 500).otherwise(1000)
    placed = numbered(points, by, bucket, order).withColumn("chunk", F.floor(F.col("no") / width))
    items = F.transform(F.sort_array(F.collect_list(F.struct("no", item))), lambda x: x[item])
    return placed.groupBy(by, "chunk").agg(items.alias("items"))


def latest_features(rows: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Last write wins for each key."""
    return rows.groupBy(key).agg(*[F.max_by(c, F.struct(*order)).alias(c) for c in fields])
