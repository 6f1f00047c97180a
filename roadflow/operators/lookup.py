"""Lookups against road dimensions: nearest, as-of, clamped, and walks along the road.

A dimension (gantries, stakes, road points) is grouped by cells of its key; each cell's rows form one short array,
which is joined to the facts by an equi-join on the cell. Facts are never shuffled for it when the dimension is
small enough for Spark to broadcast, and never multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S


def _cells(dim: DataFrame, key: str, width: float, by: Sequence[str], fields: Sequence[str], reach: int = 1) -> DataFrame:
    """A row for each cell (and ``by``) with an array of the dimension's rows in it and its neighbours."""
    cell = F.floor(F.col(key) / width)
    return (
        dim.withColumn("_cell", F.explode(F.sequence(cell - reach, cell + reach)))
        .groupBy(*by, "_cell").agg(F.collect_list(F.struct(*fields)).alias("_near"))
    )


def nearest(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, dim_id: str, reach: float, by: Sequence[str] = (), name: str = "nearest") -> DataFrame:
    """``facts`` with ``name``: struct(distance, id) of the dimension row nearest along one axis and at most ``reach`` away,
    else null; ties go to the smaller id."""
    table = _cells(dim, dim_key, reach, by, [dim_key, dim_id])
    near = F.filter("_near", lambda d: F.abs(d[dim_key] - F.col(fact_key)) <= reach)
    best = F.array_min(F.transform(near, lambda d: F.struct(F.abs(d[dim_key] - F.col(fact_key)).alias("distance"), d[dim_id].alias("id"))))
    keyed = facts.withColumn("_cell", F.floor(F.col(fact_key) / reach))
    return keyed.join(table, [*by, "_cell"], "left").withColumn(name, best).drop("_cell", "_near")


def nearest_gantry(points: DataFrame, gantries: DataFrame, reach: int = 100) -> DataFrame:
    """``gantry_id`` of the nearest gantry of the same direction within ``reach`` metres, 0 if there is none."""
    found = nearest(points, gantries, "mileage", "mileage", "id", reach, ["direction"], "_g")
    return found.withColumn("gantry_id", F.coalesce("_g.id", F.lit(0))).drop("_g")


def nearest_road_point(points: DataFrame, road: DataFrame, reach: float = 0.01) -> DataFrame:
    """``road_seq`` of the road point with the smallest |dlat| + |dlon| (to nine decimals; ties: the first one), looked for
    within ``reach`` degrees; else null."""
    table = _cells(road, "latitude", reach, [], ["latitude", "longitude", "road_seq"])
    away = lambda d: F.abs(d["latitude"] - F.col("latitude")) + F.abs(d["longitude"] - F.col("longitude"))
    best = F.array_min(F.transform(F.filter("_near", lambda d: away(d) <= reach), lambda d: F.struct(F.round(away(d), 9).alias("l1"), d["road_seq"].alias("road_seq"))))
    keyed = points.withColumn("_cell", F.floor(F.col("latitude") / reach))
    return keyed.join(table, "_cell", "left").withColumn("_b", best).withColumns({"road_seq": F.col("_b.road_seq"), "l1": F.col("_b.l1")}).drop("_cell", "_near", "_b")


def clamped_coordinate(points: DataFrame, stakes: DataFrame) -> DataFrame:
    """Coordinate at a mileage, clamped to the table's ends; null where the table has a gap, or without mileage."""
    ends = stakes.agg(F.min("mileage"), F.max("mileage")).head()
    at = F.when(F.col("mileage").isNotNull(), F.greatest(F.lit(ends[0]), F.least(F.lit(ends[1]), F.col("mileage")))) if ends and ends[0] is not None else F.col("mileage")
    dim = stakes.select(F.col("mileage").alias("_m"), "longitude", "latitude")
    return points.withColumn("_m", at).join(dim, "_m", "left").drop("_m")


def as_of(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fields: Sequence[str], width: float, name: str, after: bool = False) -> DataFrame:
    """``facts`` with ``name``: the dimension row with the greatest key not above the fact's (or the smallest not below).

    Every cell of the dimension's range holds its own rows and the last one before it, so that one equi-join finds it.
    """
    sign = -1 if after else 1
    d = dim.select((F.col(dim_key) * sign).alias("_k"), F.struct(*fields).alias("_row"))
    own = d.groupBy(F.floor(F.col("_k") / width).alias("_cell")).agg(F.collect_list(F.struct("_k", "_row")).alias("_own"), F.max(F.struct("_k", "_row")).alias("_last"))
    span = own.agg(F.min("_cell").alias("a"), F.max("_cell").alias("b")).select(F.explode(F.sequence("a", "b")).alias("_cell"))
    carried = F.last("_last", ignorenulls=True).over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    table = span.join(own, "_cell", "left").withColumn("_before", carried).select(
        "_cell", F.array_compact(F.concat(F.coalesce("_own", F.array().cast(own.schema["_own"].dataType)), F.array("_before"))).alias("_near")
    )
    high = own.agg(F.max("_cell").alias("b"), F.max("_last").alias("top")).head()
    v = F.col(fact_key) * sign
    cell = F.floor(v / width)
    if high and high["b"] is not None:
        cell = F.least(cell, F.lit(high["b"]))
    best = F.array_max(F.filter("_near", lambda x: x["_k"] <= v))
    return facts.withColumn("_cell", cell).join(table, "_cell", "left").withColumn(name, best["_row"]).drop("_cell", "_near")


def coordinate_stake(points: DataFrame, stakes: DataFrame, width: float = 0.05, hit_m: float = 0.5) -> DataFrame:
    """``stake`` at a coordinate, stakes being in descending latitude: one within ``hit_m`` metres, else the first one
    whose latitude is below the point's."""
    fields = ["stake", "latitude", "longitude"]
    dim = stakes.select(*fields)
    p = as_of(points, dim, "latitude", "latitude", fields, width, "_below")
    p = as_of(p, dim, "latitude", "latitude", fields, width, "_above", after=True)
    far = lambda c: S.haversine_km(F.col("latitude"), F.col("longitude"), F.col(f"{c}.latitude"), F.col(f"{c}.longitude")) * 1000
    stake = F.when(far("_below") <= hit_m, F.col("_below.stake")).when(far("_above") <= hit_m, F.col("_above.stake")).otherwise(F.col("_below.stake"))
    return p.withColumn("stake", stake).drop("_below", "_above")


def closest_position(points: DataFrame, dim: DataFrame, key: str, position: str, dim_id: str, width: float) -> DataFrame:
    """``closest`` (id) by numeric position; ties go to the earlier one."""
    fields = [position, dim_id]
    p = as_of(points, dim, key, position, fields, width, "_lo")
    p = as_of(p, dim, key, position, fields, width, "_hi", after=True)
    down, up = F.col(key) - F.col(f"_lo.{position}"), F.col(f"_hi.{position}") - F.col(key)
    return p.withColumn("closest", F.when(down.isNull() | (up < down), F.col(f"_hi.{dim_id}")).otherwise(F.col(f"_lo.{dim_id}"))).drop("_lo", "_hi")


def advance_along(points: DataFrame, road: DataFrame, metres: Column) -> DataFrame:
    """``next_seq, next_stake`` of the road row 2 * ceil(metres) rows on; null past the end."""
    ahead = road.select(F.col("road_seq").alias("next_seq"), F.col("stake").alias("next_stake"))
    moved = points.withColumn("_to", (F.col("road_seq") + 2 * F.ceil(metres)).cast("long"))
    return moved.join(ahead, F.col("_to") == F.col("next_seq"), "left").drop("_to")


def checkpoint_rank(latitude: Column, checkpoints: Sequence[float]) -> Column:
    """Number of checkpoints at the latitude or north of it."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in checkpoints]), lambda c: c >= latitude))


def road_segment(mileage: Column, bounds: Sequence[int]) -> Column:
    """Index of the first upper bound not below the mileage; null beyond the last."""
    out = F.when(mileage <= bounds[0], 0)
    for k, b in enumerate(bounds[1:], 1):
        out = out.when(mileage <= b, k)
    return out


def gate_passages(points: DataFrame, gates: DataFrame, reach: int = 20, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """First point of each vehicle within ``reach`` metres of each gate of its direction: an aggregate, so that a task sends
    one point of a vehicle and gate at most."""
    found = nearest(points, gates, "mileage", "mileage", "id", reach, ["direction"], "_g").where("_g IS NOT NULL").withColumn("gate", F.col("_g.id")).drop("_g")
    rest = [c for c in found.columns if c not in ("vehicle_id", "gate")]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_p")
    return found.groupBy("vehicle_id", "gate").agg(first).select("vehicle_id", "gate", "_p.*")


def absent_vehicles(frames: DataFrame, points: DataFrame, max_gap: int) -> DataFrame:
    """(frame, vehicle) where a vehicle seen before, at most ``max_gap`` frames ago, isn't seen: each sighting offers the
    frames up to the vehicle's next one, and those that are frames at all remain."""
    nxt = F.lead("frame").over(Window.partitionBy("vehicle_id").orderBy("frame"))
    seen = points.select("vehicle_id", "frame").distinct().withColumn("_next", nxt)
    end = frames.agg(F.max("frame")).head()[0]
    last = F.least(F.coalesce(F.col("_next") - 1, F.lit(end)), F.col("frame") + max_gap)
    gaps = seen.where(last > F.col("frame")).select("vehicle_id", F.explode(F.sequence(F.col("frame") + 1, last)).alias("frame"))
    return gaps.join(frames.select("frame").distinct(), "frame", "left_semi").select("frame", "vehicle_id")


def new_vehicles(points: DataFrame, seen: DataFrame, key: str = "vehicle_id") -> DataFrame:
    return points.join(seen.select(key), key, "left_anti")


def prefer_fresh(predicted: DataFrame, observed: DataFrame, keys: Sequence[str], fresh_ms: int = 300) -> DataFrame:
    """Each prediction replaced by the last observation of the same key, if that is less than ``fresh_ms`` older or newer."""
    last = F.max(F.struct(F.col("ms").alias("_ms"), F.col("mileage").alias("_m"))).alias("_o")
    o = observed.groupBy(*keys).agg(last).select(*keys, "_o.*")
    near = F.abs(F.col("_ms") - F.col("ms")) < fresh_ms
    joined = predicted.join(o, list(keys), "left")
    return joined.withColumns({"is_observed": F.coalesce(near, F.lit(False)), "mileage": F.when(near, F.col("_m")).otherwise(F.col("mileage"))}).drop("_ms", "_m")


def with_default(facts: DataFrame, mapping: DataFrame, key: str, value: str, default: str = "unknown") -> DataFrame:
    """``value`` looked up by ``key``, ``default`` where the mapping has none."""
    return facts.join(mapping.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))
