"""Views of the given tables as vehicle observations and road dimensions, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Ends of the road in metres, and the upper bounds of its segments (each a part of ten to fifteen km).
ROAD = (1016020, 1173790)
SEGMENTS = tuple(range(1030000, 1180000, 14000))
#: Spacing of the gantries, stakes and road rows that the queries use as dimensions.
GANTRY_STEP, STAKE_STEP = 5000, 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms_of(ts: Column | str) -> Column:
    """Epoch milliseconds of a time without zone, whatever the session's zone is."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts) if isinstance(ts, str) else ts)


def as_observations(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        "event_id", "ts", F.col("user_id").alias("vehicle_id"), F.concat(F.lit("P"), F.col("user_id")).alias("plate"),
        (1016020 + 1577 * F.get_json_object("props", "$.k").cast("long")).alias("mileage"), (1 + F.col("event_id") % 2).cast("int").alias("direction"),
        (1 + F.col("event_id") % 4).cast("int").alias("lane"),
        F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 8).when(kind == "signup", 10).otherwise(0).alias("vehicle_type"),
        F.col("value").alias("speed"), (F.col("event_id") % 3).cast("int").alias("device"), "event_type",
    ).withColumns({"ms": ms_of("ts"), "stake": S.metres_to_stake(F.col("mileage"))}).withColumns({
        "frame": F.floor(F.col("ms") / 3_600_000), "section": S.section_id(F.col("stake")), "class": S.vehicle_class(F.col("vehicle_type")),
        "latitude": 30.0 + (F.col("mileage") - 1016020) / 100000.0, "longitude": 110.0 + (F.col("mileage") - 1016020) / 50000.0, "day": F.to_date("ts"),
    })


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(table(spark, sf_dir, "events"))


#: The same as a common table expression.
O = r"""o AS (SELECT *, ms // 3600000 AS frame, mileage // 10000 AS section, printf('K%d+%03d', mileage // 1000, mileage % 1000) AS stake,
  CASE WHEN vehicle_type IN (1, 2) THEN 0 WHEN vehicle_type IN (8, 10) THEN 1 ELSE -1 END AS class,
  30.0::DOUBLE + (mileage - 1016020) / 100000.0::DOUBLE AS latitude, 110.0::DOUBLE + (mileage - 1016020) / 50000.0::DOUBLE AS longitude, CAST(ts AS DATE) AS day
  FROM (SELECT event_id, ts, user_id AS vehicle_id, 'P' || user_id AS plate, 1016020 + 1577 * CAST(regexp_extract(props, '"k": *(\d+)', 1) AS BIGINT) AS mileage,
    1 + event_id % 2 AS direction, 1 + event_id % 4 AS lane,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 8 WHEN 'signup' THEN 10 ELSE 0 END AS vehicle_type,
    value AS speed, event_id % 3 AS device, event_type, epoch_us(ts) // 1000 AS ms FROM events))"""


def gantries(spark: SparkSession) -> DataFrame:
    """A gantry every GANTRY_STEP metres; odd ids for direction 1, even ones for 2."""
    n = (ROAD[1] - ROAD[0]) // GANTRY_STEP
    return spark.range(1, n + 1).select("id", (ROAD[0] + F.col("id") * GANTRY_STEP).alias("mileage"), (2 - F.col("id") % 2).cast("int").alias("direction"))


GANTRIES = f"g AS (SELECT id, {ROAD[0]} + id * {GANTRY_STEP} AS mileage, 2 - id % 2 AS direction FROM range(1, {(ROAD[1] - ROAD[0]) // GANTRY_STEP + 1}) t(id))"


def road(spark: SparkSession) -> DataFrame:
    """A road row every STAKE_STEP metres with sequence, stake and coordinate."""
    n = (ROAD[1] - ROAD[0]) // STAKE_STEP
    return spark.range(0, n + 1).select(
        F.col("id").alias("road_seq"), (ROAD[0] + F.col("id") * STAKE_STEP).alias("mileage")
    ).withColumns({
        "stake": S.metres_to_stake(F.col("mileage")), "latitude": 30.0 + (F.col("mileage") - 1016020) / 100000.0, "longitude": 110.0 + (F.col("mileage") - 1016020) / 50000.0,
    })


ROADS = f"""d AS (SELECT road_seq, mileage, printf('K%d+%03d', mileage // 1000, mileage % 1000) AS stake, 30.0::DOUBLE + (mileage - 1016020) / 100000.0::DOUBLE AS latitude,
  110.0::DOUBLE + (mileage - 1016020) / 50000.0::DOUBLE AS longitude FROM (SELECT id AS road_seq, {ROAD[0]} + id * {STAKE_STEP} AS mileage FROM range(0, {(ROAD[1] - ROAD[0]) // STAKE_STEP + 1}) t(id)))"""


#: Rows of the ramps' tables, two a metre.
RAMPS = {"AK": 4161, "BK": 4309, "CK": 779, "DK": 732}


def road_network(spark: SparkSession) -> DataFrame:
    """The mainline (K) and four ramps of different length: ``road, road_seq, mileage, longitude, latitude``."""
    main = road(spark).select(F.lit("K").alias("road"), "road_seq", "mileage", "longitude", "latitude")
    for k, (name, rows) in enumerate(RAMPS.items(), 1):
        seq = F.col("id")
        ramp = spark.range(rows).select(F.lit(name).alias("road"), seq.alias("road_seq"), F.floor(seq / 2).alias("mileage"), (110.0 + k + seq / 100000.0).alias("longitude"), (30.0 + (seq * (seq % 7 + k)) / 1000000.0).alias("latitude"))
        main = main.unionByName(ramp)
    return main


NETWORK = f"""{ROADS}, net AS (SELECT 'K' AS road, road_seq, mileage, longitude, latitude FROM d UNION ALL
  SELECT road, id, id // 2, 110.0::DOUBLE + k + id / 100000.0::DOUBLE, 30.0::DOUBLE + (id * (id % 7 + k)) / 1000000.0::DOUBLE FROM
    (SELECT road, k, unnest(range(0, n)) AS id FROM (VALUES {", ".join(f"('{r}', {k}, {n})" for k, (r, n) in enumerate(RAMPS.items(), 1))}) v(road, k, n)))"""


def on_roads(o: DataFrame) -> DataFrame:
    """Observations dealt to the roads by id, with a mileage of theirs and the coordinate of the row there."""
    code, rows = F.element_at(F.array(*[F.lit(r) for r in ("K", *RAMPS)]), (F.col("event_id") % 5 + 1).cast("int")), F.element_at(F.array(F.lit(0), *[F.lit(n) for n in RAMPS.values()]), (F.col("event_id") % 5 + 1).cast("int"))
    return o.withColumn("road", code).withColumn("mileage", F.when(F.col("road") == "K", F.col("mileage")).otherwise((F.col("mileage") - ROAD[0]) % F.floor(rows / 2)))
