"""The operators as queries over the given tables, each with the same query as SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import completion as dead
from ..operators import flow, fusion, lookup
from ..operators import trajectory as trj
from ..operators.roads import Roads
from ..sources import decode, sinks
from ..streaming import jobs, keyed, ticks
from ..streaming.ordered import SPREAD, arrivals
from .adapter import GANTRIES, NETWORK, RAMPS, ROAD, ROADS, SEGMENTS, O, gantries, ms_of, observations, on_roads, road, road_network, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
CHECKPOINTS = (30.2, 30.5, 30.9, 31.3)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def text(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def t(sql: str) -> str:
    return f"strftime({sql}, '%Y-%m-%d %H:%M:%S')"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.section_changes(observations(spark, sf_dir).where("class <> -1 AND section <> -1"))


C = f"""{O}, c AS (SELECT *, date_trunc('hour', ts) AS hour FROM o WHERE class <> -1 AND section <> -1
  QUALIFY section IS DISTINCT FROM lag(section) OVER (PARTITION BY vehicle_id, date_trunc('hour', ts) ORDER BY ts, event_id))"""
FLOW = """count(*) FILTER (direction = 1 AND class = 0) AS up_bus, count(*) FILTER (direction = 1 AND class = 1) AS up_truck,
  count(*) FILTER (direction = 2 AND class = 0) AS down_bus, count(*) FILTER (direction = 2 AND class = 1) AS down_truck,
  round(coalesce(avg(speed) FILTER (direction = 1), 0), 6) AS up_speed, round(coalesce(avg(speed) FILTER (direction = 2), 0), 6) AS down_speed"""


@query(f"WITH {C} SELECT {t('hour')} AS hour, section, {FLOW} FROM c GROUP BY ALL")
def hourly_section_flow(spark, sf_dir):
    """Flow by hour and section: classes, section changes, counts and mean speeds."""
    f = flow.hourly_section_flow(changes(spark, sf_dir))
    return f.select(text("hour").alias("hour"), F.col("section").cast("long"), "up_bus", "up_truck", "down_bus", "down_truck", F.round("up_speed", 6).alias("up_speed"), F.round("down_speed", 6).alias("down_speed"))


@query(f"WITH {C} SELECT event_id, vehicle_id, section FROM c")
def section_change_dedup(spark, sf_dir):
    return changes(spark, sf_dir).select("event_id", "vehicle_id", F.col("section").cast("long"))


@query(f"WITH {O} SELECT date_trunc('hour', ts)::VARCHAR AS hour, count(DISTINCT (vehicle_id, section)) AS n FROM o WHERE class <> -1 GROUP BY 1")
def section_once_an_hour(spark, sf_dir):
    c = flow.section_changes(observations(spark, sf_dir).where("class <> -1"), distinct=True)
    return c.groupBy(text("hour").alias("hour")).agg(F.count("*").alias("n"))


@query(f"WITH {O} SELECT class, count(*) AS n, min(vehicle_type)::BIGINT AS low, max(vehicle_type)::BIGINT AS high FROM o GROUP BY class")
def vehicle_class(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("class").agg(F.count("*").alias("n"), F.min("vehicle_type").cast("long").alias("low"), F.max("vehicle_type").cast("long").alias("high"))


RAMPED = "CASE device WHEN 0 THEN 'A' || stake WHEN 1 THEN stake ELSE '' END"


def ramped(o: DataFrame) -> DataFrame:
    return o.withColumn("stake", F.when(F.col("device") == 0, F.concat(F.lit("A"), F.col("stake"))).when(F.col("device") == 1, F.col("stake")).otherwise(F.lit("")))


@query(f"WITH {O} SELECT event_id, stake FROM (SELECT event_id, {RAMPED} AS stake FROM o) WHERE stake <> '' AND NOT regexp_matches(stake, '^[ABCD]')")
def mainline_filter(spark, sf_dir):
    return ramped(observations(spark, sf_dir)).where(S.is_mainline(F.col("stake"))).select("event_id", "stake")


@query(f"WITH {O} SELECT regexp_extract({RAMPED}, '^([A-D]?K)', 1) AS road, count(*) AS n FROM o GROUP BY 1")
def road_codes(spark, sf_dir):
    return ramped(observations(spark, sf_dir)).groupBy(S.road_code(F.col("stake")).alias("road")).agg(F.count("*").alias("n"))


@query(f"WITH {O} SELECT device, CASE WHEN {RAMPED} LIKE 'K%' THEN section ELSE -1 END AS section, count(*) AS n FROM o GROUP BY ALL")
def stake_sections(spark, sf_dir):
    """Sections of stakes; ramps and empty stakes are -1."""
    o = ramped(observations(spark, sf_dir)).withColumn("section", S.section_id(F.col("stake")).cast("long"))
    return o.groupBy(F.col("device").cast("long"), "section").agg(F.count("*").alias("n"))


@query(f"WITH {O} SELECT event_id, stake, regexp_extract(stake, '^K(\\d+)', 1)::BIGINT * 1000 + regexp_extract(stake, '(\\d+)$', 1)::BIGINT AS metres, mileage = regexp_extract(stake, '^K(\\d+)', 1)::BIGINT * 1000 + regexp_extract(stake, '(\\d+)$', 1)::BIGINT AS same FROM o")
def stake_conversion(spark, sf_dir):
    o = observations(spark, sf_dir).withColumn("metres", S.stake_to_metres(F.col("stake")))
    return o.select("event_id", "stake", "metres", (F.col("metres") == F.col("mileage")).alias("same"))


SEGMENT = "CASE " + " ".join(f"WHEN mileage <= {b} THEN {k}" for k, b in enumerate(SEGMENTS)) + " ELSE -1 END"


@query(f"WITH {O} SELECT {SEGMENT} AS segment, count(*) AS n, min(mileage) AS low, max(mileage) AS high FROM o WHERE mileage BETWEEN 1016020 AND 1173790 AND mileage NOT BETWEEN 1050000 AND 1055000 GROUP BY 1")
def segment_route(spark, sf_dir):
    """Points within the road's bounds and off the bridge, by road segment."""
    o = observations(spark, sf_dir).where(F.col("mileage").between(1016020, 1173790) & ~F.col("mileage").between(1050000, 1055000))
    return o.groupBy(F.coalesce(lookup.road_segment(F.col("mileage"), SEGMENTS), F.lit(-1)).alias("segment")).agg(F.count("*").alias("n"), F.min("mileage").alias("low"), F.max("mileage").alias("high"))


@query(f"WITH {O} SELECT (hour(ts) BETWEEN 7 AND 8 OR hour(ts) BETWEEN 17 AND 18) AS peak, event_type <> 'error' AS special, count(*) AS n FROM o GROUP BY ALL")
def peak_and_special(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.groupBy(S.is_peak_hour(F.col("ts")).alias("peak"), (F.col("event_type") != "error").alias("special")).agg(F.count("*").alias("n"))


@query(f"WITH {O} SELECT event_id, CASE WHEN direction = 1 AND mileage BETWEEN 1055000 AND 1065000 THEN 'CK' WHEN direction = 2 AND mileage BETWEEN 1100000 AND 1110000 THEN 'AK' END AS ramp FROM o WHERE (direction = 1 AND mileage BETWEEN 1055000 AND 1065000) OR (direction = 2 AND mileage BETWEEN 1100000 AND 1110000)")
def ramp_exit_zones(spark, sf_dir):
    """Points in the exit zones of a zone table."""
    zones = spark.createDataFrame([(1, 1055000, 1065000, "CK"), (2, 1100000, 1110000, "AK")], "zone_dir int, low long, high long, ramp string")
    o = observations(spark, sf_dir)
    return o.join(F.broadcast(zones), (F.col("direction") == F.col("zone_dir")) & F.col("mileage").between(F.col("low"), F.col("high"))).select("event_id", "ramp")


@query(f"WITH {O} SELECT event_id, plate || ' 预测值' AS marked, plate AS unmarked FROM o")
def predicted_plates(spark, sf_dir):
    o = observations(spark, sf_dir).withColumn("marked", S.mark_predicted(F.col("plate")))
    return o.select("event_id", "marked", S.unmark_predicted(F.col("marked")).alias("unmarked"))


@query(f"WITH {O} SELECT event_id, upper(event_type) AS upper, split_part(stake || '-A' || stake, '-', 2) AS ramp, direction FROM o WHERE event_id <> 0 AND stake IS NOT NULL AND ts IS NOT NULL")
def cleaned_points(spark, sf_dir):
    """Placeholders and incomplete rows dropped, compound stakes split, names in upper case."""
    o = observations(spark, sf_dir).where("event_id <> 0").dropna(subset=["stake", "ts"])
    compound = F.concat(F.col("stake"), F.lit("-A"), F.col("stake"))
    return o.select("event_id", F.upper("event_type").alias("upper"), F.split(compound, "-")[1].alias("ramp"), F.col("direction").cast("long"))


@query(f"WITH {O} SELECT {t('day')} AS day, count(*) FILTER (direction = 1) AS up, count(*) FILTER (direction = 2) AS down FROM o GROUP BY 1")
def daily_direction(spark, sf_dir):
    return flow.daily_directions(observations(spark, sf_dir)).select(text("day").alias("day"), "up", "down")


GAP = "6 * 3600"
SESSIONS = f"""{O}, n AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w > {GAP} * 1000000::BIGINT OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM o WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY vehicle_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM n)"""
SUMMARY = f"""{SESSIONS}, z AS (SELECT vehicle_id, session, min(ts) AS start_ts, max(ts) AS last_ts, arg_min(plate, event_id) AS plate, arg_min(vehicle_type, (ts, event_id)) AS type, count(*) AS points FROM s GROUP BY ALL)"""


@query(f"WITH {SESSIONS} SELECT event_id, session FROM s")
def sessions(spark, sf_dir):
    return trj.sessions(observations(spark, sf_dir), 6 * 3600).select("event_id", F.col("session").cast("long"))


@query(f"WITH {SUMMARY} SELECT vehicle_id, session, (epoch_us(start_ts) // 1000) || '-' || plate || '-' || vehicle_id AS key, type::BIGINT AS type, points, last_ts = max(last_ts) OVER (PARTITION BY vehicle_id) AS is_open FROM z")
def session_summary(spark, sf_dir):
    s = trj.session_summaries(observations(spark, sf_dir), 6 * 3600)
    key = S.trajectory_key(ms_of("start_ts"), F.col("plate"), F.col("vehicle_id"))
    return s.select("vehicle_id", F.col("session").cast("long"), key.alias("key"), F.col("type").cast("long"), "points", "is_open")


@query(f"""WITH RECURSIVE {SESSIONS}, a AS (SELECT vehicle_id, session, epoch_us(ts) / 1000000.0::DOUBLE AS x, row_number() OVER (PARTITION BY vehicle_id, session ORDER BY ts, event_id) AS i FROM s),
  k(vehicle_id, session, i, last, kept) AS (SELECT vehicle_id, session, i, x, 1 FROM a WHERE i = 1 UNION ALL
    SELECT a.vehicle_id, a.session, a.i, CASE WHEN a.x - k.last >= 3600 THEN a.x ELSE k.last END, k.kept + CASE WHEN a.x - k.last >= 3600 THEN 1 ELSE 0 END
    FROM k JOIN a ON a.vehicle_id = k.vehicle_id AND a.session = k.session AND a.i = k.i + 1)
  SELECT vehicle_id, session, max(kept)::BIGINT AS kept, max(i)::BIGINT AS points FROM k GROUP BY ALL""")
def session_sampled(spark, sf_dir):
    """Greedy down-sampling of each session to points an hour apart."""
    o = observations(spark, sf_dir)
    return trj.session_samples(o, 6 * 3600, 3600).select("vehicle_id", F.col("session").cast("long"), F.col("kept").cast("long"), F.col("points").cast("long"))


@query(f"WITH {SUMMARY} SELECT {t('date_trunc(' + chr(39) + 'hour' + chr(39) + ', start_ts)')} AS hour, count(*) AS n FROM z GROUP BY 1")
def hourly_start_count(spark, sf_dir):
    s = trj.session_summaries(observations(spark, sf_dir), 6 * 3600)
    return s.groupBy(text(F.date_trunc("hour", "start_ts")).alias("hour")).agg(F.count("*").alias("n"))


def _rollup(unit: str) -> str:
    return f"""WITH {O}, b AS (SELECT date_trunc('{unit}', min(ts)) - INTERVAL 1 DAY AS a, date_trunc('{unit}', max(ts)) AS z FROM o),
  c AS (SELECT unnest(generate_series(a, z, INTERVAL 1 {unit})) AS slot FROM b), n AS (SELECT date_trunc('{unit}', ts) AS slot, sum(lane) AS total FROM o GROUP BY 1)
  SELECT {t('slot')} AS slot, coalesce(total, 0)::BIGINT AS total FROM c LEFT JOIN n USING (slot)"""


def _zero_filled(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    o = observations(spark, sf_dir)
    ends = o.agg(F.min("ts"), F.max("ts")).head()
    start, end = (F.lit(str(v)).cast("timestamp_ntz") for v in ends)
    return flow.zero_filled(o, unit, "lane", F.date_trunc(unit, start) - F.expr("INTERVAL 1 DAY"), end).select(text("slot").alias("slot"), "total")


@query(_rollup("hour"))
def rollup_hour_zero(spark, sf_dir):
    """Minute counts rolled up to hours, hours without rows as 0, from a day before the first row."""
    return _zero_filled(spark, sf_dir, "hour")


@query(_rollup("day"))
def rollup_day_zero(spark, sf_dir):
    return _zero_filled(spark, sf_dir, "day")


@query(f"WITH {O} SELECT {t('date_trunc(' + chr(39) + 'minute' + chr(39) + ', ts)')} AS minute, mileage // 1000 AS km, string_agg(DISTINCT plate, ',' ORDER BY plate) AS plates FROM o GROUP BY ALL")
def minute_km_plates(spark, sf_dir):
    return flow.minute_km_plates(observations(spark, sf_dir)).select(text("minute").alias("minute"), "km", "plates")


SEG = f"""{O}, v AS (SELECT date_trunc('minute', ts) AS minute, mileage // 1000 AS km, vehicle_id, sum(speed) AS speed_sum, count(*) AS points, arg_min(plate, (ts, event_id)) AS plate,
  arg_min(direction, (ts, event_id)) AS direction, arg_min(lane, (ts, event_id)) AS lane, arg_min(vehicle_type, (ts, event_id)) AS vehicle_type FROM o GROUP BY ALL)"""


@query(f"WITH {SEG} SELECT {t('minute')} AS minute, km, vehicle_id, round(speed_sum, 6) AS speed_sum, points, plate, direction::BIGINT AS direction, lane::BIGINT AS lane FROM v")
def vehicle_minute_segment(spark, sf_dir):
    v = flow.vehicle_minute_segments(observations(spark, sf_dir))
    return v.select(text("minute").alias("minute"), "km", "vehicle_id", F.round("speed_sum", 6).alias("speed_sum"), "points", "plate", F.col("direction").cast("long"), F.col("lane").cast("long"))


@query(f"WITH {SEG} SELECT {t('minute')} AS minute, km, string_agg(vehicle_id::VARCHAR, ',' ORDER BY vehicle_id) AS vehicles, count(*) AS n FROM v GROUP BY ALL")
def minute_segment_lists(spark, sf_dir):
    v = flow.minute_segment_lists(flow.vehicle_minute_segments(observations(spark, sf_dir)))
    ids = F.array_join(F.transform("vehicles", lambda x: x["vehicle_id"].cast("string")), ",")
    return v.select(text("minute").alias("minute"), "km", ids.alias("vehicles"), F.size("vehicles").cast("long").alias("n"))


@query(f"""WITH {SEG}, k AS (SELECT *, CASE WHEN vehicle_type IN (1, 2) THEN 0 WHEN vehicle_type IN (8, 10) THEN 1 ELSE -1 END AS c FROM v)
  SELECT {t('minute')} AS minute, km, direction::BIGINT AS direction, round(sum(speed_sum) / sum(points), 6) AS avg_speed, count(*) AS density, count(*) FILTER (c = 0) AS buses, count(*) FILTER (c = 1) AS trucks,
  round(coalesce(avg(speed_sum / points) FILTER (c = 0), 0), 6) AS bus_speed, round(coalesce(avg(speed_sum / points) FILTER (c = 1), 0), 6) AS truck_speed,
  count(*) FILTER (lane = 1) AS lane1, count(*) FILTER (lane = 2) AS lane2, count(*) FILTER (lane = 3) AS lane3, count(*) FILTER (lane = 4) AS lane4 FROM k GROUP BY ALL""")
def segment_status(spark, sf_dir):
    s = flow.segment_status(flow.vehicle_minute_segments(observations(spark, sf_dir)), S.vehicle_class(F.col("vehicle_type")))
    r = {c: F.round(c, 6) for c in ("avg_speed", "bus_speed", "truck_speed")}
    return s.withColumns({**r, "minute": text("minute"), "direction": F.col("direction").cast("long")})


@query(f"""WITH {O}, f AS (SELECT vehicle_id, min(ts) AS ts, arg_min(lane, (ts, event_id)) AS lane FROM o WHERE device = 1 GROUP BY 1)
  SELECT {t('date_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)')} AS hour, count(*) FILTER (lane % 2 = 1) AS up, count(*) FILTER (lane % 2 = 0) AS down FROM f GROUP BY 1""")
def station_updown(spark, sf_dir):
    return flow.station_up_down(observations(spark, sf_dir), F.col("device") == 1).select(text("hour").alias("hour"), "up", "down")


SLOT = "ms - (ms - 1704067200000) % 7200000"


@query(f"WITH {O} SELECT {SLOT} AS slot, device, string_agg(DISTINCT plate, ',' ORDER BY plate) AS plates, count(DISTINCT plate) AS n FROM o GROUP BY ALL")
def slot_device_set(spark, sf_dir):
    s = flow.slot_device_plates(observations(spark, sf_dir), S.slot_start(F.col("ms"), 1704067200000, 7200000))
    return s.withColumn("device", F.col("device").cast("long"))


@query(f"""WITH {O}, p AS (SELECT *, {SLOT} AS slot FROM o QUALIFY frame = min(frame) OVER (PARTITION BY {SLOT}, device))
  SELECT slot, device, string_agg(DISTINCT plate, ',' ORDER BY plate) AS plates, count(DISTINCT plate) AS n FROM p GROUP BY ALL""")
def slot_first_frame(spark, sf_dir):
    s = flow.slot_device_plates(observations(spark, sf_dir), S.slot_start(F.col("ms"), 1704067200000, 7200000), first_frame_only=True)
    return s.withColumn("device", F.col("device").cast("long"))


@query(f"WITH {O} SELECT {t('time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP ' + chr(39) + '2024-01-01 00:05:00' + chr(39) + ')')} AS slot, count(DISTINCT vehicle_id) AS vehicles FROM o GROUP BY 1")
def slot_unique(spark, sf_dir):
    return flow.slot_unique(observations(spark, sf_dir), "15 minutes", "5 minutes").select(text("slot").alias("slot"), "vehicles")


@query(f"""WITH {O}, v AS (SELECT vehicle_id, 'P' || (vehicle_id + event_id % 3) AS plate, count(*) AS votes, min((ts, event_id)) AS first FROM o GROUP BY 1, 2)
  SELECT vehicle_id, plate, votes, votes >= 10 AS settled FROM v QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY votes DESC, first) = 1""")
def plate_vote(spark, sf_dir):
    """Plates by vote, where reads of a vehicle differ."""
    o = observations(spark, sf_dir).withColumn("plate", F.concat(F.lit("P"), F.col("vehicle_id") + F.col("event_id") % 3))
    return flow.plate_votes(o)


@query(f"""WITH {O}, r AS (SELECT event_id, vehicle_id, ts, 'P' || (vehicle_id + event_id % 3) AS plate FROM o),
  v AS (SELECT vehicle_id, plate, count(*) AS votes, min((ts, event_id)) AS first FROM r GROUP BY 1, 2), b AS (SELECT vehicle_id, plate FROM v QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY votes DESC, first) = 1)
  SELECT event_id, b.plate FROM r JOIN b USING (vehicle_id)""")
def plate_carry_over(spark, sf_dir):
    o = observations(spark, sf_dir).withColumn("plate", F.concat(F.lit("P"), F.col("vehicle_id") + F.col("event_id") % 3))
    return flow.carried_plates(flow.plate_votes(o), o).select("event_id", "plate")


@query(f"WITH {O} SELECT plate, arg_max(mileage, (ts, event_id)) AS mileage, arg_max(vehicle_type, (ts, event_id))::BIGINT AS vehicle_type, max(event_id) FILTER (true) AS newest FROM o GROUP BY plate")
def latest_features(spark, sf_dir):
    o = observations(spark, sf_dir)
    f = flow.latest_features(o, "plate", ["mileage", "vehicle_type"])
    return f.join(o.groupBy("plate").agg(F.max("event_id").alias("newest")), "plate").withColumn("vehicle_type", F.col("vehicle_type").cast("long"))


@query(f"WITH {O} SELECT device, round(min(longitude), 6) AS min_x, round(max(longitude), 6) AS max_x, round(min(latitude), 6) AS min_y, round(max(latitude), 6) AS max_y FROM o GROUP BY device")
def bounding_box(spark, sf_dir):
    b = flow.bounding_boxes(observations(spark, sf_dir), "device", "longitude", "latitude")
    return b.select(F.col("device").cast("long"), *[F.round(c, 6).alias(c) for c in ("min_x", "max_x", "min_y", "max_y")])


@query(f"""WITH {O}, b AS (SELECT vehicle_id, mileage, lag(mileage) OVER (PARTITION BY vehicle_id ORDER BY ts, event_id) AS p FROM o)
  SELECT vehicle_id, CASE WHEN bool_and(mileage >= p) THEN 'INCREASING' WHEN bool_and(mileage <= p) THEN 'DECREASING' ELSE 'NOT_MONOTONIC' END AS trend FROM b GROUP BY 1""")
def monotonic(spark, sf_dir):
    return flow.monotonicity(observations(spark, sf_dir), "vehicle_id", "mileage", ["ts", "event_id"])


@query(f"WITH {O}, f AS (SELECT frame, count(*) AS n FROM o GROUP BY 1) SELECT frame, n, (coalesce(sum(n) OVER (ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 500)::BIGINT AS pack FROM f")
def pack_frames(spark, sf_dir):
    f = observations(spark, sf_dir).groupBy("frame").agg(F.count("*").alias("n"))
    return flow.packed_frames(f, 500, F.floor(F.col("frame") / 24))


@query(f"WITH {O} SELECT event_id, row_number() OVER (PARTITION BY day ORDER BY ts, event_id) + 9999 AS new_id, lpad((row_number() OVER (PARTITION BY day ORDER BY ts, event_id) + 9999)::VARCHAR, 7, '0') AS new_plate FROM o")
def renumbered_points(spark, sf_dir):
    return flow.renumbered(observations(spark, sf_dir), "day", F.col("frame"), ["ts", "event_id"]).select("event_id", F.col("new_id").cast("long"), "new_plate")


@query(f"""WITH {O}, f AS (SELECT day, count(*) AS n FROM o GROUP BY 1), w AS (SELECT day, n, CASE WHEN n <= 1000 THEN greatest(50, n // 2) WHEN n <= 5000 THEN 300 WHEN n <= 10000 THEN 500 ELSE 1000 END AS w FROM f),
  c AS (SELECT day, n, w, unnest(range(0, CAST(ceil(n / w::DOUBLE) AS BIGINT))) AS chunk FROM w) SELECT {t('day')} AS day, chunk, least(w, n - chunk * w)::BIGINT AS points FROM c""")
def chunk_frames(spark, sf_dir):
    return flow.chunked(observations(spark, sf_dir), "day", F.col("frame"), ["ts", "event_id"], "event_id").select(text("day").alias("day"), F.col("chunk").cast("long"), F.size("items").cast("long").alias("points"))


@query(r"""SELECT word, count(*) AS "count" FROM (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM documents) GROUP BY word""")
def word_count(spark, sf_dir):
    return flow.word_counts(table(spark, sf_dir, "documents"))


@query(f"WITH {O} SELECT event_id, round(avg(speed) OVER (PARTITION BY vehicle_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS mean_speed FROM o")
def moving_avg_speed(spark, sf_dir):
    return trj.moving_speed(observations(spark, sf_dir)).select("event_id", F.round("mean_speed", 6).alias("mean_speed"))


@query(f"WITH {O} SELECT event_id, coalesce(ms - lag(ms) OVER (PARTITION BY device ORDER BY ts, event_id), -1) AS gap_ms FROM o")
def msg_gap(spark, sf_dir):
    return trj.message_gaps(observations(spark, sf_dir), "device").select("event_id", F.coalesce(F.col("gap_ms"), F.lit(-1)).alias("gap_ms"))


@query(f"WITH {O}, b AS (SELECT event_id, lag(event_id) OVER (PARTITION BY device ORDER BY ts, event_id) AS before FROM o) SELECT event_id, before FROM b WHERE event_id <> before + 1")
def seq_gap(spark, sf_dir):
    return trj.sequence_gaps(observations(spark, sf_dir), "device", "event_id").select("event_id", "before")


@query(f"""WITH {O}, r AS (SELECT frame, row_number() OVER (ORDER BY frame) AS rank FROM (SELECT DISTINCT frame FROM o)), s AS (SELECT DISTINCT vehicle_id, frame FROM o)
  SELECT vehicle_id, frame, coalesce(rank - lag(rank) OVER (PARTITION BY vehicle_id ORDER BY rank) - 1, -1) AS missed FROM s JOIN r USING (frame)""")
def missed_frames(spark, sf_dir):
    o = observations(spark, sf_dir)
    return trj.missed_frames(o, o).select("vehicle_id", "frame", F.coalesce(F.col("missed"), F.lit(-1)).cast("long").alias("missed"))


@query(f"""WITH {O}, h AS (SELECT event_id, lead(mileage) OVER (PARTITION BY frame, lane, direction ORDER BY mileage, event_id) - mileage AS ahead FROM o) SELECT event_id, ahead FROM h WHERE ahead < 10""")
def headway(spark, sf_dir):
    return trj.headway(observations(spark, sf_dir)).select("event_id", "ahead")


@query(f"""WITH {O}, q AS (SELECT event_id, radians(lag(latitude) OVER w) AS a, radians(latitude) AS b, radians(longitude - lag(longitude) OVER w) AS d FROM o WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id)),
  y AS (SELECT event_id, degrees(atan2(sin(d) * cos(b), cos(a) * sin(b) - sin(a) * cos(b) * cos(d))) AS h FROM q) SELECT event_id, round(CASE WHEN h < 0 THEN h + 360 ELSE h END, 6) AS heading FROM y""")
def heading(spark, sf_dir):
    return trj.headings(observations(spark, sf_dir)).select("event_id", F.round("heading", 6).alias("heading"))


@query(f"""WITH {O}, {GANTRIES}, c AS (SELECT event_id, vehicle_id, ts, g.id AS gate, row_number() OVER (PARTITION BY event_id ORDER BY abs(o.mileage - g.mileage), g.id) AS k FROM o JOIN g ON o.direction = g.direction AND abs(o.mileage - g.mileage) <= 400)
  SELECT event_id, vehicle_id, gate FROM c WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY vehicle_id, gate ORDER BY ts, event_id) = 1""")
def gate_passage(spark, sf_dir):
    return lookup.gate_passages(observations(spark, sf_dir), gantries(spark), reach=400).select("event_id", "vehicle_id", "gate")


@query(f"""WITH {O}, {GANTRIES}, c AS (SELECT event_id, arg_min(g.id, (abs(o.mileage - g.mileage), g.id)) AS id FROM o JOIN g ON o.direction = g.direction AND abs(o.mileage - g.mileage) <= 600 GROUP BY 1)
  SELECT event_id, coalesce(id, 0) AS gantry_id FROM o LEFT JOIN c USING (event_id)""")
def nearest_gantry(spark, sf_dir):
    return lookup.nearest_gantry(observations(spark, sf_dir), gantries(spark), reach=600).select("event_id", "gantry_id")


def _moved(o: DataFrame) -> DataFrame:
    """Points a little off the road."""
    return o.withColumns({"latitude": F.col("latitude") + (F.col("event_id") % 7) / 10000.0, "longitude": F.col("longitude") - (F.col("event_id") % 5) / 10000.0})


MOVED = "m AS (SELECT event_id, latitude + (event_id % 7) / 10000.0::DOUBLE AS latitude, longitude - (event_id % 5) / 10000.0::DOUBLE AS longitude FROM o)"


@query(f"""WITH {O}, {ROADS}, {MOVED} SELECT event_id, round(min(abs(m.latitude - d.latitude) + abs(m.longitude - d.longitude)), 6) AS l1, arg_min(d.road_seq, (round(abs(m.latitude - d.latitude) + abs(m.longitude - d.longitude), 9), d.road_seq)) AS road_seq FROM m JOIN d ON abs(m.latitude - d.latitude) <= 0.01 AND abs(m.longitude - d.longitude) <= 0.01
  GROUP BY event_id HAVING min(abs(m.latitude - d.latitude) + abs(m.longitude - d.longitude)) <= 0.01""")
def nearest_road_point(spark, sf_dir):
    n = lookup.nearest_road_point(_moved(observations(spark, sf_dir)), road(spark)).where("road_seq IS NOT NULL")
    return n.select("event_id", F.round("l1", 6).alias("l1"), "road_seq")


@query(f"""WITH {O}, {ROADS}, e AS (SELECT min(mileage) AS a, max(mileage) AS z FROM d), p AS (SELECT event_id, mileage - 3000 + (event_id % 60) * 20 AS mileage FROM o)
  SELECT event_id, round(d.longitude, 6) AS longitude, round(d.latitude, 6) AS latitude FROM p, e LEFT JOIN d ON d.mileage = greatest(e.a, least(e.z, p.mileage))""")
def clamp_lookup(spark, sf_dir):
    p = observations(spark, sf_dir).select("event_id", (F.col("mileage") - 3000 + (F.col("event_id") % 60) * 20).alias("mileage"))
    return lookup.clamped_coordinate(p, road(spark)).select("event_id", F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude"))


@query(f"""WITH {O}, {ROADS}, p AS (SELECT event_id, mileage FROM o), lo AS (SELECT event_id, p.mileage AS m, d.mileage AS a, d.road_seq AS sa FROM p ASOF LEFT JOIN d ON p.mileage >= d.mileage),
  hi AS (SELECT lo.*, d.mileage AS z, d.road_seq AS sz FROM lo ASOF LEFT JOIN d ON lo.m <= d.mileage) SELECT event_id, CASE WHEN a IS NULL OR z - m < m - a THEN sz ELSE sa END AS closest FROM hi""")
def closest_position(spark, sf_dir):
    return lookup.closest_position(observations(spark, sf_dir), road(spark), "mileage", "mileage", "road_seq", 1000).select("event_id", "closest")


@query(f"""WITH {O}, {ROADS}, p AS (SELECT event_id, latitude FROM o) SELECT event_id, d.stake FROM p ASOF LEFT JOIN d ON p.latitude + 1e-9 >= d.latitude""")
def coordinate_stake(spark, sf_dir):
    """Stake at the point's latitude or the next one south of it (a stake within half a metre is hit)."""
    p = observations(spark, sf_dir).withColumn("latitude", F.col("latitude") + 1e-9)
    return lookup.coordinate_stake(p, road(spark)).select("event_id", "stake")


@query(f"""WITH {O}, {ROADS}, p AS (SELECT event_id, (mileage - 1016020) // 100 AS road_seq, speed FROM o) SELECT event_id, d.stake AS next_stake FROM p LEFT JOIN d ON d.road_seq = p.road_seq + 2 * ceil(p.speed * 200 / 3600.0::DOUBLE)::BIGINT""")
def advance_road(spark, sf_dir):
    p = observations(spark, sf_dir).select("event_id", F.floor((F.col("mileage") - 1016020) / 100).alias("road_seq"), "speed")
    return lookup.advance_along(p, road(spark), S.travelled_metres(F.col("speed"), 200)).select("event_id", "next_stake")


@query(f"WITH {O} SELECT event_id, {' + '.join(f'(latitude <= {c})::INT' for c in CHECKPOINTS)} AS rank FROM o")
def checkpoint_rank(spark, sf_dir):
    return observations(spark, sf_dir).select("event_id", lookup.checkpoint_rank(F.col("latitude"), CHECKPOINTS).alias("rank"))


@query(f"""WITH {O}, f AS (SELECT ms // 600000 AS slot, device, list(event_id ORDER BY event_id) AS l FROM o GROUP BY ALL) SELECT a.slot, len(a.l) + len(b.l) AS points, list_min(a.l) AS first FROM f a JOIN f b ON a.slot = b.slot AND a.device = 0 AND b.device = 1""")
def sensor_merge(spark, sf_dir):
    """Frames (ten minutes) of two sensors at the same time, put together."""
    f = observations(spark, sf_dir).groupBy(F.floor(F.col("ms") / 600_000).alias("slot"), "device").agg(F.sort_array(F.collect_list("event_id")).alias("points"))
    m = fusion.merged_sensors(f.where("device = 0").drop("device"), f.where("device = 1").drop("device"), "slot", "points")
    return m.select("slot", F.size("points").cast("long").alias("points"), F.col("points")[0].alias("first"))


@query(f"WITH {O} SELECT event_id, ms - (ms - 37) % 200 AS aligned FROM o")
def phase_align(spark, sf_dir):
    return observations(spark, sf_dir).select("event_id", fusion.aligned(F.col("ms"), 37).alias("aligned"))


def _reads(o: DataFrame) -> DataFrame:
    near = F.floor((F.col("mileage") - 1016020 + 2500) / 5000) * 5000 + 1016020
    env = F.when(F.col("event_id") % 10 == 0, "99").otherwise("1")
    return o.where("event_type = 'purchase'").select(F.col("event_id").alias("read_id"), "ms", "direction", near.alias("mileage"), "lane", env.alias("env"), "frame")


def fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    points = o.where("event_type <> 'purchase'").select("vehicle_id", "ms", "direction", "mileage", "lane")
    return fusion.reads_to_tracks(_reads(o), points, seen_before=o.where("day = DATE'2024-01-01'"), reach=2500, wait_ms=1_800_000, step_ms=120_000, guard_ms=GUARD)


#: A vehicle can match again after so many milliseconds (the table's times are that much farther apart than a road's).
GUARD = 3_600_000


def _pass(k: int, fit: str, order: str) -> str:
    gone = "" if k == 1 else " WHERE " + " AND ".join(
        f"read_id NOT IN (SELECT read_id FROM w{j}) AND NOT EXISTS (SELECT 1 FROM w{j} WHERE w{j}.vehicle_id = c.vehicle_id AND abs(w{j}.match_ms - c.p_ms) < {GUARD})" for j in range(1, k)
    )
    return f"""b{k} AS (SELECT * FROM (SELECT * FROM c{gone}) WHERE {fit} QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY {order}, vehicle_id, p_ms) = 1),
  w{k} AS (SELECT read_id, vehicle_id, {k} AS pass, distance, p_ms AS match_ms FROM b{k} a WHERE NOT EXISTS (SELECT 1 FROM b{k} z
    WHERE z.vehicle_id = a.vehicle_id AND abs(z.p_ms - a.p_ms) < {GUARD} AND (z.distance < a.distance OR z.distance = a.distance AND z.read_id < a.read_id)))"""


FUSED = f"""{O}, r AS (SELECT event_id AS read_id, ms, direction, (mileage - 1016020 + 2500) // 5000 * 5000 + 1016020 AS mileage, lane, CASE WHEN event_id % 10 = 0 THEN '99' ELSE '1' END AS env, frame FROM o WHERE event_type = 'purchase'),
  c AS MATERIALIZED (SELECT r.*, o.vehicle_id, o.ms AS p_ms, o.mileage AS pm, o.lane AS pl, abs(o.mileage - r.mileage) AS distance, (o.ms - r.ms) // 120000 AS tries,
    o.vehicle_id IN (SELECT vehicle_id FROM o WHERE day = DATE '2024-01-01') AS known FROM r JOIN o ON o.event_type <> 'purchase' AND o.direction = r.direction AND o.ms BETWEEN r.ms AND r.ms + 1800000 AND abs(o.mileage - r.mileage) <= 2500),
  {_pass(1, "env <> '99' AND pl = lane AND CASE WHEN direction = 1 THEN pm <= mileage ELSE pm >= mileage END", "tries, distance")},
  {_pass(2, "env <> '99' AND (abs(pl - lane) <= 1 OR pl = 5)", "tries, known DESC, (pl <> lane)::INT, distance")},
  {_pass(3, "env = '99'", "tries, distance")},
  w AS (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3), m AS (SELECT r.*, vehicle_id, pass, distance, match_ms FROM r LEFT JOIN w USING (read_id))"""


@query(f"WITH {FUSED} SELECT read_id, coalesce(vehicle_id, -1) AS vehicle_id, coalesce(pass, 0)::BIGINT AS pass, coalesce(distance, -1) AS distance, coalesce(match_ms, -1) AS match_ms FROM m")
def fuse_gantry(spark, sf_dir):
    """Gantry reads given to tracks in three passes; a vehicle matches again once the guard's time has passed."""
    return fused(spark, sf_dir).fillna({"vehicle_id": -1, "pass": 0, "distance": -1, "match_ms": -1}).select("read_id", "vehicle_id", F.col("pass").cast("long"), "distance", "match_ms")


@query(f"""WITH {FUSED}, n AS (SELECT vehicle_id, 'P' || (read_id % 5) AS plate, count(*) AS votes, min((match_ms, read_id)) AS first FROM m WHERE vehicle_id IS NOT NULL GROUP BY 1, 2)
  SELECT vehicle_id, plate, votes, votes >= 10 AS settled FROM n QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY votes DESC, first) = 1""")
def fused_votes(spark, sf_dir):
    """Plates of vehicles by vote over all their matched reads: several gantries speak for a vehicle."""
    votes = fused(spark, sf_dir).where("vehicle_id IS NOT NULL").withColumn("plate", F.concat(F.lit("P"), F.col("read_id") % 5))
    return flow.plate_votes(votes, order=("match_ms", "read_id"))


@query(f"""WITH {FUSED} SELECT frame // 24 AS tick, count(*) AS reads, count(*) FILTER (vehicle_id IS NULL) AS anomalies,
  coalesce(string_agg(read_id::VARCHAR, ',' ORDER BY read_id::VARCHAR) FILTER (vehicle_id IS NULL), '') AS unmatched FROM m GROUP BY 1""")
def match_summary(spark, sf_dir):
    """The second output of a fusion run: reads and anomalies by tick."""
    o = observations(spark, sf_dir)
    points = o.where("event_type <> 'purchase'").select("vehicle_id", "ms", "direction", "mileage", "lane")
    _, summary = fusion.fused_and_summed(
        _reads(o), points, F.floor(F.col("frame") / 24), seen_before=o.where("day = DATE'2024-01-01'"), reach=2500, wait_ms=1_800_000, step_ms=120_000, guard_ms=GUARD
    )
    return summary


@query(f"""WITH {O}, s AS (SELECT DISTINCT vehicle_id, frame FROM o), n AS (SELECT vehicle_id, frame, lead(frame) OVER (PARTITION BY vehicle_id ORDER BY frame) AS nx FROM s),
  e AS (SELECT vehicle_id, unnest(range(frame + 1, least(coalesce(nx - 1, frame + 3000), frame + 3000, (SELECT max(frame) FROM o)) + 1)) AS frame FROM n) SELECT frame, vehicle_id FROM e WHERE frame IN (SELECT frame FROM o)""")
def absent_vehicles(spark, sf_dir):
    o = observations(spark, sf_dir)
    return lookup.absent_vehicles(o, o, 3000)


@query(f"WITH {O} SELECT event_id, vehicle_id FROM o WHERE vehicle_id NOT IN (SELECT vehicle_id FROM o WHERE day = DATE '2024-01-01')")
def new_vehicles(spark, sf_dir):
    o = observations(spark, sf_dir)
    return lookup.new_vehicles(o, o.where("day = DATE'2024-01-01'").select("vehicle_id").distinct()).select("event_id", "vehicle_id")


@query(f"""WITH {O}, i AS (SELECT event_id AS image_id, plate, ms // 60000 AS upload, ts FROM o WHERE event_type = 'click'), r AS (SELECT event_id, plate, (ms + 5000) // 60000 AS upload, ts - INTERVAL 5 SECOND AS ts FROM o WHERE event_id % 3 = 0)
  SELECT r.event_id, coalesce(i.image_id, -1) AS image_id FROM r LEFT JOIN i ON r.plate = i.plate AND r.upload = i.upload AND i.ts BETWEEN r.ts AND r.ts + INTERVAL 20 SECOND""")
def read_images(spark, sf_dir):
    o = observations(spark, sf_dir)
    images = o.where("event_type = 'click'").select(F.col("event_id").alias("image_id"), "plate", F.floor(F.col("ms") / 60000).alias("upload"), "ts")
    reads = o.where("event_id % 3 = 0").select("event_id", "plate", F.floor((F.col("ms") + 5000) / 60000).alias("upload"), (F.col("ts") - F.expr("INTERVAL 5 SECONDS")).alias("ts"))
    return fusion.reads_to_images(reads, images).select("event_id", F.coalesce("image_id", F.lit(-1)).alias("image_id"))


@query(f"WITH {O} SELECT event_id, coalesce(CASE device WHEN 0 THEN 'north' WHEN 1 THEN 'south' END, 'unknown') AS station FROM o")
def station_names(spark, sf_dir):
    names = spark.createDataFrame([(0, "north"), (1, "south")], "device int, station string")
    return lookup.with_default(observations(spark, sf_dir), names, "device", "station").select("event_id", "station")


@query(f"""WITH {O}, a AS (SELECT frame, vehicle_id, min(ms) AS ms, min(mileage) AS mileage FROM o WHERE device = 0 GROUP BY ALL), b AS (SELECT frame, vehicle_id, min(ms) AS ms, max(mileage) AS mileage FROM o WHERE device = 1 GROUP BY ALL)
  SELECT a.frame, a.vehicle_id, coalesce(abs(b.ms - a.ms) < 600000, false) AS is_observed, CASE WHEN abs(b.ms - a.ms) < 600000 THEN b.mileage ELSE a.mileage END AS mileage FROM a LEFT JOIN b USING (frame, vehicle_id)""")
def fresh_over_predicted(spark, sf_dir):
    o = observations(spark, sf_dir)
    a = o.where("device = 0").groupBy("frame", "vehicle_id").agg(F.min("ms").alias("ms"), F.min("mileage").alias("mileage"))
    b = o.where("device = 1").groupBy("frame", "vehicle_id").agg(F.min("ms").alias("ms"), F.max("mileage").alias("mileage"))
    return lookup.prefer_fresh(a, b, ["frame", "vehicle_id"], 600_000).select("frame", "vehicle_id", "is_observed", "mileage")


@query(f"WITH {O} SELECT vehicle_id, plate, arg_max(regexp_extract({RAMPED}, '^([A-D]?K)', 1), (ts, event_id)) AS road FROM o GROUP BY ALL")
def last_road_code(spark, sf_dir):
    o = ramped(observations(spark, sf_dir))
    return trj.last_road_code(o.withColumn("road", S.road_code(F.col("stake"))))


@query(f"WITH {O} SELECT DISTINCT a.vehicle_id, a.plate FROM o a JOIN o b ON a.plate = b.plate AND a.device = 0 AND b.device = 1")
def ramp_vehicles(spark, sf_dir):
    """Vehicles whose plate a second sensor has read: they are on the ramp."""
    o = observations(spark, sf_dir)
    return o.where("device = 0").join(o.where("device = 1").select("plate"), "plate", "left_semi").select("vehicle_id", "plate").distinct()


FRAMES = f"{O}, f AS (SELECT vehicle_id, frame, arg_min(mileage, event_id) AS mileage, arg_min(direction, event_id) AS direction, arg_min(speed, event_id) AS speed, arg_min(plate, event_id) AS plate, arg_min(regexp_extract({RAMPED}, '^([A-D]?K)', 1), event_id) AS road FROM o GROUP BY 1, 2)"


def framed(o: DataFrame) -> DataFrame:
    return o.groupBy("vehicle_id", "frame").agg(*[F.min_by(c, "event_id").alias(c) for c in ("mileage", "direction", "speed", "plate", "road")])


#: Hours that a frame lasts in the queries, in milliseconds, how many of them the watermark stays behind in streams of
#: frames, and the last frame that it closes there, counted from the newest one.
FRAME_MS, FRAME_DELAY = 3_600_000, 3
STREAM_END = FRAME_DELAY + 1


def _completion_sql(tail: bool = False, by_road: bool = False, wait: int = 0, removals: bool = False, stream: bool = False) -> str:
    """Step by step, as the operator does it: the mean of the last twenty speeds moves the point and joins them. A stream
    ends with the last frame that its watermark has closed."""
    gap = "lead(frame) OVER w - frame - 1"
    if tail:
        gap = f"coalesce({gap}, (SELECT max(frame) FROM f) - 2 - frame)"
    end = f" AND frame + {wait} + k <= (SELECT max(frame) FROM f) - {STREAM_END}" if stream else ""
    up = "direction = 1 OR road <> 'K'" if by_road else "direction = 1"
    return f"""WITH RECURSIVE {FRAMES}, g AS (SELECT *, CASE WHEN {gap} > 0 THEN least({gap}, 3000) - {wait} END AS gap, CASE WHEN frame - lag(frame) OVER w > 1 THEN 1 ELSE 0 END AS fresh FROM f WINDOW w AS (PARTITION BY vehicle_id ORDER BY frame)),
  r AS (SELECT *, sum(fresh) OVER (PARTITION BY vehicle_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM g),
  v AS (SELECT *, list(speed) OVER (PARTITION BY vehicle_id, run ORDER BY frame ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS w FROM r),
  k(vehicle_id, frame, gap, up, w, m, k, v, gone) AS (SELECT vehicle_id, frame, gap, {up}, w, mileage::BIGINT, 0, 0.0::DOUBLE, false FROM v WHERE gap > 0 UNION ALL
    SELECT vehicle_id, frame, gap, up, list_append(w, s)[-20:], CASE WHEN x BETWEEN 1016020 AND 1173790 THEN trunc(x)::BIGINT ELSE 0 END, k + 1, s, x NOT BETWEEN 1016020 AND 1173790
    FROM (SELECT *, CASE WHEN up THEN m + s * 200 / 3600 ELSE m - s * 200 / 3600 END AS x FROM (SELECT *, list_reduce(w, lambda a, b: a + b) / len(w) AS s FROM k WHERE k < gap AND NOT gone)))
  SELECT vehicle_id, frame + {wait} + k AS frame, m AS mileage, round(CASE WHEN gone THEN 0 ELSE v END, 6) AS speed{", gone AS removed" if removals else ""} FROM k WHERE k > 0{"" if removals else " AND NOT gone"}{end}"""


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return framed(ramped(observations(spark, sf_dir)).withColumn("road", S.road_code(F.col("stake"))))


def _closed_frame(points: DataFrame) -> int:
    """The last frame that a watermark of an hour behind the newest frame has closed."""
    return (points.agg(F.max("frame")).head()[0] or 0) - 2


@query(_completion_sql())
def completion(spark, sf_dir):
    """Predicted points of vehicles that are missing between two sightings, every frame of a gap (3000 at most)."""
    c = dead.completed(_framed(spark, sf_dir))
    return c.select("vehicle_id", "frame", "mileage", F.round("speed", 6).alias("speed"))


@query(_completion_sql(tail=True, by_road=True, removals=True))
def completion_by_road(spark, sf_dir):
    """Prediction by the road's rule (ramps always forward), also of vehicles that don't come back, with removal rows."""
    p = _framed(spark, sf_dir)
    c = dead.completed(p, by_road=True, until=_closed_frame(p), removals=True)
    return c.select("vehicle_id", "frame", "mileage", F.round("speed", 6).alias("speed"), "removed")


@query(_completion_sql(tail=True, wait=4))
def timeout_prediction(spark, sf_dir):
    """Prediction that starts only when nothing has come for five frames (a second)."""
    p = _framed(spark, sf_dir)
    c = dead.completed(p, until=_closed_frame(p), wait=4)
    return c.select("vehicle_id", "frame", "mileage", F.round("speed", 6).alias("speed"))


def _road_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Roads]:
    """One sighting of each vehicle and frame with its road and the coordinate there, and the roads."""
    net = road_network(spark)
    o = on_roads(observations(spark, sf_dir))
    seq = F.when(F.col("road") == "K", F.floor((F.col("mileage") - ROAD[0]) / 100)).otherwise(F.col("mileage") * 2 + 1)
    at = framed(o).withColumn("road_seq", seq).drop("longitude", "latitude")
    return at.join(net.drop("mileage"), ["road", "road_seq"], "left"), Roads.of(net, *ROAD)


def _walk_sql(stream: bool = False) -> str:
    """Dead reckoning along road rows, step by step; coordinates and headings of the rows afterwards."""
    size = "CASE road " + " ".join(f"WHEN '{r}' THEN {n}" for r, n in RAMPS.items()) + " END"
    end = STREAM_END if stream else 2
    only = f" AND frame + k <= (SELECT max(frame) FROM f) - {STREAM_END}" if stream else ""
    return f"""WITH RECURSIVE {O}, {NETWORK}, y AS (SELECT * REPLACE (CASE WHEN road = 'K' THEN mileage ELSE (mileage - {ROAD[0]}) % (({size}) // 2) END AS mileage) FROM (SELECT *, ['K', {", ".join(f"'{r}'" for r in RAMPS)}][event_id % 5 + 1] AS road FROM o)),
  f AS (SELECT vehicle_id, frame, arg_min(mileage, event_id) AS mileage, arg_min(direction, event_id) AS direction, arg_min(speed, event_id) AS speed, arg_min(road, event_id) AS road FROM y GROUP BY 1, 2),
  g AS (SELECT *, least(coalesce(lead(frame) OVER w - frame - 1, (SELECT max(frame) FROM f) - {end} - frame), 3000) AS gap, CASE WHEN frame - lag(frame) OVER w > 1 THEN 1 ELSE 0 END AS fresh FROM f WINDOW w AS (PARTITION BY vehicle_id ORDER BY frame)),
  r AS (SELECT *, sum(fresh) OVER (PARTITION BY vehicle_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM g),
  v AS (SELECT *, list(speed) OVER (PARTITION BY vehicle_id, run ORDER BY frame ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS w FROM r),
  k(vehicle_id, frame, gap, road, up, w, m, seq, k, v, gone) AS (SELECT vehicle_id, frame, gap, road, direction = 1, w, mileage::BIGINT, CASE WHEN road = 'K' THEN (mileage - {ROAD[0]}) // 100 ELSE mileage * 2 + 1 END::BIGINT, 0, 0.0::DOUBLE, false FROM v WHERE gap > 0 UNION ALL
    SELECT vehicle_id, frame, gap, road, up, list_append(w, s)[-20:], CASE WHEN off THEN 0 ELSE trunc(x)::BIGINT END, CASE WHEN off THEN 0 WHEN road = 'K' THEN (trunc(x)::BIGINT - {ROAD[0]}) // 100 ELSE ahead END, k + 1, s, off
    FROM (SELECT *, CASE WHEN road = 'K' THEN x NOT BETWEEN {ROAD[0]} AND {ROAD[1]} ELSE ahead >= {size} END AS off FROM (
      SELECT *, CASE WHEN up OR road <> 'K' THEN m + s * 200 / 3600 ELSE m - s * 200 / 3600 END AS x, seq + 2 * ceil(s * 200 / 3600)::BIGINT AS ahead FROM (SELECT *, list_reduce(w, lambda a, b: a + b) / len(w) AS s FROM k WHERE k < gap AND NOT gone)))),
  p AS (SELECT k.*, net.longitude AS x, net.latitude AS y, radians(lag(net.latitude) OVER z) AS a, radians(net.latitude) AS b, radians(net.longitude - lag(net.longitude) OVER z) AS dx FROM k LEFT JOIN net ON net.road = k.road AND net.road_seq = k.seq WINDOW z AS (PARTITION BY vehicle_id, frame ORDER BY k)),
  h AS (SELECT *, degrees(atan2(sin(dx) * cos(b), cos(a) * sin(b) - sin(a) * cos(b) * cos(dx))) AS t FROM p WHERE k > 0{only})
  SELECT vehicle_id, frame + k AS frame, road, m AS mileage, CASE WHEN NOT gone THEN printf('%s%d+%03d', road, m // 1000, m % 1000) END AS stake, round(CASE WHEN gone THEN 0 ELSE v END, 6) AS speed, gone AS removed,
    round(CASE WHEN gone THEN 0 ELSE x END, 6) AS longitude, round(CASE WHEN gone THEN 0 ELSE y END, 6) AS latitude, round(CASE WHEN gone THEN 0 WHEN t < 0 THEN t + 360 ELSE t END, 3) AS heading FROM h"""


def _walked(c: DataFrame) -> DataFrame:
    return c.select("vehicle_id", "frame", "road", "mileage", "stake", F.round("speed", 6).alias("speed"), "removed", *[F.round(x, 6).alias(x) for x in ("longitude", "latitude")], F.round("heading", 3).alias("heading"))


@query(_walk_sql())
def completion_on_roads(spark, sf_dir):
    """Predicted points with coordinate, heading and the road's stake, on the mainline and four ramps that end after their
    own rows; removal rows where a vehicle leaves its road."""
    p, roads = _road_points(spark, sf_dir)
    return _walked(dead.completed(p, until=_closed_frame(p), removals=True, roads=roads, by_road=True))


@query(f"""WITH {O}, {ROADS}, x AS (SELECT event_id, 1016020 + (mileage - 1016020) // 100 * 100 AS m, longitude, latitude + 1e-9 AS latitude FROM o), p AS (SELECT *, printf('K%d+%03d', m // 1000, m % 1000) AS sk FROM x),
  n AS (SELECT p.event_id, d.stake AS near FROM p ASOF LEFT JOIN d ON p.latitude >= d.latitude), e AS (SELECT min(mileage) AS a, max(mileage) AS z FROM d)
  SELECT event_id, CASE WHEN event_id % 4 = 0 THEN near ELSE sk END AS stake, round(CASE WHEN event_id % 4 = 1 THEN d.longitude ELSE p.longitude END, 6) AS longitude,
  round(CASE WHEN event_id % 4 = 1 THEN d.latitude ELSE p.latitude END, 6) AS latitude FROM p JOIN n USING (event_id), e LEFT JOIN d ON d.mileage = greatest(e.a, least(e.z, p.m))""")
def fill_missing(spark, sf_dir):
    """Missing stakes from coordinates, and missing coordinates (null, 0, -1) from stakes."""
    k = F.col("event_id") % 4
    at = 1016020 + F.floor((F.col("mileage") - 1016020) / 100) * 100
    hole = F.when(F.col("event_id") % 3 == 0, F.lit(0.0)).when(F.col("event_id") % 3 == 1, F.lit(-1.0))
    p = observations(spark, sf_dir).select(
        "event_id", "mileage", F.when((k == 0) & (F.col("event_id") % 8 == 0), F.lit("")).when(k != 0, S.metres_to_stake(at)).alias("stake"),
        F.when(k == 1, hole).otherwise(F.col("latitude") + 1e-9).alias("latitude"), "longitude",
    )
    return dead.filled(p, road(spark)).select("event_id", "stake", F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude"))


def _station_sql(prefix: str, angle: str) -> str:
    return f"""WITH {O}, {ROADS}, {MOVED}, n AS (SELECT m.event_id, arg_min(d.stake, (round(abs(m.latitude - d.latitude) + abs(m.longitude - d.longitude), 9), d.road_seq)) AS stake, arg_min(d.mileage, (round(abs(m.latitude - d.latitude) + abs(m.longitude - d.longitude), 9), d.road_seq)) AS mileage
    FROM m JOIN d ON abs(m.latitude - d.latitude) <= 0.01 AND abs(m.latitude - d.latitude) + abs(m.longitude - d.longitude) <= 0.01 GROUP BY 1)
  SELECT o.event_id AS id, '{prefix}' || n.stake AS stake, n.mileage, {angle} AS angle, count(*) OVER (PARTITION BY frame, device) AS num FROM o LEFT JOIN n USING (event_id)"""


def _station_messages(o: DataFrame, fields: dict[str, Column], head: list[Column], targets: str) -> DataFrame:
    """A message for each frame and sensor."""
    body = F.struct(*[v.alias(k) for k, v in fields.items()])
    grouped = o.groupBy("frame", "device").agg(F.sort_array(F.collect_list(body)).alias(targets))
    return grouped.select(F.to_json(F.struct(*head, targets)).alias("value"), F.concat_ws("-", "frame", "device").alias("fid"))


@query(_station_sql("K1122+200-", "round(event_id % 360 + 0.126, 2)"))
def station_frames(spark, sf_dir):
    """Base-station frames as path frames: nearest stake, its mileage, the rounded angle."""
    o = _moved(observations(spark, sf_dir))
    fields = {"id": F.col("event_id").cast("int"), "lane": F.col("lane"), "lat": F.col("latitude"), "lon": F.col("longitude"), "angle": F.col("event_id") % 360 + 0.126, "speed": F.col("speed"), "picLicense": F.col("plate")}
    m = _station_messages(o, fields, [F.col("frame").cast("int").alias("frameNum"), F.lit("x").alias("globalTime")], "targetList")
    good, _ = decode.decode_station_json(m)
    p = dead.station_points(good, road(spark), "frame.targetList", "fid", decode.STATION_FIELDS, "K1122+200-")
    f = dead.station_path_frames(p, "fid").select(F.explode("pathList").alias("p"), F.col("pathNum").cast("long").alias("num"))
    return f.select(F.col("p.id").cast("long").alias("id"), F.col("p.stakeId").alias("stake"), "p.mileage", F.col("p.carAngle").alias("angle"), "num")


@query(_station_sql("", "round(event_id % 360 + 0.5, 2)"))
def lidar_frames(spark, sf_dir):
    """Lidar frames as path frames."""
    o = _moved(observations(spark, sf_dir))
    body = F.struct(F.col("event_id").alias("id"), F.col("plate").alias("plateNo"), "speed", F.lit(1).alias("color"), F.lit(2).alias("type"), "longitude", "latitude", (F.col("event_id") % 360 + 0.5).alias("heading"))
    frames = o.groupBy("frame", "device").agg(F.sort_array(F.collect_list(body)).alias("participants")).withColumn("fid", F.concat_ws("-", "frame", "device"))
    p = dead.station_points(frames, road(spark), "participants", "fid", decode.LIDAR_FIELDS)
    f = dead.station_path_frames(p, "fid").select(F.explode("pathList").alias("p"), F.col("pathNum").cast("long").alias("num"))
    return f.select("p.id", F.col("p.stakeId").alias("stake"), "p.mileage", F.col("p.carAngle").alias("angle"), "num")


@query(f"""WITH {O}, n AS (SELECT frame FROM (SELECT DISTINCT frame FROM o) ORDER BY frame LIMIT 100) SELECT vehicle_id, count(*) AS points, string_agg(mileage::VARCHAR, ',' ORDER BY ts, event_id) AS mileages FROM o WHERE frame <= (SELECT max(frame) FROM n) GROUP BY 1""")
def snapshot(spark, sf_dir):
    """Trajectories as they stand at the hundredth frame (the limit is the operator's own)."""
    return trj.snapshot(observations(spark, sf_dir), 100)


@query(f"WITH {O} SELECT frame, event_id, mileage FROM o QUALIFY row_number() OVER (PARTITION BY frame ORDER BY mileage DESC, event_id) <= 10")
def frame_row_cap(spark, sf_dir):
    """The ten farthest points of each frame (a top-k operator)."""
    from pyspark.sql.window import Window

    n = F.row_number().over(Window.partitionBy("frame").orderBy(F.desc("mileage"), "event_id"))
    return observations(spark, sf_dir).withColumn("n", n).where("n <= 10").select("frame", "event_id", "mileage")


@query(f"""WITH {O}, q AS (SELECT event_id, radians(latitude) AS a, radians(30.7) AS b, radians(110.9) - radians(longitude) AS d FROM o)
  SELECT event_id, round(2 * 6371.393 * asin(sqrt(pow(sin((b - a) / 2), 2) + cos(a) * cos(b) * pow(sin(d / 2), 2))), 3) AS km FROM q""")
def haversine(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.select("event_id", F.round(S.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(30.7), F.lit(110.9)), 3).alias("km"))


@query(f"""WITH {O} SELECT event_id, strftime(ts, '%Y%m%d%H') || '-' || section AS hour_key, strftime(ts, '%Y%m%d%H%M') || '_K' || (mileage // 1000) AS minute_key, right(ms::VARCHAR, 8) AS last8,
  strftime(ts, '%Y-%m-%d %H:%M:%S:') || lpad((ms % 1000)::VARCHAR, 3, '0') AS frame_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second FROM o""")
def keys_and_times(spark, sf_dir):
    o = observations(spark, sf_dir)
    stamp = S.format_frame_time(F.col("ts"))
    return o.select(
        "event_id", S.hour_section_key(F.col("ts"), F.col("section")).alias("hour_key"), S.minute_km_key(F.col("ts"), F.floor(F.col("mileage") / 1000)).alias("minute_key"),
        F.right(F.col("ms").cast("string"), F.lit(8)).alias("last8"), stamp.alias("frame_time"), S.to_second(stamp).alias("second"),
    )


@query(f"WITH {O} SELECT event_id, ms - ms % 1000 + (ms % 1000) AS ms, true AS parsed FROM o")
def frame_time_round_trip(spark, sf_dir):
    """Times written as frame times and parsed again."""
    back = S.parse_frame_time(S.format_frame_time(F.col("ts")))
    return observations(spark, sf_dir).select("event_id", ms_of(back.cast("timestamp_ntz")).alias("ms"), back.isNotNull().alias("parsed"))


@query(f"""WITH {O}, c AS (SELECT vehicle_id, event_type, count(*) AS n FROM o GROUP BY ALL) SELECT vehicle_id, event_type AS top, coalesce((SELECT sum(n) FROM c d WHERE d.vehicle_id = c.vehicle_id AND event_type = 'view'), 0)::BIGINT AS views FROM c QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY n DESC, event_type) = 1""")
def map_counts(spark, sf_dir):
    """Most frequent key of a map of counts, and a key with a default."""
    counts = observations(spark, sf_dir).groupBy("vehicle_id", "event_type").count().groupBy("vehicle_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "count"))).alias("m"))
    return counts.select("vehicle_id", S.most_frequent_key(F.col("m")).alias("top"), F.coalesce(F.try_element_at("m", F.lit("view")), F.lit(0)).alias("views"))


# Decoders: frames are written from the observations and decoded again.


def path_messages(o: DataFrame) -> DataFrame:
    point = F.struct(F.col("event_id").alias("id"), F.col("plate").alias("plateNo"), F.col("vehicle_type").alias("vehicleType"), "speed", F.col("lane").alias("laneNo"), "direction", F.col("stake").alias("stakeId"), "mileage")
    # A message is what a device sends in a minute, never an hour of all vehicles.
    frames = o.groupBy("device", F.floor(F.col("ms") / 60_000).alias("minute"), "frame").agg(F.first("day").alias("day"), F.collect_list(point).alias("pathList"))
    stamp = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" "), F.lpad((F.col("frame") % 24).cast("string"), 2, "0"), F.lit(":00:00:000"))
    body = F.to_json(F.struct(stamp.alias("timeStamp"), (F.col("frame") * 3_600_000).alias("time"), F.size("pathList").alias("pathNum"), "pathList"))
    # Every seventh frame arrives damaged.
    return frames.select(F.col("minute").alias("fid"), F.col("device").cast("long").alias("device"), F.when(F.col("frame") % 7 == 0, F.substring(body, 1, 20)).otherwise(body).alias("value"))


@query(f"WITH {O} SELECT event_id, plate, vehicle_type::BIGINT AS vehicle_type, direction::BIGINT AS direction, mileage, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S:000') AS ts FROM o WHERE frame % 7 <> 0")
def decode_path_frames(spark, sf_dir):
    good, _ = decode.decode_path_frames(path_messages(observations(spark, sf_dir)))
    return decode.path_points(good).select(F.col("id").alias("event_id"), F.col("plateNo").alias("plate"), F.col("vehicleType").cast("long").alias("vehicle_type"), F.col("direction").cast("long"), F.col("mileage").cast("long"), F.col("timeStamp").alias("ts"))


@query(f"WITH {O} SELECT ms // 60000 AS minute, device, count(*) AS points FROM o WHERE frame % 7 = 0 GROUP BY ALL")
def quarantined_frames(spark, sf_dir):
    """Damaged frames end in quarantine, none is lost."""
    o = observations(spark, sf_dir)
    _, bad = decode.decode_path_frames(path_messages(o))
    points = o.groupBy(F.floor(F.col("ms") / 60_000).alias("minute"), F.col("device").cast("long").alias("device")).agg(F.count("*").alias("points"))
    return bad.select(F.col("fid").alias("minute"), "device").join(points, ["minute", "device"])


@query(f"WITH {O} SELECT kind, count(*) AS n FROM (SELECT DISTINCT ms // 60000, device, CASE WHEN frame % 7 = 0 THEN 'unknown' WHEN ms // 60000 % 2 = 0 THEN 'fibre' ELSE 'path' END AS kind FROM o) GROUP BY kind")
def route_envelopes(spark, sf_dir):
    m = path_messages(observations(spark, sf_dir))
    bad = "floor(fid / 60) % 7 = 0"
    both = m.where(f"fid % 2 = 1 OR {bad}").unionByName(m.where(f"fid % 2 = 0 AND NOT {bad}").withColumn("value", F.to_json(F.struct(F.col("fid").alias("SN"), F.lit("x").alias("DEVICEIP")))))
    return decode.route_envelopes(both).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH {O} SELECT ms // 60000 AS minute, device, count(*) AS n, list_sum(list_sort(list(mileage)))::BIGINT AS total, min(event_id) AS first FROM o GROUP BY ALL")
def regroup_frames(spark, sf_dir):
    """Points of a device and minute as a frame again."""
    o = observations(spark, sf_dir).withColumn("minute", F.floor(F.col("ms") / 60_000))
    f = decode.regroup_points(o, ["minute", "device"], ["event_id", "mileage"])
    return f.select("minute", F.col("device").cast("long").alias("device"), F.col("pathNum").cast("long").alias("n"), F.aggregate("pathList", F.lit(0).cast("long"), lambda a, p: a + p["mileage"]).alias("total"), F.col("pathList")[0]["event_id"].alias("first"))


def _le(value: Column, size: int) -> Column:
    h = F.lpad(F.hex(value.cast("long")), 16, "0")
    return F.concat(*[F.substring(h, 17 - 2 * k, 2) for k in range(1, size + 1)])


def _be(value: Column, size: int) -> Column:
    return F.substring(F.lpad(F.hex(value.cast("long")), 16, "0"), 17 - 2 * size, 2 * size)


def arrived(messages: DataFrame, label: str) -> DataFrame:
    """Messages as a source has them: written to the work folder and read."""
    path = sinks.work_path(messages.sparkSession, label)
    sinks.put(messages, path)
    return messages.sparkSession.read.schema(messages.schema).parquet(path)


#: Records that go into one binary frame at most; it has the first one's time.
RECORDS = 16
PACKED = f"q AS (SELECT *, min(ms) OVER k AS t, min(frame) OVER k AS sn, count(*) OVER k AS n FROM o WINDOW k AS (PARTITION BY device, event_id // {RECORDS}))"


def _packed(records: DataFrame, record: Column) -> DataFrame:
    """Frames of a device: ``ms, frame`` of the first record, how many there are, and all of them in hex."""
    rows = records.withColumn("_r", record).groupBy("device", F.floor(F.col("event_id") / RECORDS).alias("pack")).agg(
        F.min("ms").alias("ms"), F.min("frame").alias("frame"), F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("event_id", "_r"))).alias("_l")
    )
    return rows.withColumn("records", F.array_join(F.transform("_l", lambda x: x["_r"]), "")).drop("_l")


@query(f"WITH {O}, {PACKED} SELECT sn, n AS records, '100.65.23.' || (sn % 256) AS ip, t AS time, event_id AS id, plate AS car, vehicle_type::BIGINT AS type, mileage AS point, lane::BIGINT AS lane, -direction::BIGINT AS direct, (event_id % 1000) / 8.0::DOUBLE AS speed FROM q")
def decode_fibre(spark, sf_dir):
    """Little-endian fibre frames, written as hex with up to RECORDS records each and decoded."""
    o = observations(spark, sf_dir)
    # Bits of a float of three binary places: its exponent and mantissa follow from the whole number of eighths.
    n = F.col("event_id") % 1000
    e = F.floor(F.log2(n.cast("double"))).cast("int")
    bits = F.when(n == 0, F.lit(0)).otherwise(F.shiftleft((e - 3 + 127).cast("long"), 23) + F.floor((n / F.pow(F.lit(2.0), e) - 1) * (1 << 23)).cast("long"))
    car = F.rpad(F.hex(F.col("plate").cast("binary")), 32, "20")
    record = F.concat(_le(F.col("event_id"), 8), car, _le(F.col("vehicle_type"), 1), F.lit("00" * 8), _le(bits, 4), _le(F.col("lane"), 1), _le(F.col("mileage"), 4), F.lit("00"), _le(-F.col("direction"), 1))
    ip = F.concat(F.lit("644117"), _be(F.col("frame") % 256, 1))
    hexed = _packed(o, record).select(F.concat(_le(F.col("frame"), 4), ip, _le(F.col("ms"), 8), _le(F.col("n"), 4), "records").alias("hex"))
    p, _ = decode.decode_fibre_hex(arrived(hexed, "fibre"))
    return p.select(F.col("SN").alias("sn"), F.col("COUNT").cast("long").alias("records"), F.col("DEVICEIP").alias("ip"), F.col("TIME").alias("time"), F.col("ID").alias("id"), F.col("Carnumber").alias("car"), F.col("Type").alias("type"), F.col("Tpointno").alias("point"), F.col("Wayno").alias("lane"), F.col("Direct").alias("direct"), F.col("Speed").alias("speed"))


@query(f"WITH {O}, {PACKED} SELECT event_id % 65536 AS id16, sn AS frame_num, n AS participants, device, round(longitude, 7) AS longitude, round(latitude, 7) AS latitude, lane::BIGINT AS speed, t - t % 1000 + 500 AS time FROM q")
def decode_e1(spark, sf_dir):
    """Big-endian lidar packets with up to RECORDS participants each, written with their check byte and decoded; ids are 16
    bits of the event's."""
    deg = lambda c: _be(F.round(F.col(c) * 1e7).cast("long"), 4)
    one = F.concat(_be(F.col("event_id") % 65536, 2), F.lit("00" * 6), deg("longitude"), deg("latitude"), F.lit("0000"), _be(F.col("lane"), 2), F.lit("00" * 16), F.lit("00" * 72), F.lit("00" * 8))
    frames = _packed(observations(spark, sf_dir), one)
    body = F.concat(
        _be(F.col("device"), 2), F.lit("0000"), _be(F.col("frame"), 4), _be(F.floor(F.col("ms") / 1000), 4), _be(F.lit(500_000), 4), F.lit("00" * 8), F.lit("0000"), _be(F.col("n"), 1), F.lit("00" * 5), "records",
        F.lit("00" * 28),
    )
    packet = F.concat(F.lit("07E10300"), _be(F.length(body) / 2, 2), body)
    check = S.xor_of_hex(packet)
    sent = frames.select("device", F.unhex(F.concat(F.lit("FFFF"), packet, _be(check, 1), F.lit("FF"))).alias("packet"))
    p, _ = decode.decode_e1(arrived(sent, "packets"))
    return p.select(F.col("id").cast("long").alias("id16"), F.col("frameNum").cast("long").alias("frame_num"), F.col("participantCount").cast("long").alias("participants"), F.col("device").cast("long"), "longitude", "latitude", "speed", F.col("timestampMs").alias("time"))


@query(f"WITH {O} SELECT frame AS sn, ms AS time, event_id AS id, plate AS car, round(speed, 2) AS speed, mileage AS point, direction::BIGINT AS direct FROM o")
def parse_log(spark, sf_dir):
    o = observations(spark, sf_dir)
    log = F.format_string(
        "SN: %d\nDEVICE IP: 100.65.23.240\nTIME: %d\nCOUNT: 1\nCar ID: %d\nCar Number: %s\nType: 0\nScope: [0, 0]\nSpeed: %.2f m/s\nWayno: 2\nTpointno: %d\nBoolean: 0\nDirect: %d\n===============\n",
        "frame", "ms", "event_id", "plate", "speed", "mileage", F.col("direction"),
    )
    logs = o.groupBy("device", F.floor(F.col("ms") / 60_000)).agg(F.array_join(F.collect_list(log), "\n").alias("value")).select("value")
    p = decode.parse_sensor_log(logs)
    return p.select(F.col("SN").alias("sn"), F.col("TIME").alias("time"), F.col("ID").alias("id"), F.col("Carnumber").alias("car"), F.round("Speed", 2).alias("speed"), F.col("Tpointno").alias("point"), F.col("Direct").cast("long").alias("direct"))


@query(f"WITH {O} SELECT vehicle_id, count(*) AS points, round(sum(round(longitude, 5)), 3) AS longitude, sum(lane)::BIGINT AS lanes FROM o GROUP BY 1")
def points_text(spark, sf_dir):
    """Point lists written as text with a broken tuple each, and parsed."""
    o = observations(spark, sf_dir)
    tup = F.format_string("(%.5f, %.5f°, %d, %d, )", "longitude", "latitude", "lane", "direction")
    lists = o.groupBy("vehicle_id", "day").agg(F.concat(F.lit("[(1, 2), "), F.array_join(F.collect_list(tup), ", "), F.lit("]")).alias("points"))
    return decode.parse_point_list(lists).groupBy("vehicle_id").agg(F.count("*").alias("points"), F.round(F.sum("longitude"), 3).alias("longitude"), F.sum("laneNo").alias("lanes"))


@query(f"WITH {O} SELECT event_id::VARCHAR AS read_id, g.id::VARCHAR AS id, CASE WHEN event_id % 10 = 0 THEN -1 ELSE lane END::BIGINT AS lane, CASE WHEN event_id % 4 = 0 THEN NULL ELSE plate END AS toll_plate, g.mileage FROM o JOIN (WITH {GANTRIES} SELECT * FROM g) g ON g.id = 1 + event_id % 2 WHERE NOT (event_id % 10 = 0 AND event_id % 4 = 0)")
def decode_gantry(spark, sf_dir):
    o = observations(spark, sf_dir)
    toll = F.when(F.col("event_id") % 4 == 0, F.array().cast("array<struct<tollPlateNumber:string,tollPlateColor:int>>")).otherwise(F.array(F.struct(F.col("plate").alias("tollPlateNumber"), F.lit(1).alias("tollPlateColor"))))
    params = F.struct(
        F.col("event_id").cast("string").alias("uploadTime"), F.when(F.col("event_id") % 10 == 0, "99").otherwise("1").alias("envState"), F.col("plate").alias("plateNumber"), F.lit("0").alias("plateColor"),
        F.col("lane").alias("headLaneCode"), F.lit("x" * 40).alias("headImage"), F.struct(toll.alias("tollList")).alias("tollRecord"),
    )
    m = o.select(F.concat(F.lit("["), F.to_json(F.struct((1 + F.col("event_id") % 2).cast("string").alias("deviceId"), params.alias("params"))), F.lit("]")).alias("value"))
    reads, _ = decode.decode_gantry(m, gantries(spark).withColumn("id", F.col("id").cast("string")), ["1", "2"])
    return reads.select(F.col("uploadTime").alias("read_id"), "id", F.coalesce("headLaneCode", F.lit(-1)).cast("long").alias("lane"), F.col("tollPlateNumber").alias("toll_plate"), "mileage")


@query(f"WITH {O} SELECT vehicle_id, {t('day')} AS day, count(*) AS features, min(event_id) AS first FROM o GROUP BY ALL")
def geojson(spark, sf_dir):
    """Trajectories as GeoJSON in parts of a day, read again."""
    g = sinks.geojson_features(observations(spark, sf_dir), ["vehicle_id", "day"], ["event_id"], ["event_id", "speed"])
    schema = "struct<type:string,features:array<struct<geometry:struct<coordinates:array<double>>,properties:struct<event_id:bigint>>>>"
    f = F.from_json("geojson", schema)["features"]
    return g.select("vehicle_id", text("day").alias("day"), F.size(f).cast("long").alias("features"), f[0]["properties"]["event_id"].alias("first"))


@query(f"WITH {O} SELECT vehicle_id, {t('day')} AS day, count(*) AS n FROM o GROUP BY ALL HAVING count(*) = 2")
def geojson_lines(spark, sf_dir):
    """Lines of exactly two points among the trajectories' lines of a day."""
    o = observations(spark, sf_dir)
    geometry = F.struct(F.lit("LineString").alias("type"), F.collect_list(F.array("longitude", "latitude")).alias("coordinates"))
    lines = o.groupBy("vehicle_id", "day").agg(geometry.alias("geometry"))
    col = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(F.struct(F.lit("Feature").alias("type"), "geometry")).alias("features")))
    return sinks.two_point_lines(lines.select("vehicle_id", "day", col.alias("geojson"))).select("vehicle_id", text("day").alias("day"), F.size("coordinates").cast("long").alias("n"))


# Sinks and keyed reads: written to the work folder and read again.


@query(f"WITH {O} SELECT event_id, plate FROM o WHERE ts >= TIMESTAMP '2024-01-02 06:00:00' AND ts < TIMESTAMP '2024-01-02 18:00:00'")
def daily_table_scan(spark, sf_dir):
    """A table by day, read by a range of time that prunes its days."""
    path = sinks.work_path(spark, "daily")
    sinks.by_day(observations(spark, sf_dir).select("event_id", "plate", "ts"), path)
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    kept = spark.read.option("basePath", path).schema("event_id long, plate string, ts timestamp_ntz, day string").parquet(path)
    return sinks.time_range(kept, at("2024-01-02 06:00:00"), at("2024-01-02 18:00:00")).select("event_id", "plate")


@query(f"WITH {C}, h AS (SELECT hour, section, {FLOW} FROM c GROUP BY ALL) SELECT strftime(hour, '%Y%m%d%H') || '-' || section AS row_key, up_bus, up_truck, down_bus, down_truck, round_even(up_speed, 1) AS up_speed, round_even(down_speed, 1) AS down_speed FROM h")
def hourly_flow_sink(spark, sf_dir):
    """Hourly flow as keyed rows, written twice with the same result."""
    path = sinks.work_path(spark, "hourly")
    f = flow.hourly_section_flow(changes(spark, sf_dir))
    rows = sinks.hourly_rows(f).withColumn("day", F.substring("row_key", 1, 8))
    for _ in range(2):
        sinks.overwrite_partitions(rows, path, "day")
    return spark.read.parquet(path).select("row_key", "up_bus", "up_truck", "down_bus", "down_truck", F.col("up_speed").cast("double"), F.col("down_speed").cast("double"))


@query(f"WITH {O} SELECT plate, arg_max(mileage, (ts, event_id)) AS mileage FROM o GROUP BY plate")
def feature_upsert(spark, sf_dir):
    """Two batches merged by plate: the last write wins."""
    o = observations(spark, sf_dir).select("plate", "ts", "event_id", "mileage")
    first = sinks.upsert_latest(o.where("event_id % 2 = 0"), None, "plate", ["ts", "event_id"])
    return sinks.upsert_latest(o.where("event_id % 2 = 1"), first, "plate", ["ts", "event_id"]).select("plate", "mileage")


def _stored_cells(spark: SparkSession, o: DataFrame) -> DataFrame:
    """JSON cells of each vehicle and day, in a table bucketed by vehicle."""
    cells = o.groupBy("vehicle_id", "day").agg(F.to_json(F.collect_list(F.struct("event_id", "mileage"))).alias("cell"))
    path = sinks.work_path(spark, "cells")
    return sinks.store_by_key(cells, path.rsplit("/", 1)[-1].replace("-", "_"), path, "vehicle_id", CELL_BUCKETS)


#: Buckets of the stored cells, and a list of keys as a caller has it.
CELL_BUCKETS, KEY_LIST = 16, (1, 5, 8, 13)
CELL = "struct<event_id:bigint,mileage:bigint>"


@query(f"WITH {O} SELECT event_id, vehicle_id, mileage FROM o WHERE vehicle_id IN (SELECT vehicle_id FROM o WHERE event_type = 'signup')")
def get_by_keys(spark, sf_dir):
    """Rows of the keys in a table, whose JSON cells are unnested; the stored table isn't exchanged."""
    o = observations(spark, sf_dir)
    picked = sinks.get_rows(_stored_cells(spark, o), o.where("event_type = 'signup'"), "vehicle_id")
    return sinks.unnested_cells(picked, "cell", CELL, ["vehicle_id"])


@query(f"WITH {O} SELECT event_id, vehicle_id, mileage FROM o WHERE vehicle_id IN {KEY_LIST}")
def get_by_key_list(spark, sf_dir):
    """Rows of a short list of keys (the operator's own feature): only their buckets are read."""
    picked = sinks.rows_of_keys(_stored_cells(spark, observations(spark, sf_dir)), "vehicle_id", KEY_LIST)
    return sinks.unnested_cells(picked, "cell", CELL, ["vehicle_id"])


@query(f"WITH {O} SELECT strftime(ts, '%Y%m%d') || '_AnomalyPics' AS bucket, 'A_' || strftime(ts, '%Y%m%d%H%M%S') || plate || '.jpg' AS file, length(plate) AS bytes, md5(plate) AS digest FROM o WHERE device <> 0")
def image_sink(spark, sf_dir):
    """Images written as a table of names and contents by day, and read again."""
    path = sinks.work_path(spark, "images")
    o = observations(spark, sf_dir).withColumn("image", F.when(F.col("device") != 0, F.base64(F.col("plate").cast("binary"))))
    sinks.write_images(o, path, "image", "A_", "ts", "plate")
    return spark.read.parquet(path).select("bucket", "file", F.length("content").cast("long").alias("bytes"), F.md5("content").alias("digest"))


@query(f"WITH {O} SELECT event_id FROM o WHERE direction = 1 AND mileage > 1100000")
def equality_scan(spark, sf_dir):
    return sinks.equal_rows(observations(spark, sf_dir), "direction", 1).where("mileage > 1100000").select("event_id")


@query(f"WITH {O} SELECT event_id, event_id AS again FROM o WHERE device = 0 UNION ALL SELECT event_id, event_id FROM o WHERE device IN (0, 1)")
def union_streams(spark, sf_dir):
    o = observations(spark, sf_dir).select("event_id", "device")
    u = o.where("device = 0").unionByName(o.where("device IN (0, 1)"))
    return u.select("event_id", F.col("event_id").alias("again"))


# Streams: the same operators over a stream of the table's files, run until there is nothing more.


def event_stream(spark: SparkSession, sf_dir: str, late_ms: int = 300_000, columns: Sequence[str] = ()) -> DataFrame:
    """Observations as they might come: five batches, each row up to ``late_ms`` after its time; all ``columns`` unless some
    are named (``event_id`` and ``ts`` are always there)."""
    rows = observations(spark, sf_dir)
    rows = rows.select("event_id", "ts", *columns) if columns else rows
    return arrivals(rows, sinks.work_path(spark, "arrivals"), late_ms).withColumn("ts", F.col("ts").cast("timestamp"))


@query(f"WITH {O} SELECT word AS word, count(*) AS \"count\" FROM (SELECT event_type AS word FROM o) GROUP BY 1")
def stream_word_count(spark, sf_dir):
    stream = jobs.word_counts(event_stream(spark, sf_dir), "event_type")
    batches = jobs.run_to_table(stream, sinks.work_path(spark, "words"), "complete")
    last = batches.agg(F.max("batch")).head()[0]
    return batches.where(F.col("batch") == last).select("word", "count")


@query(f"WITH {O}, m AS (SELECT max(date_trunc('hour', ts - INTERVAL 5 MINUTE)) AS w FROM o) SELECT {t('date_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)')} AS hour, section, {FLOW} FROM o WHERE date_trunc('hour', ts) < (SELECT w FROM m) GROUP BY ALL")
def stream_hourly_flow(spark, sf_dir):
    """Hours that the watermark has passed, by event time, section and class."""
    rows = jobs.run_to_table(jobs.hourly_section_flow(event_stream(spark, sf_dir)), sinks.work_path(spark, "flow"))
    return rows.select(text("hour").alias("hour"), F.col("section").cast("long"), "up_bus", "up_truck", "down_bus", "down_truck", F.round("up_speed", 6).alias("up_speed"), F.round("down_speed", 6).alias("down_speed"))


@query(f"WITH {O} SELECT {t('date_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)')} AS hour, count(*) FILTER (lane % 2 = 1) AS up, count(*) FILTER (lane % 2 = 0) AS down FROM o GROUP BY 1")
def stream_up_down(spark, sf_dir):
    """Running hourly counts: the last update of each hour."""
    rows = jobs.run_to_table(jobs.running_up_down(event_stream(spark, sf_dir)), sinks.work_path(spark, "updown"), "update")
    return rows.groupBy("hour").agg(F.max_by("up", "batch").alias("up"), F.max_by("down", "batch").alias("down")).withColumn("hour", text("hour"))


#: How late rows come in the streams of single observations, the slices of time that they wait in, and the rows that the
#: watermark has passed at the end, slice by slice.
LATE_MS, LATE, SLICE_MS = 7_200_000, "2 hours", 900_000
OVER = f"(ms // {SLICE_MS} + 1) * {SLICE_MS} <= (SELECT max(ms) - {LATE_MS} FROM o)"


@query(f"WITH {C} SELECT event_id, vehicle_id, section FROM c WHERE {OVER.replace('FROM o', 'FROM o WHERE class <> -1 AND section <> -1')}")
def stream_section_changes(spark, sf_dir):
    """Section changes by keyed state, in order of event time although rows come up to two hours late."""
    jobs.use_rocksdb(spark)
    stream = event_stream(spark, sf_dir, LATE_MS, ["vehicle_id", "class", "section"]).where("class <> -1 AND section <> -1")
    rows = jobs.run_to_table(jobs.section_changes(stream, delay=LATE, slice_ms=SLICE_MS), sinks.work_path(spark, "changes"))
    return rows.select("event_id", "vehicle_id", F.col("section").cast("long"))


def _frame_stream(spark: SparkSession, points: DataFrame) -> DataFrame:
    jobs.use_rocksdb(spark)
    timed = points.withColumns({"ts": F.timestamp_millis(F.col("frame") * FRAME_MS), "event_id": F.col("vehicle_id") * 31 + F.col("frame")})
    return arrivals(timed, sinks.work_path(spark, "frames"), FRAME_DELAY * FRAME_MS)


@query(_completion_sql(tail=True, by_road=True, removals=True, stream=True))
def stream_completion(spark, sf_dir):
    """Dead reckoning by keyed state and event-time timers, rows up to three frames late: every frame that the watermark
    closes, removals included."""
    stream = jobs.completed(_frame_stream(spark, _framed(spark, sf_dir)), frame_ms=FRAME_MS, by_road=True, removals=True, delay=f"{FRAME_DELAY} hours")
    rows = jobs.run_to_table(stream, sinks.work_path(spark, "completed"))
    return rows.select("vehicle_id", "frame", "mileage", F.round("speed", 6).alias("speed"), "removed")


@query(_walk_sql(stream=True))
def stream_completion_on_roads(spark, sf_dir):
    """The same by keyed state: the walk along the road rows goes on from batch to batch."""
    p, roads = _road_points(spark, sf_dir)
    stream = jobs.completed(_frame_stream(spark, p), frame_ms=FRAME_MS, removals=True, roads=roads, delay=f"{FRAME_DELAY} hours")
    return _walked(jobs.run_to_table(stream, sinks.work_path(spark, "walked")))


@query(_completion_sql(tail=True, wait=4, stream=True))
def stream_timeout_prediction(spark, sf_dir):
    """Timers that wait for five frames without a message before they predict."""
    stream = jobs.completed(_frame_stream(spark, _framed(spark, sf_dir)), frame_ms=FRAME_MS, wait=4, delay=f"{FRAME_DELAY} hours")
    rows = jobs.run_to_table(stream, sinks.work_path(spark, "timeouts"))
    return rows.select("vehicle_id", "frame", "mileage", F.round("speed", 6).alias("speed"))


@query(f"""WITH RECURSIVE {SESSIONS}, a AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id, session ORDER BY ts, event_id) AS i FROM s),
  k(vehicle_id, session, i, last, kept) AS (SELECT vehicle_id, session, i, ms, 1 FROM a WHERE i = 1 UNION ALL
    SELECT a.vehicle_id, a.session, a.i, CASE WHEN a.ms - k.last >= 3600000 THEN a.ms ELSE k.last END, k.kept + CASE WHEN a.ms - k.last >= 3600000 THEN 1 ELSE 0 END
    FROM k JOIN a ON a.vehicle_id = k.vehicle_id AND a.session = k.session AND a.i = k.i + 1),
  q AS (SELECT vehicle_id, session, max(kept)::BIGINT AS kept FROM k GROUP BY ALL),
  z AS (SELECT vehicle_id, session, min(ms) AS start_ms, max(ms) AS last_ms, count(*) AS points FROM s GROUP BY ALL)
  SELECT vehicle_id, start_ms, last_ms, points, kept FROM z JOIN q USING (vehicle_id, session)
  WHERE last_ms + 21600000 < (SELECT (max(ms) - {LATE_MS}) // {SLICE_MS} * {SLICE_MS} FROM o)""")
def stream_sampled_sessions(spark, sf_dir):
    """Sessions that have closed by event time, with the number of their sampled points; rows come up to two hours late."""
    jobs.use_rocksdb(spark)
    place = ["vehicle_id", "ms", "plate", "vehicle_type", "longitude", "latitude", "lane", "direction", "speed"]
    stream = jobs.sampled_sessions(event_stream(spark, sf_dir, LATE_MS, place), 6 * FRAME_MS, FRAME_MS, delay=LATE, slice_ms=SLICE_MS)
    rows = jobs.run_to_table(stream, sinks.work_path(spark, "sessions"))
    return rows.select("vehicle_id", "start_ms", "last_ms", "points", "kept")


@query(f"WITH {O} SELECT device AS source, event_id, row_number() OVER (PARTITION BY device ORDER BY ms, event_id) AS place FROM o WHERE {OVER}")
def stream_reorder(spark, sf_dir):
    """Rows of each device in order of time, once event time is two hours ahead of their slice; their places in it are counted
    over the slices that have come."""
    jobs.use_rocksdb(spark)
    rows = jobs.run_to_table(jobs.reordered(event_stream(spark, sf_dir, LATE_MS, ["device", "ms"]), "device", delay=LATE, slice_ms=SLICE_MS), sinks.work_path(spark, "reordered"))
    return flow.numbered(rows, "source", F.col("slice"), ["place"]).select("source", "event_id", (F.col("no") + 1).alias("place"))


@query(f"WITH {O} SELECT event_id, device FROM o")
def stream_topics(spark, sf_dir):
    """Three topics of JSON lines read as one stream."""
    o, parts = observations(spark, sf_dir), []
    for device in (0, 1, 2):
        path = sinks.work_path(spark, "topic")
        sinks.to_json_values(o.where(F.col("device") == device).select("event_id", "device")).write.text(path)
        parts.append(decode.text_lines(spark, path, stream=True))
    rows = jobs.run_to_table(decode.topics_union(parts).select(F.from_json("value", "event_id bigint, device bigint").alias("r")).select("r.*"), sinks.work_path(spark, "union"))
    return rows


@query(f"WITH {O} SELECT {t('day')} AS day, count(*) FILTER (direction = 1) AS up, count(*) FILTER (direction = 2) AS down FROM o GROUP BY 1")
def daily_count_sink(spark, sf_dir):
    """Daily counts written twice: a repeated run replaces its days."""
    path = sinks.work_path(spark, "daycounts")
    for _ in range(2):
        sinks.write_counts(flow.daily_directions(observations(spark, sf_dir)).withColumnRenamed("day", "date"), path, "date")
    return spark.read.parquet(path).select(text("date").alias("day"), "up", "down")


@query(SQL["hourly_start_count"])
def hourly_count_sink(spark, sf_dir):
    """Sessions by start hour, written as a table by day."""
    path = sinks.work_path(spark, "hourcounts")
    s = trj.session_summaries(observations(spark, sf_dir), 6 * 3600)
    sinks.write_counts(s.groupBy(F.date_trunc("hour", "start_ts").alias("hour")).agg(F.count("*").alias("n")), path, "hour")
    return spark.read.parquet(path).select(text("hour").alias("hour"), "n")


@query(f"WITH {O} SELECT strftime(ts, '%Y%m%d') || '_GantryRecords' AS bucket, event_id, plate FROM o WHERE event_type = 'purchase'")
def gantry_record_sink(spark, sf_dir):
    """Gantry records under a folder for each day."""
    path = sinks.work_path(spark, "records")
    sinks.write_gantry_records(observations(spark, sf_dir).where("event_type = 'purchase'").select("event_id", "plate", "ts"), path, "ts")
    return spark.read.option("basePath", path).schema("event_id long, plate string, bucket string").json(path).select("bucket", "event_id", "plate")


@query(f"WITH {O}, f AS (SELECT frame, count(*) AS n FROM o GROUP BY 1) SELECT frame, n, sum(n) OVER (ORDER BY frame)::BIGINT AS total FROM f")
def running_points(spark, sf_dir):
    """Points of each frame, and of all frames so far."""
    f = observations(spark, sf_dir).groupBy("frame").agg(F.count("*").alias("n"))
    return flow.running_total(f, "n", "frame", F.floor(F.col("frame") / 24)).select("frame", "n", "total")


# Streams that meet, and sinks that can be sent a batch again.


READS = """i AS (SELECT event_id AS image_id, plate, ms // 60000 AS upload, ts FROM o WHERE event_type = 'click'),
  r AS (SELECT event_id, plate, (ms + 5000) // 60000 AS upload, ts - INTERVAL 5 SECOND AS ts FROM o WHERE event_id % 3 = 0)"""


@query(f"""WITH {O}, {READS}, w AS (SELECT least((SELECT max(ts) FROM r), (SELECT max(ts) FROM i)) - INTERVAL {LATE_MS} MILLISECOND AS mark)
  SELECT r.event_id AS read_id, coalesce(i.image_id, -1) AS image_id FROM r LEFT JOIN i ON r.plate = i.plate AND r.upload = i.upload AND i.ts BETWEEN r.ts AND r.ts + INTERVAL 20 SECOND
  WHERE i.image_id IS NOT NULL OR r.ts + INTERVAL 20 SECOND < (SELECT mark FROM w)""")
def stream_read_images(spark, sf_dir):
    """Reads and images as two streams, each up to two hours late: pairs, and reads whose time has passed without an image."""
    jobs.use_rocksdb(spark)
    o = observations(spark, sf_dir)
    images = o.where("event_type = 'click'").select("event_id", F.col("event_id").alias("image_id"), "plate", F.floor(F.col("ms") / 60000).alias("upload"), "ts")
    reads = o.where("event_id % 3 = 0").select("event_id", F.col("event_id").alias("read_id"), "plate", F.floor((F.col("ms") + 5000) / 60000).alias("upload"), (F.col("ts") - F.expr("INTERVAL 5 SECONDS")).alias("ts"))
    r, i = (arrivals(x, sinks.work_path(spark, "side"), LATE_MS) for x in (reads, images))
    rows = jobs.run_to_table(jobs.reads_to_images(r, i, delay=LATE), sinks.work_path(spark, "pairs"))
    return rows.select("read_id", F.coalesce("image_id", F.lit(-1)).alias("image_id"))


#: Ten-minute frames of the two sensors.
SENSOR_MS = 600_000


@query(f"""WITH {O}, f AS (SELECT ms // {SENSOR_MS} AS slot, device, min(ts) AS ts, list(event_id ORDER BY event_id) AS l FROM o WHERE device < 2 GROUP BY ALL)
  SELECT a.slot, len(a.l) + len(b.l) AS points, list_sum(a.l)::BIGINT AS one, list_sum(b.l)::BIGINT AS other FROM f a JOIN f b ON a.slot = b.slot AND a.device = 0 AND b.device = 1 AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 300000000""")
def stream_sensor_merge(spark, sf_dir):
    """Frames of two sensors as two streams, joined where they are at most five minutes apart."""
    jobs.use_rocksdb(spark)
    o = observations(spark, sf_dir).withColumn("slot", F.floor(F.col("ms") / SENSOR_MS))
    frames = o.groupBy("slot", "device").agg(F.min("ts").alias("ts"), F.collect_list(F.struct("device", "event_id")).alias("points")).withColumn("event_id", F.col("slot"))
    a, b = (arrivals(frames.where(F.col("device") == k), sinks.work_path(spark, "sensor"), LATE_MS).withColumn("ts", F.col("ts").cast("timestamp")) for k in (0, 1))
    rows = jobs.run_to_table(jobs.merged_sensors(a, b, "slot", within="5 minutes", delay=LATE), sinks.work_path(spark, "merged"))
    of = lambda k: F.aggregate("points", F.lit(0).cast("long"), lambda s, p: s + F.when(p["device"] == k, p["event_id"]).otherwise(0))
    return rows.select("slot", F.size("points").cast("long").alias("points"), of(0).alias("one"), of(1).alias("other"))


#: Time that the split waits for rows which come up to LATE_MS after theirs.
PATIENCE_MS = 1_800_000


@query(f"""WITH {O}, a AS (SELECT *, ms + event_id * {SPREAD} % {LATE_MS} AS come FROM o), e AS (SELECT min(come) AS x, max(come) AS y FROM a),
  b AS (SELECT a.*, {" + ".join(f"(come >= x + (y - x + 1) * {k} // 5)::INT" for k in range(1, 5))} AS batch FROM a, e),
  m AS (SELECT batch, max(max(ms)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {PATIENCE_MS} AS mark FROM b GROUP BY batch)
  SELECT event_id, coalesce(epoch_us(ts) <= mark * 1000, false) AS late FROM b JOIN m USING (batch)""")
def stream_late_rows(spark, sf_dir):
    """All rows of a stream, those that are more than half an hour behind kept apart: none is dropped."""
    path = sinks.work_path(spark, "split")
    jobs.run_batches(event_stream(spark, sf_dir, LATE_MS), jobs.late_splitter(path, PATIENCE_MS), f"{path}-checkpoint")
    return spark.read.parquet(f"{path}/rows").select("event_id", F.col("late").cast("boolean").alias("late"))


@query(SQL["feature_upsert"])
def stream_feature_upsert(spark, sf_dir):
    """The last features of each plate from a stream, merged bucket by bucket; every batch is sent twice."""
    path = sinks.work_path(spark, "features")
    merge = sinks.merge_latest(path, "plate", ["us", "event_id"])

    def twice(batch: DataFrame, number: int) -> None:
        for _ in range(2):
            merge(batch, number)

    stream = event_stream(spark, sf_dir, LATE_MS).select("plate", F.unix_micros("ts").alias("us"), "event_id", "mileage")
    jobs.run_batches(stream, twice, f"{path}-checkpoint")
    return sinks.merged_rows(spark, path, "plate string, us long, event_id long, mileage long").select("plate", "mileage")


VOTED = f"""{O}, x AS (SELECT vehicle_id, event_id, ts, ms, 'P' || (vehicle_id + event_id % 3) AS plate, event_id % 3 AS j FROM o WHERE {OVER}),
  c AS (SELECT *, row_number() OVER w AS n, {", ".join(f"count(*) FILTER (j = {j}) OVER w AS c{j}, coalesce(min(epoch_us(ts)) FILTER (j = {j}) OVER w, 9e18) AS f{j}" for j in range(3))} FROM x
    WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
  b AS (SELECT *, list_sort([(-c0, f0, 0), (-c1, f1, 1), (-c2, f2, 2)])[1] AS best FROM c),
  v AS (SELECT vehicle_id, event_id, ts, n, 'P' || (vehicle_id + best[3]) AS plate, -best[1] AS votes FROM b)"""


def _vote_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.use_rocksdb(spark)
    reads = event_stream(spark, sf_dir, LATE_MS, ["vehicle_id"]).withColumn("plate", F.concat(F.lit("P"), F.col("vehicle_id") + F.col("event_id") % 3))
    return jobs.run_to_table(keyed.plate_votes(reads, votes_ms=None, delay=LATE, slice_ms=SLICE_MS), sinks.work_path(spark, "votes"))


@query(f"WITH {VOTED} SELECT vehicle_id, plate, votes, votes >= 10 AS settled FROM v QUALIFY n = max(n) OVER (PARTITION BY vehicle_id)")
def stream_plate_vote(spark, sf_dir):
    """Plates by vote from a stream: each vehicle's last word."""
    last = _vote_stream(spark, sf_dir).groupBy("vehicle_id").agg(F.max_by(F.struct("plate", "votes"), F.struct("ts", "event_id")).alias("v"))
    return last.select("vehicle_id", "v.plate", "v.votes", (F.col("v.votes") >= 10).alias("settled"))


@query(f"""WITH {VOTED}, s AS (SELECT vehicle_id, arg_min(plate, n) AS settled, min(n) AS since FROM v WHERE votes >= 10 GROUP BY 1)
  SELECT event_id, CASE WHEN n >= since THEN settled ELSE plate END AS plate FROM v LEFT JOIN s USING (vehicle_id)""")
def stream_plate_carry_over(spark, sf_dir):
    """Reads with the plate that is settled by then, else the best so far."""
    return _vote_stream(spark, sf_dir).select("event_id", F.col("carried").alias("plate"))


#: Width of the segments that are flushed after their kilometre's first row.
FLUSH_MS = 43_200_000


@query(f"""WITH RECURSIVE {O}, a AS (SELECT *, epoch_us(ts) AS us, mileage // 1000 AS km, row_number() OVER (PARTITION BY mileage // 1000 ORDER BY ts, event_id) AS i FROM o),
  k(km, i, start) AS (SELECT km, i, us FROM a WHERE i = 1 UNION ALL SELECT a.km, a.i, CASE WHEN a.us - k.start >= {FLUSH_MS}000 THEN a.us ELSE k.start END FROM k JOIN a ON a.km = k.km AND a.i = k.i + 1)
  SELECT km, start AS start_us, vehicle_id, round(sum(speed), 6) AS speed_sum, count(*) AS points, arg_min(plate, a.i) AS plate, arg_min(direction, a.i)::BIGINT AS direction, arg_min(lane, a.i)::BIGINT AS lane
  FROM k JOIN a USING (km, i) WHERE start + {FLUSH_MS}000 <= (SELECT (max(ms) - {LATE_MS}) // {SLICE_MS} * {SLICE_MS}000 FROM o) GROUP BY ALL""")
def stream_flushed_segments(spark, sf_dir):
    """Segments of each kilometre, given half a day of event time after its first row, although rows come out of order."""
    jobs.use_rocksdb(spark)
    columns = ["vehicle_id", "mileage", "speed", "plate", "direction", "lane"]
    stream = keyed.flushed_segments(event_stream(spark, sf_dir, LATE_MS, columns), FLUSH_MS, delay=LATE, slice_ms=SLICE_MS)
    rows = jobs.run_to_table(stream, sinks.work_path(spark, "flushed"))
    return rows.withColumns({"speed_sum": F.round("speed_sum", 6), "direction": F.col("direction").cast("long"), "lane": F.col("lane").cast("long")})


def _settled(spark: SparkSession, sf_dir: str) -> str:
    """Reads and points of all observations as two streams, settled tick by tick; the folder of both outputs."""
    jobs.use_rocksdb(spark)
    o = observations(spark, sf_dir)
    ends = spark.range(2).select((F.col("id") + 1).cast("int").alias("direction"))
    every = gantries(spark).drop("direction").join(ends, F.lit(True)).select((F.col("id") * 2 + F.col("direction")).alias("id"), "mileage", "direction")
    reads = _reads(o.where("event_type = 'purchase'")).join(o.select(F.col("event_id").alias("read_id"), "ts"), "read_id").withColumn("event_id", F.col("read_id"))
    points = o.where("event_type <> 'purchase'").select("event_id", "vehicle_id", "ts", "direction", "mileage", "lane", (F.col("day") == F.lit("2024-01-01").cast("date")).alias("known"))
    r, p = (arrivals(x, sinks.work_path(spark, "side"), LATE_MS) for x in (reads, points))
    path = sinks.work_path(spark, "settled")
    stream = ticks.settled_by_tick(r, p, every, reach=2500, wait_ms=1_800_000, step_ms=120_000, guard_ms=GUARD, delay=LATE)
    jobs.run_batches(stream, ticks.tick_writer(path), f"{path}-checkpoint")
    return path


@query()
def stream_tick_fusion(spark, sf_dir):
    """Reads settled at their first fitting tick, or given up when their time is over (held against a plain walk in the tests)."""
    return spark.read.parquet(f"{_settled(spark, sf_dir)}/reads").drop("batch")


@query()
def stream_tick_summary(spark, sf_dir):
    """The second output of the same run: reads and anomalies by tick."""
    return spark.read.parquet(f"{_settled(spark, sf_dir)}/summary").drop("batch")
