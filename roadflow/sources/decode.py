"""Decoders: messages as text or binary columns to typed rows, bad ones to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S

PATH_POINT = (
    "struct<id:bigint,plateNo:string,plateColor:int,vehicleType:int,speed:float,longitude:double,latitude:double,carAngle:double,"
    "laneNo:int,direction:int,stakeId:string,mileage:int,originalType:int,originalColor:int,weight:double,specialFlag:string,timeStamp:string>"
)
PATH_FRAME = f"struct<timeStamp:string,time:bigint,pathNum:int,waySectionId:string,waySectionName:string,pathList:array<{PATH_POINT}>>"
FIBRE_FRAME = (
    "struct<SN:int,DEVICEIP:string,TIME:bigint,COUNT:int,TDATA:array<struct<ID:bigint,Carnumber:string,Type:tinyint,Scope:array<int>,"
    "Speed:float,Wayno:tinyint,Tpointno:int,Boolean:tinyint,Direct:tinyint>>>"
)
STATION_FRAME = (
    "struct<frameNum:int,globalTime:string,kafkaTime:bigint,orgCode:string,targetList:array<struct<id:int,lane:int,station:int,lat:double,lon:double,angle:double,speed:double,"
    "carColor:int,carType:int,picLicense:string,licenseColor:int>>>"
)
#: Fields of path points in base-station targets and in lidar participants.
STATION_FIELDS = {"id": "id", "laneNo": "lane", "plateNo": "picLicense", "speed": "speed", "plateColor": "carColor", "vehicleType": "carType", "longitude": "lon", "latitude": "lat", "carAngle": "angle"}
LIDAR_FIELDS = {"id": "id", "plateNo": "plateNo", "speed": "speed", "plateColor": "color", "vehicleType": "type", "longitude": "longitude", "latitude": "latitude", "carAngle": "heading"}
GANTRY = (
    "struct<deviceId:string,params:struct<uploadTime:string,envState:string,plateNumber:string,plateColor:string,headLaneCode:int,"
    "tollRecord:struct<tollList:array<struct<tollPlateNumber:string,tollPlateColor:int,tollFeeVehicleType:int,tollVehicleUserType:int>>>>>"
)


def kafka_values(spark: SparkSession, servers: str, topics: list[str], starting: str = "latest", **options: str) -> DataFrame:
    """Stream of the values of several topics as text (needs Spark's Kafka package on the class path)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    return reader.option("startingOffsets", starting).options(**options).load().select(F.col("value").cast("string").alias("value"), "topic", "timestamp")


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).text(path)


def split_valid(parsed: DataFrame, valid) -> tuple[DataFrame, DataFrame]:
    """Rows that hold, and those that don't (nulls too), so that none is lost."""
    ok = F.coalesce(valid, F.lit(False))
    return parsed.where(ok), parsed.where(~ok)


def decode_json(messages: DataFrame, schema: str, required: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``messages`` with ``frame`` of the given schema, and the quarantined messages: not JSON, or without ``required``."""
    parsed = messages.withColumn("frame", F.from_json(value, schema))
    good, bad = split_valid(parsed, F.col("frame")[required].isNotNull())
    return good, bad.drop("frame")


def decode_path_frames(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    return decode_json(messages, PATH_FRAME, "timeStamp", value)


def decode_fibre_json(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    return decode_json(messages, FIBRE_FRAME, "TDATA", value)


def decode_station_json(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Base-station frames with their targets, and messages that are none."""
    return decode_json(messages, STATION_FRAME, "targetList", value)


def topics_union(streams: list[DataFrame]) -> DataFrame:
    """Several sources of the same columns as one."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def path_points(frames: DataFrame) -> DataFrame:
    """One row a point; a point without its own time has that of its frame; missing direction -1, missing mileage -1000."""
    return frames.select(F.col("frame.timeStamp").alias("frame_time"), F.explode("frame.pathList").alias("p")).select(
        "frame_time", "p.*"
    ).withColumns({
        "timeStamp": F.coalesce("timeStamp", "frame_time"), "direction": F.coalesce("direction", F.lit(-1)), "mileage": F.coalesce("mileage", F.lit(-1000)),
    })


def regroup_points(points: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Frames again: ``pathList`` and its size for each key."""
    return points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("pathList")).withColumn("pathNum", F.size("pathList"))


def decode_fibre_hex(messages: DataFrame, col: str = "hex") -> tuple[DataFrame, DataFrame]:
    """Points of little-endian fibre frames (20-byte header, 44-byte records), and frames that are cut short or not hex."""
    d = messages.withColumn("_raw", F.try_to_binary(col, F.lit("hex")))
    le = lambda at, size: S.little_endian(F.col("_raw"), at, size)
    whole = (F.length("_raw") >= 20) & (F.length("_raw") >= 20 + 44 * le(16, 4))
    good, bad = split_valid(d, whole)
    rows = good.select(
        "*", S.signed(le(0, 4), 4).alias("SN"), F.concat_ws(".", *[le(4 + k, 1) for k in range(4)]).alias("DEVICEIP"),
        le(8, 8).alias("TIME"), le(16, 4).cast("int").alias("COUNT"),
        F.explode(F.when(le(16, 4) > 0, F.sequence(F.lit(0), (le(16, 4) - 1).cast("int")))).alias("_i"),
    ).withColumn("_o", 20 + 44 * F.col("_i"))
    at = lambda k, size: S.little_endian(F.col("_raw"), F.col("_o") + k, size)
    points = rows.select(
        *[c for c in messages.columns if c != col], "SN", "DEVICEIP", "TIME", "COUNT", F.col("_i").alias("pos"),
        at(0, 8).alias("ID"), F.trim(F.translate(F.substring("_raw", F.col("_o") + 9, F.lit(16)).cast("string"), "\x00", "")).alias("Carnumber"),
        S.signed(at(24, 1), 1).alias("Type"), F.array(S.signed(at(25, 4), 4), S.signed(at(29, 4), 4)).alias("Scope"),
        S.float_of_bits(at(33, 4)).alias("Speed"), S.signed(at(37, 1), 1).alias("Wayno"), S.signed(at(38, 4), 4).alias("Tpointno"),
        S.signed(at(42, 1), 1).alias("Boolean"), S.signed(at(43, 1), 1).alias("Direct"),
    )
    return points, bad.drop("_raw")


#: Size of the lidar frame's header, of one traffic participant (three views of 36 bytes and a box of 8).
E1_HEAD, E1_OBJECT = 40, 3 * 36 + 8


def decode_e1(messages: DataFrame, col: str = "packet") -> tuple[DataFrame, DataFrame]:
    """Participants of big-endian lidar frames, and the packets that fail a guard: start FFFF, command E1, end FF, the
    exclusive-or of all bytes from the third to the last but two, and the length that the objects need. Sub-command 5
    has no body, and frames without objects give no rows."""
    be = lambda at, size: S.big_endian(F.col(col), at, size)
    n = F.length(col)
    check = S.xor_of_bytes(F.substring(F.col(col), F.lit(3), n - 4))
    sound = (n >= 10) & (be(0, 2) == 0xFFFF) & (be(3, 1) == 0xE1) & (be(n - 1, 1) == 0xFF) & (F.when(n >= 10, check) == be(n - 2, 1))
    enough = (be(4, 1) == 5) | (n >= E1_HEAD + 28 + 2 + E1_OBJECT * be(34, 1))
    good, bad = split_valid(messages, sound & enough)
    # Each participant takes its own bytes along, not its whole packet.
    own = F.transform(F.sequence(F.lit(0), (be(34, 1) - 1).cast("int")), lambda i: F.substring(F.col(col), E1_HEAD + 1 + E1_OBJECT * i, F.lit(E1_OBJECT)))
    degrees = lambda v: F.bround(S.signed(v, 4) * F.lit(1e-7), 7)
    kept = [c for c in messages.columns if c != col]
    rows = good.where(be(4, 1) != 5).select(
        *kept, be(2, 1).alias("sequence"), be(4, 1).alias("subCmd"), be(5, 1).alias("status"), be(6, 2).alias("msgLength"),
        be(8, 2).alias("deviceId"), be(12, 4).alias("frameNum"), (be(16, 4) * 1000 + F.floor(be(20, 4) / 1000)).alias("timestampMs"),
        degrees(be(24, 4)).alias("lidarLongitude"), degrees(be(28, 4)).alias("lidarLatitude"), be(32, 2).alias("angle"), be(34, 1).alias("participantCount"),
        F.posexplode(F.when(be(34, 1) > 0, own)).alias("pos", "_o"),
    )
    at = lambda k, size: S.big_endian(F.col("_o"), k, size)
    two = lambda k: S.signed(at(k, 2), 2)
    return rows.select(
        *[c for c in rows.columns if c != "_o"], at(0, 2).alias("id"), at(2, 1).alias("type"), at(3, 1).alias("confidence"), at(4, 1).alias("color"), at(5, 1).alias("source"),
        at(6, 1).alias("signBit"), at(7, 1).alias("cameraId"), degrees(at(8, 4)).alias("longitude"), degrees(at(12, 4)).alias("latitude"),
        two(16).alias("altitude"), at(18, 2).alias("speed"), F.bround(at(20, 2) * F.lit(0.01), 2).alias("heading"), at(22, 2).alias("length"),
        at(24, 2).alias("width"), at(26, 2).alias("height"), two(28).alias("X"), two(30).alias("Y"), two(32).alias("Z"), at(34, 2).alias("trackCount"),
    ), bad


def decode_gantry(messages: DataFrame, gantries: DataFrame, devices: list[str] | None = None, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Gantry reads: outer brackets stripped, images not read, only the given devices, no reads of bad weather (state 99)
    without toll record; the first toll record; the lane only in good weather; place from the gantry table."""
    parsed = messages.withColumn("g", F.from_json(S.strip_brackets(F.trim(F.col(value))), GANTRY))
    good, bad = split_valid(parsed, F.col("g.deviceId").isNotNull() & F.col("g.params").isNotNull())
    toll = F.try_element_at("g.params.tollRecord.tollList", F.lit(1))
    clear = F.coalesce(F.col("g.params.envState") != "99", F.lit(True))
    reads = good.where(clear | (F.coalesce(F.size("g.params.tollRecord.tollList"), F.lit(0)) > 0))
    if devices is not None:
        reads = reads.where(F.col("g.deviceId").isin(devices))
    reads = reads.select(
        F.col("g.deviceId").alias("id"), "g.params.uploadTime", "g.params.envState", "g.params.plateNumber", F.col("g.params.plateColor").try_cast("int").alias("plateColor"),
        F.when(clear, F.col("g.params.headLaneCode")).alias("headLaneCode"), toll["tollPlateNumber"].alias("tollPlateNumber"), toll["tollPlateColor"].alias("tollPlateColor"),
        toll["tollFeeVehicleType"].alias("tollFeeVehicleType"), toll["tollVehicleUserType"].alias("tollVehicleUserType"),
    )
    return reads.join(gantries.select("id", "mileage", "direction"), "id", "left"), bad.drop("g")


def parse_sensor_log(logs: DataFrame, text: str = "value") -> DataFrame:
    """Points of `key: value` logs: a block for each `SN:`, records closed by lines of `=`; numbers without their units."""
    block = logs.select(*[c for c in logs.columns if c != text], F.explode(F.split(text, r"(?m)^(?=SN:)")).alias("block")).where("block LIKE 'SN:%'")
    head = lambda key: F.regexp_extract("block", rf"(?m)^{key}:[ \t]*(.*?)[ \t]*$", 1)
    points = block.select(
        *[c for c in logs.columns if c != text], head("SN").try_cast("long").alias("SN"), head("DEVICE IP").alias("DEVICEIP"), head("TIME").try_cast("long").alias("TIME"),
        head("COUNT").try_cast("int").alias("COUNT"), F.posexplode(F.filter(F.split("block", r"(?m)^=+[ \t]*$"), lambda x: x.contains("Car ID:"))).alias("pos", "rec"),
    )
    of = lambda key: F.regexp_extract("rec", rf"(?m)^{key}:[ \t]*(.*?)[ \t]*$", 1)
    number = lambda key: F.regexp_extract(of(key), r"-?[\d.]+", 0).try_cast("double")
    return points.select(
        *[c for c in points.columns if c != "rec"], of("Car ID").try_cast("long").alias("ID"), of("Car Number").alias("Carnumber"), number("Type").cast("int").alias("Type"),
        number("Speed").alias("Speed"), number("Wayno").cast("int").alias("Wayno"), number("Tpointno").cast("long").alias("Tpointno"),
        number("Boolean").cast("int").alias("Boolean"), number("Direct").cast("int").alias("Direct"),
    )


def parse_point_list(texts: DataFrame, col: str = "points") -> DataFrame:
    """Rows of `[(lon, lat, lane, direction, speed), ...]`; whatever isn't part of a number is left out, nothing is 0,
    and tuples of another arity are dropped."""
    tuples = F.regexp_extract_all(col, F.lit(r"\(([^()]*)\)"), F.lit(1))
    rows = texts.select(*[c for c in texts.columns if c != col], F.posexplode(F.transform(tuples, lambda t: F.split(t, ","))).alias("pos", "f")).where("size(f) = 5")
    num = lambda k: F.coalesce(F.regexp_replace(F.col("f")[k], r"[^0-9.\-]", "").try_cast("double"), F.lit(0.0))
    return rows.select(*[c for c in rows.columns if c != "f"], num(0).alias("longitude"), num(1).alias("latitude"), num(2).cast("int").alias("laneNo"), num(3).cast("int").alias("direction"), num(4).alias("speed"))


def route_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with the kind that their fields show: station, path, fibre, track or unknown."""
    has = lambda key: F.get_json_object(value, f"$.{key}").isNotNull()
    return messages.withColumn("kind", F.when(has("frameNum"), "station").when(has("pathList"), "path").when(has("SN"), "fibre").when(has("vehicleTrackID"), "track").otherwise("unknown"))


def read_stakes(spark: SparkSession, path: str) -> DataFrame:
    """Stake table (JSON array of stake, lnglat, direction) by mileage; stakes that can't be read are left out."""
    stakes = spark.read.schema("stake string, lnglat array<double>, direction int").json(path, multiLine=True)
    return stakes.withColumn("mileage", S.stake_to_metres(F.col("stake"))).where("mileage IS NOT NULL")


def read_road_points(spark: SparkSession, path: str) -> DataFrame:
    """Road points from one JSON array, whose order gives ``road_seq`` (a point that has one keeps it)."""
    point = "struct<road_seq:int,ramp:string,laneNum:int,location:string,locationNum:double,longitude:double,latitude:double,laneType:int,direction:int>"
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", f"array<{point}>")).alias("pos", "p"))
    return whole.select(F.coalesce("p.road_seq", "pos").alias("road_seq"), *[f"p.{c}" for c in ("ramp", "laneNum", "location", "locationNum", "longitude", "latitude", "laneType", "direction")])


def read_gantries(spark: SparkSession, path: str) -> DataFrame:
    """Gantries by mileage."""
    return spark.read.schema("id string, mileage int, direction int").csv(path, header=True).orderBy("mileage")


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoints (longitude, latitude) from north to south, numbered from 0."""
    rows = spark.read.schema("longitude double, latitude double").csv(path, header=True).where("latitude IS NOT NULL")
    return rows.withColumn("rank", (F.row_number().over(Window.orderBy(F.desc("latitude"), "longitude")) - 1))
