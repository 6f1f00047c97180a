"""Sinks and keyed reads: partitioned tables, upserts, fan-out, topics, and scans that prune."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as S


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the cluster's shared one (``spark.checkpoint.dir``). Where that is unset, a temporary one on a
    single machine (master ``local``); on a cluster an error, as executors and driver must share it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the work folder and read again: computed once, whoever reads them, and safe from lost executors."""
    path = work_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def to_json_values(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value`` (and ``key``), as a topic takes them."""
    value = F.to_json(F.struct("*")).alias("value")
    return rows.select(F.col(key).cast("string").alias("key"), value) if key else rows.select(value)


def write_topic(stream: DataFrame, servers: str, topic: str, checkpoint: str, **options: str):
    """Streaming query that sends JSON to a topic (needs Spark's Kafka package); large messages by the producer's zstd."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint, "kafka.compression.type": "zstd", "kafka.max.request.size": str(10 << 20)}
    return to_json_values(stream).writeStream.format("kafka").options(**(settings | options)).start()


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that gives each batch to several writers and computes it once."""

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for w in writers:
                w(kept, number)
        finally:
            kept.unpersist()

    return write


def by_day(rows: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    """A table with one partition a day, taken from each row's own time."""
    rows.withColumn("day", F.date_format(ts, "yyyyMMdd")).write.mode(mode).partitionBy("day").parquet(path)


def by_day_and_hour(rows: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    rows.withColumns({"day": F.date_format(ts, "yyyyMMdd"), "hour": F.hour(ts)}).write.mode(mode).partitionBy("day", "hour").parquet(path)


def hourly_rows(flow: DataFrame) -> DataFrame:
    """Hourly flow with its row key `yyyyMMddHH-section`, averages as text with one decimal (of six-place ones: sums of
    doubles end a hair off, which must not decide a tie)."""
    flow = flow.withColumns({c: F.round(c, 6) for c in ("up_speed", "down_speed")})
    return flow.select(
        S.hour_section_key(F.col("hour"), F.col("section")).alias("row_key"), "up_bus", "up_truck", "down_bus", "down_truck",
        S.decimals(F.col("up_speed"), 1).alias("up_speed"), S.decimals(F.col("down_speed"), 1).alias("down_speed"),
    )


def overwrite_partitions(rows: DataFrame, path: str, *partitions: str) -> None:
    """Keyed overwrite: only the partitions that the rows are in are replaced, so that a repeated batch changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def upsert_latest(rows: DataFrame, target: DataFrame | None, key: str, order: Sequence[str]) -> DataFrame:
    """The target with the rows merged in: the last write of each key wins."""
    every = rows if target is None else target.unionByName(rows)
    fields = [c for c in every.columns if c != key]
    return every.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("r")).select(key, "r.*")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def merge_latest(path: str, key: str, order: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the last write of each key in a table, whatever is sent again.

    The table is cut into ``buckets`` of keys. A batch merges only the buckets that it touches, into new versions of them
    (``rows/version=N/bucket=b``); its line in the ledger (``path/ledger``, one row a touched bucket) makes them count. A batch
    whose line is there is left alone; one that was broken off before its line is written again. Readers see the newest
    version of each bucket in the ledger, so never half a batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ledger = _ledger(spark, path)
        if not ledger.where(F.col("version") == number).isEmpty():
            return
        # The last row of each key, and from here on one row a key.
        fresh = staged(upsert_latest(batch, None, key, order).withColumn("bucket", bucket_of(key, buckets)), "fresh")
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())  # at most ``buckets`` rows
        current = _versions(spark, path, fresh.schema, touched)
        merged = upsert_latest(fresh.drop("bucket"), current.drop("bucket", "version"), key, order) if current is not None else fresh.drop("bucket")
        out = merged.withColumns({"version": F.lit(number).cast("long"), "bucket": bucket_of(key, buckets)})
        overwrite_partitions(out.repartition("bucket"), f"{path}/rows", "version", "bucket")
        lines = spark.createDataFrame([(b, number) for b in touched], "bucket int, version long")
        overwrite_partitions(lines.coalesce(1), f"{path}/ledger", "version")

    return write


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/ledger", "bucket int, version long")


def _versions(spark: SparkSession, path: str, schema: StructType, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """Rows of the newest version of each bucket (or of those listed), read from just their folders."""
    newest = _ledger(spark, path).groupBy("bucket").agg(F.max("version").alias("version")).collect()  # a row a bucket
    folders = [f"{path}/rows/version={r['version']}/bucket={r['bucket']}" for r in newest if buckets is None or r["bucket"] in buckets]
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*folders) if folders else None


def merged_rows(spark: SparkSession, path: str, schema: str, keys: Sequence[object] | None = None, key: str | None = None, buckets: int = 64) -> DataFrame:
    """What ``merge_latest`` has kept; with ``keys`` (of column ``key``) only the buckets that they are in are read."""
    listed = None
    if keys is not None:
        listed = [r[0] for r in spark.createDataFrame([(k,) for k in keys], f"{key} {dict(f.split() for f in schema.split(', '))[key]}").select(bucket_of(key, buckets)).distinct().collect()]
    empty = spark.createDataFrame([], schema)
    rows = _versions(spark, path, empty.schema, listed)
    if rows is None:
        return empty
    rows = rows.select(empty.columns)
    return rows if keys is None else rows.where(F.col(key).isin(list(keys)))


def store_by_key(rows: DataFrame, name: str, path: str, key: str, buckets: int = 64) -> DataFrame:
    """A table bucketed and sorted by its row key, in the catalog under ``name``: reads by a list of keys open only the keys'
    buckets, and joins by the key don't exchange it."""
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return rows.sparkSession.table(name)


def rows_of_keys(table: DataFrame, key: str, keys: Sequence[object]) -> DataFrame:
    """Rows of the keys in a list."""
    return table.where(F.col(key).isin(list(keys)))


def image_files(rows: DataFrame, image: str, prefix: str, time: str, plate: str) -> DataFrame:
    """Binary images with the day and file name that they belong under; rows without image are left out."""
    return rows.where(F.col(image).isNotNull()).select(
        F.date_format(time, "yyyyMMdd").alias("day"),
        F.concat(F.lit(prefix), F.date_format(time, "yyyyMMddHHmmss"), F.col(plate), F.lit(".jpg")).alias("file"), F.try_to_binary(image, F.lit("base64")).alias("content"),
    )


def write_counts(counts: DataFrame, path: str, ts: str, now: Column | None = None) -> None:
    """Daily or hourly counts with the time they were computed, one partition a day; a repeated run replaces its days."""
    stamped = counts.withColumns({"execution_time": F.current_timestamp() if now is None else now, "day": F.date_format(ts, "yyyyMMdd")})
    overwrite_partitions(stamped, path, "day")


def write_gantry_records(records: DataFrame, path: str, ts: str) -> None:
    """Records under a folder for each day, named `<yyyyMMdd>_GantryRecords`."""
    named = records.withColumn("bucket", F.concat(F.date_format(ts, "yyyyMMdd"), F.lit("_GantryRecords")))
    named.write.mode("append").partitionBy("bucket").json(path)


def write_images(rows: DataFrame, path: str, image: str, prefix: str, time: str, plate: str) -> None:
    """Images as a table of file name and content under `<yyyyMMdd>_AnomalyPics`; rows without image are left out."""
    files = image_files(rows, image, prefix, time, plate)
    files.withColumn("bucket", F.concat(F.col("day"), F.lit("_AnomalyPics"))).drop("day").write.mode("append").partitionBy("bucket").parquet(path)


def capture_text(stream: DataFrame, path: str, checkpoint: str):
    return stream.select("value").writeStream.format("text").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def time_range(rows: DataFrame, start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Rows of [start, end): the days of the partition column prune, the time column is pushed down."""
    days = F.col("day").between(F.date_format(start, "yyyyMMdd"), F.date_format(end, "yyyyMMdd")) if "day" in rows.columns else F.lit(True)
    return rows.where(days & (F.col(ts) >= start) & (F.col(ts) < end))


def equal_rows(rows: DataFrame, column: str, value: object) -> DataFrame:
    return rows.where(F.col(column) == F.lit(value))


def get_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of the listed keys."""
    return rows.join(keys.select(key).distinct(), key, "left_semi")


def unnested_cells(rows: DataFrame, cell: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Elements of a JSON array cell, one row each; cells that are missing or bad give none."""
    return rows.select(*keep, F.explode(F.from_json(cell, f"array<{schema}>")).alias("e")).select(*keep, "e.*")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one of the schema if there is none."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def put(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def geojson_features(points: DataFrame, by: str | Sequence[str], order: Sequence[str], properties: Sequence[str] = ()) -> DataFrame:
    """A GeoJSON FeatureCollection of points for each trajectory, or part of one (such as vehicle and day)."""
    keys = [by] if isinstance(by, str) else list(by)
    p = F.struct(*order, F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties") if properties else F.create_map().alias("properties"),
    ).alias("f"))
    features = F.transform(F.sort_array(F.collect_list(p)), lambda x: x["f"])
    return points.groupBy(*keys).agg(features.alias("features")).select(*keys, F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("geojson"))


LINES = "struct<type:string,features:array<struct<type:string,geometry:struct<type:string,coordinates:array<array<double>>>>>>"


def two_point_lines(collections: DataFrame, col: str = "geojson") -> DataFrame:
    """Features that are lines of exactly two points."""
    keep = [c for c in collections.columns if c != col]
    rows = collections.select(*keep, F.explode(F.from_json(col, LINES)["features"]).alias("f"))
    return rows.where((F.col("f.geometry.type") == "LineString") & (F.size("f.geometry.coordinates") == 2)).select(*keep, F.col("f.geometry.coordinates").alias("coordinates"))
