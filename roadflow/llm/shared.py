"""Staged tables and connected components, used by several operators of this subpackage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textvec import blocks


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where that is unset, a temporary one on a single machine (master ``local``);
    on a cluster an error, as executors and driver must share the folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of these names, in any case of letters: an operator's own columns replace them."""
    gone = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in gone]
    return df if len(kept) == len(df.columns) else df.select(*[F.col(f"`{c}`") for c in kept])


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and survives a lost executor."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def of_texts(docs: DataFrame, text_col: str, into: str, kind: str, begin: Callable[[], Callable[[list], pd.DataFrame | pd.Series]], most: int = 500_000) -> DataFrame:
    """``docs`` with a column ``into`` that a function of whole texts makes, block by block; ``begin`` gives that function,
    once a task. Only the texts go to the Python workers: all other columns stay as they are, in the JVM. A column of
    that name is replaced."""

    @F.pandas_udf(kind)
    def frames(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = begin()
        for batch in batches:
            texts = batch.tolist()
            yield pd.concat([work(texts[i:j]) for i, j in blocks(texts, most)] or [work([])], ignore_index=True)

    @F.pandas_udf(kind)
    def columns(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        work = begin()
        for batch in batches:
            texts = batch.tolist()
            yield pd.concat([work(texts[i:j]) for i, j in blocks(texts, most)] or [work([])], ignore_index=True)

    text = F.col(f"`{text_col}`")
    made = (frames if kind.startswith("struct") else columns)(text)
    return without(docs, *({into} - {text_col})).withColumn(into, made)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is staged inside: long texts then fit beside each other in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in tables:
        path = getattr(df, "_staged_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


#: Bits of the map that tells which keys may be wanted (2 MB).
BITMAP = 1 << 24


def split_by_keys(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among ``wanted`` (one column of that name), and those whose key surely isn't; nothing is
    shuffled by it. The wanted keys set bits of a map of BITMAP bits, which has a fixed size (a row for each 32768
    bits) and so can be broadcast; a full map puts all rows on the first side. Rows with a null key are on the second."""
    slot = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BITMAP))
    bits = wanted.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(slot).alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    part, map_ = fresh(rows, "_part"), fresh(rows, "_bits")
    bits = stage(bits.select(F.col("_part").alias(part), F.col("_bits").alias(map_)), "bits")
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(map_, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1, F.lit(False)) & F.col(key).isNotNull()
    seen = rows.withColumn(part, F.bitmap_bucket_number(slot)).join(F.broadcast(bits), part, "left")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return seen.where(hit).select(columns), seen.where(~hit).select(columns)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)`` that is not the smallest of its component.

    Each round hooks a node to its smallest neighbour, shortens the chains by pointer jumping and
    contracts the edges; every round drops all nodes but local minima, so the number of rounds is
    logarithmic. Everything stays in tables; hot nodes are aggregated before the shuffle or sit on
    the side of a join that adaptive execution can split. Self links, nulls and repeats don't matter;
    no edges give an empty table.
    """
    e = stage(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    levels: list[DataFrame] = []
    while not e.isEmpty():
        hooks = stage(
            e.select(F.col("b").alias("x"), F.col("a").alias("m"))
            .groupBy("x").agg(F.min("m").alias("m")),
            "hooks",
        )
        while True:
            up = hooks.select(F.col("x").alias("m"), F.col("m").alias("up"))
            jumped = stage(
                hooks.join(up, "m", "left").select(
                    "x", F.coalesce("up", "m").alias("m"), F.col("up").isNotNull().alias("moved")
                ),
                "hooks",
            )
            unstage(hooks)
            hooks = jumped
            if hooks.where("moved").isEmpty():
                break
        levels.append(hooks)
        root = hooks.select("x", "m")
        nxt = stage(
            e.join(root.withColumnRenamed("x", "a").withColumnRenamed("m", "ra"), "a", "left")
            .join(root.withColumnRenamed("x", "b").withColumnRenamed("m", "rb"), "b", "left")
            .select(F.coalesce("ra", "a").alias("p"), F.coalesce("rb", "b").alias("q"))
            .where("p <> q")
            .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
            .distinct(),
            "edges",
        )
        unstage(e)
        e = nxt
    out = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for k, level in enumerate(levels):
        here = level.select(F.col("x").alias("node"), F.col("m").alias("component"))
        if k == 0:
            out = here
            continue
        up = level.select(F.col("x").alias("component"), F.col("m").alias("up"))
        out = out.join(up, "component", "left").select(
            "node", F.coalesce("up", "component").alias("component")
        ).unionByName(here)
    return out
