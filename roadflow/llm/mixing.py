"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import fresh, stage, unstage

LEVELS, BITS = 3, 12


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_level(key: Column, level: int) -> Column:
    """Bits ``12 * level`` to ``12 * level + 11`` of the key's md5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 3 * level + 1, 3), 16, 10).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``skey, source_size, target`` from ``skey, size``: targets by weight, none above ``most`` times its
    source's size, the excess shared again by weight (water level in closed form).

    ``skey`` orders the sources; the weights repeat along them. One row a source is gathered, which
    grows with the number of sources and not with the documents.
    """
    s = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name, by_room = Window.orderBy("skey"), Window.orderBy("room", "skey")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    s = (
        s.withColumn("w", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("room", F.col("cap") / F.col("w"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("w_left"))
    )
    water = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "skey", "level"))).over(everything)
    return s.select("skey", "source_size", F.least("cap", F.col("w") * water["level"]).alias("target"))


def _keys(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """Source key (ordered, null last), size and hash levels of a document."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    return {
        "skey": F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col))),
        "size": word_count(F.col(text_col)),
        **{f"h{k}": hash_level(ident, k) for k in range(LEVELS)},
    }


def _mark(of: Callable[[str], Column]) -> Column:
    return F.concat_ws("", *[F.lpad(of(f"h{k}").cast("string"), 4, "0") for k in range(LEVELS)])


def _fates(base: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """One staged row a source: what it has, its target, whole epochs, and the hash up to which documents are taken once
    more (``edge``, itself included if ``with_edge``)."""
    targets = source_targets(base, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = stage(
        targets.withColumn("full", whole.cast("long")).withColumn(
            "budget", F.col("target") - F.col("full") * F.col("source_size")
        ),
        "targets",
    )
    # Boundary bucket of each level, and the budget that is left before it.
    bound, used = plan.select("skey", F.col("budget").alias("rest")), [plan]
    inside = base.where("size > 0")
    for k in range(LEVELS):
        keys = ["skey", *[f"h{i}" for i in range(k)]]
        histogram = inside.join(bound, keys).groupBy(*keys, "rest", f"h{k}").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy(*keys).orderBy(f"h{k}"))
        nearest = stage(
            histogram.withColumn("upto", upto)
            .where("upto > rest")
            .groupBy(*keys)
            .agg(F.min(F.struct(f"h{k}", "upto", "words", "rest")).alias("b"))
            .select(
                *keys,
                F.col(f"b.h{k}").alias(f"h{k}"),
                (F.col("b.rest") - (F.col("b.upto") - F.col("b.words"))).alias("rest"),
                F.col("b.words").alias("words"),
            ),
            "bound",
        )
        used.append(nearest)
        bound = nearest.select(*keys, f"h{k}", "rest")
    edges = nearest.select("skey", _mark(F.col).alias("edge"), (F.col("rest") * 2 > F.col("words")).alias("with_edge"))
    fates = stage(
        plan.join(edges, "skey", "left").select(
            "skey", "source_size", "target", "full", F.coalesce("edge", F.lit("~")).alias("edge"), F.coalesce("with_edge", F.lit(False)).alias("with_edge")
        ),
        "fates",
    )
    unstage(*used)
    return fates


def _epochs(mark: Column, of: Callable[[str], Column], most: float) -> Column:
    """How often a document is taken: whole epochs, and once more below the edge."""
    extra = (mark < of("edge")) | ((mark == of("edge")) & of("with_edge"))
    return of("full") + F.when(extra & (of("full") < most), 1).otherwise(0)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row a document: ``doc_id, size, source_size, target, taken``.

    Every document is taken ``floor(target / source_size)`` times; what is left of the target goes to the
    documents of smallest hash. The threshold is found by histograms: words are summed by source and
    hash bucket, the bucket in which the budget ends is refined by the next bits, and after the last
    level the boundary bucket (36 equal bits) is taken if that brings the source nearer to its target.
    Nothing is sorted by document and no group is gathered: all sums are partial aggregates.

    Null texts have size 0; a null source is a source of its own, last in order; rows that repeat an id
    share its fate; a null id is hashed by its text. Empty tables give no rows. Only the three named
    columns are read, so further columns can't clash.
    """
    base = stage(docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in _keys(docs, id_col, text_col, source_col).items()]), "mix")
    fates = _fates(base, weights, most)
    return base.join(fates, "skey").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * _epochs(_mark(F.col), F.col, most)).cast("long").alias("taken"),
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents themselves, each as often as ``mix_sources`` takes it (documents without words once); columns as
    they are. The fate of a source is joined to its documents where they lie: texts aren't shuffled as long as the
    table of sources is small enough to broadcast, which Spark decides by its size."""
    keys = _keys(docs, id_col, text_col, source_col)
    base = stage(docs.select(*[c.alias(n) for n, c in keys.items()]), "mix")
    fates = _fates(base, weights, most)
    skey, fate, epoch = fresh(docs, "_skey"), fresh(docs, "_fate"), fresh(docs, "_epoch")
    unstage(base)
    found = docs.withColumn(skey, keys["skey"]).join(fates.select(F.col("skey").alias(skey), F.struct("full", "edge", "with_edge").alias(fate)), skey)
    of = lambda n: keys[n] if n in keys else F.col(fate)[n]
    times = F.when(keys["size"] > 0, _epochs(_mark(of), of, most)).otherwise(1).cast("int")
    taken = found.withColumn(epoch, times).where(F.col(epoch) > 0)
    return taken.withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(epoch)))).select(*[F.col(f"`{c}`") for c in docs.columns])
