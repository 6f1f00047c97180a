"""Nearest neighbours by multi-index hashing: learnt rotated binary codes, indexed by their 16-bit substrings."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stage
from .vectors import digests, dots, sizes_of, usable

BITS, WORD, SAMPLE, ROUNDS = 2048, 16, 4096, 8
TABLES = BITS // WORD
#: Vectors in a shard at most, shards that smaller tables are cut into, queries in a block, queries probed together.
SHARD, LEAST_SHARDS, BLOCK, CHUNK = 65536, 6, 32768, 128
#: The share of codes as far away as the neighbours found that must be retrieved, by expectation; the share of a sample's
#: true neighbours that the Hamming radius around a query must hold, and the sample's queries that it is taken from.
TARGET, WITHIN, ASKED = 0.95, 0.9995, 256


def learn_rotations(x: np.ndarray) -> np.ndarray:
    """Projections d x BITS: rotations that bring a sample near the corners of the cube (iterative quantisation), each
    from another random start; as many as the bits need."""
    d = x.shape[1]
    rng = np.random.default_rng(5)
    out = []
    for _ in range(-(-BITS // d)):
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        for _ in range(ROUNDS if len(x) >= d else 0):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ q))
            q = u @ vt
        out.append(q)
    return np.concatenate(out, axis=1)[:, :BITS]


def lifted(x: np.ndarray, longest: float | None) -> np.ndarray:
    """One component more, which makes data vectors equally long (``longest``), so that the largest inner product is
    the smallest angle; queries (None) get 0 there."""
    last = np.zeros(len(x)) if longest is None else np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))
    return np.concatenate((x, last[:, None]), axis=1)


def encode(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as n x TABLES substrings."""
    return np.packbits(x @ rotations > 0, axis=1).view(np.uint16)


@functools.lru_cache(maxsize=WORD + 1)
def masks(flips: int) -> np.ndarray:
    """All substrings with so many bits set."""
    return np.flatnonzero(np.bitwise_count(np.arange(1 << WORD, dtype=np.uint32)) == flips).astype(np.int64)


@functools.lru_cache(maxsize=WORD + 1)
def retrieved(flips: int) -> np.ndarray:
    """The probability that a code at each Hamming distance has a substring in which at most ``flips`` bits differ."""
    share = np.arange(BITS + 1) / BITS
    one = sum(math.comb(WORD, k) * share**k * (1 - share) ** (WORD - k) for k in range(flips + 1))
    return 1 - (1 - np.minimum(one, 1.0)) ** TABLES


class Index:
    """The codes of a shard with a table for each substring position: value -> rows."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.n = codes, len(codes)
        self.order = np.argsort(codes, axis=0, kind="stable").astype(np.int32).T.copy()
        self.first = np.zeros((TABLES, (1 << WORD) + 1), np.int32)
        for t in range(TABLES):
            np.cumsum(np.bincount(codes[:, t], minlength=1 << WORD), out=self.first[t, 1:])

    def probe(self, asked: np.ndarray, flips: int, seen: np.ndarray, which: np.ndarray) -> None:
        """Mark in ``seen[which]`` the rows that have a substring in which just ``flips`` bits differ from the query's."""
        change = masks(flips)
        flat = seen.reshape(-1)
        for t in range(TABLES):
            keys = asked[:, t].astype(np.int64)[:, None] ^ change[None, :]
            a = self.first[t][keys].ravel()
            count = self.first[t][keys + 1].ravel() - a
            hit = np.flatnonzero(count)
            count = count[hit]
            ends = np.cumsum(count)
            if len(ends):
                at = np.arange(ends[-1]) + np.repeat(a[hit] - (ends - count), count)
                flat[np.repeat(which[hit // len(change)] * self.n, count) + self.order[t][at]] = True

    def search(self, asked: np.ndarray, depth: int, slack: int) -> Iterator[tuple[int, np.ndarray, int, int]]:
        """For each query the rows to compare by floats, how many the tables gave, and how many bits were flipped for that.

        The tables give the rows for the query's substrings with up to ``flips`` flipped bits: by the pigeonhole principle
        all codes within the Hamming radius TABLES * (flips + 1) - 1, and more. Their whole codes are compared with the
        query's. ``flips`` grows until ``depth`` rows are found and, of codes as far from the query as the ``depth``
        nearest of them are (plus half the slack), a share of TARGET is retrieved by expectation. Of all that was retrieved the rows within the
        distance of the ``depth``-th nearest plus ``slack`` bits are left."""
        depth = min(depth, self.n)
        whole = self.codes.view(np.uint64)
        for begin in range(0, len(asked), CHUNK):
            pending = np.arange(begin, min(begin + CHUNK, len(asked)))
            seen = np.zeros((len(pending), self.n), bool)
            apart = np.full((len(pending), self.n), BITS + 1, np.int16)
            for flips in range(WORD + 1):
                self.probe(asked[pending], flips, seen, pending - begin)
                again = []
                for i in pending:
                    far = apart[i - begin]
                    fresh = np.flatnonzero(seen[i - begin] & (far > BITS))
                    far[fresh] = np.bitwise_count(whole[fresh] ^ asked[i].view(np.uint64)).sum(axis=1, dtype=np.int16)
                    got = int(seen[i - begin].sum())
                    if got < depth:
                        again.append(i)
                        continue
                    nearest = np.partition(far, depth - 1)[:depth]
                    if got < self.n and retrieved(flips)[np.minimum(nearest + slack // 2, BITS)].mean() < TARGET:
                        again.append(i)
                        continue
                    yield int(i), np.flatnonzero(far <= min(int(nearest.max()) + slack, BITS)), got, flips
                pending = np.array(again, np.int64)
                if not len(pending):
                    break


def learn_slack(x: np.ndarray, codes: np.ndarray, asked: np.ndarray, depth: int) -> int:
    """By how many bits the true neighbours of a sample's vectors (the ``depth`` largest inner products) are beyond the
    ``depth``-th nearest code, but for a share of 1 - WITHIN of them; ``codes`` and ``asked`` are the vectors' codes as data
    and as queries."""
    depth = min(depth, len(x))
    over = []
    for i in range(0, len(x), max(1, len(x) // ASKED)):
        far = np.bitwise_count(codes.view(np.uint64) ^ asked[i].view(np.uint64)).sum(axis=1, dtype=np.int64)
        true = np.argpartition(-(x @ x[i]), depth - 1)[:depth]
        over.append(far[true] - np.partition(far, depth - 1)[depth - 1])
    return max(0, int(np.ceil(np.quantile(np.concatenate(over), WITHIN)))) if over else BITS


def _matrix(col: pd.Series, kind: type) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(kind) if len(col) else np.zeros((0, 1), kind)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of each query row its k nearest by inner product, among all rows but itself.

    Rotations are learnt from at most about ``SAMPLE`` vectors drawn by a hash of the id; all rows are coded and
    indexed. Of equal vectors the k + 1 first by id stand for all on the data side (no other can be among k nearest), and
    one on the query side. Rows are dealt into shards and queries into blocks of bounded size, each pair of which is one
    group: the substring tables give the candidates, whole codes leave those within a Hamming radius, and the original
    vectors of these are compared. How many bits are flipped and how wide the radius is follow the data (see
    ``Index.search`` and ``learn_slack``); there is no limit to either. Scores are in double precision from the original
    components; ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id. Vectors
    of different numbers of components aren't compared with each other. Repeated ids are rows of their own, and repeated
    query rows each get their own result. With fewer than k other vectors all are returned; empty tables give no rows.
    Further columns aren't read.
    """
    spark = vectors.sparkSession
    kind = "double" if vectors.schema[vec_col].dataType.simpleString() == "array<double>" else "float"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("x")))
    rows = stage(rows.select("*", *digests(F.col("x")), F.size("x").alias("d")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in sizes_of(rows):
        out = out.unionByName(_nearest(rows.where(F.col("d") == d), k, kind))
    return out


def _nearest(rows: DataFrame, k: int, kind: str) -> DataFrame:
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    n, nq, longest = rows.agg(F.count("*"), F.count_if("is_query"), F.sqrt(F.max(square))).head()
    part = min(1.0, SAMPLE / n)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 20)) < part * (1 << 20)).select("x").toPandas()
    dim = rows.select(F.size("x")).head()[0]
    x = _matrix(sample["x"], np.float64) if len(sample) else np.zeros((0, dim))
    high = lifted(x, longest)
    rotations = learn_rotations(high).astype(np.float32)
    slack = learn_slack(x, encode(high.astype(np.float32), rotations), encode(lifted(x, None).astype(np.float32), rotations), k + 1)
    shards, parts = max(-(-n // SHARD), min(LEAST_SHARDS, -(-n // 2048))), max(1, -(-nq // BLOCK))
    share = (k + 1) / shards
    depth = min(k + 1, math.ceil(share + 3 * math.sqrt(share)) + 1)  # of the nearest of all, so many lie in a shard at most
    held = rows.sparkSession.sparkContext.broadcast(rotations)  # (d + 1) x BITS floats
    wide = np.float64 if kind == "double" else np.float32

    copy = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id", "row"))
    place = F.xxhash64("row")
    data = rows.select("row", "vec_id", "x", "h1", "h2").withColumn("copy", copy).where(F.col("copy") <= k + 1).select(
        "row", "vec_id", "x", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    )
    asked = rows.where("is_query").groupBy("h1", "h2").agg(F.min("row").alias("ask"), F.min_by("x", "row").alias("x")).select(
        "h1", "h2", "x", F.pmod(F.xxhash64("ask"), F.lit(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    )

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"h1": [], "h2": [], "row": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            x, q = _matrix(left["x"], wide), _matrix(right["x"], wide)
            ids, row = left["vec_id"].to_numpy(), left["row"].to_numpy()
            codes = np.concatenate([encode(lifted(x[i : i + 4096].astype(np.float32), longest).astype(np.float32), held.value) for i in range(0, len(x), 4096)])
            asks = np.concatenate([encode(lifted(q[i : i + 4096].astype(np.float32), None).astype(np.float32), held.value) for i in range(0, len(q), 4096)])
            rough = x.astype(np.float32)
            for i, found, *_ in Index(codes).search(asks, depth, slack):
                score = rough[found] @ q[i].astype(np.float32)
                if len(found) > k + 1:
                    least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    found = found[score >= least - 1e-4 * max(longest, 1e-30) * float(np.linalg.norm(q[i]))]
                exact = dots(x[found], np.broadcast_to(q[i], (len(found), q.shape[1])))
                best = np.lexsort((row[found], ids[found], -exact))[: k + 1]
                for c, v in zip(out, (np.full(len(best), right["h1"].iat[i]), np.full(len(best), right["h2"].iat[i]), row[found[best]], ids[found[best]], exact[best]), strict=True):
                    out[c].append(v)
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, float if c == "score" else np.int64) for c, v in out.items()})

    found = data.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(cell, "h1 long, h2 long, row long, vec_id long, score double")
    order = [F.desc("score"), F.col("vec_id"), F.col("row")]
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("h1", "h2").orderBy(*order))).where(F.col("rank") <= k + 1).drop("rank")
    best = stage(best, "nearest")
    own = rows.where("is_query").select("h1", "h2", F.col("row").alias("own"), F.col("vec_id").alias("query_id"))
    each = own.join(best, ["h1", "h2"]).where("row <> own")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("own").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
