"""Toxicity by a factorization machine over hashed terms: linear weights and learned pairwise interactions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import of_texts
from .textvec import NOT_LETTERS, U, Block, blocks

DIM_BITS = 20
#: A term is a word or its first so many bytes.
PREFIXES = (4, 5, 6, 7, 8)
#: At most about so many labelled rows of each class are used to fit; of larger tables a hash takes a sample.
MOST_TOXIC, MOST_CLEAN = 4000, 6000
LEAST_DOCS, LEAST_CHI2 = 5, 8.0
#: Terms that may be chosen by chance, expected over all terms that are tried.
CHANCE = 1.0
FACTORS, STEPS, RATE, DECAY = 4, 200, 0.05, 2e-4
THRESHOLD = 0.3
_SALT = [U(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1) for k in range(len(PREFIXES) + 1)]


def terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each term of the block's texts, with repeats."""
    s, e, row = block.words(NOT_LETTERS)
    shift = U(64 - DIM_BITS)
    rows, buckets = [row], [(block.hashes(s, e) ^ _SALT[0]) >> shift]
    for k, n in enumerate(PREFIXES, 1):
        long = e - s > n
        s1 = s[long]
        rows.append(row[long])
        buckets.append((block.hashes(s1, s1 + n) ^ _SALT[k]) >> shift)
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


@dataclass
class Model:
    index: np.ndarray  # bucket -> place in the tables below, or -1
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of n texts from the rows and buckets of their terms."""
        at = self.index[buckets]
        hit = at >= 0
        key = np.unique(rows[hit] * len(self.linear) + at[hit]) if hit.any() else np.zeros(0, np.int64)
        row, at = (key // len(self.linear), key % len(self.linear)) if len(key) else (key, key)
        logit = self.bias + np.bincount(row, self.linear[at], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            logit += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def least_chi2(tried: int) -> float:
    """The chi-square (one degree of freedom) that CHANCE of so many unrelated terms reach; the more terms are tried, the
    more each has to show."""
    least = LEAST_CHI2
    while math.erfc(math.sqrt(least / 2)) * tried > CHANCE:
        least += 0.25
    return least


def choose(bucket: np.ndarray, df: np.ndarray, toxic: np.ndarray, n: int, n1: int) -> np.ndarray:
    """Table bucket -> place in the model (or -1): the buckets of LEAST_DOCS texts or more that go with the label, beyond
    what chance gives among so many."""
    df, toxic = df.astype(float), toxic.astype(float)
    index = np.full(1 << DIM_BITS, -1, np.int32)
    if 0 < n1 < n:
        expect = (df * n1 / n, df * (n - n1) / n, (n - df) * n1 / n, (n - df) * (n - n1) / n)
        chi2 = (toxic - expect[0]) ** 2 * sum(1 / np.maximum(x, 1e-9) for x in expect)
        chosen = np.sort(bucket[(df >= LEAST_DOCS) & (chi2 >= least_chi2(int((df >= LEAST_DOCS).sum())))])
        index[chosen] = np.arange(len(chosen))
    return index


def fit(kept: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, index: np.ndarray) -> Model:
    """Weights and factors by Adam, from the places (of ``index``) of each text's terms."""
    m = int(index.max()) + 1
    prior = float((weights * labels).sum() / max(weights.sum(), 1e-9))
    bias = float(np.log((prior + 1e-4) / (1 - prior + 1e-4)))
    if not m:
        return Model(index, bias, np.zeros(1), np.zeros((1, FACTORS)))
    row = np.repeat(np.arange(len(kept)), [len(x) for x in kept])
    at = np.concatenate(kept).astype(np.int64)
    rows = len(kept)
    rng = np.random.default_rng(7)
    params = {"b": np.array([bias]), "w": np.zeros(m), "v": rng.normal(0, 0.02, (m, FACTORS))}
    first = {k: np.zeros_like(p) for k, p in params.items()}
    second = {k: np.zeros_like(p) for k, p in params.items()}
    share = weights / weights.sum()
    for t in range(1, STEPS + 1):
        w, v = params["w"], params["v"]
        sums = np.stack([np.bincount(row, v[at, f], rows) for f in range(FACTORS)], axis=1)
        squares = np.stack([np.bincount(row, v[at, f] ** 2, rows) for f in range(FACTORS)], axis=1)
        logit = params["b"] + np.bincount(row, w[at], rows) + 0.5 * (sums**2 - squares).sum(axis=1)
        error = share * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels)
        reach = np.bincount(at, error[row], m)
        grad = {
            "b": np.array([error.sum()]),
            "w": reach + DECAY * w,
            "v": np.stack([np.bincount(at, error[row] * sums[row, f], m) for f in range(FACTORS)], axis=1)
            - v * reach[:, None] + DECAY * v,
        }
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return Model(index, float(params["b"][0]), params["w"], params["v"])


def bags(texts: list[str | None]) -> list[np.ndarray]:
    """Distinct buckets of each text's terms."""
    row, bucket = terms(Block(texts))
    key = np.unique((row << DIM_BITS) + bucket)
    cut = np.searchsorted(key, np.arange(len(texts) + 1) << DIM_BITS)
    at = (key & (1 << DIM_BITS) - 1).astype(np.int32)
    return [at[p:q] for p, q in zip(cut[:-1], cut[1:], strict=True)]


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts and toxic texts with each bucket, by block; bucket -1 counts all."""
    for pdf in frames:
        texts, label = pdf["text"].tolist(), pdf["toxic"].to_numpy(bool)
        for i, j in blocks(texts):
            found = bags(texts[i:j])
            bucket, at = np.unique(np.concatenate(found), return_inverse=True)
            toxic = np.repeat(label[i:j], [len(x) for x in found])
            yield pd.DataFrame({
                "bucket": np.append(bucket, -1).astype(np.int32), "df": np.append(np.bincount(at, minlength=len(bucket)), j - i),
                "toxic": np.append(np.bincount(at[toxic], minlength=len(bucket)), label[i:j].sum()),
            })


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    The fit reads a sample of bounded size (``most_toxic`` and ``most_clean`` rows, give or take the sampling), drawn
    by a hash of the id. Its terms are counted on the executors; the counts of frequent buckets (of which there are
    2^20 at most) and the chosen terms of the sample's rows come to the driver. Rows without label are left out;
    of several labels of a document the largest counts. Without labels of both kinds the model has a bias only.
    """
    y = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in y.groupBy("toxic").count().collect()}
    keep = {c: min(1.0, most / max(counts.get(c, 0), 1)) for c, most in ((1, most_toxic), (0, most_clean))}
    u = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) / float(1 << 20)
    y = y.where(u < F.when(F.col("toxic") == 1, keep[1]).otherwise(keep[0]))
    sample = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")  # as bounded as the sample
    counts = sample.mapInPandas(_counts, "bucket int, df long, toxic long").groupBy("bucket").agg(F.sum("df").alias("df"), F.sum("toxic").alias("toxic"))
    c = counts.where((F.col("df") >= LEAST_DOCS) | (F.col("bucket") < 0)).toPandas()
    all_, c = c[c["bucket"] < 0], c[c["bucket"] >= 0]
    index = choose(c["bucket"].to_numpy(), c["df"].to_numpy(), c["toxic"].to_numpy(), int(all_["df"].sum()), int(all_["toxic"].sum()))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def chosen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = pdf["text"].tolist()
            for i, j in blocks(texts):
                part = pdf.iloc[i:j]
                at = [shared.value[b] for b in bags(texts[i:j])]
                yield pd.DataFrame({"doc_id": part["doc_id"].values, "toxic": part["toxic"].values, "kept": [x[x >= 0] for x in at]})

    rows = sample.mapInPandas(chosen, "doc_id long, toxic int, kept array<int>").toPandas().sort_values("doc_id")
    label = rows["toxic"].to_numpy(np.int64)
    weight = np.where(label == 1, 1 / keep[1], 1 / keep[0])
    return fit([np.asarray(b, np.int32) for b in rows["kept"]], label, weight, index)


def score(docs: DataFrame, model: Model, into: str = "tox_score", text_col: str = "text") -> DataFrame:
    """The documents with the column ``into``: one pass over whole texts, no shuffle; null or empty texts get the bias's
    score. A column of that name in the input is replaced; all others stay as they are.

    The broadcast model has a fixed size (one integer a bucket, and the chosen buckets' weights).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        m = shared.value
        return lambda texts: pd.Series(m.scores(*terms(Block(texts)), len(texts)) if texts else [], dtype=float)

    return of_texts(docs, text_col, into, "double", begin)


def fit_rows(ident) -> "F.Column":
    """Rows that labels may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(4)) != 2
