"""Whitening against a plain covariance, and its odd cases."""

from __future__ import annotations

import numpy as np
import pandas as pd

from roadflow.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(ids, vectors, most=32):
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    centred = np.array([[n * a - b for a, b in zip(r, s, strict=True)] for r in x], dtype=object)
    v = np.array([[int(sum(centred[:, i] * centred[:, j])) / n**3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return (centred.astype(float) / n) @ u / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(v), [int(sum(r * r)) for r in centred]


def matches(got: pd.DataFrame, ids, vectors):
    white, explained, deviation = plain(ids, vectors)
    k = white.shape[1]
    got = got.sort_values(["vec_id", "component"], kind="stable")
    order = np.argsort(ids, kind="stable")
    mine = got["whitened"].to_numpy().reshape(-1, k)
    sign = np.sign((mine * white[order]).sum(0))
    assert np.abs(mine - white[order] * sign).max() < 1e-6
    assert np.abs(got["explained"].to_numpy().reshape(-1, k) - explained).max() < 1e-9
    assert (got["deviation"].to_numpy().reshape(-1, k) == np.array(deviation)[order][:, None]).all()
    assert set(got["n"]) == {len(ids)} and got["identity_error"].max() < 1e-9 and list(got["component"].unique()) == list(range(1, k + 1))


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    matches(queries.op13_polarisation_whitening(spark, sf_dir).toPandas(), table["vec_id"].to_numpy(), table["embedding"])


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    good = [[float(x) for x in rng.normal(size=5).astype(np.float32)] for _ in range(60)]
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(k, v) for k, v in enumerate(good + [[0.0] * 5, good[0]])]
    frame = spark.createDataFrame(rows + [(1000 + k, v) for k, v in enumerate(odd)], SCHEMA).selectExpr("*", "1 AS ident", "2 AS v", "3 AS d", "4 AS component", "5 AS `a.b`")
    matches(whitening.whiten(frame).toPandas(), np.arange(62), [r[1] for r in rows])


def test_empty_and_flat(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])], SCHEMA)).collect()
    assert len(flat) == 6 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in flat} == {(0, None, 0.0, 0.0)}
    line = whitening.whiten(spark.createDataFrame([(k, [float(k), float(2 * k)]) for k in range(4)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and max(r.identity_error for r in line) < 1e-9


def test_large_entries(spark):
    """Exact beyond 64 bits; a deviation that fits no long is null."""
    rows = [(k, [1e9 * (k % 3), float(k), -3e38 if k == 5 else 0.0]) for k in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 27 and all(r.deviation is None for r in got) and max(r.identity_error for r in got) < 1e-3
