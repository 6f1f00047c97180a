"""Near duplicates: large canopies whose members are near each other but not near the hub; limits of the operator."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from roadflow.llm import hyperminhash, shared

from .test_llm import components, docs, shingles


def test_members_far_from_the_hub_find_each_other(spark, monkeypatch):
    """Chains of edits: ends of a chain are below the threshold, neighbours above; all in few canopies."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(160)]
    texts = []
    for chain in range(4):
        now = list(base)
        for k in range(25):
            texts.append(" ".join(now))
            now[(chain * 40 + 3 * k) % 160] = f"c{chain}k{k}"
            now[(chain * 40 + 3 * k + 70) % 160] = f"d{chain}k{k}"
    monkeypatch.setattr(hyperminhash, "BLOCK", 12)
    got = hyperminhash.near_duplicates(docs(spark, texts), width=2).orderBy("doc_id").toPandas()
    sets = [shingles(t, 2) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert got.component_id.tolist() == components(len(texts), links)


def test_percent_below_80_is_refused(spark):
    with pytest.raises(ValueError):
        hyperminhash.near_duplicates(docs(spark, ["a b"]), percent=70)


def test_split_by_keys_is_whole(spark):
    rows = spark.range(5000).withColumn("_part", F.lit("x"))
    maybe, surely_not = shared.split_by_keys(rows, "id", spark.range(0, 5000, 50).toDF("id"))
    assert maybe.columns == surely_not.columns == rows.columns
    assert maybe.count() + surely_not.count() == 5000 and 100 <= maybe.count() <= 130
    assert surely_not.where("id % 50 = 0").count() == 0
    assert shared.split_by_keys(rows, "id", spark.range(0).toDF("id"))[1].count() == 5000
