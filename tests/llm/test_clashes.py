"""Columns that carry the operators' own names, ids beyond 2^53 beside null ids, rows that repeat an id."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from roadflow.llm import language, mixing, pieces, secrets, toxicity

from .test_llm import DOCS, docs, odd, words

NAMES = ("times", "epoch", "_base", "_left", "tox_score", "n_tokens", "ids", "decoded", "secret_spans", "mark", "_part", "_bits", "_kept", "_place", "_skey", "_fate", "_epoch", "target", "Taken", "kept", "component_id", "a.b")


def clashing(spark):
    return odd(spark).drop("size", "hub", "rep", "row", "key", "n").withColumns({c: F.lit("x") for c in NAMES})


@pytest.mark.parametrize("stage", ["drop_toxic", "drop_near_duplicates", "redact_secrets", "mix_by_source", "encode_pieces"])
def test_stages_keep_foreign_columns(spark, sf_dir, stage):
    import corpus_pipeline as p

    d = clashing(spark)
    got = getattr(p, stage)(spark, d, sf_dir)
    rows = got.collect()
    assert rows
    if stage != "encode_pieces":
        assert got.columns == d.columns and all(r[c] == "x" for r in rows for c in NAMES)


def test_operators_replace_columns_of_their_own_names(spark):
    d = clashing(spark)
    model = toxicity.train(d, spark.createDataFrame([(5, 1), (6, 0)], "doc_id long, toxic int"))
    assert {type(r.tox_score) for r in toxicity.score(d, model).collect()} == {float}
    got = pieces.tokenised(d, pieces.default_model())
    assert got.columns.count("n_tokens") == 1 and got.where("decoded").count() == 8
    assert secrets.scan_secrets(d).columns.count("secret_spans") == 1
    assert mixing.mix_sources(d).count() == 8


def test_large_ids_beside_null_ids(spark):
    big = 2**60 + 1
    d = spark.createDataFrame([(big, "the text", "en", "a", 1), (None, "other", "en", "a", 1)], DOCS)
    model = toxicity.train(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.doc_id for r in toxicity.score(d, model).collect()} == {big, None}
    assert {r.doc_id for r in language.predict(d, language.train(d)).collect()} == {big, None}
    assert {r.doc_id for r in pieces.tokenised(d, pieces.default_model()).collect()} == {big, None}


def test_one_row_of_a_repeated_id_stays_and_the_same_each_time(spark, sf_dir):
    import corpus_pipeline as p

    texts = [f"row {i} with " + " ".join(f"w{i}x{k}" for k in range(8)) for i in range(6)]
    d = docs(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") < 3, F.lit(1).cast("long")).otherwise(F.col("doc_id")))
    once = p.drop_near_duplicates(spark, d, sf_dir).collect()
    again = p.drop_near_duplicates(spark, d.repartition(3, "text").orderBy(F.desc("text")), sf_dir).collect()
    assert sorted(once) == sorted(again) and sorted(r.doc_id for r in once) == [1, 3, 4, 5]


def test_mixed_rows_are_those_of_the_plan(spark):
    rng = random.Random(5)
    rows = [(i if i % 7 else None, f"d{i} " + "w " * rng.randint(0, 40), None, f"s{i % 5}" if i % 9 else None, 1) for i in range(700)]
    d = spark.createDataFrame(rows, DOCS)
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix_sources(d.where("doc_id IS NOT NULL")).collect()}
    got = mixing.mixed(d.where("doc_id IS NOT NULL")).groupBy("doc_id", "text").count().collect()
    n = {r.doc_id: r["count"] for r in got}
    assert all(n.get(i, 0) * s == t for i, (t, s) in taken.items())
    plan = mixing.mix_sources(d).agg(F.sum("taken")).head()[0]
    assert sum(len(words(r.text)) for r in mixing.mixed(d).select("text").collect()) == plan
