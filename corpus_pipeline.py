"""The corpus pipeline: five operators over all documents, each on what the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every result to the shared folder and
reads it again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadflow.llm import hyperminhash, mixing, pieces, secrets, toxicity
from roadflow.llm.shared import batches_of, fresh, split_by_keys, stage, unstage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, learnt from ``labels``, scores below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    mark = fresh(docs, "tox_score")
    return toxicity.score(docs, model, mark).where(F.col(mark) < toxicity.THRESHOLD).drop(mark)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on five-word shingles.

    Of rows that repeat an id one stays, if that id does: the first by a hash of the text, then of the whole row. Texts
    with an empty set have no duplicates and stay, as do all rows without an id. Only rows that may have to go (a bitmap
    of their ids tells) are shuffled; all others pass as they are.
    """
    found = stage(hyperminhash.near_duplicates(docs, width=5, percent=80).select("doc_id", "kept"), "found")
    suspects = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("c"), F.max("kept").alias("kept")).where("c > 1 OR NOT kept")
    suspects = stage(suspects.select("doc_id", "kept"), "suspects")
    unstage(found)
    maybe, untouched = split_by_keys(docs, "doc_id", suspects.select("doc_id"))
    place, mark = fresh(docs, "_place"), fresh(docs, "_kept")
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not f.dataType.simpleString().count("map<")])
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), row)
    one = maybe.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    judged = one.join(suspects.withColumnRenamed("kept", mark), "doc_id", "left").where(F.coalesce(mark, F.lit(True)))
    return judged.select([F.col(f"`{c}`") for c in docs.columns]).unionByName(untouched)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars``, where there is such a column, counts the new text."""
    masked = secrets.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select([F.col(f"`{c}`") for c in docs.columns])


def mix_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole epochs, and the hashed share of the last one."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, with their checksum and whether they decode to the text.

    Staged here, so that its Arrow batches can be small: workers that earlier stages have filled leave little room.
    """
    with batches_of(spark, 1000):
        return stage(pieces.tokenised(docs.select("doc_id", "text"), pieces.default_model()).drop("text"), "pieces")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_by_source),
    ("sentencepiece", encode_pieces),
]

#: Trained scores and merges of a vocabulary aren't expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
