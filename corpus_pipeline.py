"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Toxic documents go; one document of each group of near duplicates stays; documents that hold a
benchmark passage go; secrets are replaced by a mark; texts are encoded to packed piece ids.
Null and empty texts pass every filter (they are neither toxic, alike nor contaminated); further
columns of ``documents`` are carried along under names of their own, so none can clash with what a stage
computes (one that has the name of a column the last stage adds comes back as ``<name>_in``); an
empty table gives an empty corpus.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, jaccard, pieces, secrets, toxicity
from strata.llm.common import load
from strata.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs.select("doc_id", "text"), load(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).where("toxicity < 0.5").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(docs, load(spark, sf_dir, "benchmark", "item_id", "text"))
    bad = found.select("doc_id").distinct().withColumnRenamed("doc_id", "__bad")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]), "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.redact(secrets.scan(docs, secrets.fit(docs)))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = pieces.decode(pieces.encode(docs))
    size = len(pieces.load_pieces().texts)
    return (both.withColumn("n_tokens", pieces.n_tokens(size))
            .withColumn("round_trip", F.col("decoded").eqNullSafe(F.col("text"))).drop("decoded"))


CORE = ("doc_id", "text", "n_chars")  # the columns that stages read


def apart(stage):
    """``stage`` with all columns but the core ones renamed while it runs."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = [c for c in docs.columns if c not in CORE]
        hidden = {c: f"__own{i}" for i, c in enumerate(own)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(hidden.get(c, c)) for c in docs.columns]), sf_dir)
        added = [c for c in out.columns if c not in CORE and c not in hidden.values()]
        names = {c: f"{c}_in" if c.lower() in [a.lower() for a in added] else c for c in own}
        return out.select(*[F.col(f"`{hidden.get(c, c)}`").alias(names.get(c, c)) for c in docs.columns], *added)

    return run_stage


STAGES = [(name, apart(stage)) for name, stage in (
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("sentencepiece", encode_pieces),
)]

ORACLE_SQL = None  # trained scores and similarity joins have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
