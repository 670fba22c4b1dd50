"""From raw documents to a training mixture: five stages, each applying one operator.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again before
the next.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm import contamination, language, minhash, mixing, pii
from dockhand.llm.queries import MIX, PII_KEY, WEIGHTS, domain, table
from dockhand.llm.store import bounded, written

SHINGLE, PERCENT = 5, 80
LEAST_SCORE = 0.5  # a language must be likelier than all others together

#: Naive Bayes, sketches, seeds and a Feistel network can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go; a missing lang is filled in."""
    bounded(spark)
    found = language.predict(docs, language.fit(docs), language="found lang", score="found score")
    found = found.where((F.col("found lang") != language.UNKNOWN) & (F.col("found score") >= LEAST_SCORE))
    return found.select(*[F.coalesce("lang", "found lang").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.  Rows with one id
    are one document, of which the first row by text and the other plain columns stays; rows
    without id stay."""
    bounded(spark)
    found = written(minhash.near_duplicates(docs, SHINGLE, PERCENT), "pipeline-near")
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    again = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    docs = docs.join(sent(gone), "doc_id", "left_anti").select(*docs.columns)
    again = written(again, "pipeline-again")
    if again.isEmpty():
        return docs
    once = docs.join(sent(again), "doc_id", "left_anti").select(*docs.columns)
    others = [c for c in docs.columns if c != "doc_id"]
    order = F.struct("text", *[f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name != "text"])
    first = F.min_by(F.struct(*others), order).alias("row")
    repeated = docs.join(sent(again), "doc_id", "left_semi").groupBy("doc_id").agg(first)
    return once.unionByName(repeated.select("doc_id", *[F.col("row")[c].alias(c) for c in others]).select(*docs.columns))


def sent(ids: DataFrame) -> DataFrame:
    """Ids to every executor if they are few enough, else as they are."""
    return F.broadcast(ids) if ids.count() <= minhash.BROADCAST_ROWS else ids


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return contamination.matches(docs, table(spark, sf_dir, "benchmark"), only_clean=True)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become pseudonyms; n_chars follows the text."""
    bounded(spark)
    hidden = pii.pseudonymize(docs, PII_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        hidden = hidden.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return hidden


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row per document and epoch, its text as far as it is taken."""
    mixed = mixing.mix(docs, WEIGHTS, domain=domain(), **MIX)
    return mixed.withColumn("text", mixing.prefix("text"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
