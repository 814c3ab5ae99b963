"""A corpus from raw documents to token ids, in stages that read and write tables of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm import bpe, jaccard, language, mixing, substring
from ctrflow.llm.common import Scratch, row_keys
from ctrflow.llm.queries import TARGETS, VOCABULARY, find_package, labelled_domains

#: No stage can be written in SQL: they learn models, follow links and merge symbols. Tests compare each with brute force.
ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """The documents with ``row_key``, which every row has for itself: decisions are about rows, not about ids."""
    return row_keys(docs, "doc_id", "text", Scratch(docs.sparkSession, name), nameless=True)[0]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without words, in other languages or in none go."""
    docs = keyed(docs, "language")
    found = language.identify(docs, language.fit_languages(docs), "row_key", declared="lang", host="source")
    return docs.join(found.where("rejected").select("row_key"), "row_key", "left_anti").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group connected by a Jaccard similarity of 0.8 of five-word shingles. Rows that
    share an id and rows without one are compared like others; the latter only stay where no row of their group has an id."""
    docs = keyed(docs, "near")
    found = jaccard.jaccard_components(docs, "row_key", n=5, percent=80)
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias("row_key"))
    return docs.join(copies, "row_key", "left_anti").select(COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 20 words that start earlier; what is left is joined by spaces, untouched texts stay as they
    are, and documents of which nothing is left go. Each row of a repeated id is cut for itself; rows without an id come last."""
    docs = keyed(docs, "cut")
    left = substring.remove_repeats(docs, "row_key").where("n_removed > 0").select(F.col("doc_id").alias("row_key"), "kept")
    text = F.coalesce("kept", "text")
    return docs.join(left, "row_key", "left").where("kept IS NULL OR kept <> ''").select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length("kept").cast("long")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that bring tokens of good, low and toxic documents to their target shares.

    Good documents are taken once; the others are thinned where there are too many of them, and never repeated.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mixing.fit_domains(labelled_domains(docs, labels), list(TARGETS))
    docs = keyed(docs, "mix")
    rates = mixing.fit_rates(docs, model, TARGETS, "row_key", anchor="good")
    gone = rates.where(mixing.taken(F.col("rate"), F.col("row_key")) == 0)
    return docs.join(gone.select("row_key"), "row_key", "left_anti").select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    return bpe.encode_texts(docs, VOCABULARY).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; between stages the documents are a table in the shared folder."""
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.stage(docs, str(i))
    return docs
