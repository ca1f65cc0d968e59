"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last return the
columns of ``documents``. Null and empty texts pass the filters, give no words to the mix and so end there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import mixing, ngram_join, packing, secrets, toxicity
from lotwise.sources.scratch import materialize
from lotwise.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below one half. Lexicon and curve come from the labelled rows among ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="_toxicity").where("_toxicity.score < 0.5").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id."""
    return ngram_join.keep_first(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live credentials masked; values that many sources hold are examples and stay."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each round through a source that takes words of a document."""
    return mixing.mix(docs).documents()


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of at most 2048 tokens; a row taken twice is packed twice."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Classifiers, components and tokenizers have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
