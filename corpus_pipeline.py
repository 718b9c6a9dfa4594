"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; the
columns of documents for all but the last. ``run`` writes each stage's rows as
Parquet into the shared checkpoint folder and reads them for the next stage, so a
lost executor costs one stage's tasks at most. The folder of a run (``pipeline-``
and a random name) is left for whoever keeps the checkpoint folder to remove.

Null texts and empty tables pass through every stage; see the operators for the
result they define.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brightwell.llm import components, minhash, mixing, packing, pii, quality, queries, simhash
from brightwell.llm.common import table
from brightwell.session import checkpoint_folder

#: SQL cannot express a fitted model or a tokenizer; tests hold run() against a plain version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near a language reference."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that of the smallest doc_id. Texts are linked if
    their SimHash fingerprints, found by deletion variants, differ in two bits at most,
    or if the Jaccard similarity of their five-word shingles is 0.8 or more."""
    return components.one_of_each(docs, components.merged(minhash.grouped(docs), simhash.grouped(docs)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return pii.redact(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for every epoch that the target weights give them."""
    return mixing.mixture(docs, queries.MIX)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(packing.pieces(docs, queries.TOKENIZERS))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
