"""A corpus pipeline: reject poor texts, drop exact and near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of the documents;
the last returns their token ids. Stages keep rows with nulls: a null text is scored like an empty one, is one class of the
exact copies, links with nothing, and encodes to no ids.

Very long texts go through each stage whole, one row of a task. Equal scores fall on the same side of the classifier's bound; of
equal texts, repeated rows among them, the exact stage leaves one, and of documents of one near-duplicate group that share the
least id all stay. Columns beyond those of documents are carried up to the mix, whatever their names; the encoder keeps the
source. An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm.common import stored, table, tokenizer_path
from shelfline.llm.exact_dedup import distinct_documents
from shelfline.llm.minhash_dedup import one_of_each_group
from shelfline.llm.mixing import mixed_documents
from shelfline.llm.quality_classifier import accepted_documents, train
from shelfline.llm.sentence_pieces import encode_documents


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labelled ones, does not reject."""
    return accepted_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 in shingles of five words, the one with the least id."""
    return one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source, repeated or selected up to its target."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix: doc_id, source, n_tokens, ids."""
    return encode_documents(docs, tokenizer_path("piece_bpe_32k.model"), keep=("source",))


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("source_mix", mix),
    ("sentence_pieces", encode),
]

#: A trained classifier is not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
