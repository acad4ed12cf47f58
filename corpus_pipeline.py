"""A corpus in five stages: toxic documents out, one of each near-duplicate group, benchmark passages out, sources mixed to weights, ids written.

Every stage takes the rows that its predecessor kept, written as Parquet and read again; all but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanlink.llm import decontaminate, mixing, similar, simhash, tokens, toxicity
from spanlink.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents, keep what scores below the threshold."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within the radius; then of those with five-word similarity of 0.8, which differ in more bits."""
    return similar.without_similar(materialize(simhash.one_of_each(docs)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as often as the mix takes them."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from the files."""
    written, _ = tokens.encode_documents(docs)
    return tokens.digest(tokens.read_archive(written))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix),
    ("token_output", write_tokens),
]

#: Models, fingerprints and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else materialize(docs), sf_dir)
    return docs
