"""Documents through quality rules, line dedup, near-dedup, decontamination and mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Between stages
the documents are written as Parquet to the shared folder and read again. What a stage keeps for itself
is removed once its documents are written; the last stage's stays, as its result is computed when read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from plantlens.llm.common import stored, table
from plantlens.registry.core import Query
from plantlens.session import scratch, shared_dir, use_utc

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, learned from the labels, reject are left out."""
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).where("kept").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them."""
    kept = line_dedup.clean(docs, line_dedup.start(docs, min_docs=10))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id.

    Documents are near copies as `op4_simhash` says: fingerprints of three-word shingles that differ
    in at most three bits, linked on.
    """
    found = simhash.near_duplicates(docs)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.where(first).dropDuplicates(["doc_id", "simhash"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text are left out."""
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have tempered shares of the tokens."""
    mixed = mixing.mix(docs, POWERS).where("n_copies > 0")
    return mixed.select(*COLUMNS, "topic", "n_tokens", "probability", "n_copies")


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(use_utc(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        if i == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        label = name.replace(" ", "-")
        path = shared_dir(spark, label)
        with scratch(spark, f"work-{label}"):
            docs = stored(stage(spark, docs, sf_dir), label, path)
    return docs


QUERY = Query(run, ORACLE_SQL)
