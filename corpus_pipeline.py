"""Corpus preparation: five stages over the table of documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``docs``.  ``run`` writes each stage's result as
Parquet below the shared checkpoint folder and reads it as the next one's input.
"""

from __future__ import annotations

from tidemark.llm.common import documents, prepare, staged
from tidemark.llm.decontaminate import uncontaminated
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.quality_rules import rejected_rows_removed
from tidemark.llm.sharding import sharded
from tidemark.llm.simhash_dedup import one_per_group


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or their host's verdict reject go."""
    prepare(spark)
    return rejected_rows_removed(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each SimHash component stays (4-word shingles, 4 bits)."""
    prepare(spark)
    return one_per_group(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark passage go."""
    prepare(spark)
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark, docs, sf_dir):
    """Sources are drawn to their target weights; taken documents repeat as often as they are taken."""
    prepare(spark)
    return mixed_documents(docs)


def sharding(spark, docs, sf_dir):
    """Rows get a shard and a slot; equal texts share a shard."""
    prepare(spark)
    return sharded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The draw of the mix and the fingerprints are not SQL; tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
