"""A training corpus from raw documents: five operators in a row, each on all that the one before kept.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; ``run`` writes it as Parquet to the shared
folder and reads it again for the next stage. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.decontaminate import remove_leaks
from tidemark.llm.linefreq import drop_site_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.simhash import keep_one_of_each
from tidemark.llm.toxicity import remove_toxic
from tidemark.session import cut_lineage

STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", drop_site_lines),
    ("near dedup", keep_one_of_each),
    ("decontamination", remove_leaks),
    ("packing", pack_documents),
]

#: SQL cannot say the stages with a learnt model, Golay keys or token ids; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of a folder to packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
