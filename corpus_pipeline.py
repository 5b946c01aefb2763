"""From raw documents to packed sequences: classify, dedup, near-dedup, mix, pack.

Every stage gets all that the one before kept, written as Parquet and read again. All but the
last return rows with the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vocalstat.llm.common import load
from vocalstat.llm.exact_dedup import drop_exact_copies
from vocalstat.llm.mixing import take_mix
from vocalstat.llm.packing import pack_stage
from vocalstat.llm.quality import keep_good
from vocalstat.llm.simhash import drop_near_copies
from vocalstat.session import materialize

STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", take_mix),
    ("best-fit packing", pack_stage),
]

#: Trees, hashes of shingles and token ids have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that the stages keep."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
