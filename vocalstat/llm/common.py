"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of the columns that an operator adds while it works, against clashes with a table's own.
TMP = "__vs_"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def map_rows(df: DataFrame, fn: Callable[..., dict], schema: str, *inputs: str) -> DataFrame:
    """``fn`` gets the input columns of an Arrow batch as lists and returns the output columns as lists."""
    wanted = [f.name for f in df.sparkSession.createDataFrame([], schema).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(*[batch.column(c).to_pylist() for c in inputs])
            yield pa.RecordBatch.from_pydict({c: out[c] for c in wanted}, schema=arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow_schema = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    return df.select(*inputs).mapInArrow(run, schema)


def row_hash(name: str = "text") -> Column:
    """Tells rows that share a doc_id apart by their text."""
    return F.xxhash64(whole_text(name))


def keep_rows(docs: DataFrame, lost: DataFrame, tied: DataFrame) -> DataFrame:
    """``docs`` without the (doc_id, text hash) of ``lost``; of those in ``tied`` one row each.

    ``lost`` and ``tied`` have the columns TMP+"id" and TMP+"h", no row twice. ``tied`` holds
    rows that are repeated as a whole (same id and text), so that it is empty for most tables
    and AQE then skips its branch. Null ids are compared null-safe.
    """
    cols = docs.columns
    d = docs.withColumns({f"{TMP}did": F.col("doc_id"), f"{TMP}dh": row_hash()})
    on = lambda t: F.col(f"{TMP}did").eqNullSafe(t[f"{TMP}id"]) & (F.col(f"{TMP}dh") == t[f"{TMP}h"])
    both = lost.select(f"{TMP}id", f"{TMP}h").unionByName(tied.select(f"{TMP}id", f"{TMP}h"))
    once = d.join(tied, on(tied), "left_semi").dropDuplicates([f"{TMP}did", f"{TMP}dh"])
    return d.join(both, on(both), "left_anti").unionByName(once).select(*[d[f"`{c}`"] for c in cols])
