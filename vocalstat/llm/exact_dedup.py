"""Exact dedup over a persistent digest index, bucketed and sorted by hash.

The index is a bucketed Parquet table of versions (digest, keep_id); a digest's id is the largest
of its versions. New rows are reduced to one row a digest with map-side combine and anti-joined
against the index on the bucket key (the index side of the sort-merge join needs no shuffle): a
digest that the index lacks, or has with smaller ids only, is appended. So batches may come in
any order of ids, to an index that outlives the session; a second run over the same rows finds
all of them and appends nothing, so a batch can be repeated after a failure.

Defined cases: null text counts as empty; the empty text is a text like any other; texts of any
length go through the same SHA-256; of equal texts the largest doc_id stays, null ids only when
there is no other; a row repeated with its id stays once; empty tables give empty results;
further columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import TMP, keep_rows, load, row_hash, whole_text
from vocalstat.session import materialize, scratch_path

#: Equal rows that are written at once.
COPIES = 4096


class DigestIndex:
    """A digest index at ``path``; an existing one is opened with its data."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, table: str | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = table or f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        """(digest, keep_id): the largest id of each digest; grouped within the buckets."""
        return self.spark.table(self.table).groupBy("digest").agg(F.max("keep_id").alias("keep_id"))

    def append(self, digests: DataFrame) -> None:
        """Add the digests of (doc_id, digest) rows that the index lacks or has with smaller ids, each with its largest doc_id."""
        # written first: the optimizer would else push the anti-join below the grouping, onto every copy
        batch = materialize(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "batch").alias("b")
        held = self.spark.table(self.table).hint("merge").alias("i")
        known = (F.col("b.digest") == F.col("i.digest")) & (F.col("b.keep_id").isNull() | (F.col("i.keep_id") >= F.col("b.keep_id")))
        new = batch.join(held, known, "left_anti")
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
            .select("digest", "keep_id").write.mode("append").insertInto(self.table))

    def close(self) -> None:
        """Take the index's name out of the catalog; its files stay at ``path``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def text_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, h, copies): one row per id and SHA-256 of the whole text."""
    return (docs.select("doc_id", F.unhex(F.sha2(whole_text().cast("binary"), 256)).alias("digest"), row_hash().alias("h"))
            .groupBy("doc_id", "digest", "h").agg(F.count(F.lit(1)).alias("copies")))


def indexed_groups(rows: DataFrame, batches: int = 2, buckets: int | None = None) -> DataFrame:
    """(digest, keep_id, group_size) of the digests of ``rows``.

    The rows arrive at an index in ``batches`` ranges of doc_id, the smallest ids first, as
    new documents do.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)] or [0.5])).first()[0] or []
    step = sum((F.when(F.col("doc_id") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets)
    for k in range(len(cuts) + 1):
        index.append(rows.where(step == k))
    sizes = rows.groupBy("digest").agg(F.sum("copies").alias("group_size"))
    # a table of its own, so that AQE can split a digest that many rows share where rows meet it
    groups = materialize(sizes.join(index.rows(), "digest"), "groups")
    index.close()
    return groups


def exact_groups(docs: DataFrame, batches: int = 2, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    rows = materialize(text_digests(docs), "digests")
    out = rows.join(indexed_groups(rows, batches, buckets), "digest")
    # rows that are equal in id and text come back by blocks, so that no array is as long as their number
    first = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(COPIES).cast("long")))
    out = out.withColumn("first", first).withColumn("copy", F.explode(F.sequence("first", F.least(F.col("copies"), F.col("first") + COPIES - 1))))
    return out.select(
        "doc_id", "digest", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each text stays, that with the largest doc_id; columns as in ``docs``."""
    rows = materialize(text_digests(docs), "digests")
    shared = rows.join(indexed_groups(rows).where("group_size > 1"), "digest").select(
        F.col("doc_id").alias(f"{TMP}id"), F.col("h").alias(f"{TMP}h"), "copies", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("won"))
    shared = materialize(shared, "copies")
    return keep_rows(docs, shared.where("NOT won"), shared.where("won AND copies > 1"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id that stays for its text, over the whole ``documents``."""
    return exact_groups(load(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
