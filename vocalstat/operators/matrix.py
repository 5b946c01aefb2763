"""Cross-dataset results A39-A41 and the configuration row K14."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import hours, version_column
from vocalstat.operators import stats


def support_cells(split_stats: DataFrame, versions: Sequence[str] | None = dims.VERSIONS,
                  validated: str = "validated") -> DataFrame:
    """A39 cells: (lc, ver, cell) with cell = hours '|' algorithms, null without algorithm.

    Hours come from the validated bucket's dur_total (one decimal, '0' when
    unknown); algorithms are the sorted distinct non-empty ``alg`` values.
    """
    s = split_stats.where(F.col("ver").isin(*versions)) if versions is not None else split_stats
    algs = (s.where(F.col("alg").isNotNull() & (F.col("alg") != F.lit("")))
            .groupBy("lc", "ver").agg(F.array_sort(F.collect_set("alg")).alias("_algs")))
    val = (s.where((F.coalesce(F.col("alg"), F.lit("")) == F.lit("")) & (F.col("sp") == F.lit(validated)))
           .groupBy("lc", "ver").agg(F.max("dur_total").alias("_dur")))
    j = algs.join(val, ["lc", "ver"], "left")
    h = F.when(F.col("_dur") >= 0, hours("_dur").cast("string")).otherwise(F.lit("0"))
    cell = F.concat(h, F.lit(dims.SEP_ALGO), F.array_join("_algs", dims.SEP_ALGO))
    return j.select("lc", "ver", cell.alias("cell"))


def support_matrix(cells: DataFrame, locales: DataFrame, versions: Sequence[str] = dims.VERSIONS) -> DataFrame:
    """A39 wide: one row per locale (all locales, left join), one column per version,
    newest first; ``lang`` stays null. Pivot values are the fixed version list,
    so no extra pass computes them."""
    cols = [dims.version_column(v) for v in reversed(list(versions))]
    wide = (cells.withColumn("vcol", version_column("ver"))
            .groupBy("lc").pivot("vcol", cols).agg(F.first("cell")))
    out = locales.select("lc").distinct().join(wide, "lc", "left")
    return out.select("lc", F.lit(None).cast("string").alias("lang"), *cols)


def combined_counts(split_stats: DataFrame) -> DataFrame:
    """Totals over the combined split statistics (rows, locales, algorithm rows)."""
    algo_rows = (split_stats.where(F.col("alg").isNotNull() & (F.col("alg") != F.lit("")))
                 .select("ver", "lc", "alg").distinct().agg(F.count(F.lit(1)).alias("total_algo")))
    base = split_stats.agg(F.count(F.lit(1)).alias("total_splits"), F.count_distinct("lc").alias("total_lc"))
    return stats.join_groups(base, algo_rows, [])  # two one-row totals


def run_counters(work: DataFrame, phase: str = "phase", status: str = "status") -> DataFrame:
    """Per phase, total / processed / exists / no data from a work list with a status column."""
    return work.groupBy(phase).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(status) == "processed").alias("processed"),
        F.count_if(F.col(status) == "exists").alias("exists"),
        F.count_if(F.col(status) == "nodata").alias("nodata"))


def config_row(spark: SparkSession, locales: Sequence[str], date: str) -> DataFrame:
    """The one-row configuration (versions, dates, locales, algorithms, bins)."""
    row = {"date": date, "cv_versions": list(dims.VERSIONS), "cv_dates": list(dims.VERSION_DATES),
           "cv_locales": list(locales), "algorithms": list(dims.ALGORITHMS),
           "cs_threshold": bins.CS_THRESHOLD, "ch_threshold": bins.CHARS_THRESHOLD,
           "bins_reasons": list(dims.REPORT_REASONS_ALL), **bins.trimmed_for_config()}
    return spark.createDataFrame([row])
