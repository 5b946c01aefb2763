"""Reported-sentence statistics A20-A23, keys (ver, lc)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.operators import stats
from vocalstat.operators.splits import per_item_stats

KEYS = ["ver", "lc"]


def reason_label(reason: str = "reason", base: Sequence[str] = dims.REPORT_REASONS) -> F.Column:
    """reasons outside the base list (and null) become ``other``."""
    return F.when(F.col(reason).isin(*base), F.col(reason)).otherwise(F.lit(dims.OTHER))


def report_counts(df: DataFrame, keys: Sequence[str] = KEYS, sentence_id: str = "sentence_id") -> DataFrame:
    """rep_sum (reports), rep_sen (distinct sentences, null counted once)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rep_sum"),
                                 stats.distinct_with_null(sentence_id).alias("rep_sen"))


def reports_per_sentence(df: DataFrame, keys: Sequence[str] = KEYS,
                         sentence_id: str = "sentence_id") -> tuple[DataFrame, DataFrame]:
    """avg/med/std of reports per sentence + histogram (first bin dropped)."""
    return per_item_stats(df, keys, sentence_id, "rep", bins.REPORTED)


def reason_frequency(df: DataFrame, keys: Sequence[str] = KEYS, reason: str = "reason",
                     base: Sequence[str] = dims.REPORT_REASONS) -> DataFrame:
    """Dense (keys, reason_idx, reason, cnt) in the fixed order base + other."""
    labels = list(base) + [dims.OTHER]
    counts = df.groupBy(*keys, reason_label(reason, base).alias("reason")).agg(F.count(F.lit(1)).alias("_c"))
    cells = [F.struct(F.lit(i).alias("reason_idx"), F.lit(r).alias("reason")) for i, r in enumerate(labels)]
    grid = df.select(*keys).distinct().select(*keys, F.inline(F.array(*cells)))
    out = grid.join(counts, [*keys, "reason"], "left")
    return out.select(*keys, "reason_idx", "reason", F.coalesce("_c", F.lit(0)).cast("long").alias("cnt"))


def reported_stats(df: DataFrame, work: DataFrame | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """One record per (ver, lc) with A20-A22; A23: datasets in ``work`` with no
    reports get a zero record (left join from the work list)."""
    keys = list(keys)
    rec = report_counts(df, keys)
    s, h = reports_per_sentence(df, keys)
    rea = reason_frequency(df, keys)
    rec = (rec.join(s, keys, "left").join(stats.to_array(h, keys, "bin", "cnt", "rep_freq"), keys, "left")
           .join(stats.to_array(rea, keys, "reason_idx", "cnt", "rea_freq"), keys, "left"))
    if work is not None:
        rec = work.select(*keys).distinct().join(rec, keys, "left")
        zero = F.lit(0).cast("long")
        rec = rec.select(*keys, F.coalesce("rep_sum", zero).alias("rep_sum"), F.coalesce("rep_sen", zero).alias("rep_sen"),
                         *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("rep_avg", "rep_med", "rep_std")],
                         F.coalesce("rep_freq", F.array().cast("array<long>")).alias("rep_freq"),
                         F.coalesce("rea_freq", F.array().cast("array<long>")).alias("rea_freq"))
    return rec
