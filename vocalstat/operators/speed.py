"""Character speed C1-C4: ms per character, with data-dependent bins.

Group means pick the bins (speed mean LOW/HIGH speed bins, mean sentence length
SHORT/LONG length bins). Rows are counted by their places in all four bin lists,
map-side first, and the choice is joined onto those few counts: a join of the rows
on a handful of groups would sort a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import bin_index, char_speed
from vocalstat.operators import stats
from vocalstat.session import materialize

KEYS = ["ver", "lc", "alg", "sp"]


def with_speed(df: DataFrame, duration: str = "duration", sentence: str = "sentence",
               length: str | None = None) -> DataFrame:
    """P8 + P14: add ``s_len`` (code points, null stays null, Q6) and ``char_speed``."""
    s_len = F.col(length) if length else F.length(F.col(sentence))
    return df.withColumn("s_len", s_len).withColumn("char_speed", char_speed(duration, "s_len"))


def speed_choice(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group: speed summary (C1) and the two bin choices.

    Both thresholds are tested on raw means; the mean length is taken over all
    rows, with or without a duration.
    """
    summ = stats.summary(df, keys, "char_speed", "cs", with_sum=False)
    means = df.groupBy(*keys).agg(F.avg("s_len").alias("_len_avg"), F.avg("char_speed").alias("_cs_avg"))
    ch = stats.join_groups(summ, means, keys)
    return (ch.withColumn("use_low_cs", F.col("_cs_avg") < F.lit(bins.CS_THRESHOLD))
            .withColumn("use_short_len", F.col("_len_avg") < F.lit(bins.CHARS_THRESHOLD)))


def binned(df: DataFrame, keys: Sequence[str], choice: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rows counted by ``columns`` and ``bin_cs`` / ``bin_slen`` labels (lower edges), half-open ``cut`` form.

    (keys, columns, bin_cs, bin_slen, n); a combination may come in several rows.
    """
    lists = {"_cs1": ("char_speed", bins.CS_LOW), "_cs2": ("char_speed", bins.CS_HIGH),
             "_len1": ("s_len", bins.CHARS_SHORT), "_len2": ("s_len", bins.CHARS_LONG)}
    places = [bin_index(value, edges, closed_last=False, truncate=False).alias(c) for c, (value, edges) in lists.items()]
    cells = df.select(*keys, *columns, *places).groupBy(*keys, *columns, *lists).agg(F.count(F.lit(1)).alias("n"))
    j = materialize(cells, "speed-cells").join(choice.select(*keys, "use_low_cs", "use_short_len"), list(keys))

    def label(place: str):
        return F.element_at(F.array(*[F.lit(e) for e in lists[place][1][:-1]]), F.col(place) + 1)

    return j.select(*keys, *columns, F.when(F.col("use_low_cs"), label("_cs1")).otherwise(label("_cs2")).cast("long").alias("bin_cs"),
                    F.when(F.col("use_short_len"), label("_len1")).otherwise(label("_len2")).cast("long").alias("bin_slen"), "n")


def speed_histogram(df: DataFrame, keys: Sequence[str], choice: DataFrame) -> DataFrame:
    """C1 cs_freq: dense half-open histogram over the chosen speed bins."""
    return stats.adaptive_histogram_from_counts(
        df.select(*keys, "char_speed"), keys, "char_speed", None,
        choice.select(*keys, F.col("use_low_cs").alias("use_low")), bins.CS_LOW, bins.CS_HIGH,
        closed_last=False, truncate=False)


def speed_vs_length(b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C2 cs2s: speed bin x length bin, observed rows and columns only (C4)."""
    return stats.crosstab(b, keys, "bin_cs", "bin_slen", weight="n")


def speed_vs(b: DataFrame, keys: Sequence[str], column: str, labels: Sequence[str]) -> DataFrame:
    """C3 cs2g / cs2a: speed bin x gender or age, columns dense over the fixed labels."""
    return stats.crosstab(b, keys, "bin_cs", column, col_labels=labels, weight="n")


def char_speed_stats(clips: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One char-speed record per group (C1-C4), arrays as in the published record.

    Every group has a record: one without any duration keeps zeros and empty
    arrays. ``clips`` must carry ``duration`` in seconds (null when unknown).
    """
    keys = list(keys)
    every = with_speed(clips)
    ch = speed_choice(every, keys)
    df = every.where(F.col("char_speed").isNotNull())
    hist = speed_histogram(df, keys, ch)
    b = binned(df, keys, ch, ["gender", "age"])
    cs2s = speed_vs_length(b, keys)
    cs2g = speed_vs(b, keys, "gender", dims.GENDERS)
    cs2a = speed_vs(b, keys, "age", dims.AGES)

    def matrix(ct: DataFrame, column: str, name: str) -> DataFrame:
        rows = (ct.groupBy(*keys, "bin_cs")
                .agg(F.array_sort(F.collect_list(F.struct(F.col(column).alias("c"), F.col("n").alias("n")))).alias("_r")))
        return (rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bin_cs", "_r"))).alias("_m"))
                .select(*keys, F.transform("_m", lambda s: s["bin_cs"]).alias(f"{name}_rows"),
                        F.transform("_m", lambda s: F.transform(s["_r"], lambda x: x["n"])).alias(name),
                        F.transform(F.element_at("_m", 1)["_r"], lambda x: x["c"]).alias(f"{name}_cols")))

    def ordered(ct: DataFrame, column: str, labels: Sequence[str], name: str) -> DataFrame:
        order = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(column))
        rows = (ct.groupBy(*keys, "bin_cs")
                .agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("n").alias("n")))).alias("_r")))
        return (rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bin_cs", "_r"))).alias("_m"))
                .select(*keys, F.transform("_m", lambda s: F.transform(s["_r"], lambda x: x["n"])).alias(name)))

    m2s = matrix(cs2s, "bin_slen", "cs2s")
    clips_cnt = cs2s.groupBy(*keys).agg(F.sum("n").cast("long").alias("clips"))
    rec = stats.assemble([
        every.select(*keys).distinct(), ch.select(*keys, "cs_avg", "cs_med", "cs_std"), clips_cnt, stats.to_array(hist, keys, "bin", "cnt", "cs_freq"),
        m2s.select(*keys, F.col("cs2s_rows").alias("cs_r"), F.col("cs2s_cols").alias("cs2s_c"), "cs2s"),
        ordered(cs2g, "gender", dims.GENDERS, "cs2g"), ordered(cs2a, "age", dims.AGES, "cs2a")], keys)
    blank = {"bigint": F.lit(0).cast("long"), "double": F.lit(0.0)}
    return rec.select(*[F.coalesce(F.col(c), blank.get(t, F.array().cast(t) if t.startswith("array") else None)).alias(c)
                        if c not in keys and (t in blank or t.startswith("array")) else F.col(c) for c, t in rec.dtypes])
