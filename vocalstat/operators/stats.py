"""Aggregation building blocks A1-A9 and top-k U7.

Every function takes key columns and value columns by name so it runs on
clip tables and on any other table. Nothing here collects a group into one
task: counts are pre-aggregated per (keys, value) before anything per group,
hot groups are split by value or by a salt, and the one exact statistic that
needs an order (the median) has a range-partitioned selection for values with
unbounded cardinality.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalstat.functions.exprs import bin_index, rint3
from vocalstat.session import materialize

_G = "_grp"  # stand-in key when a statistic is global


def _keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(_G, F.lit(0)), [_G]


def join_groups(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two per-group results on ``keys``.

    Without keys both sides are global aggregates of exactly one row, so the
    join puts one row beside one row (Spark broadcasts the one-row side); data
    rows are never paired.
    """
    keys = list(keys)
    return a.join(b, keys, how) if keys else a.join(b, how=how)


def _drop_g(df: DataFrame) -> DataFrame:
    return df.drop(_G) if _G in df.columns else df


# --------------------------------------------------------------------------
# A4 / A5 value counts
# --------------------------------------------------------------------------

def value_counts(df: DataFrame, keys: Sequence[str], value: str | Column,
                 name: str = "value", count: str = "count", drop_nulls: bool = True) -> DataFrame:
    """A4: (keys, value, count), nulls excluded. Partial aggregation map-side.

    ``drop_nulls=False`` keeps one null row per group instead of filtering
    first: a filter on a computed value is pushed below the aggregate and
    evaluates the expression twice per row; the summaries and histograms here
    ignore the null row themselves.
    """
    v = F.col(value) if isinstance(value, str) else value
    df = df.select(*keys, v.alias(name))
    if drop_nulls:
        df = df.where(F.col(name).isNotNull())
    return df.groupBy(*keys, name).agg(F.count(F.lit(1)).alias(count))


def item_frequency(df: DataFrame, keys: Sequence[str], items: str | Column,
                   name: str = "item", count: str = "count") -> DataFrame:
    """A5: explode an array column and count items per group."""
    arr = F.col(items) if isinstance(items, str) else items
    return (df.select(*keys, F.explode(arr).alias(name)).where(F.col(name).isNotNull())
            .groupBy(*keys, name).agg(F.count(F.lit(1)).alias(count)))


# --------------------------------------------------------------------------
# A6 / A7 distinct counts
# --------------------------------------------------------------------------

def text_key(c: str | Column) -> Column:
    """32 bytes that stand for a whole text (its SHA-256; null stays null).

    A distinct count shuffles its column once per distinct aggregate. Counted by
    this key, equal texts still count once, and a shuffled row has the same size
    however long the text is. It pays for long texts; short items go as they are.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.sha2(x.cast("binary"), 256))


def distinct_with_null(c: str | Column) -> Column:
    """Distinct values with null counted once (``unique().shape[0]``)."""
    x = F.col(c) if isinstance(c, str) else c
    return (F.count_distinct(x) + F.max(F.when(x.isNull(), 1).otherwise(0))).cast("long")


def distinct_non_null(c: str | Column) -> Column:
    """Distinct values, nulls dropped."""
    x = F.col(c) if isinstance(c, str) else c
    return F.count_distinct(x).cast("long")


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: dict[str, str | Column]) -> DataFrame:
    """A6 for several columns: (keys, name...), null counted once.

    Each column is made distinct by itself, one exchange of (keys, value) after map-side
    combine, and then counted; several ``count(distinct)`` in one aggregate would expand every row
    once a column instead.
    """
    keys = list(keys)
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return assemble([df.groupBy(*keys, col(c).alias("_v")).agg(F.lit(1).alias("_1")).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
                     for name, c in columns.items()], keys)


# --------------------------------------------------------------------------
# A1 summary: sum, mean, median, population std
# --------------------------------------------------------------------------

def median_select(vc: DataFrame, keys: Sequence[str], value: str, weight: str,
                  partitions: int | None = None) -> DataFrame:
    """Exact interpolated median per group from (keys, value, weight) rows.

    Distributed order statistic: rows are range-partitioned on (keys, value),
    so a hot group is spread over many partitions; per-(partition, group)
    weight totals (a table of about partitions + groups rows) give each chunk's
    rank offset; only the one or two chunks holding the middle ranks are
    scanned in order. No task ever holds a whole group. The range-partitioned
    table is checkpointed so partition ids are stable between its two uses.
    """
    vc, keys = _keys(vc, keys)
    spark = vc.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wt = F.when(F.col(value).isNotNull(), F.col(weight)).otherwise(F.lit(0)).cast("long")  # null rows weigh 0
    ranged = materialize(vc.select(*keys, F.col(value).alias("_v"), wt.alias("_w"))
                         .repartitionByRange(p, *keys, "_v")
                         .withColumn("_pid", F.spark_partition_id()), "median")
    chunks = ranged.groupBy("_pid", *keys).agg(F.sum("_w").alias("_cw"))
    by_group = Window.partitionBy(*keys)
    ordered = by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = (chunks.withColumn("_end", F.sum("_cw").over(ordered))
              .withColumn("_n", F.sum("_cw").over(by_group))
              .withColumn("_start", F.col("_end") - F.col("_cw"))
              .withColumn("_rlo", F.floor((F.col("_n") - 1) / 2))
              .withColumn("_rhi", F.floor(F.col("_n") / 2)))

    def holds(rank: str, lo: str, hi: str) -> Column:
        return (F.col(rank) >= F.col(lo)) & (F.col(rank) < F.col(hi))

    targets = (chunks.where(holds("_rlo", "_start", "_end") | holds("_rhi", "_start", "_end"))
               .select("_pid", *keys, "_start", "_rlo", "_rhi"))
    sel = ranged.join(targets, ["_pid", *keys])
    within = Window.partitionBy("_pid", *keys).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sel = (sel.withColumn("_ce", F.col("_start") + F.sum("_w").over(within))
           .withColumn("_cs", F.col("_ce") - F.col("_w")))
    out = sel.groupBy(*keys).agg(
        F.max(F.when(holds("_rlo", "_cs", "_ce"), F.col("_v"))).alias("_lo"),
        F.max(F.when(holds("_rhi", "_cs", "_ce"), F.col("_v"))).alias("_hi"))
    return out.select(*keys, ((F.col("_lo").cast("double") + F.col("_hi").cast("double")) / 2).alias("median"))


def summary_from_counts(vc: DataFrame, keys: Sequence[str], value: str, weight: str,
                        prefix: str, decimals: int | None = 3, median: str = "map",
                        with_sum: bool = True, with_count: bool = False) -> DataFrame:
    """A1 over value counts: ``{prefix}_sum/_avg/_med/_std`` (+ ``_cnt``).

    ``median='map'`` uses the built-in exact ``percentile(v, 0.5, w)``; its
    state per group is one entry per *distinct value*, which is bounded for
    integer measures (lengths, counts, truncated seconds). ``median='select'``
    is the range-partitioned selection for high-cardinality floats.
    The population deviation of whole numbers comes from exact decimal sums in the
    same pass; that of other numbers is a second pass over the value counts with the
    group mean joined in (numerically stable, no sum-of-squares cancellation).
    """
    vc, keys = _keys(vc, keys)
    v, w = F.col(value), F.col(weight)
    aggs = [F.sum(F.when(v.isNotNull(), w)).alias("_n"), F.sum(v * w).alias("_s")]
    if median == "map":
        aggs.append(F.percentile(v, F.lit(0.5), w).alias("_med"))
    exact = dict(vc.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    if exact:
        d = lambda c: c.cast("decimal(15,0)")
        aggs.append(F.sum(d(w) * d(v) * d(v)).cast("decimal(38,0)").alias("_q"))
    base = vc.groupBy(*keys).agg(*aggs).withColumn("_mean", F.col("_s") / F.col("_n"))
    if exact:  # n * sum(v^2) - sum(v)^2 is the squared deviation times n, without rounding
        whole = lambda c: F.col(c).cast("decimal(19,0)")
        res = base.withColumn("_m2", ((whole("_n") * F.col("_q")).cast("decimal(38,0)") - (whole("_s") * whole("_s")).cast("decimal(38,0)"))
                              .cast("double") / F.col("_n"))
    else:
        m2 = (vc.join(base.select(*keys, "_mean"), keys)
              .groupBy(*keys).agg(F.sum(w * (v - F.col("_mean")) * (v - F.col("_mean"))).alias("_m2")))
        res = base.join(m2, keys)
    if median == "select":
        res = res.join(median_select(vc, keys, value, weight), keys).withColumnRenamed("median", "_med")
    rnd = (lambda c: rint3(c) if decimals == 3 else F.round(c, decimals)) if decimals is not None else (lambda c: c)
    cols = [*keys]
    if with_count:
        cols.append(F.col("_n").cast("long").alias(f"{prefix}_cnt"))
    if with_sum:
        cols.append(F.col("_s").alias(f"{prefix}_sum"))
    cols += [
        rnd(F.col("_mean")).alias(f"{prefix}_avg"),
        rnd(F.col("_med").cast("double")).alias(f"{prefix}_med"),
        rnd(F.sqrt(F.col("_m2") / F.col("_n"))).alias(f"{prefix}_std"),
    ]
    return _drop_g(res.select(*cols))


def summary(df: DataFrame, keys: Sequence[str], value: str | Column, prefix: str,
            decimals: int | None = 3, median: str = "map", with_sum: bool = True,
            with_count: bool = False) -> DataFrame:
    """A1: sum, mean, interpolated median, population std of a column, nulls dropped.

    ``median='select'`` is for columns of nearly unique numbers, where value counts
    would compress nothing: sums and moments come straight from the rows in one pass
    with map-side combine, and only the median orders them.
    """
    if median == "select":
        d, own = _keys(df.select(*keys, (F.col(value) if isinstance(value, str) else value).cast("double").alias("_val")), keys)
        moments = d.groupBy(*own).agg(F.count("_val").alias("_n"), F.sum("_val").alias("_s"), F.avg("_val").alias("_mean"),
                                      F.stddev_pop("_val").alias("_std"))
        res = moments.join(median_select(d.withColumn("_wt", F.lit(1)), own, "_val", "_wt"), own)
        rnd = (lambda c: rint3(c) if decimals == 3 else F.round(c, decimals)) if decimals is not None else (lambda c: c)
        cols = [*own, *([F.col("_n").cast("long").alias(f"{prefix}_cnt")] if with_count else []),
                *([F.col("_s").alias(f"{prefix}_sum")] if with_sum else []), rnd(F.col("_mean")).alias(f"{prefix}_avg"),
                rnd(F.col("median")).alias(f"{prefix}_med"), rnd(F.col("_std")).alias(f"{prefix}_std")]
        return _drop_g(res.select(*cols))
    vc = value_counts(df, keys, value, name="_val", count="_wt", drop_nulls=False)
    return summary_from_counts(vc, keys, "_val", "_wt", prefix, decimals, median, with_sum, with_count)


# --------------------------------------------------------------------------
# A2 / A3 histograms over fixed edges
# --------------------------------------------------------------------------

_OUT = -1  # bin number of values outside the reported bins


def _dense_from_counts(counts: DataFrame, keys: Sequence[str], n_bins: int, count: str,
                       lo: Column, extra: Sequence[str] = ()) -> DataFrame:
    """(keys, bin, _c) -> dense (keys, bin, lo, count) over bins 0..n_bins-1.

    Densified per group through a map bin -> count (at most n_bins + 1 entries)
    instead of a join on the bin: a join key on a derived bin would make the
    optimizer infer ``isnotnull(bin)`` and push that CASE below the aggregate.
    """
    per_group = counts.groupBy(*keys, *extra).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "_c"))).alias("_m"))
    dense = per_group.select(
        *keys, *extra,
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)),
                                 lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0)))).alias("bin", count))
    return dense.select(*keys, "bin", lo.cast("long").alias("lo"), F.col(count).cast("long").alias(count))


def histogram_from_counts(vc: DataFrame, keys: Sequence[str], value: str, weight: str | None,
                          edges: Sequence[float], closed_last: bool = True,
                          drop_first: bool = False, truncate: bool = True,
                          groups: DataFrame | None = None, count: str = "cnt") -> DataFrame:
    """A2/A3 in long form: (keys, bin, lo, cnt), dense over the fixed bins.

    Rows are binned where they are (one CASE per row, inside codegen), summed
    per (keys, bin) with map-side partial aggregation, then densified per group
    against the literal bin list. Groups without rows produce no rows (F8)
    unless ``groups`` lists them, in which case they get all-zero bins.
    """
    vc, keys = _keys(vc, keys)
    m = len(edges) - 1
    first = 1 if drop_first else 0
    wt = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    b = bin_index(value, edges, closed_last, truncate, drop_first, sentinel=_OUT)
    counts = vc.select(*keys, b.alias("bin"), wt.alias("_w")).groupBy(*keys, "bin").agg(F.sum("_w").alias("_c"))
    los = F.array(*[F.lit(e) for e in edges[first:m]])
    dense = _dense_from_counts(counts, keys, m - first, count, F.element_at(los, F.col("bin") + 1))
    if groups is not None:
        if keys == [_G]:
            groups = groups.withColumn(_G, F.lit(0))
        empty = (groups.select(*keys).join(counts.select(*keys).distinct(), keys, "left_anti")
                 .select(*keys, F.posexplode(los).alias("bin", "lo"))
                 .select(*keys, "bin", F.col("lo").cast("long").alias("lo"), F.lit(0).cast("long").alias(count)))
        dense = dense.unionByName(empty)
    return _drop_g(dense)


def histogram(df: DataFrame, keys: Sequence[str], value: str | Column, edges: Sequence[float],
              closed_last: bool = True, drop_first: bool = False, truncate: bool = True,
              groups: DataFrame | None = None, count: str = "cnt") -> DataFrame:
    """A2 over raw rows (bin index per row, then ``groupBy(keys, bin)``)."""
    v = F.col(value) if isinstance(value, str) else value
    src = df.select(*keys, v.alias("_val"))
    return histogram_from_counts(src, keys, "_val", None, edges, closed_last, drop_first,
                                 truncate, groups, count)


def adaptive_histogram_from_counts(vc: DataFrame, keys: Sequence[str], value: str, weight: str | None,
                                   choice: DataFrame, low_edges: Sequence[float],
                                   high_edges: Sequence[float], closed_last: bool = True,
                                   truncate: bool = True, count: str = "cnt") -> DataFrame:
    """Data-dependent bins (A11, C1, C2): ``choice`` = (keys, use_low boolean) per group.

    Rows are binned by both edge sets where they are and summed per (keys, both
    bins); the chosen edge set is joined onto those few sums by group key, never
    onto the rows. Both edge sets must have the same number of bins.
    """
    assert len(low_edges) == len(high_edges)
    vc, keys = _keys(vc, keys)
    if keys == [_G]:
        choice = choice.withColumn(_G, F.lit(0))
    m = len(low_edges) - 1
    wt = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    at = lambda edges: bin_index(value, edges, closed_last, truncate, sentinel=_OUT)
    cells = (vc.select(*keys, at(low_edges).alias("_bl"), at(high_edges).alias("_bh"), wt.alias("_w"))
             .groupBy(*keys, "_bl", "_bh").agg(F.sum("_w").alias("_c")))
    j = cells.join(choice.select(*keys, "use_low"), keys)
    counts = (j.select(*keys, "use_low", F.when(F.col("use_low"), F.col("_bl")).otherwise(F.col("_bh")).alias("bin"), "_c")
              .groupBy(*keys, "use_low", "bin").agg(F.sum("_c").alias("_c")))
    lo_low = F.array(*[F.lit(e) for e in low_edges[:-1]])
    lo_high = F.array(*[F.lit(e) for e in high_edges[:-1]])
    per_group = counts.groupBy(*keys, "use_low").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "_c"))).alias("_m"))
    dense = per_group.select(
        *keys, "use_low",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(m - 1)),
                                 lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0)))).alias("bin", count))
    lo = F.when(F.col("use_low"), F.element_at(lo_low, F.col("bin") + 1)).otherwise(F.element_at(lo_high, F.col("bin") + 1))
    return _drop_g(dense.select(*keys, "bin", lo.cast("long").alias("lo"), F.col(count).cast("long").alias(count)))


def to_array(long_df: DataFrame, keys: Sequence[str], index: str, value: str, name: str) -> DataFrame:
    """Long (keys, index, value) to one ordered array per group (sink / record form).

    Only for bounded index sets (bins, fixed labels): the array per group has
    as many entries as the literal list it was densified from.
    """
    long_df, keys = _keys(long_df, keys)
    out = (long_df.groupBy(*keys)
           .agg(F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(value).alias("v")))).alias("_a"))
           .select(*keys, F.transform("_a", lambda s: s["v"]).alias(name)))
    return _drop_g(out)


# --------------------------------------------------------------------------
# A8 pivot with margins, A9 cross-tab
# --------------------------------------------------------------------------

def margin_matrix(df: DataFrame, keys: Sequence[str], row: str, column: str,
                  row_labels: Sequence[str], col_labels: Sequence[str],
                  value: str | None = None, total: str = "TOTAL", count: str = "n") -> DataFrame:
    """Counts by (row, column) with TOTAL margins, dense over the fixed labels.

    Long form (keys, row, column, n): rows = row_labels + TOTAL, columns =
    col_labels + TOTAL, missing cells 0. Values outside the label lists are
    counted in the TOTAL cells only. First a plain (keys, row, column) count
    (partial aggregation on raw rows), then grouping sets over that small table.
    """
    df, keys = _keys(df, keys)
    cnt = F.count(F.col(value)) if value else F.count(F.lit(1))
    base = df.groupBy(*keys, row, column).agg(cnt.alias("_c"))
    sets = [[*keys, row, column], [*keys, row], [*keys, column], list(keys)]
    g = base.groupingSets(sets, *keys, row, column).agg(
        F.sum("_c").alias("_n"), F.grouping(row).alias("_gr"), F.grouping(column).alias("_gc"))
    g = g.select(*keys,
                 F.when(F.col("_gr") == 1, F.lit(total)).otherwise(F.col(row)).alias(row),
                 F.when(F.col("_gc") == 1, F.lit(total)).otherwise(F.col(column)).alias(column),
                 "_n")
    rows = list(row_labels) + [total]
    cols = list(col_labels) + [total]
    cells = [F.struct(F.lit(r).alias(row), F.lit(c).alias(column), F.lit(i).alias("_ri"), F.lit(j).alias("_ci"))
             for i, r in enumerate(rows) for j, c in enumerate(cols)]
    grid = base.select(*keys).distinct().select(*keys, F.inline(F.array(*cells)))
    out = grid.join(g, [*keys, row, column], "left")
    return _drop_g(out.select(*keys, row, column, "_ri", "_ci",
                              F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias(count)))


def matrix_array(long_df: DataFrame, keys: Sequence[str], count: str = "n",
                 row_index: str = "_ri", col_index: str = "_ci", name: str = "matrix") -> DataFrame:
    """Dense long matrix to array<array<long>> per group (record form)."""
    long_df, keys = _keys(long_df, keys)
    rows = (long_df.groupBy(*keys, row_index)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(col_index).alias("i"), F.col(count).alias("v")))).alias("_a"))
            .select(*keys, row_index, F.transform("_a", lambda s: s["v"]).alias("_r")))
    out = (rows.groupBy(*keys)
           .agg(F.array_sort(F.collect_list(F.struct(F.col(row_index).alias("i"), F.col("_r").alias("r")))).alias("_m"))
           .select(*keys, F.transform("_m", lambda s: s["r"]).alias(name)))
    return _drop_g(out)


def crosstab(df: DataFrame, keys: Sequence[str], row: str, column: str,
             col_labels: Sequence | None = None, row_labels: Sequence | None = None,
             count: str = "n", weight: str | None = None) -> DataFrame:
    """(keys, row, column, n) without margins.

    Rows present in the data are kept (observed only, C4) unless ``row_labels``
    is given; columns are densified over ``col_labels`` when given, else the
    columns observed in the group. Rows/columns with a null label are dropped.
    ``weight`` is a column of counts when ``df`` is counted already.
    """
    df, keys = _keys(df, keys)
    base = (df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
            .groupBy(*keys, row, column).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n")))
    if row_labels is None:
        rows = base.select(*keys, row).distinct()
    else:
        rows = base.select(*keys).distinct().select(*keys, F.explode(F.array(*[F.lit(x) for x in row_labels])).alias(row))
    if col_labels is None:
        cols = base.select(*keys, column).distinct()
        grid = rows.join(cols, keys)
    else:
        grid = rows.select(*keys, row, F.explode(F.array(*[F.lit(x) for x in col_labels])).alias(column))
    out = grid.join(base, [*keys, row, column], "left")
    return _drop_g(out.select(*keys, row, column, F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias(count)))


# --------------------------------------------------------------------------
# U7 / U8 top-k
# --------------------------------------------------------------------------

def top_k(freq: DataFrame, keys: Sequence[str], item: str, count: str, k: int,
          shards: int | None = None, rank: str = "rnk") -> DataFrame:
    """The k most frequent items per group, ties broken by item.

    Two rounds: top k within (group, hash(item) mod shards), then top k of
    those candidates (at most shards x k rows per group). The union of the
    per-shard top-k always contains the group's top-k, so the result is exact,
    and no window ever holds more than a shard of a hot group.
    """
    freq, keys = _keys(freq, keys)
    shards = shards or int(freq.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(count).desc(), F.col(item).asc()]
    salted = freq.withColumn("_shard", F.pmod(F.xxhash64(F.col(item)), F.lit(shards)))
    cand = (salted.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_shard").orderBy(*order)))
            .where(F.col("_r") <= k).drop("_r", "_shard"))
    out = (cand.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
           .where(F.col(rank) <= k))
    return _drop_g(out)


# --------------------------------------------------------------------------
# Several measures at once (A1 + A2 per measure), one grouping per record
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Measure:
    """Bins of one measure. With ``threshold`` a group whose rounded mean is below it takes ``low_edges`` (as many bins)."""

    edges: Sequence[float]
    closed_last: bool = True
    drop_first: bool = False
    low_edges: Sequence[float] | None = None
    threshold: float | None = None

    @property
    def bins(self) -> int:
        return len(self.edges) - 1 - int(self.drop_first)

    def index(self, value: str | Column, low: Column) -> Column:
        at = lambda e: bin_index(value, e, self.closed_last, True, self.drop_first, sentinel=_OUT)
        return at(self.edges) if self.low_edges is None else F.when(low, at(self.low_edges)).otherwise(at(self.edges))


def measure_table(rows: DataFrame, keys: Sequence[str], measures: dict[str, Measure], value: str = "value",
                  weight: str = "weight", distinct_values: bool = False) -> DataFrame:
    """A1 + A2 of all measures together: (keys, measure, n, sum, avg, med, std, freq), one row a group and measure.

    ``rows`` holds (keys, measure, value, weight), null values allowed. Value counts
    of whole numbers keep the exact deviations and the map median. For nearly unique
    numbers (``distinct_values``, no weights) moments come straight from the rows and one
    range partition on (keys, measure, value) orders all medians at once. A group whose
    values of a measure are all null has empty bins and no other figures.
    """
    by = [*keys, "measure"]
    if distinct_values:
        summ = summary(rows, by, value, "m", median="select", with_count=True)
    else:
        summ = summary_from_counts(rows, by, value, weight, "m", with_count=True)
    low = F.lit(False)
    for name, m in measures.items():
        if m.low_edges is not None:
            low = low | ((F.col("measure") == name) & F.coalesce(F.col("m_avg") < F.lit(m.threshold), F.lit(False)))
    adaptive = any(m.low_edges is not None for m in measures.values())
    binned = rows.join(summ.select(*by, low.alias("_low")), by, "left") if adaptive else rows.withColumn("_low", F.lit(False))
    at = F.lit(_OUT)
    size = F.lit(0)
    for name, m in measures.items():
        at = F.when(F.col("measure") == name, m.index(value, F.col("_low"))).otherwise(at)
        size = F.when(F.col("measure") == name, F.lit(m.bins)).otherwise(size)
    wt = F.lit(1).cast("long") if distinct_values else F.col(weight).cast("long")
    counts = binned.select(*by, at.alias("bin"), wt.alias("_w")).groupBy(*by, "bin").agg(F.sum("_w").alias("_c"))
    counts = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "_c"))).alias("_m"))  # a bin once: bounded
    freq = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0).cast("long")))
    out = counts.select(*by, freq.alias("freq")).join(summ, by, "left")
    return out.select(*by, F.col("m_cnt").alias("n"), F.col("m_sum").alias("sum"), F.col("m_avg").alias("avg"),
                      F.col("m_med").alias("med"), F.col("m_std").alias("std"), "freq")


def measure_columns(table: DataFrame, keys: Sequence[str], prefixes: dict[str, str] | Sequence[str],
                    fields: Sequence[str] = ("n", "sum", "avg", "med", "std", "freq")) -> DataFrame:
    """``measure_table`` with a row per group: ``{prefix}_{field}`` for every measure."""
    prefixes = prefixes if isinstance(prefixes, dict) else {p: p for p in prefixes}
    of = lambda m, f: F.first(F.when(F.col("measure") == m, F.col(f)), ignorenulls=True)
    return table.groupBy(*keys).agg(*[of(m, f).alias(f"{p}_{f}") for m, p in prefixes.items() for f in fields])


def assemble(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per group from parts that hold different columns of it: a union and one grouping, no join a part.

    Each column comes from one part, with one row a group at most; a group that a part lacks gets nulls.
    """
    keys = list(keys)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest])
