"""Split statistics A24-A30, V1, V2 and the clip-side joins J5, U1.

Input rows are unified clips (see ``functions.exprs.unify_clips``) carrying
the dataset keys; every statistic is one grouped plan over all datasets.
Column names are parameters so the plans also run on other tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import ms_to_s
from vocalstat.operators import stats
from vocalstat.session import materialize

KEYS = ["ver", "lc", "alg", "sp"]


def with_all_clips(df: DataFrame, bucket: str = "sp", buckets: Sequence[str] = dims.MAIN_BUCKETS,
                   all_name: str = dims.ALL_CLIPS, alg: str | None = "alg") -> DataFrame:
    """Each bucket row also counts in the synthetic ``clips`` bucket.

    One scan, no second read: rows of the main buckets are exploded into their
    own key and ``clips``; other rows (algorithm splits) pass unchanged.
    """
    is_bucket = F.col(bucket).isin(*buckets)
    if alg is not None:
        is_bucket = is_bucket & (F.coalesce(F.col(alg), F.lit("")) == F.lit(""))
    targets = F.when(is_bucket, F.array(F.col(bucket), F.lit(all_name))).otherwise(F.array(F.col(bucket)))
    return df.withColumn(bucket, F.explode(targets))


def attach_durations(clips: DataFrame, durations: DataFrame, on_clip: str = "path",
                     lc: str | None = "lc", clip: str = "clip", duration_ms: str = "duration_ms",
                     ver: str | None = "ver") -> DataFrame:
    """Clip -> duration (seconds) lookup, missing stays null; version 1 gets none.

    The duration table is deduplicated per (lc, clip) first (minimum kept), so
    the left join never multiplies clip rows.
    """
    dkeys = [lc] if lc else []
    d = (durations.groupBy(*dkeys, clip).agg(F.min(duration_ms).alias("_dms"))
         .withColumnRenamed(clip, "_clip"))
    cond = [F.col(on_clip) == F.col("_clip")]
    if dkeys:
        d = d.withColumnRenamed(lc, "_dlc")
        cond.append(F.col(lc) == F.col("_dlc"))
    j = clips.join(d, cond, "left")
    dur = ms_to_s("_dms")
    if ver is not None:
        dur = F.when(~F.col(ver).isin(*dims.NO_DURATION_VERSIONS), dur)
    out = j.withColumn("duration", dur).drop("_clip", "_dms")
    return out.drop("_dlc") if dkeys else out


def basic_counts(df: DataFrame, keys: Sequence[str] = KEYS, client: str = "client_id",
                 sentence: str = "sentence", sentence_lower: str = "sentence_lower") -> DataFrame:
    """Clips, uq_v, uq_s, uq_sl (null counted once, Q4)."""
    distinct = stats.distinct_counts(df, keys, {"uq_v": client, "uq_s": sentence, "uq_sl": sentence_lower})
    return stats.assemble([df.groupBy(*keys).agg(F.count(F.lit(1)).alias("clips")), distinct], keys).select(
        *keys, "clips", "uq_v", "uq_s", "uq_sl")


def duration_stats(df: DataFrame, keys: Sequence[str] = KEYS, duration: str = "duration",
                   has_durations: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """dur_total/avg/med/std (3 decimals) + duration histogram (truncated seconds).

    Groups whose version has no duration mapping get -1 and an empty histogram
    (``has_durations`` false); groups with mapping but no matched clip keep the
    statistics null (Q8) and all-zero bins.
    """
    vc = stats.value_counts(df, keys, duration, name="_v", count="_w", drop_nulls=False)
    summ = stats.summary_from_counts(vc, keys, "_v", "_w", "dur")
    summ = summ.withColumnRenamed("dur_sum", "dur_total").withColumn("dur_total", F.rint(F.col("dur_total") * 1000) / 1000)
    hist = stats.histogram_from_counts(vc, keys, "_v", "_w", bins.DURATION)
    return summ, hist


def per_item_stats(df: DataFrame, keys: Sequence[str], item: str, prefix: str,
                   edges: Sequence[float], drop_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """A26 (recordings per voice) / A27 (per sentence) / A21 (reports per sentence).

    Counts per item first (shuffle on (keys, item) spreads a hot group), then
    the summary and histogram run over those counts.
    """
    per_item = stats.value_counts(df, keys, item, name="_item", count="_c")
    vc = stats.value_counts(per_item, keys, "_c", name="_v", count="_w")
    summ = stats.summary_from_counts(vc, keys, "_v", "_w", prefix, with_sum=False)
    hist = stats.histogram_from_counts(vc, keys, "_v", "_w", edges, drop_first=drop_first)
    return summ, hist


def vote_stats(df: DataFrame, keys: Sequence[str], votes: str, prefix: str,
               edges: Sequence[float] = bins.VOTES_UP) -> tuple[DataFrame, DataFrame]:
    """A28 (Q3 kept): ``{p}_sum`` of votes; avg/med/std over the counts of each
    distinct vote value; histogram of votes per clip in half-open bins (A3)."""
    vc = stats.value_counts(df, keys, votes, name="_v", count="_w")
    total = vc.groupBy(*keys).agg(F.sum(F.col("_v") * F.col("_w")).cast("long").alias(f"{prefix}_sum"))
    summ = stats.summary_from_counts(vc.select(*keys, F.col("_w").alias("_x")).groupBy(*keys, "_x")
                                     .agg(F.count(F.lit(1)).alias("_y")), keys, "_x", "_y", prefix, with_sum=False)
    hist = stats.histogram_from_counts(vc, keys, "_v", "_w", edges, closed_last=False, truncate=False)
    return total.join(summ, list(keys)), hist


def demographics(df: DataFrame, keys: Sequence[str] = KEYS, age: str = "age", gender: str = "gender",
                 client: str = "client_id", path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Recordings (count of non-null path) and unique voices by age x gender.

    Dense long matrices (keys, age, gender, n) over AGES+TOTAL x GENDERS+TOTAL.
    """
    rec = stats.margin_matrix(df, keys, age, gender, dims.AGES, dims.GENDERS, value=path)
    uq = stats.margin_matrix(df.select(*keys, client, age, gender).distinct(), keys, age, gender,
                             dims.AGES, dims.GENDERS)
    return rec, uq


def _named(presets: DataFrame, code: str, lc: str | None) -> DataFrame:
    """(lc, _key, _code, _ord): what a preset is called by, its text or its code, once per locale.

    A text that is also another preset's code means the preset with that text; of several
    presets with one text the first in order counts.
    """
    by = [F.col(lc).alias("_plc")] if lc else []
    own = lambda key, rank: presets.select(*by, F.col(key).alias("_key"), F.col(code).alias("_code"),
                                           F.struct(F.lit(rank).alias("r"), F.col("ord").cast("long").alias("o")).alias("_at"))
    both = own("text", 0).unionByName(own(code, 1)).where(F.col("_key").isNotNull())
    return both.groupBy(*(["_plc"] if lc else []), "_key").agg(
        F.min_by("_code", "_at").alias("_code"), F.min("_at")["o"].alias("_ord"))


def _meet(rows: DataFrame, names: DataFrame, value: str, lc: str | None) -> DataFrame:
    cond = F.col(value) == F.col("_key")
    j = rows.join(names, cond & (F.col(lc) == F.col("_plc")) if lc else cond, "left")
    return j.drop("_key", "_plc")


def variant_counts(df: DataFrame, keys: Sequence[str], presets: DataFrame, variant: str = "variant",
                   client: str = "client_id", lc: str | None = "lc") -> DataFrame:
    """V1: recordings and distinct (variant, voice) pairs per variant code.

    ``presets`` = (lc, code, text, ord): free text is turned into its code by an
    exact match (D for Q10), then counts are re-aggregated by code; output is
    in preset order with ``nodata`` last and what is no preset (null ``ord``) after it.
    """
    m = _meet(df.select(*keys, F.col(variant).alias("_txt"), client), _named(presets, "code", lc), "_txt", lc)
    m = m.select(*keys, F.coalesce("_code", "_txt").alias("variant"), client,
                 F.when(F.col("_txt") == F.lit(dims.NODATA), F.lit(1 << 30)).otherwise(F.col("_ord")).alias("ord"))
    agg = m.groupBy(*keys, "variant").agg(
        F.count(F.lit(1)).alias("rec"), F.count_distinct(client).alias("voices"),
        F.min("ord").alias("ord"))
    return agg.select(*keys, "variant", F.col("ord").cast("long").alias("ord"),
                      F.col("rec").cast("long").alias("rec"), F.col("voices").cast("long").alias("voices"))


def accent_counts(df: DataFrame, keys: Sequence[str], presets: DataFrame, accents: str = "accents",
                  client: str = "client_id", lc: str | None = "lc", sep: str = ",") -> DataFrame:
    """V2: accent counts per preset token, ``nodata`` and ``other``.

    A value that is a preset (by text or token) or nodata as a whole counts once;
    otherwise it is split on ``sep`` and each piece counts, unknown pieces as ``other``.
    Counted per recording (rec) and per distinct (accent value, voice) pair (voices).
    Dense over the locale's presets + nodata + other. ``presets`` = (lc, token, text, ord).
    """
    names = _named(presets, "token", lc)
    label = lambda value: F.coalesce("_code", F.when(F.col(value) == F.lit(dims.NODATA), F.lit(dims.NODATA)))
    vals = df.groupBy(*keys, F.col(accents).alias("_val")).agg(
        F.count(F.lit(1)).alias("_rec"), F.count_distinct(client).alias("_uv"))
    vals = _meet(vals, names, "_val", lc).withColumn("accent", label("_val")).drop("_code", "_ord")
    whole = vals.where(F.col("accent").isNotNull()).drop("_val")
    pieces = vals.where(F.col("accent").isNull()).select(*keys, "_rec", "_uv", F.explode(F.split("_val", sep)).alias("_piece"))
    pieces = _meet(pieces, names, "_piece", lc).select(
        *keys, "_rec", "_uv", F.coalesce(label("_piece"), F.lit(dims.OTHER)).alias("accent"))
    counted = whole.unionByName(pieces).groupBy(*keys, "accent").agg(F.sum("_rec").alias("rec"), F.sum("_uv").alias("voices"))
    groups = df.select(*keys).distinct()
    by = [F.col(lc).alias("_plc")] if lc else []
    tokens = presets.select(*by, F.col("token").alias("accent"), F.col("ord").cast("long").alias("ord"))
    tokens = tokens.groupBy(*(["_plc"] if lc else []), "accent").agg(F.min("ord").alias("ord"))
    if lc:
        grid = groups.join(tokens, F.col(lc) == F.col("_plc")).select(*keys, "accent", "ord")
    else:  # one row that holds the presets, beside each group
        listed = tokens.agg(F.collect_list(F.struct("accent", "ord")).alias("_all"))
        grid = groups.join(listed, how="inner").select(*keys, F.inline("_all"))
    fixed = groups.select(*keys, F.inline(F.array(
        F.struct(F.lit(dims.NODATA).alias("accent"), F.lit(1 << 30).cast("long").alias("ord")),
        F.struct(F.lit(dims.OTHER).alias("accent"), F.lit((1 << 30) + 1).cast("long").alias("ord")))))
    out = grid.unionByName(fixed).join(counted, [*keys, "accent"], "left")
    return out.select(*keys, "accent", F.col("ord").cast("long").alias("ord"),
                      F.coalesce("rec", F.lit(0)).cast("long").alias("rec"),
                      F.coalesce("voices", F.lit(0)).cast("long").alias("voices"))


def split_stats(clips: DataFrame, keys: Sequence[str] = KEYS, variants: DataFrame | None = None,
                accents: DataFrame | None = None) -> DataFrame:
    """One split-statistics record per (ver, lc, alg, sp): A24-A30, V1, V2 as arrays.

    ``clips`` are unified clips with a ``duration`` column (seconds, null when
    unknown; see ``attach_durations``).
    """
    keys = list(keys)
    timed = ~F.col("ver").isin(*dims.NO_DURATION_VERSIONS)
    if "has_durations" in clips.columns:  # a locale without any duration is as version 1
        timed = timed & F.col("has_durations")
    base = clips.groupBy(*keys).agg(F.count(F.lit(1)).alias("clips"), F.max(F.when(timed, 1).otherwise(0)).alias("_hd"))
    dur = stats.value_counts(clips, keys, "duration", name="value", count="weight").withColumn("measure", F.lit("dur"))
    parts = [base, item_counts(clips, keys), stats.measure_columns(
        stats.measure_table(dur, keys, {"dur": stats.Measure(bins.DURATION)}), keys, ["dur"], ("sum", "avg", "med", "std", "freq"))]
    parts += demographic_tables(clips, keys)
    rows = lambda t, label, names: (t.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ord", label, "rec", "voices"))).alias("_r"))
        .select(*keys, *[F.col(f"_r.{f}").alias(n) for f, n in zip((label, "rec", "voices"), names)]))
    if variants is not None:
        v = variant_counts(clips, keys, variants).withColumn("ord", F.coalesce("ord", F.lit((1 << 30) + 1)))
        parts.append(rows(v, "variant", ("var_rows", "var_freq", "var_ufreq")))
    if accents is not None:
        parts.append(rows(accent_counts(clips, keys, accents), "accent", ("acc_rows", "acc_freq", "acc_ufreq")))
    rec = stats.assemble(parts, keys)
    none = F.array().cast("array<long>")
    has = F.col("_hd") == 1
    dur_zero = F.array(*[F.lit(0).cast("long")] * (len(bins.DURATION) - 1))
    rec = rec.withColumns({
        "dur_total": F.when(has, F.rint(F.col("dur_sum") * 1000) / 1000).otherwise(F.lit(-1.0)),
        **{d: F.when(has, F.col(d)).otherwise(F.lit(-1.0)) for d in ("dur_avg", "dur_med", "dur_std")},
        "dur_freq": F.when(has, F.coalesce("dur_freq", dur_zero)).otherwise(none), "dem_fix_r": none, "dem_fix_v": none})
    names = ["clips", "uq_v", "uq_s", "uq_sl", "dur_total", "dur_avg", "dur_med", "dur_std", "dur_freq",
             *[f"{p}_{f}" for p in "vs" for f in ("avg", "med", "std", "freq")],
             *[f"{p}_{f}" for p in ("uv", "dv") for f in ("sum", "avg", "med", "std", "freq")], "dem_table", "dem_uq", "dem_fix_r", "dem_fix_v",
             *(["var_rows", "var_freq", "var_ufreq"] if variants is not None else []),
             *(["acc_rows", "acc_freq", "acc_ufreq"] if accents is not None else [])]
    return rec.select(*keys, *names)


def item_counts(clips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A24 (distinct values), A26, A27 and A28 of each group, from tables that they share.

    Clips are counted by voice, by sentence and by votes, one exchange each; the number of a table's
    rows is the distinct count, its counts give the statistics, and the lower-case
    sentences are counted from the sentences. All measures are then summed up and binned together.
    """
    keys = list(keys)
    per = {c: clips.groupBy(*keys, F.col(c).alias("item")).agg(F.count(F.lit(1)).alias("n")) for c in ("client_id", "sentence", "up_votes", "down_votes")}
    measures = {"v": stats.Measure(bins.VOICES, drop_first=True), "s": stats.Measure(bins.SENTENCES, drop_first=True)}
    rows = []
    one = F.lit(1).cast("long")

    def add(table: DataFrame, measure: str, value: Column, weight: Column) -> None:
        rows.append(table.where(F.col("item").isNotNull()).select(*keys, F.lit(measure).alias("measure"), value.cast("long").alias("value"), weight.alias("weight")))

    add(per["client_id"], "v", F.col("n"), one)
    add(per["sentence"], "s", F.col("n"), one)
    for votes, p, edges in (("up_votes", "uv", bins.VOTES_UP), ("down_votes", "dv", bins.VOTES_DOWN)):
        measures[p] = measures[f"{p}c"] = stats.Measure(edges, closed_last=False)
        add(per[votes], p, F.col("item"), F.col("n"))
        add(per[votes], f"{p}c", F.col("n"), one)  # Q3: statistics over the counts of the distinct votes
    union = rows[0]
    for r in rows[1:]:
        union = union.unionByName(r)
    counts = materialize(union.groupBy(*keys, "measure", "value").agg(F.sum("weight").alias("weight")), "item-counts")
    table = stats.measure_columns(stats.measure_table(counts, keys, measures), keys, list(measures))
    lower = per["sentence"].select(*keys, F.lower("item").alias("_l")).distinct()
    size = lambda t, name: t.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    rec = stats.assemble([size(per["client_id"], "uq_v"), size(per["sentence"], "uq_s"), size(lower, "uq_sl"), table], keys)
    return rec.select(*keys, "uq_v", "uq_s", "uq_sl", *[f"{p}_{f}" for p in "vs" for f in ("avg", "med", "std", "freq")],
                      *[c for p in ("uv", "dv") for c in (F.col(f"{p}_sum").cast("long").alias(f"{p}_sum"), f"{p}_freq",
                                                          *[F.col(f"{p}c_{f}").alias(f"{p}_{f}") for f in ("avg", "med", "std")])])


def demographic_tables(clips: DataFrame, keys: Sequence[str]) -> list[DataFrame]:
    """A29 in record form: dem_table and dem_uq."""
    dem, uq = demographics(clips, keys)
    return [stats.matrix_array(dem, keys, name="dem_table"), stats.matrix_array(uq, keys, name="dem_uq")]


def fillable_demographics(df: DataFrame, keys: Sequence[str] = KEYS, client: str = "client_id",
                          field: str = "gender") -> DataFrame:
    """A30 (optional, off by default in ``split_stats``): voices with both blank and
    exactly one real value of ``field``; (keys, fillable_recordings, fillable_voices).

    Aggregated per (keys, client) first, so a voice is never gathered with others.
    """
    per_voice = df.groupBy(*keys, client).agg(
        F.count_distinct(F.when(F.col(field) != F.lit(dims.NODATA), F.col(field))).alias("_vals"),
        F.sum(F.when(F.col(field) == F.lit(dims.NODATA), 1).otherwise(0)).alias("_blank"))
    fix = per_voice.where((F.col("_vals") == 1) & (F.col("_blank") > 0))
    return fix.groupBy(*keys).agg(F.sum("_blank").cast("long").alias("fillable_recordings"),
                                  F.count(F.lit(1)).cast("long").alias("fillable_voices"))
