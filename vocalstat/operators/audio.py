"""Audio-quality statistics A31-A38 and the audio joins J6-J8.

Audio specs are a large measured table (tens of millions of rows). Joins to
it are membership joins on distinct split paths, so a clip listed twice in a
split never multiplies spec rows; the spec table is shuffled on (lc, path),
never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import ms_to_s, truncate_long, vad_percentage, version_ordinal
from vocalstat.operators import stats
from vocalstat.session import materialize

KEYS = ["ver", "lc", "alg", "sp"]


def dedup_specs(specs: DataFrame, version_fix: dict[str, str] | None = None) -> DataFrame:
    """Full-row dedup and version-label repair (float-looking labels to real ones)."""
    s = specs.dropDuplicates()
    version_fix = dims.SPEC_VERSION_FIX if version_fix is None else version_fix
    if version_fix:
        m = F.create_map(*[F.lit(x) for kv in version_fix.items() for x in kv])
        s = s.withColumn("ver", F.coalesce(F.try_element_at(m, F.col("ver")), F.col("ver")))
    return s


def specs_for_splits(split_paths: DataFrame, specs: DataFrame, keys: Sequence[str] = KEYS,
                     path: str = "path", ds: str = "cv") -> DataFrame:
    """J7 + J8 in the order that does not multiply: each split's **distinct** paths are
    matched to spec rows on (lc, path) first (an equi-join, so a spec row meets only
    the splits that hold its clip), then specs newer than the dataset's version are
    dropped by ordinal (Q9). Version 1 gets none (F6)."""
    paths = (split_paths.where(F.col("ver") != F.lit("1"))
             .select(*keys, F.col(path).alias("orig_path")).distinct())
    s = (specs.where(F.col("ds") == F.lit(ds)).withColumn("_sord", version_ordinal("ver"))
         .drop("ver", "ds"))
    j = paths.join(s, ["lc", "orig_path"])
    return j.where(F.col("_sord") <= version_ordinal("ver")).drop("_sord")


def specs_of_datasets(datasets: DataFrame, log: DataFrame, ds: str = "cv") -> DataFrame:
    """Spec rows of each dataset (ver, lc), from a spec log with ``since``.

    A dataset lists the log's folders up to its own version, at most one a release, and meets them by
    equality on (lc, since): no condition compares versions row by row, and folders no dataset lists are not read.
    """
    d = datasets.select("ver", "lc").distinct().where(version_ordinal("ver").isNotNull() & (F.col("ver") != F.lit("1")))
    folders = F.transform(F.sequence(F.lit(0), version_ordinal("ver")), lambda i: F.lpad(i.cast("string"), 2, "0"))
    return d.withColumn("since", F.explode(folders)).join(log.where(F.col("ds") == F.lit(ds)), ["lc", "since"]).drop("since")


def specs_of_splits(split_paths: DataFrame, specs: DataFrame, keys: Sequence[str] = KEYS,
                    path: str = "path") -> DataFrame:
    """Spec rows of each split, by membership of (lc, orig_path) in the split's
    **distinct** paths; version 1 gets none (F6)."""
    paths = split_paths.where(F.col("ver") != F.lit("1")).select(*keys, F.col(path).alias("orig_path")).distinct()
    return paths.join(specs, ["ver", "lc", "orig_path"]) if "ver" in specs.columns else \
        paths.join(specs, ["lc", "orig_path"])


def errors_of_splits(split_paths: DataFrame, errors: DataFrame, keys: Sequence[str] = KEYS,
                     path: str = "path", ds: str = "cv") -> DataFrame:
    """J6 + A32: errors, err_r / err_freq by source, per split (Q13: no table = 0)."""
    e = errors.where(F.col("ds") == F.lit(ds)).select("ver", "lc", "path", "source")
    paths = split_paths.select(*keys, F.col(path).alias("path")).distinct()
    j = paths.join(e, ["ver", "lc", "path"])
    per_source = j.groupBy(*keys, "source").agg(F.count(F.lit(1)).alias("n"))
    return per_source.groupBy(*keys).agg(
        F.sum("n").cast("long").alias("errors"),
        F.array_sort(F.collect_list(F.struct("source", F.col("n").cast("long").alias("n")))).alias("_e")) \
        .select(*keys, "errors", F.transform("_e", lambda s: s["source"]).alias("err_r"),
                F.transform("_e", lambda s: s["n"]).alias("err_freq"))


def quality_counts(specs: DataFrame, keys: Sequence[str] = KEYS,
                   low_snr: float = dims.LOW_SNR_THRESHOLD, low_power: float = dims.LOW_POWER_THRESHOLD) -> DataFrame:
    """Clips, dur (rounded seconds), no_vad, low_snr, low_power."""
    return specs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("clips"),
        F.rint(F.coalesce(F.sum("duration"), F.lit(0)) / 1000.0).cast("long").alias("dur"),
        F.count_if(F.col("est_snr").isNull()).alias("no_vad"),
        F.count_if(F.col("est_snr") < F.lit(low_snr)).alias("low_snr"),
        F.count_if(F.col("speech_power") < F.lit(low_power)).alias("low_power"))


def bad_clips(specs: DataFrame, keys: Sequence[str] = KEYS, low_snr: float = dims.LOW_SNR_THRESHOLD,
              low_power: float = dims.LOW_POWER_THRESHOLD, main_buckets_only: bool = True) -> DataFrame:
    """No speech, low SNR or low power; one row per clip (distinct), by clip_id."""
    bad = specs.where(F.col("est_snr").isNull() | (F.col("est_snr") < F.lit(low_snr))
                      | (F.col("speech_power") < F.lit(low_power)))
    if main_buckets_only and "alg" in keys:
        bad = bad.where((F.col("alg") == F.lit("")) & F.col("sp").isin(*dims.MAIN_BUCKETS))
    return bad.dropDuplicates([*keys, "clip_id"] if "clip_id" in specs.columns else None)


MEASURES = {
    # name: (expression, edges, drop_first, median strategy)
    "vad": (lambda: ms_to_s("speech_duration"), bins.DURATION, False, "map"),
    "vadp": (lambda: vad_percentage("speech_duration", "duration"), bins.PERCENT, False, "select"),
    "sp_pwr": (lambda: F.col("speech_power") * F.lit(1_000_000.0), bins.POWER, False, "select"),
    "sil_pwr": (lambda: F.col("silence_power") * F.lit(1_000_000_000.0), bins.POWER, False, "select"),
    "snr": (lambda: F.col("est_snr").cast("double"), bins.SNR, True, "select"),
}


def measure_stats(specs: DataFrame, keys: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """avg/med/std (3 decimals) and histogram (values truncated) of one measure."""
    expr, edges, drop_first, med = MEASURES[name]
    if med == "select":  # nearly unique numbers: straight from the rows
        summ = stats.summary(specs, keys, expr(), name, median=med, with_sum=False)
        return summ, stats.histogram(specs, keys, expr(), edges, drop_first=drop_first)
    vc = stats.value_counts(specs, keys, expr(), name="_v", count="_w", drop_nulls=False)
    summ = stats.summary_from_counts(vc, keys, "_v", "_w", name, median=med)
    summ = summ.withColumn(f"{name}_sum", truncate_long(f"{name}_sum"))
    hist = stats.histogram_from_counts(vc, keys, "_v", "_w", edges, drop_first=drop_first)
    return summ, hist


def value_distributions(specs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Labels and counts of encoding, channels, sample rate, bit rate.

    One unpivot (``stack``) and one grouped count; labels ordered as text.
    Long form (keys, measure, label, cnt).
    """
    cols = {"enc": "orig_encoding", "chan": "orig_num_channels", "srate": "orig_sample_rate",
            "brate": "orig_bitrate_kbps"}
    stack = "stack(4, " + ", ".join(f"'{k}', cast({v} as string)" for k, v in cols.items()) + ") as (measure, label)"
    long = specs.select(*keys, F.expr(stack)).where(F.col("label").isNotNull())
    return long.groupBy(*keys, "measure", "label").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


def audio_stats(specs: DataFrame, keys: Sequence[str] = KEYS, errors: DataFrame | None = None,
                split_paths: DataFrame | None = None) -> DataFrame:
    """One audio-analysis record per split group (A31-A38), arrays for frequencies.

    With ``split_paths`` every split has a record: one without specs keeps zeros and
    empty arrays, as the published placeholder.
    """
    keys = list(keys)
    parts = [quality_counts(specs, keys), *measure_records(specs, keys), label_arrays(specs, keys)]
    if errors is not None and split_paths is not None:
        parts.append(errors_of_splits(split_paths, errors, keys))
    if split_paths is not None:
        parts.append(split_paths.select(*keys).distinct())
    rec = stats.assemble(parts, keys)
    if split_paths is None:
        rec = rec.where(F.col("clips").isNotNull())
    if errors is not None and split_paths is not None:
        rec = rec.withColumn("errors", F.coalesce("errors", F.lit(0).cast("long")))
    else:
        rec = (rec.withColumn("errors", F.lit(0).cast("long"))
               .withColumn("err_r", F.array().cast("array<string>"))
               .withColumn("err_freq", F.array().cast("array<long>")))
    if split_paths is not None:
        blank = {"bigint": F.lit(0).cast("long"), "double": F.lit(0.0), "array<string>": F.array().cast("array<string>"),
                 "array<bigint>": F.array().cast("array<long>")}
        none = F.col("clips").isNull()
        rec = rec.select(*[(F.when(none & F.col(c).isNull(), blank[t]).otherwise(F.col(c)).alias(c) if c not in keys and t in blank
                            else F.col(c)) for c, t in rec.dtypes])
    return rec


def measure_records(specs: DataFrame, keys: Sequence[str]) -> list[DataFrame]:
    """A34-A37 for the record. The nearly unique measures are unpivoted to (keys, measure, value): one
    aggregate has their moments, one their bins, and one range partition orders all medians; whole
    milliseconds go through value counts."""
    keys = list(keys)
    kinds = lambda how: {n: m for n, m in MEASURES.items() if m[3] == how}
    spec = lambda ms: {n: stats.Measure(m[1], drop_first=m[2]) for n, m in ms.items()}
    loose, counted = kinds("select"), kinds("map")
    long = specs.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), m[0]().cast("double").alias("value")) for n, m in loose.items()])))
    long = materialize(long, "measures")
    fields = ("avg", "med", "std", "freq")
    out = [stats.measure_columns(stats.measure_table(long, keys, spec(loose), distinct_values=True), keys, list(loose), fields)]
    for name, m in counted.items():
        vc = stats.value_counts(specs, keys, m[0](), name="value", count="weight", drop_nulls=False).withColumn("measure", F.lit(name))
        t = stats.measure_columns(stats.measure_table(vc, keys, spec({name: m})), keys, [name], ("sum", *fields))
        out.append(t.withColumn(f"{name}_sum", truncate_long(f"{name}_sum")))
    return out


def label_arrays(specs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A38 for the record: labels and counts of each property, ordered by label as text, in one grouping."""
    of = lambda m: F.array_sort(F.collect_list(F.when(F.col("measure") == m, F.struct("label", "cnt"))))
    names = ("enc", "chan", "srate", "brate")
    arrays = value_distributions(specs, keys).groupBy(*keys).agg(*[of(m).alias(f"_{m}") for m in names])
    part = lambda m, f: F.when(F.size(f"_{m}") > 0, F.col(f"_{m}.{f}"))
    return arrays.select(*keys, *[c for m in names for c in (part(m, "label").alias(f"{m}_r"), part(m, "cnt").alias(f"{m}_freq"))])
