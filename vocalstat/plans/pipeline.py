"""End-to-end jobs over clip / sentence / report tables (the E1-E3 entry points).

One job covers every dataset: the loop variables of a per-dataset program
(version, locale, algorithm, split) are key columns, every statistic is one
grouped plan, and results are written partitioned by (lc, ver) with dynamic
overwrite, so a re-run rewrites only what it recomputed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.functions import dims
from vocalstat.functions.exprs import unify_clips
from vocalstat.operators import audio, corpus, matrix, membership, reported, speed, splits, textcorpus
from vocalstat.sources import sinks
from vocalstat.session import materialize as materialize_df

KEYS = ["ver", "lc", "alg", "sp"]


@dataclass
class SplitInputs:
    clips: DataFrame                      # raw clip rows with ver, lc, alg ('' for buckets), sp
    durations: DataFrame | None = None    # (lc, clip, duration_ms)
    specs: DataFrame | None = None        # audio specs (S10/S11)
    errors: DataFrame | None = None       # clip errors (S10)
    variants: DataFrame | None = None     # (lc, code, text, ord)
    accents: DataFrame | None = None      # (lc, token, text, ord)


def prepared_clips(inp: SplitInputs, materialize: bool = True) -> DataFrame:
    """P1-P4 + U1 + F7 + J5: unified rows, main buckets also in 'clips', algorithm
    splits only for datasets whose validated bucket has rows, durations attached.

    The result is checkpointed (written to the shared ``spark.checkpoint.dir``)
    so the dozen statistics that read it never re-run the scan, the unification
    and the duration join, and a lost executor does not replay them either.
    """
    c = unify_clips(inp.clips)
    c = splits.with_all_clips(c)
    bucket = F.col("alg") == ""
    flags = inp.clips.groupBy("ver", "lc").agg(F.max(bucket & (F.col("sp") == "validated")).alias("_validated"))
    # one row a dataset, and one a locale below: unhinted, a shuffle with few groups is not broadcast and sorts a dataset in one task
    c = c.join(F.broadcast(flags), ["ver", "lc"]).where(bucket | F.col("_validated")).drop("_validated")
    if inp.durations is not None:
        c = splits.attach_durations(c, inp.durations)
        there = inp.durations.select("lc").distinct().withColumn("has_durations", F.lit(True))
        c = c.join(F.broadcast(there), "lc", "left").withColumn("has_durations", F.coalesce("has_durations", F.lit(False)))
    else:
        c = c.withColumns({"duration": F.lit(None).cast("double"), "has_durations": F.lit(False)})
    return materialize_df(c, "clips") if materialize else c


def split_statistics(inp: SplitInputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(split stats, char speed, audio analysis) records per (ver, lc, alg, sp)."""
    c = prepared_clips(inp)
    ss = materialize_df(splits.split_stats(c, KEYS, inp.variants, inp.accents), "splits")
    cs = materialize_df(speed.char_speed_stats(c, KEYS), "cs")
    if inp.specs is not None:
        split_specs = audio.specs_for_splits(c.select(*KEYS, "path"), audio.dedup_specs(inp.specs))
        aa = materialize_df(audio.audio_stats(materialize_df(split_specs, "specs"), KEYS, inp.errors,
                                              c.select(*KEYS, "path")), "aa")
    else:
        aa = None
    return ss, cs, aa


@dataclass
class TextCounts:
    """E2 before its records: item counts by signature (texts included) and by group, and the groups of each signature."""

    by_sig: DataFrame
    groups: DataFrame
    counts: DataFrame


def text_corpus_counts(base: DataFrame, index: DataFrame, split_rows: DataFrame,
                       enrich: Callable[[DataFrame], DataFrame] | None = None) -> TextCounts:
    """What E2 counts, per (ver, lc, alg, sp): the version's corpus as a whole (alg = sp = ''), its
    buckets (labelled with the first algorithm, Q14) and its algorithm splits (J3 + J4).

    A sentence that many versions and splits share is read once: rows get a signature, the set of
    groups they belong to; items are counted by signature and those counts spread over the groups.
    ``enrich`` derives the columns that ``base`` lacks where its rows are counted.
    """
    usable = base.where(F.col("is_used") == 1) if "is_used" in base.columns else base
    tagged, groups = membership.signatures(membership.corpus_members(base, index, split_rows))
    by_sig = textcorpus.counts_by_signature(usable, tagged, enrich=enrich)
    counts = materialize_df(textcorpus.spread_counts(by_sig, groups, KEYS), "text-counts", partition_by=("kind",))
    return TextCounts(by_sig, groups, counts)


def text_corpus_statistics(base: DataFrame, index: DataFrame, split_rows: DataFrame,
                           capabilities: DataFrame | None = None,
                           enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Text-corpus records per (ver, lc, alg, sp)."""
    return text_records(text_corpus_counts(base, index, split_rows, enrich), capabilities)


def text_records(c: TextCounts, capabilities: DataFrame | None = None) -> DataFrame:
    """A10-A17 records of counted texts."""
    return textcorpus.records(c.counts, textcorpus.spread_distinct(c.by_sig, c.groups, KEYS), KEYS, capabilities)


def reported_statistics(reports: DataFrame, work: DataFrame | None = None) -> DataFrame:
    """E2 (reported): records per (ver, lc)."""
    return reported.reported_stats(reports, work)


def support_matrix(split_stats: DataFrame, locales: DataFrame) -> DataFrame:
    """A39 wide matrix from the combined split statistics."""
    return matrix.support_matrix(matrix.support_cells(split_stats), locales)


def write_results(spark: SparkSession, out: str, ss: DataFrame, cs: DataFrame, aa: DataFrame | None) -> None:
    """K3 / K5: result tables partitioned by (lc, ver), dynamic overwrite."""
    sinks.write_table(ss, f"{out}/splits")
    sinks.write_table(cs, f"{out}/cs")
    if aa is not None:
        sinks.write_table(aa, f"{out}/aa")


def missing_datasets(possible: DataFrame, results_path: str | None, spark: SparkSession,
                     force: bool = False) -> DataFrame:
    """Datasets still to compute (anti join with the result table's keys)."""
    from vocalstat.sources.tsv import path_exists, read_results
    if results_path is None or force or not path_exists(spark, results_path):
        return possible.select("ver", "lc").distinct()
    return membership.work_left(possible, read_results(spark, results_path).select("ver", "lc").distinct())


def corpus_job(spark: SparkSession, out: str, validated: DataFrame, versions: DataFrame, old_sentences: DataFrame | None = None,
               rules: DataFrame | None = None, phonemes: DataFrame | None = None) -> None:
    """A18 / A19 with K8-K10: extend the stored corpus and write the version indexes, disabled and not found sentences.

    The corpus is a log: a run writes only the sentences that it adds, to a folder of its own, and
    never touches earlier ones, so a failed run leaves the corpus as it was. ``read_corpus`` reads the
    folders that runs finished.
    """
    from vocalstat.sources.tsv import finished_folders
    runs = finished_folders(spark, f"{out}/corpus")
    _, added = corpus.extend_corpus(read_corpus(spark, out), validated, rules, phonemes)
    added.write.mode("overwrite").parquet(f"{out}/corpus/run-{len(runs):06d}")
    index, disabled, missing = corpus.version_indexes(read_corpus(spark, out), versions, old_sentences)
    sinks.write_table(sinks.version_index(index), f"{out}/index")
    sinks.write_table(sinks.disabled_sentences(disabled), f"{out}/disabled")
    sinks.write_table(missing, f"{out}/not_found")


def read_corpus(spark: SparkSession, out: str, upto: int | None = None) -> DataFrame | None:
    """The corpus after its first ``upto`` runs (all by default); none before the first run."""
    from vocalstat.sources.tsv import finished_folders
    runs = finished_folders(spark, f"{out}/corpus")[:upto]
    return spark.read.parquet(*[f"{out}/corpus/{r}" for r in runs]) if runs else None


def spec_job(spark: SparkSession, out: str, specs: DataFrame, datasets: DataFrame) -> None:
    """J8 + K11: the spec log, and the specs of the datasets that have none yet."""
    from vocalstat.sources.tsv import path_exists, read_results, read_spec_log
    sinks.write_spec_log(audio.dedup_specs(specs), f"{out}/spec_log")
    made = read_results(spark, f"{out}/dataset_specs") if path_exists(spark, f"{out}/dataset_specs") else None
    sinks.write_dataset_specs(audio.specs_of_datasets(datasets, read_spec_log(spark, f"{out}/spec_log")), f"{out}/dataset_specs", made)


def text_job(out: str, base: DataFrame, index: DataFrame, split_rows: DataFrame, capabilities: DataFrame | None = None,
             level: int = sinks.SAVE_DEFAULT) -> None:
    """Text records of versions and splits, and the frequency tables that the save level keeps (K6)."""
    c = text_corpus_counts(base, index, split_rows)
    sinks.write_table(text_records(c, capabilities), f"{out}/tc")
    tables = {"tokens": (textcorpus.TOKEN, "token"), "graphemes": (textcorpus.GRAPHEME, "grapheme"),
              "domains": (textcorpus.DOMAIN, "sentence_domain"), "phonemes": (textcorpus.PHONEME, "phoneme")}
    for name, (kind, item) in tables.items():
        freq = textcorpus.frequency(c.counts, KEYS, kind, item)
        if name != "phonemes" or "phonemised" in base.columns:
            sinks.write_table(sinks.frequency_tables_to_save(freq, level), f"{out}/freq_{name}")
    _, unknown = textcorpus.domain_counts(textcorpus.frequency(c.counts, KEYS, textcorpus.DOMAIN, "sentence_domain"), KEYS)  # labels outside the map (Q12)
    sinks.write_table(unknown, f"{out}/unknown_domains")


def reported_job(out: str, reports: DataFrame, work: DataFrame | None = None) -> None:
    """E2 (reported): records per locale folder (K4)."""
    sinks.write_reported(reported_statistics(reports, work), f"{out}/reported")


def summary_job(spark: SparkSession, out: str, locales: DataFrame, date: str) -> None:
    """The combined table (K5), the support matrix with its totals, and the configuration row."""
    from vocalstat.sources.tsv import read_results
    ss = read_results(spark, f"{out}/splits")
    sinks.write_table(sinks.combined(ss), f"{out}/combined", partition_by=())
    sinks.write_table(support_matrix(ss, locales), f"{out}/support", partition_by=())
    sinks.write_table(matrix.combined_counts(ss), f"{out}/totals", partition_by=())
    names = [r["lc"] for r in locales.select("lc").distinct().orderBy("lc").collect()]  # a row per locale
    sinks.write_table(matrix.config_row(spark, names, date), f"{out}/config", partition_by=())


def bad_clip_job(out: str, clips: DataFrame, specs: DataFrame) -> None:
    """Bad clips of the main buckets, one row a clip, ordered by clip_id within each dataset's files."""
    bad = audio.bad_clips(audio.specs_for_splits(clips.select(*KEYS, "path"), audio.dedup_specs(specs)), KEYS)
    sinks.write_table(bad.repartition("lc", "ver").sortWithinPartitions("lc", "ver", "clip_id"), f"{out}/bad_clips")


def export_job(spark: SparkSession, out: str, clips: DataFrame) -> DataFrame:
    """J10 + K13: export the training splits that the manifest lacks, then add them to it.

    Files are written before their manifest rows, and exporting again overwrites the
    same folders, so a run that broke off is simply repeated. Returns what was exported.
    """
    from vocalstat.sources.tsv import path_exists, read_results
    training = clips.where((F.col("alg") != "") & F.col("sp").isin(*dims.TRAINING_SPLITS))
    at = f"{out}/manifest"
    made = read_results(spark, at) if path_exists(spark, at) else sinks.manifest(training).limit(0)
    todo = materialize_df(membership.exports_left(training, made), "exports")
    sinks.export_splits(training.join(todo, ["ver", "lc", "alg"], "left_semi"), f"{out}/exports")
    sinks.manifest(todo).write.mode("append").parquet(at)
    return todo
