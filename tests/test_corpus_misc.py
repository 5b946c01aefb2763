"""A18/A19 incremental corpus, J3, J9, K6, K14, S6/S7, A40/A41."""

import json
import os
import random
import tempfile

from pyspark.sql import functions as F

from vocalstat.functions import dims
from vocalstat.operators import corpus, matrix, membership, textcorpus
from vocalstat.operators.textcorpus import enrich_sentences
from vocalstat.plans import pipeline
from vocalstat.sources import sinks, tsv

S = "lc string, sentence_id string, sentence string, sentence_domain string, source string, is_used int, clips_count int"


def test_extend_corpus_adds_only_new(spark):
    v1 = spark.createDataFrame([("tr", "a", "Merhaba dünya", None, "s", 1, 0), ("tr", "b", "İyi günler", None, "s", 0, 0)], S)
    rules = spark.createDataFrame([("tr", r"^[\p{L}\p{M} ]+$")], "lc string, allowed string")
    c1, added1 = corpus.extend_corpus(None, v1, rules)
    assert added1.count() == 2
    v2 = v1.unionByName(spark.createDataFrame([("tr", "c", "yeni 123", None, "s", 1, 0)], S))
    c2, added2 = corpus.extend_corpus(c1, v2, rules)
    assert [r.sentence_id for r in added2.collect()] == ["c"]
    got = {r.sentence_id: (r.word_cnt, r.valid) for r in c2.collect()}
    assert got == {"a": (2, 1), "b": (2, 1), "c": (2, 0)}  # Q1: old rows kept


def test_version_indexes(spark):
    c = spark.createDataFrame([("tr", "a", "x y", None, "s", 1, 0), ("tr", "b", "z", None, "s", 0, 0),
                               ("tr", "c", "w", None, "s", 1, 0)], S)
    c, _ = corpus.extend_corpus(None, c)
    versions = spark.createDataFrame([("20.0", "tr"), ("5.1", "tr")], "ver string, lc string")
    old = spark.createDataFrame([("5.1", "tr", "w"), ("5.1", "tr", "gone")], "ver string, lc string, sentence string")
    idx, disabled, not_found = corpus.version_indexes(c, versions, old)
    got = sorted((r.ver, r.sentence_id) for r in idx.collect())
    assert got == [("20.0", "a"), ("20.0", "c"), ("5.1", "c")]
    assert [r.sentence_id for r in disabled.collect()] == ["b"]
    assert sorted(r.sentence_id for r in not_found.collect()) == ["a"]


def test_corpus_rows_of_splits_by_id_and_text(spark):
    c = spark.createDataFrame([("tr", "a", "x"), ("tr", "b", "y")], "lc string, sentence_id string, sentence string")
    sp = spark.createDataFrame([("20.0", "tr", "s1", "train", "a", "zzz"), ("20.0", "tr", "s1", "train", "a", "zzz"),
                                ("5.1", "tr", "s1", "dev", None, "y")],
                               "ver string, lc string, alg string, sp string, sentence_id string, sentence string")
    got = sorted((r.ver, r.sp, r.sentence_id) for r in membership.corpus_rows_of_splits(c, sp).collect())
    assert got == [("20.0", "train", "a"), ("5.1", "dev", "b")]  # distinct: no multiplication


def test_work_left(spark):
    possible = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], "ver string, lc string")
    done = spark.createDataFrame([("1", "a")], "ver string, lc string")
    nodata = spark.createDataFrame([("2", "a")], "ver string, lc string")
    assert [tuple(r) for r in membership.work_left(possible, done, nodata).collect()] == [("1", "b")]
    assert membership.work_left(possible, done, force=True).count() == 3


def test_save_levels(spark):
    f = spark.createDataFrame([("", ""), ("s1", "train"), ("s5", "train"), ("s1", "other")], "alg string, sp string")
    assert sinks.frequency_tables_to_save(f, sinks.SAVE_DEFAULT).count() == 2
    assert sinks.frequency_tables_to_save(f, sinks.SAVE_DETAILED).count() == 4
    assert sinks.frequency_tables_to_save(f, sinks.SAVE_NONE).count() == 0


def test_config_row(spark):
    r = matrix.config_row(spark, ["tr", "en"], "2025-01-01").collect()[0]
    assert r.bins_voices[0] == 1 and r.bins_duration[-1] == 30 and r.bins_percent[-1] == 100
    assert r.cv_versions == dims.VERSIONS and r.bins_reasons[-1] == "other"


def test_locales_sources(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "meta.json")
    with open(p, "w") as f:
        json.dump({"locales": {"tr": {"x": 1}, "en": {"x": 2}}}, f)
    assert [r.lc for r in tsv.locales_from_json(spark, p).collect()] == ["en", "tr"]
    langs = spark.createDataFrame([(1, "tr"), (2, "en"), (3, "de")], "id int, name string")
    ds = spark.createDataFrame([("cv-corpus-20.0-2024-12-06", 1), ("cv-corpus-20.0-2024-12-06", 3),
                                ("cv-corpus-19.0-2024-09-13", 2)], "release_dir string, locale_id int")
    got = tsv.locales_from_tables(langs, ds, "cv-corpus-20.0-2024-12-06")
    assert [r.lc for r in got.collect()] == ["de", "tr"]
    assert dims.release_dir("20.0") == "cv-corpus-20.0-2024-12-06" and dims.release_dir("3") == "cv-corpus-3"


def test_counters(spark):
    w = spark.createDataFrame([("tc", "processed"), ("tc", "exists"), ("tc", "nodata"), ("rep", "processed")],
                              "phase string, status string")
    got = {r.phase: (r.total, r.processed, r.exists, r.nodata) for r in matrix.run_counters(w).collect()}
    assert got == {"tc": (3, 1, 1, 1), "rep": (1, 1, 0, 0)}
    ss = spark.createDataFrame([("20.0", "tr", "", "validated"), ("20.0", "tr", "s1", "train"),
                                ("20.0", "de", "s1", "dev")], "ver string, lc string, alg string, sp string")
    r = matrix.combined_counts(ss).collect()[0]
    assert (r.total_splits, r.total_lc, r.total_algo) == (3, 2, 2)


def test_specs_for_splits_equals_dataset_then_split(spark):
    from tests import synthetic
    from vocalstat.functions.exprs import version_ordinal
    from vocalstat.operators import audio
    c = synthetic.clips(spark, 2000).select("ver", "lc", "alg", "sp", "path")
    specs = synthetic.specs(spark, 2000)
    direct = audio.specs_for_splits(c, specs)
    # the plain order: each dataset's specs first, then its splits'
    s = specs.where("ds = 'cv'").withColumn("so", version_ordinal("ver")).drop("ver")
    d = c.select("ver", "lc").distinct().withColumn("do", version_ordinal("ver"))
    staged = audio.specs_of_splits(c, s.join(d, "lc").where("so <= do").drop("so", "do"))
    key = ["ver", "lc", "alg", "sp", "clip_id"]
    assert sorted(tuple(r) for r in direct.select(*key).collect()) == \
        sorted(tuple(r) for r in staged.select(*key).collect())
    assert direct.count() > 0


def test_sinks_write_once_and_problems(spark):
    d = tempfile.mkdtemp()
    specs = spark.createDataFrame([("20.0", "tr", 1), ("20.0", "de", 2)], "ver string, lc string, clip_id long")
    sinks.write_dataset_specs(specs.where(F.col("lc") == "tr"), f"{d}/specs")
    written = tsv.read_results(spark, f"{d}/specs")
    sinks.write_dataset_specs(specs, f"{d}/specs", existing=written)
    assert sorted((r.lc, r.clip_id) for r in tsv.read_results(spark, f"{d}/specs").collect()) == [("de", 2), ("tr", 1)]
    probs = spark.createDataFrame([("f", 3, "junk", "unrepairable")], "file string, ln long, line string, reason string")
    sinks.write_problems(probs, f"{d}/problems", ver="20.0", lc="tr")
    assert tsv.read_results(spark, f"{d}/problems").collect()[0].line == "junk"
    rep = spark.createDataFrame([("20.0", "tr", 4), ("19.0", "tr", 2)], "ver string, lc string, rep_sum long")
    sinks.write_reported(rep, f"{d}/reported")
    assert [r.ver for r in sinks.combined(tsv.read_results(spark, f"{d}/reported")).collect()] == ["19.0", "20.0"]


def test_fillable_demographics(spark):
    from vocalstat.operators import splits
    df = spark.createDataFrame([("k", "c1", "male"), ("k", "c1", "nodata"), ("k", "c1", "nodata"),
                                ("k", "c2", "male"), ("k", "c2", "female"), ("k", "c2", "nodata"),
                                ("k", "c3", "nodata")], "sp string, client_id string, gender string")
    r = splits.fillable_demographics(df, ["sp"]).collect()[0]
    assert (r.fillable_recordings, r.fillable_voices) == (2, 1)


def test_records_by_signature_equal_records_of_copied_rows(spark):
    """E2 counted once a sentence equals the record over rows copied into every group they belong to."""
    rnd = random.Random(3)
    words = ["alpha", "be", "Gamma", "d", "ééé", "two words", "x  y"]
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(0, 40))) for _ in range(30)] + ["", None, "long " * 400]
    rows = [(lc, f"{i}", rnd.choice(texts), rnd.choice(["general", "general,healthcare", "odd", None]), rnd.choice([0, 1, None]), rnd.choice(texts), int(i % 9 > 0))
            for lc in ("xx", "yy") for i in range(80)]
    corpus = enrich_sentences(spark.createDataFrame(rows, "lc string, sentence_id string, sentence string, sentence_domain string, valid int, phonemised string, is_used int"))
    index = spark.createDataFrame([(v, lc, f"{i}") for v in ("16.1", "18.0", "20.0") for lc in ("xx", "yy") for i in range(80) if rnd.random() < 0.7],
                                  "ver string, lc string, sentence_id string")
    split = [(v, r[0], alg, sp, r[1], r[2]) for v in ("16.1", "18.0", "20.0") for r in rows
             for alg, sp in (("", "validated"), ("", "other"), ("s1", "train"), ("s99", "dev")) if rnd.random() < 0.3]
    split = spark.createDataFrame(split * 2, "ver string, lc string, alg string, sp string, sentence_id string, sentence string")
    base = membership.restrict_to_index(corpus, index)
    used = membership.corpus_rows_of_splits(base, split)
    used = used.withColumn("alg", F.when(F.col("alg") == "", F.lit("s1")).otherwise(F.col("alg")))
    copied = base.withColumns({"alg": F.lit(""), "sp": F.lit("")})
    copied = copied.unionByName(used.select(*copied.columns))
    caps = spark.createDataFrame([("xx", True, False)], "lc string, has_val boolean, has_phon boolean")
    want = textcorpus.text_corpus_stats(copied, pipeline.KEYS, caps, top=5)
    c = pipeline.text_corpus_counts(corpus, index, split)
    got = textcorpus.records(c.counts, textcorpus.spread_distinct(c.by_sig, c.groups, pipeline.KEYS), pipeline.KEYS, caps, top=5)
    read = lambda df: sorted((str([(k, r[k]) for k in sorted(df.columns)]) for r in df.collect()))
    assert read(got) == read(want) and want.count() > 20
    assert c.groups.select("lc", "sig").distinct().count() > 5
    own = textcorpus.item_counts(copied, pipeline.KEYS)
    assert read(textcorpus.records(own, textcorpus.distinct_texts(own, pipeline.KEYS), pipeline.KEYS, caps, top=5)) == read(want)
