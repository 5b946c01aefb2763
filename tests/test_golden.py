"""Golden rows of FIXTURES.md §2 (worked out by hand / numpy from the rows shown)."""

import pytest
from pyspark.sql import functions as F

from vocalstat.functions import dims
from vocalstat.functions.exprs import unify_clips
from vocalstat.operators import audio, reported, speed, splits, stats, textcorpus

K = ["ver", "lc", "alg", "sp"]
CLIPS = [
    ("c1", "p1", "merhaba", 2, 0, "teens", "male_masculine"),
    ("c1", "p2", "merhaba", 2, 1, "teens", "male_masculine"),
    ("c2", "p3", "Merhaba", 3, 0, None, None),
    ("c3", "p4", "iyi günler", 0, 2, "twenties", "female_feminine"),
    ("c3", "p5", "iyi günler", 2, 0, "twenties", "female"),
]
DURATIONS = [("tr", "p1", 1500), ("tr", "p2", 2500), ("tr", "p3", 999), ("tr", "p4", 30000)]


@pytest.fixture(scope="module")
def clips(spark):
    raw = spark.createDataFrame(
        [("20.0", "tr", "", "validated", *r) for r in CLIPS],
        "ver string, lc string, alg string, sp string, client_id string, path string, sentence string, "
        "up_votes int, down_votes int, age string, gender string")
    c = unify_clips(raw)
    d = spark.createDataFrame(DURATIONS, "lc string, clip string, duration_ms long")
    return splits.attach_durations(c, d)


def one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0]


def test_a24_counts(clips):
    r = one(splits.basic_counts(clips, K))
    assert (r.clips, r.uq_v, r.uq_s, r.uq_sl) == (5, 3, 3, 2)


def test_a25_durations(clips):
    s, h = splits.duration_stats(clips, K)
    r = one(s)
    assert (r.dur_total, r.dur_avg, r.dur_med, r.dur_std) == (34.999, 8.75, 2.0, 12.281)
    freq = [x.cnt for x in h.orderBy("bin").collect()]
    assert len(freq) == 18 and freq[:3] == [1, 1, 1] and freq[-1] == 1 and sum(freq) == 4


def test_a26_a27_per_item(clips):
    s, h = splits.per_item_stats(clips, K, "client_id", "v", [0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024,
                                                            2048, 4096, 8192, 16384, 32768, 65536, 131072, 999999])
    r = one(s)
    assert (r.v_avg, r.v_med, r.v_std) == (1.667, 2.0, 0.471)
    assert [x.cnt for x in h.orderBy("bin").collect()] == [1, 2] + [0] * 16
    s, h = splits.per_item_stats(clips, K, "sentence", "s", [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 20, 30, 40, 50, 100,
                                                           999999])
    r = one(s)
    assert (r.s_avg, r.s_med, r.s_std) == (1.667, 2.0, 0.471)
    assert [x.cnt for x in h.orderBy("bin").collect()] == [1, 2] + [0] * 13


def test_a28_votes(clips):
    s, h = splits.vote_stats(clips, K, "up_votes", "uv")
    r = one(s)
    assert (r.uv_sum, r.uv_avg, r.uv_med, r.uv_std) == (9, 1.667, 1.0, 0.943)
    assert [x.cnt for x in h.orderBy("bin").collect()] == [1, 0, 3, 1] + [0] * 11
    s, h = splits.vote_stats(clips, K, "down_votes", "dv")
    r = one(s)
    assert (r.dv_sum, r.dv_avg, r.dv_med, r.dv_std) == (3, 1.667, 1.0, 0.943)
    assert [x.cnt for x in h.orderBy("bin").collect()] == [3, 1, 1] + [0] * 12


def test_a29_demographics(clips):
    rec, uq = splits.demographics(clips, K)
    m = {(r.age, r.gender): r.n for r in rec.collect()}
    assert len(m) == 55
    assert m[("teens", "male")] == 2 and m[("twenties", "female")] == 2 and m[("nodata", "nodata")] == 1
    assert m[("teens", "TOTAL")] == 2 and m[("TOTAL", "TOTAL")] == 5
    assert sum(v for (a, g), v in m.items() if a != "TOTAL" and g != "TOTAL") == 5
    u = {(r.age, r.gender): r.n for r in uq.collect()}
    assert u[("teens", "male")] == 1 and u[("twenties", "female")] == 1 and u[("nodata", "nodata")] == 1
    assert u[("TOTAL", "TOTAL")] == 3
    arr = one(stats.matrix_array(rec, K, name="dem_table")).dem_table
    assert len(arr) == 11 and all(len(x) == 5 for x in arr) and arr[-1][-1] == 5


def test_p14_c1_speed(clips):
    df = speed.with_speed(clips)
    cs = [r.char_speed for r in df.orderBy("path").collect()]
    assert cs == [214.0, 357.0, 143.0, 3000.0, None]
    rec = one(speed.char_speed_stats(clips, K))
    assert (rec.cs_avg, rec.cs_med, rec.cs_std) == (928.5, 285.5, 1198.462)
    assert rec.clips == 4
    assert len(rec.cs_freq) == 18 and sum(rec.cs_freq) == 4  # HIGH bins; [650, 999999) holds 3000
    assert rec.cs_freq[-1] == 1


def test_split_record(clips):
    rec = one(splits.split_stats(clips, K))
    assert rec.clips == 5 and rec.dur_total == 34.999 and rec.uv_freq[:4] == [1, 0, 3, 1]
    assert len(rec.dem_table) == 11 and rec.dem_fix_r == []


def test_sentences(spark):
    df = spark.createDataFrame([("x", "a b", "general,finance"), ("x", "a b c", "agriculture"), ("x", "b", None)],
                               "lc string, sentence string, sentence_domain string")
    df = textcorpus.enrich_sentences(df)
    w, _ = textcorpus.word_stats(df, ["lc"])
    r = one(w)
    assert (r.w_sum, r.w_avg, r.w_med, r.w_std) == (6, 2.0, 2.0, 0.816)
    freq = textcorpus.token_table(df, ["lc"])
    assert {x.token: x["count"] for x in freq.collect()} == {"b": 3, "a": 2, "c": 1}
    t, _ = textcorpus.token_stats(freq, ["lc"])
    r = one(t)
    assert (r.t_sum, r.t_avg, r.t_med, r.t_std) == (3, 2.0, 2.0, 0.816)
    g = one(textcorpus.top_items(textcorpus.grapheme_table(df, ["lc"]), ["lc"], "grapheme", 100, "g"))
    assert g.g_items == [" ", "b", "a", "c"] and g.g_freq == [3, 3, 2, 1] and g.g_cnt == 4
    doms, quarantine = textcorpus.domain_counts(textcorpus.domain_table(df, ["lc"]), ["lc"])
    assert [(x.domain, x["count"]) for x in doms.orderBy("dom_idx").collect()] == [
        ("agriculture_food", 1), ("finance", 1), ("general", 1)]
    assert quarantine.count() == 0


def test_text_corpus_record(spark):
    df = spark.createDataFrame([("x", "1", "a b", "general"), ("x", "2", "a b c", None)],
                               "lc string, sentence_id string, sentence string, sentence_domain string")
    rec = one(textcorpus.text_corpus_stats(textcorpus.enrich_sentences(df), ["lc"]))
    assert rec.s_cnt == 2 and rec.c_sum == 8 and len(rec.c_freq) == 22 and rec.dom_items == ["general"]


def test_reported(spark):
    df = spark.createDataFrame([("s1", "grammar-or-spelling"), ("s1", "rude"), ("s1", None),
                                ("s2", "different-language")], "sentence_id string, reason string")
    df = df.withColumn("ver", F.lit("17.0")).withColumn("lc", F.lit("tr"))
    work = df.select("ver", "lc").union(df.sparkSession.createDataFrame([("17.0", "de")], "ver string, lc string"))
    recs = {r.lc: r for r in reported.reported_stats(df, work).collect()}
    r = recs["tr"]
    assert (r.rep_sum, r.rep_sen, r.rep_avg, r.rep_med, r.rep_std) == (4, 2, 2.0, 2.0, 1.0)
    assert r.rea_freq == [0, 1, 1, 0, 2]
    assert recs["de"].rep_sum == 0  # A23: listed dataset with no reports


def test_snr(spark):
    vals = [-150.0, -0.5, 0.0, 12.3, 100.0, None]
    df = spark.createDataFrame([("k", v, 1e-3) for v in vals], "k string, est_snr double, speech_power double")
    q = one(audio.quality_counts(df.withColumn("duration", F.lit(1000)), ["k"]))
    assert (q.no_vad, q.low_snr) == (1, 2)
    s, h = audio.measure_stats(df, ["k"], "snr")
    r = one(s)
    assert (r.snr_avg, r.snr_med, r.snr_std) == (-7.64, 0.0, 80.448)
    assert [x.cnt for x in h.orderBy("bin").collect()] == [0, 0, 0, 0, 2, 1] + [0] * 8 + [1]


def test_accents(spark):
    df = spark.createDataFrame([("x", "c1", "x"), ("x", "c2", "x,z"), ("x", "c3", None), ("x", "c4", "z,w")],
                               "lc string, client_id string, accents string")
    df = df.withColumn("accents", F.coalesce("accents", F.lit(dims.NODATA)))
    presets = df.sparkSession.createDataFrame([("x", "x", "x", 0), ("x", "y", "y", 1)],
                                              "lc string, token string, text string, ord int")
    got = {r.accent: r.rec for r in splits.accent_counts(df, ["lc"], presets).collect()}
    assert got == {"x": 2, "y": 0, "nodata": 1, "other": 3}


def test_variants(spark):
    df = spark.createDataFrame([("x", "c1", "Long Name"), ("x", "c1", "Long Name"), ("x", "c2", "nodata"),
                                ("x", "c3", "free text")], "lc string, client_id string, variant string")
    presets = df.sparkSession.createDataFrame([("x", "ln", "Long Name", 0)], "lc string, code string, text string, ord int")
    got = {r.variant: (r.rec, r.voices) for r in splits.variant_counts(df, ["lc"], presets).collect()}
    assert got == {"ln": (2, 1), "nodata": (1, 1), "free text": (1, 1)}


def test_bucket_union(spark):
    df = spark.createDataFrame([("validated", ""), ("invalidated", ""), ("train", "s1")], "sp string, alg string")
    got = sorted((r.alg, r.sp) for r in splits.with_all_clips(df).collect())
    assert got == [("", "clips"), ("", "clips"), ("", "invalidated"), ("", "validated"), ("s1", "train")]
