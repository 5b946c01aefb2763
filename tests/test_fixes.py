"""Cases in which rows were once lost, doubled or counted in the wrong place."""

import pytest
from pyspark.sql import functions as F

from tests import synthetic
from vocalstat.functions import dims
from vocalstat.functions.exprs import unknown_versions, version_ordinal
from vocalstat.operators import audio, speed, splits
from vocalstat.operators.textcorpus import enrich_sentences
from vocalstat.plans import pipeline
from vocalstat.sources import tsv


def test_texts_of_splits_stay_within_their_version(spark):
    corpus = enrich_sentences(spark.createDataFrame(
        [("xx", "a", "one two", 1), ("xx", "b", "three", 1), ("xx", "c", "four", 1)],
        "lc string, sentence_id string, sentence string, is_used int"), "sentence")
    index = spark.createDataFrame([(v, "xx", i) for v in ("16.1", "18.0", "20.0") for i in ("a", "b")] + [("20.0", "xx", "c")],
                                  "ver string, lc string, sentence_id string")
    rows = spark.createDataFrame(
        [("18.0", "xx", "s1", "train", "a", "one two"), ("18.0", "xx", "s1", "train", "c", "four"), ("16.1", "xx", "s1", "train", None, "three"),
         ("20.0", "xx", "s1", "dev", "c", "four"), ("20.0", "xx", "s1", "dev", "a", "one two"), ("99", "xx", "s1", "dev", "a", "one two")],
        "ver string, lc string, alg string, sp string, sentence_id string, sentence string")
    got = {(r.ver, r.alg, r.sp): r.s_cnt for r in pipeline.text_corpus_statistics(corpus, index, rows).collect()}
    assert got == {("16.1", "", ""): 2, ("18.0", "", ""): 2, ("20.0", "", ""): 3,
                   ("18.0", "s1", "train"): 1, ("16.1", "s1", "train"): 1, ("20.0", "s1", "dev"): 2}


PRESETS = [("xx", "t1", "Text, One", 0), ("xx", "t2", "two", 1), ("xx", "t3", "two", 2), ("xx", "two", "fourth", 3)]


@pytest.mark.parametrize("lc", ["lc", None])
def test_accents_by_text_and_by_token(spark, lc):
    df = spark.createDataFrame([("xx", f"c{i}", a) for i, a in enumerate(
        ["Text, One", "t1", "two", "t1,two,odd", "nodata", "fourth,nodata", "t3"])], "lc string, client_id string, accents string")
    presets = spark.createDataFrame(PRESETS, "lc string, token string, text string, ord int")
    got = {r.accent: (r.rec, r.voices) for r in splits.accent_counts(df, ["lc"], presets, lc=lc).collect()}
    assert got == {"t1": (3, 3), "t2": (2, 2), "t3": (1, 1), "two": (1, 1), "nodata": (2, 2), "other": (1, 1)}


@pytest.mark.parametrize("lc", ["lc", None])
def test_variants_are_not_doubled_and_are_ordered(spark, lc):
    df = spark.createDataFrame([("xx", f"c{i}", v) for i, v in enumerate(["two", "t3", "free", "nodata", "Text, One", "t1"])],
                               "lc string, client_id string, variant string")
    presets = spark.createDataFrame(PRESETS, "lc string, code string, text string, ord int")
    got = {r.variant: (r.ord, r.rec) for r in splits.variant_counts(df, ["lc"], presets, lc=lc).collect()}
    assert got == {"t2": (1, 1), "t3": (2, 1), "free": (None, 1), "nodata": (1 << 30, 1), "t1": (0, 2)}


def test_split_record_puts_what_is_no_preset_last(spark):
    clips = synthetic.clips(spark, 800).withColumn("variant", F.expr("CASE pmod(hash(path), 3) WHEN 0 THEN 'v1 text' WHEN 1 THEN 'free' ELSE NULL END"))
    inp = pipeline.SplitInputs(clips=clips, variants=spark.createDataFrame([("en", "v1", "v1 text", 0)], "lc string, code string, text string, ord int"))
    c = pipeline.prepared_clips(inp, materialize=False)
    rows = splits.split_stats(c.where("lc = 'en' AND sp = 'clips'"), variants=inp.variants).collect()
    assert rows and all(r.var_rows == ["v1", "nodata", "free"] for r in rows)


def test_locale_without_durations_is_marked(spark):
    clips, dur = synthetic.clips(spark, 1500), synthetic.durations(spark, 1500).where("lc <> 'tr'")
    ss, cs, _ = pipeline.split_statistics(pipeline.SplitInputs(clips=clips, durations=dur))
    for r in ss.collect():
        marked = r.lc == "tr" or r.ver == "1"
        assert (r.dur_total == -1.0 and r.dur_freq == []) == marked
    speeds = cs.collect()
    assert {tuple(r[k] for k in pipeline.KEYS) for r in speeds} == {tuple(r[k] for k in pipeline.KEYS) for r in ss.collect()}
    assert all((r.clips, r.cs_avg, r.cs_freq, r.cs2s) == (0, 0.0, [], []) for r in speeds if r.lc == "tr" or r.ver == "1")
    none = pipeline.split_statistics(pipeline.SplitInputs(clips=clips))[1].collect()
    assert len(none) == len(speeds) and all(r.clips == 0 for r in none)


def test_speed_choices_use_all_lengths_and_raw_means(spark):
    rows = [("g", "x" * 10, 2.9999)] + [("g", "x" * 200, None)] * 3
    df = speed.with_speed(spark.createDataFrame(rows, "k string, sentence string, duration double"))
    r = speed.speed_choice(df, ["k"]).first()
    assert r.use_short_len is False and r.use_low_cs is (r._cs_avg < 300)


def test_audio_record_for_every_split(spark):
    paths = spark.createDataFrame([("20.0", "en", "", "validated", "p1"), ("20.0", "en", "", "other", "p9")], "ver string, lc string, alg string, sp string, path string")
    specs = synthetic.specs(spark, 5).where("orig_path = 'p1'").withColumns({"lc": F.lit("en"), "ver": F.lit("20")})
    specs = specs.unionByName(specs)
    got = {r.sp: r for r in audio.audio_stats(audio.specs_for_splits(paths, audio.dedup_specs(specs)), split_paths=paths).collect()}
    assert got["validated"].clips == 1 and (got["other"].clips, got["other"].dur, got["other"].vad_freq, got["other"].enc_r) == (0, 0, [], [])


def test_unknown_versions_match_nothing(spark):
    df = spark.createDataFrame([("20",), ("20.0",), (None,)], "ver string")
    assert [r.o for r in df.select(version_ordinal("ver").alias("o")).collect()] == [None, dims.VERSIONS.index("20.0"), None]
    assert unknown_versions(df).count() == 2


def test_short_and_long_rows(spark, tmp_path):
    folder = tmp_path / "cv-corpus-20.0-2024-12-06" / "xx"
    folder.mkdir(parents=True)
    (folder / "validated.tsv").write_text("client_id\tpath\tsentence\nc1\tp1\ts1\nc2\tp2\nc3\tp3\ts3\tsurplus\n")
    rows, bad = tsv.read_clips_checked(spark, str(folder / "*.tsv"))
    assert sorted((r.client_id, r.path, r.sentence) for r in rows.collect()) == [("c1", "p1", "s1"), ("c2", "p2", None)]
    assert [r.line for r in bad.collect()] == ["c3\tp3\ts3\tsurplus"]
    out, problems = f"{tmp_path}/table", f"{tmp_path}/problems"
    for _ in range(2):  # repeated without a lookup: the dataset replaces itself
        tsv.ingest(spark, str(folder / "*.tsv"), out, problems=problems)
    assert tsv.read_ingested(spark, out).count() == 2 and spark.read.text(problems).count() == 1
    assert tsv.ingest(spark, str(folder / "*.tsv"), out, existing=out).count() == 0
    assert tsv.read_ingested(spark, out).count() == 2


def test_failed_lookup_is_an_error(spark, tmp_path):
    folder = tmp_path / "cv-corpus-20.0-2024-12-06" / "xx"
    folder.mkdir(parents=True)
    (folder / "validated.tsv").write_text("client_id\tpath\nc1\tp1\n")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET|FAILED"):
        tsv.ingest(spark, str(folder / "*.tsv"), f"{tmp_path}/out", existing=f"{tmp_path}/broken")
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET|FAILED"):
        pipeline.missing_datasets(spark.createDataFrame([("1", "x")], "ver string, lc string"), f"{tmp_path}/broken", spark)


def test_wide_spec_file(spark, tmp_path):
    names = [f.name for f in tsv.SPEC_SCHEMA.fields]
    head = ["extra", *names[::-1], "more"]
    (tmp_path / "specs.tsv").write_text("\t".join(head) + "\n" + "\t".join("7" for _ in head) + "\n")
    got = tsv.read_optional(spark, f"{tmp_path}/specs.tsv", tsv.SPEC_SCHEMA)
    assert got.schema == tsv.SPEC_SCHEMA and got.first().clip_id == 7
    assert tsv.read_optional(spark, f"{tmp_path}/none.tsv", tsv.SPEC_SCHEMA).count() == 0


def test_locale_fallback(spark):
    languages = spark.createDataFrame([(1, "en"), (2, "tr")], "id int, name string")
    datasets = spark.createDataFrame([("r1", 1)], "release_dir string, locale_id int")
    other = spark.createDataFrame([("de",)], "lc string")
    assert [r.lc for r in tsv.locales_from_tables(languages, datasets, "r1", other).collect()] == ["en"]
    assert [r.lc for r in tsv.locales_from_tables(languages, datasets, "r2", other).collect()] == ["de"]


def test_recompute_has_all_columns(spark, tmp_path):
    from vocalstat.streaming import incremental
    clips = synthetic.clips(spark, 600).where("lc = 'en'")
    inputs = pipeline.SplitInputs(clips=clips, durations=synthetic.durations(spark, 600), specs=synthetic.specs(spark, 600),
                                  variants=spark.createDataFrame([("en", "v1", "v1 text", 0)], "lc string, code string, text string, ord int"),
                                  accents=spark.createDataFrame([("en", "x", "x", 0)], "lc string, token string, text string, ord int"))
    tsv.write_ingested(clips, f"{tmp_path}/clips")
    incremental.recompute(spark, f"{tmp_path}/clips", clips.select("ver", "lc").distinct(), f"{tmp_path}/a", inputs)
    pipeline.write_results(spark, f"{tmp_path}/b", *pipeline.split_statistics(inputs))
    for table in ("splits", "cs", "aa"):
        a, b = (tsv.read_results(spark, f"{tmp_path}/{x}/{table}") for x in "ab")
        assert sorted(a.columns) == sorted(b.columns) and a.count() == b.count() > 0


def test_tsv_values_stay_in_their_field(spark, tmp_path):
    from vocalstat.sources import sinks
    sinks.write_tsv(spark.createDataFrame([("a\tb", "c\nd", "e")], "x string, y string, z string"), f"{tmp_path}/t")
    assert {r.value for r in spark.read.text(f"{tmp_path}/t").collect()} == {"x\ty\tz", "a\\tb\tc\\nd\te"}
