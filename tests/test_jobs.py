"""Whole jobs: what they write can be read back, and a repeated run changes nothing."""


import duckdb

from tests import synthetic
from vocalstat.plans import jobs, pipeline
from vocalstat.sources import tsv


def sentences(spark, ids, used=1):
    return spark.createDataFrame([("xx", i, f"text {i}", "general,odd", "src", used, 0) for i in ids],
                                 "lc string, sentence_id string, sentence string, sentence_domain string, source string, is_used int, clips_count int")


def test_corpus_and_text_jobs(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    versions = spark.createDataFrame([("16.1", "xx"), ("20.0", "xx")], "ver string, lc string")
    old = spark.createDataFrame([("16.1", "xx", "text a"), ("16.1", "xx", "gone")], "ver string, lc string, sentence string")
    pipeline.corpus_job(spark, out, sentences(spark, "ab"), versions, old)
    for _ in range(2):
        pipeline.corpus_job(spark, out, sentences(spark, "abc").unionByName(sentences(spark, "d", 0)), versions, old)
    base = pipeline.read_corpus(spark, out)
    assert sorted(r.sentence_id for r in base.collect()) == ["a", "b", "c", "d"]
    runs = [sorted(r.sentence_id for r in spark.read.parquet(f"{out}/corpus/run-{i:06d}").collect()) for i in range(3)]
    assert runs == [["a", "b"], ["c", "d"], []]  # a run writes only what it adds
    assert sorted(r.sentence_id for r in pipeline.read_corpus(spark, out, 1).collect()) == ["a", "b"]
    read = lambda t: sorted((r.ver, r.sentence_id) for r in tsv.read_results(spark, f"{out}/{t}").collect())
    assert read("index") == [("16.1", "a"), ("20.0", "a"), ("20.0", "b"), ("20.0", "c")]
    assert read("disabled") == [("20.0", "d")] and read("not_found") == [("16.1", "b"), ("16.1", "c")]
    rows = spark.createDataFrame([("20.0", "xx", "", "validated", "b", "text b")], "ver string, lc string, alg string, sp string, sentence_id string, sentence string")
    index = tsv.read_results(spark, f"{out}/index")
    pipeline.text_job(out, base, index, rows)
    got = {(r.ver, r.alg, r.sp): (r.s_cnt, r.dom_items) for r in tsv.read_results(spark, f"{out}/tc").collect()}
    assert got == {("16.1", "", ""): (1, ["general"]), ("20.0", "", ""): (3, ["general"]), ("20.0", "s1", "validated"): (1, ["general"])}
    tokens = tsv.read_results(spark, f"{out}/freq_tokens").where("ver = '20.0' AND alg = ''")
    assert {r.token: r["count"] for r in tokens.collect()} == {"text": 3, "a": 1, "b": 1, "c": 1}
    assert {r.label for r in tsv.read_results(spark, f"{out}/unknown_domains").collect()} == {"odd"}


def test_summary_export_and_bad_clip_jobs(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    clips = synthetic.clips(spark, 800)
    inputs = pipeline.SplitInputs(clips=clips, durations=synthetic.durations(spark, 800), specs=synthetic.specs(spark, 800))
    pipeline.write_results(spark, out, *pipeline.split_statistics(inputs))
    locales = clips.select("lc").distinct()
    pipeline.summary_job(spark, out, locales, "2025-01-01")
    assert spark.read.parquet(f"{out}/support").count() == locales.count()
    assert spark.read.parquet(f"{out}/totals").first().total_splits == spark.read.parquet(f"{out}/combined").count()
    assert spark.read.parquet(f"{out}/config").first().cv_locales == sorted(r.lc for r in locales.collect())
    first, again = pipeline.export_job(spark, out, clips), pipeline.export_job(spark, out, clips)
    assert first.count() > 0 and again.count() == 0
    assert spark.read.parquet(f"{out}/manifest").count() == first.count()
    pipeline.bad_clip_job(out, clips, inputs.specs.unionByName(inputs.specs))
    bad = tsv.read_results(spark, f"{out}/bad_clips")
    assert bad.count() == bad.select(*pipeline.KEYS, "clip_id").distinct().count() > 0 and bad.where("alg <> ''").count() == 0
    pipeline.reported_job(out, spark.createDataFrame([("20.0", "xx", "s1", "user")], "ver string, lc string, sentence_id string, reason string"),
                          spark.createDataFrame([("20.0", "xx"), ("20.0", "yy")], "ver string, lc string"))
    assert {r.lc: r.rep_sum for r in tsv.read_results(spark, f"{out}/reported").collect()} == {"xx": 1, "yy": 0}


def same_as_sql(df, sql, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{table}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=repr) == expected and expected


def test_files_hold_all_versions_locales_and_buckets(spark):
    sf = "/root/testdata/sf0.001"
    sql = jobs.oracle_sql()
    same_as_sql(jobs.tsv_round_trip(spark, sf), sql["tsv_round_trip"], "events")
    same_as_sql(jobs.plain_files(spark, sf), sql["plain_files"], "documents")


def test_reported_files_hold_whole_texts(spark, tmp_path):
    sql = jobs.REPORTED_FILES_SQL
    same_as_sql(jobs.reported_files(spark, "/root/testdata/sf0.001"), sql, "conversations")
    texts = ["one line", "two\nlines " + "and many words " * 30, "a\n\nb  c\nd", "back\\slash"]
    spark.createDataFrame([(i, 1, "user", t) for i, t in enumerate(texts * 2)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    same_as_sql(jobs.reported_files(spark, str(tmp_path)), sql.replace("FROM conversations", f"FROM '{tmp_path}/conversations.parquet/*.parquet'"), "conversations")


def test_newest_durations_are_chosen_by_file_name(spark, tmp_path):
    have = {"15.0-2023-09-08": ["en", "de"], "16.1-2023-12-06": ["en", "fr"], "9.0-2022-04-27": ["en", "tr"]}
    for release, lcs in have.items():
        for lc in lcs:
            folder = tmp_path / f"cv-corpus-{release}" / lc
            folder.mkdir(parents=True)
            (folder / "clip_durations.tsv").write_text(f"clip\tduration[ms]\n{lc}-{release[:2]}\t7\n")
            (folder / "other.tsv").write_text("x\n")
    got = tsv.read_newest_durations(spark, f"file://{tmp_path}")
    assert sorted((r.lc, r.clip, r.duration_ms) for r in got.collect()) == [("de", "de-15", 7), ("en", "en-16", 7), ("fr", "fr-16", 7), ("tr", "tr-9.", 7)]
    assert len(got.inputFiles()) == 4
    (tmp_path / "empty").mkdir()
    assert tsv.read_newest_durations(spark, f"file://{tmp_path}/empty").count() == 0


def test_spec_log_prunes_folders(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = [(1, "p1", "cv", "xx", "16.100000381469727", 5), (1, "p1", "cv", "xx", "20.0", 5), (2, "p2", "cv", "xx", "18.0", 6), (3, "p3", "cv", "yy", "20.0", 7),
            (4, "p4", "other", "xx", "1", 8), (5, "p5", "cv", "xx", "nonsense", 9)]
    specs = spark.createDataFrame(rows, "clip_id long, orig_path string, ds string, lc string, ver string, duration long")
    datasets = spark.createDataFrame([(v, lc) for v in ("1", "16.1", "18.0", "20.0", "odd") for lc in ("xx", "yy")], "ver string, lc string")
    for _ in range(2):
        pipeline.spec_job(spark, out, specs, datasets)
    got = sorted((r.ver, r.lc, r.clip_id) for r in tsv.read_results(spark, f"{out}/dataset_specs").collect())
    assert got == [("16.1", "xx", 1), ("18.0", "xx", 1), ("18.0", "xx", 2), ("20.0", "xx", 1), ("20.0", "xx", 2), ("20.0", "yy", 3)]
    upto = tsv.read_spec_log(spark, f"{out}/spec_log", "16.1")
    plan = upto._jdf.queryExecution().executedPlan().toString()
    assert "since" in plan.split("PartitionFilters")[1] and sorted(r.clip_id for r in upto.collect()) == [1, 4]
