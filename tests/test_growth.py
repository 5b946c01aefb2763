"""Steps whose share of one task, or whose moved bytes, must not grow with the rows of a group."""

from pyspark.sql import functions as F

from vocalstat.functions import bins
from vocalstat.operators import seq, speed, textcorpus
from vocalstat.plans import driver, pipeline
from vocalstat.sources import repair


def _speeds(spark, n=4000):
    """Two groups and a null one; each row has a speed and a length within the bins."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "cold").alias("k"), (F.col("id") % 7).cast("string").alias("label"),
        F.when(F.col("id") % 10 < 7, (F.col("id") % 50) / 10.0).otherwise((F.col("id") % 90) * 1.0).alias("duration"),
        (F.col("id") % 37 + 1).cast("int").alias("qty"))
    return speed.with_speed(rows, length="qty")


def _edge(x, edges):
    return next(a for a, b in zip(edges, edges[1:]) if a <= x < b)


def _plain_bins(df):
    """(k, label, speed bin, length bin) of every row, and the chosen speed bins by group, row by row."""
    data = [r for r in df.collect() if r.k is not None]
    low, short = {}, {}
    for k in {r.k for r in data}:
        cs, ln = [r.char_speed for r in data if r.k == k], [r.s_len for r in data if r.k == k]
        low[k], short[k] = sum(cs) / len(cs) < bins.CS_THRESHOLD, sum(ln) / len(ln) < bins.CHARS_THRESHOLD
    return [(r.k, r.label, _edge(r.char_speed, bins.CS_LOW if low[r.k] else bins.CS_HIGH),
             _edge(r.s_len, bins.CHARS_SHORT if short[r.k] else bins.CHARS_LONG)) for r in data], low


def test_crosstab_joins_counts_not_rows(spark):
    df = _speeds(spark)
    want, _ = _plain_bins(df)
    b = speed.binned(df, ["k"], speed.speed_choice(df, ["k"]))
    cells = b.collect()
    assert sum(r.n for r in cells) == len(want) and len(cells) < 1000
    got = {(r.k, r.bin_cs, r.bin_slen): r.n for r in speed.speed_vs_length(b, ["k"]).collect()}
    both = [(k, c, s) for k, _, c, s in want]
    assert {x: n for x, n in got.items() if n} == {x: both.count(x) for x in set(both)}
    observed = {(k, c, s) for k, c, _ in both for k2, _, s in both if k == k2}
    assert set(got) == observed


def _labelled(spark, labels):
    """(got, wanted, cells) of speed bins by label, columns dense over ``labels``."""
    df = _speeds(spark)
    rows = [(k, c, x) for k, x, c, _ in _plain_bins(df)[0] if x in labels]
    want = {(k, c, x): rows.count((k, c, x)) for k, c in {r[:2] for r in rows} for x in labels}
    b = speed.binned(df, ["k"], speed.speed_choice(df, ["k"]), ["label"]).where(F.col("label").isin(labels))
    got = {(r.k, r.bin_cs, r.label): r.n for r in speed.speed_vs(b, ["k"], "label", labels).collect()}
    return got, want, b.columns


def test_speed_by_many_labels_from_counts(spark):
    got, want, columns = _labelled(spark, [str(i) for i in range(7)])
    assert got == want and "n" in columns


def test_speed_by_two_labels_from_counts(spark):
    got, want, columns = _labelled(spark, ["1", "0"])
    assert got == want and "n" in columns


def test_adaptive_histogram_joins_sums_not_rows(spark):
    df = _speeds(spark)
    choice = speed.speed_choice(df, ["k"])
    hist = speed.speed_histogram(df, ["k"], choice)
    want, low = _plain_bins(df)
    for r in hist.collect():
        edges = bins.CS_LOW if low[r.k] else bins.CS_HIGH
        assert (r.lo, r.cnt) == (edges[r.bin], sum(k == r.k and c == edges[r.bin] for k, _, c, _ in want))
    # the outermost join is one of sums: right below it stands their aggregate
    plan = hist._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "Aggregate" in plan[next(i for i, x in enumerate(plan) if "Join Inner" in x) + 1]


def _clips(spark, n=600):
    return spark.range(n).select(
        F.when(F.col("id") % 3 > 0, "20.0").otherwise("19.0").alias("ver"), F.when(F.col("id") % 5 > 0, "en").otherwise("xx").alias("lc"),
        F.when(F.col("id") % 4 > 0, "").otherwise("s1").alias("alg"),
        F.when(F.col("id") % 4 == 0, "train").when(F.col("id") % 5 > 0, "validated").otherwise("other").alias("sp"),
        F.concat(F.lit("v"), F.col("id") % 9).alias("client_id"), F.concat(F.lit("p"), F.col("id")).alias("path"),
        F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("sentence"), F.lit("1").alias("up_votes"), F.lit("0").alias("down_votes"),
        F.lit("twenties").alias("age"), F.lit("other").alias("gender"))


def test_datasets_of_clips_are_broadcast(spark):
    """Clips are never sorted by their dataset: the tables of a row per dataset or locale go to the clips."""
    dur = _clips(spark).where("lc = 'en'").select("lc", F.col("path").alias("clip"), F.lit(4000).alias("duration_ms"))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = pipeline.prepared_clips(pipeline.SplitInputs(clips=_clips(spark), durations=dur), materialize=False)
        plan = c._jdf.queryExecution().executedPlan().toString()
        got = {tuple(r) for r in c.groupBy("ver", "lc", "alg", "sp", "has_durations").agg(F.count("*"), F.count("duration")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1  # the join on clips stays as it was
    rows = [(r.ver, r.lc, r.alg, sp) for r in _clips(spark).collect() for sp in ([r.sp] if r.alg else [r.sp, "clips"])]
    rows = [r for r in rows if not r[2] or r[1] == "en"]  # xx has no validated clips
    assert got == {(*r, r[1] == "en", rows.count(r), rows.count(r) if r[1] == "en" else 0) for r in rows}


def test_only_sentences_are_stored_for_counting(spark, monkeypatch):
    """Normalised texts, tokens and phonemes are derived where they are counted; the records stay the same."""
    base = spark.createDataFrame([("xx", str(i), t, 1) for i, t in enumerate(["One two, two", "three  TWO", "one two two", None, ""])],
                                 "lc string, sentence_id string, sentence string, is_used int")
    index = base.select(F.lit("20.0").alias("ver"), "lc", "sentence_id")
    rows = spark.createDataFrame([("20.0", "xx", "", "validated", "0", None), ("20.0", "xx", "s1", "dev", "4", None)],
                                 "ver string, lc string, alg string, sp string, sentence_id string, sentence string")
    stored = {}
    keep = textcorpus.materialize
    monkeypatch.setattr(textcorpus, "materialize", lambda df, name="mat", **kw: stored.setdefault(name, df.columns) and keep(df, name, **kw))
    enrich = lambda d: textcorpus.enrich_sentences(d).withColumn("phonemised", F.reverse("normalized"))
    got = pipeline.text_corpus_statistics(base, index, rows, None, enrich).collect()
    assert stored["tagged"] == ["lc", "sig", "sentence"]
    assert sorted(map(str, got)) == sorted(map(str, pipeline.text_corpus_statistics(enrich(base), index, rows).collect()))
    assert {(r.alg, r.sp): (r.s_cnt, r.uq_s, r.uq_n, r.w_sum, r.t_sum) for r in got}["", ""] == (5, 4, 3, 8, 3)


def test_numbers_are_dense_and_ordered(spark):
    rows = [(i * 7919 % 500 if i % 9 else None, i, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long, v string").repartition(7)
    got = seq.number_rows(df, ["k", "i"], "n", partitions=6)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got.columns == ["v", "n"] and [tuple(r) for r in got.orderBy("n").collect()] == [(v, n) for n, (_, _, v) in enumerate(want)]


def test_invalid_texts_are_not_stored(spark, monkeypatch):
    """What decides about broken lines is stored without them, and valid lines are joined with nothing."""
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(
        ["a" * 64 + "\tone", "two\td\ts\t1\t2", "b" * 64 + "\tx\td\ts\t1\t2", "junk"])], "file string, ln long, value string")
    stored, keep = {}, repair.materialize
    monkeypatch.setattr(repair, "materialize", lambda df, name="mat", **kw: stored.setdefault(name, df.columns) and keep(df, name, **kw))
    rows, problems = repair.repair_lines(lines, 6, repair.SENTENCE_COLUMNS, header=False)
    assert sorted((r.ln, r.sentence) for r in rows.collect()) == [(0, "one two"), (2, "x")]
    assert [(r.ln, r.line) for r in problems.collect()] == [(3, "junk")]
    assert stored["invalid"] and not any("value" in columns for columns in stored.values())
    joins = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) == 1


def test_rendered_documents_of_one_id_keep_their_lines(spark, tmp_path):
    """Texts leave for their numbers once, and lines of equal ids do not mix."""
    docs = [(1, "a\nb\nc", "en", "s", 5), (1, "d\ne\nf", "en", "s", 5), (None, "g\nh", "en", "s", 3), (0, None, "en", "s", 0), (2, "k", "de", "t", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    lines = driver.rendered_lines(spark, str(tmp_path))
    got = [r.value for r in lines.orderBy("ln").collect()]
    assert [r.ln for r in lines.orderBy("ln").collect()] == list(range(10))
    zeros = lambda i: f"{i:064d}"
    one, two = [f"{zeros(1)}\ta", "b", "c\ten\ts\t1\t5"], [f"{zeros(1)}\td", "e", "f\ten\ts\t1\t5"]
    assert got in ([*["g", "h\ten\ts\t1\t3", f"{zeros(0)}\ten\ts\t1\t0"], *x, f"{zeros(2)}\tk\tde\tt\t1\t1"] for x in (one + two, two + one))
    assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_pid" not in lines._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
