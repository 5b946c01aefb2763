"""Queries over the driver tables for whole jobs, sources and sinks, each beside its oracle SQL.

Stand-ins as in ``vocalstat.plans.driver``. Sources and sinks are run on files: a
driver table is written to the scratch folder in the input format and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import (int_or_null, list_to_text, nodata, release_dir, unify_clips, version_column,
                                       version_date, version_ordinal)
from vocalstat.operators import audio, corpus, matrix, membership, speed, splits
from vocalstat.plans import pipeline
from vocalstat.plans.driver import (AGE_LABELS, GENDER_LABELS, _pick, load, split_results)
from vocalstat.plans.sqlgen import hist_sql, r3, values_list
from vocalstat.session import scratch_path
from vocalstat.sources import sinks, tsv
from vocalstat.sources.repair import SENTENCE_COLUMNS, number_lines, read_reported, repair_lines

VERSIONS = ["1", "16.1", "20.0"]
BUCKETS = ["validated", "invalidated", "other"]


def _arrays_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[list_to_text(c).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- clips

def release_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a release's clip files: accent under its old or new name, columns missing."""
    e = load(spark, sf_dir, "events")
    u = F.col("user_id")
    accent = F.concat(F.lit("a"), (u % 4).cast("string"))
    bucket = _pick(BUCKETS, F.pmod("event_id", F.lit(3)))
    return e.select(
        _pick(VERSIONS, u % 3).alias("ver"), F.concat(F.lit("l"), (F.floor(u / 3) % 4).cast("string")).alias("lc"),
        F.when(F.col("event_id") % 4 == 1, "s1").otherwise("").alias("alg"),
        F.when(F.col("event_id") % 4 == 1, "train").when(F.floor(u / 3) % 4 == 3, "other").otherwise(bucket).alias("sp"),
        u.cast("string").alias("client_id"), F.col("event_id").cast("string").alias("path"), F.upper("props").alias("sentence"),
        (u % 5).cast("string").alias("up_votes"), F.lit("0").alias("down_votes"),
        _pick(AGE_LABELS, F.pmod(u, F.lit(11))).alias("age"), _pick(GENDER_LABELS, F.pmod(u, F.lit(7))).alias("gender"),
        F.when(u % 2 == 0, accent).alias("accents"), F.when(u % 2 == 1, F.when(u % 5 > 0, accent)).alias("accent"))


def _release_sql() -> str:
    lit = lambda x: "NULL" if x is None else f"'{x}'"
    pick = lambda xs, i: f"([{', '.join(map(lit, xs))}])[{i} + 1]"
    back = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in dims.GENDER_BACKMAP.items())
    gender = f"coalesce({pick(GENDER_LABELS, 'user_id % 7')}, 'nodata')"
    return f"""SELECT {pick(VERSIONS, 'user_id % 3')} AS ver, 'l' || CAST((user_id // 3) % 4 AS VARCHAR) AS lc,
  CASE WHEN event_id % 4 = 1 THEN 's1' ELSE '' END AS alg,
  CASE WHEN event_id % 4 = 1 THEN 'train' WHEN (user_id // 3) % 4 = 3 THEN 'other' ELSE {pick(BUCKETS, 'event_id % 3')} END AS sp,
  CAST(user_id AS VARCHAR) AS client_id, event_id, upper(props) AS sentence, user_id % 5 AS up_votes,
  coalesce({pick(AGE_LABELS, 'user_id % 11')}, 'nodata') AS age, CASE {gender} {back} ELSE {gender} END AS gender,
  CASE WHEN user_id % 2 = 0 OR user_id % 5 > 0 THEN 'a' || CAST(user_id % 4 AS VARCHAR) ELSE 'nodata' END AS accents
FROM events"""


def clips_unified(spark, sf_dir):
    """One schema over release layouts."""
    c = unify_clips(release_clips(spark, sf_dir))
    return c.groupBy("ver", "lc", "age", "gender", "accents", "variant", "segment", "sentence_domain").agg(
        F.count(F.lit(1)).alias("n"), F.sum("up_votes").cast("long").alias("up"), F.sum("down_votes").cast("long").alias("down"),
        F.count_if(F.col("sentence_lower") == F.lower("sentence")).alias("lowered"), F.count_distinct("locale").alias("locales"))


def _clip_inputs(spark, sf_dir) -> pipeline.SplitInputs:
    e = load(spark, sf_dir, "events").where("event_id % 7 <> 0")
    dur = e.select(F.explode(F.array(*map(F.lit, ("l0", "l1", "l3")))).alias("lc"), F.col("event_id").cast("string").alias("clip"),
                   (F.col("user_id") * 10).alias("duration_ms"))
    return pipeline.SplitInputs(clips=release_clips(spark, sf_dir), durations=dur)


def clips_prepared(spark, sf_dir):
    """What the split statistics are computed on; l3 has no validated rows, l2 no durations."""
    c = pipeline.prepared_clips(_clip_inputs(spark, sf_dir))
    return c.groupBy("ver", "lc", "alg", "sp").agg(
        F.count(F.lit(1)).alias("clips"), F.count("duration").alias("timed"),
        F.sum(F.round(F.col("duration") * 1000).cast("long")).alias("ms"), F.max("has_durations").alias("has_durations"))


def split_durations(spark, sf_dir):
    """A25 in the split record: -1 and empty for version 1 and for locales without durations; U3 over all keys."""
    ss = splits.split_stats(pipeline.prepared_clips(_clip_inputs(spark, sf_dir)))
    return ss.select("ver", "lc", "alg", "sp", "clips", "dur_total", "dur_avg", list_to_text("dur_freq").alias("dur_freq"))


def speed_placeholders(spark, sf_dir):
    """C1 records of every split; one without durations keeps the empty record."""
    cs = speed.char_speed_stats(pipeline.prepared_clips(_clip_inputs(spark, sf_dir)))
    return cs.groupBy("ver", "lc").agg(F.count(F.lit(1)).alias("splits"), F.sum("clips").cast("long").alias("clips"),
                                       F.count_if((F.col("clips") == 0) & (F.size("cs_freq") == 0)).alias("empty"))


def _prepared_sql() -> str:
    return f"""
WITH r AS ({_release_sql()}),
v AS (SELECT DISTINCT ver, lc FROM r WHERE alg = '' AND sp = 'validated'),
u AS (SELECT * FROM r UNION ALL SELECT * REPLACE ('clips' AS sp) FROM r WHERE alg = ''),
c AS (SELECT u.*, CASE WHEN lc <> 'l2' AND ver <> '1' AND event_id % 7 <> 0 THEN CAST(client_id AS BIGINT) * 10 END AS ms, lc <> 'l2' AS has_durations
      FROM u WHERE alg = '' OR EXISTS (SELECT 1 FROM v WHERE v.ver = u.ver AND v.lc = u.lc))"""


def speed_by_age(spark, sf_dir):
    """Speed bins by age, columns dense over the fixed labels."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_returnflag", _pick(dims.AGES, F.pmod("l_suppkey", F.lit(7))).alias("age"), F.col("l_quantity").cast("int").alias("len"),
        (F.col("l_extendedprice") / 20000.0).alias("duration"))
    df = speed.with_speed(li, length="len")
    ch = speed.speed_choice(df, ["l_returnflag"])
    return speed.speed_vs(speed.binned(df, ["l_returnflag"], ch, ["age"]), ["l_returnflag"], "age", dims.AGES)


def _speed_by_age_sql() -> str:
    case = lambda edges: "CASE " + " ".join(
        f"WHEN s >= {a} AND s < {b} THEN {a}" for a, b in zip(edges, edges[1:])) + " END"
    ages = "[" + ", ".join(f"'{a}'" for a in dims.AGES) + "]"
    return f"""
WITH r AS (SELECT l_returnflag, ({ages})[l_suppkey % 7 + 1] AS age,
             round_even(1000.0 * ((l_extendedprice / 20000.0) / CAST(CAST(l_quantity AS INTEGER) AS DOUBLE)), 0) AS s FROM lineitem),
m AS (SELECT l_returnflag, avg(s) < {bins.CS_THRESHOLD} AS low FROM r GROUP BY 1),
b AS (SELECT r.l_returnflag, age, CAST(CASE WHEN low THEN {case(bins.CS_LOW)} ELSE {case(bins.CS_HIGH)} END AS BIGINT) AS bin_cs FROM r JOIN m USING (l_returnflag)),
g AS (SELECT DISTINCT l_returnflag, bin_cs FROM b WHERE bin_cs IS NOT NULL),
a AS (SELECT unnest({ages}) AS age)
SELECT g.l_returnflag, g.bin_cs, a.age, CAST(count(b.age) AS BIGINT) AS n
FROM g CROSS JOIN a LEFT JOIN b ON b.l_returnflag = g.l_returnflag AND b.bin_cs = g.bin_cs AND b.age = a.age GROUP BY ALL"""


def silence_power(spark, sf_dir):
    """P16 + A36: silence power (x1e9), statistics and histogram as text."""
    e = load(spark, sf_dir, "events").select("event_type", (F.col("value") * F.lit(1e-9)).alias("silence_power"))
    s, h = audio.measure_stats(e, ["event_type"], "sil_pwr")
    h = h.groupBy("event_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bin", "cnt"))), lambda x: x["cnt"].cast("string")), "#").alias("freq"))
    return s.join(h, "event_type")


def fillable(spark, sf_dir):
    """Voices with blank and exactly one real gender."""
    e = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("sp"), (F.col("user_id") % 97).cast("string").alias("client_id"),
        nodata(F.when(F.col("event_id") % 3 > 0, F.when(F.col("user_id") % 2 == 0, "male").otherwise(
            F.when(F.col("event_id") % 5 == 0, "female").otherwise("male")))).alias("gender"))
    return splits.fillable_demographics(e, ["sp"])


# ---------------------------------------------------------------- audio specs

def split_specs(spark, sf_dir):
    """J7 + J8 + S11: specs of each split, up to its version; repeated rows and number-like labels repaired."""
    li = load(spark, sf_dir, "lineitem").select(
        _pick(["1", "16.1", "20.0"], F.pmod("l_partkey", F.lit(3))).alias("ver"), F.lit("x").alias("lc"), F.lit("").alias("alg"),
        F.col("l_returnflag").alias("sp"), F.col("l_orderkey").cast("string").alias("path"))
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("clip_id"), F.col("o_orderkey").cast("string").alias("orig_path"), F.lit("cv").alias("ds"), F.lit("x").alias("lc"),
        _pick(["16.100000381469727", "20", "18.0", "no_version"], F.pmod("o_custkey", F.lit(4))).alias("ver"), F.col("o_totalprice").cast("long").alias("duration"))
    s = audio.specs_for_splits(li, audio.dedup_specs(o.unionByName(o)))
    return s.groupBy("ver", "sp").agg(F.count(F.lit(1)).alias("n"), F.sum("duration").alias("dur"))


# ---------------------------------------------------------------- text corpus

def _versioned(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """documents as a corpus (is_used 0 for each 11th; not enriched), an index of three overlapping versions, and split rows."""
    d = load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("sentence"), F.col("lang").alias("lc"))
    d = d.withColumns({"sentence_id": F.col("doc_id").cast("string"), "is_used": (F.col("doc_id") % 11 > 0).cast("int")})
    every = d.select("lc", "sentence_id", "doc_id")
    index = every.where("doc_id % 4 < 3").withColumn("ver", F.lit("16.1")).unionByName(
        every.where("doc_id % 4 > 0").withColumn("ver", F.lit("18.0"))).unionByName(every.withColumn("ver", F.lit("20.0"))).drop("doc_id")
    lab = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    rows = lab.select(F.explode(F.array(*map(F.lit, ("16.1", "18.0", "20.0")))).alias("ver"), F.col("lang").alias("lc"),
                      F.when(F.col("quality") == 1, "").otherwise("s1").alias("alg"), F.when(F.col("quality") == 1, "validated").otherwise("train").alias("sp"),
                      F.col("doc_id").cast("string").alias("sentence_id"), F.col("text").alias("sentence"))
    return d.drop("doc_id"), index, rows


def split_texts(spark, sf_dir):
    """Text records of the version and of its splits, within the version's index."""
    rec = pipeline.text_corpus_statistics(*_versioned(spark, sf_dir))
    return rec.select("ver", "lc", "alg", "sp", "s_cnt", "uq_s", "c_sum", "c_avg", "c_med", "c_std", "w_sum", "t_sum", "g_cnt")


SPLIT_TEXTS_SQL = r"""
WITH c AS (SELECT doc_id, lang AS lc, text, CAST(length(text) AS BIGINT) AS n, doc_id % 11 > 0 AS used,
             list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') AS tokens FROM documents),
i AS (SELECT '16.1' AS ver, * FROM c WHERE used AND doc_id % 4 < 3 UNION ALL SELECT '18.0', * FROM c WHERE used AND doc_id % 4 > 0
      UNION ALL SELECT '20.0', * FROM c WHERE used),
s AS (SELECT DISTINCT CASE WHEN quality = 1 THEN 'validated' ELSE 'train' END AS sp, d.lang AS lc, l.doc_id, d.text FROM labels l JOIN documents d USING (doc_id)),
m AS (SELECT i.*, '' AS alg, '' AS sp FROM i
      UNION ALL SELECT i.*, 's1', s.sp FROM i JOIN s ON s.lc = i.lc AND s.doc_id = i.doc_id WHERE i.ver <> '16.1'
      UNION ALL SELECT i.*, 's1', s.sp FROM i JOIN (SELECT DISTINCT sp, lc, text FROM s) s ON s.lc = i.lc AND s.text = i.text WHERE i.ver = '16.1'),
t AS (SELECT ver, lc, alg, sp, count(DISTINCT token) AS t_sum FROM (SELECT ver, lc, alg, sp, unnest(tokens) AS token FROM m) GROUP BY ALL),
g AS (SELECT ver, lc, alg, sp, count(DISTINCT ch) AS g_cnt FROM (SELECT ver, lc, alg, sp, unnest(string_split(text, '')) AS ch FROM m) GROUP BY ALL)
SELECT m.ver, m.lc, m.alg, m.sp, count(*) AS s_cnt, count(DISTINCT text) AS uq_s, CAST(sum(n) AS BIGINT) AS c_sum, """ + \
    f"{r3('avg(n)')} AS c_avg, {r3('median(n)')} AS c_med, {r3('stddev_pop(n)')} AS c_std, CAST(sum(len(tokens)) AS BIGINT) AS w_sum," + """
  any_value(t.t_sum) AS t_sum, any_value(g.g_cnt) AS g_cnt
FROM m JOIN t USING (ver, lc, alg, sp) JOIN g USING (ver, lc, alg, sp) GROUP BY m.ver, m.lc, m.alg, m.sp"""


def corpus_versions(spark, sf_dir):
    """Index, disabled and not found sentences per version."""
    d, _, _ = _versioned(spark, sf_dir)
    versions = d.select("lc").distinct().select(F.explode(F.array(F.lit("16.1"), F.lit("20.0"))).alias("ver"), "lc")
    old = load(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.lit("16.1").alias("ver"), F.col("lang").alias("lc"), F.col("text").alias("sentence"))
    index, disabled, missing = corpus.version_indexes(d.select("lc", "sentence_id", "sentence", "is_used"), versions, old)
    count = lambda t, kind: t.groupBy("ver", "lc").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("sentence_id").cast("long")).alias("ids")).withColumn("kind", F.lit(kind))
    return count(sinks.version_index(index), "index").unionByName(count(sinks.disabled_sentences(disabled), "disabled")).unionByName(count(missing, "not_found"))


def corpus_growth(spark, sf_dir):
    """A corpus extended by what it lacks; validity by locale, phonemes where given."""
    d = load(spark, sf_dir, "documents").select(
        F.col("lang").alias("lc"), F.col("doc_id").cast("string").alias("sentence_id"), F.col("text").alias("sentence"), F.lit("").alias("sentence_domain"),
        "source", F.lit(1).alias("is_used"), F.lit(0).alias("clips_count"), "doc_id")
    rules = spark.createDataFrame([("en", "^[a-z0-9 ]+$"), ("de", r"^[\p{L}0-9 ]+$")], "lc string, allowed string")
    phon = d.where("doc_id % 2 = 0").select("lc", "sentence_id", F.lit("p").alias("phonemised"))
    base, _ = corpus.extend_corpus(None, d.where("doc_id % 5 < 2").drop("doc_id"), rules, phon)
    grown, added = corpus.extend_corpus(base, d.drop("doc_id"), rules, phon)
    n = added.groupBy("lc").agg(F.count(F.lit(1)).alias("added"))
    return grown.groupBy("lc").agg(F.count(F.lit(1)).alias("n"), F.sum("valid").cast("long").alias("valid"), F.count("phonemised").alias("phonemised"),
                                   F.sum("word_cnt").cast("long").alias("words"), F.sum("char_cnt").cast("long").alias("chars")).join(n, "lc")


CORPUS_GROWTH_SQL = r"""
WITH d AS (SELECT lang AS lc, doc_id, text, trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')) AS norm FROM documents)
SELECT lc, count(*) AS n, CAST(CASE lc WHEN 'en' THEN count(*) FILTER (WHERE regexp_matches(norm, '^[a-z0-9 ]+$'))
    WHEN 'de' THEN count(*) FILTER (WHERE regexp_matches(norm, '^[\p{L}0-9 ]+$')) END AS BIGINT) AS valid,
  count(*) FILTER (WHERE doc_id % 2 = 0) AS phonemised,
  CAST(sum(len(list_filter(string_split(norm, ' '), lambda x: x <> ''))) AS BIGINT) AS words, CAST(sum(length(text)) AS BIGINT) AS chars,
  count(*) FILTER (WHERE doc_id % 5 >= 2) AS added
FROM d GROUP BY lc"""


def saved_frequencies(spark, sf_dir):
    """K6: grapheme tables of buckets and splits, kept by the default save level, written and read back."""
    from vocalstat.operators.textcorpus import grapheme_table
    d = load(spark, sf_dir, "documents").select(
        F.lit("20.0").alias("ver"), F.col("lang").alias("lc"), _pick(["", "s1", "s99"], F.pmod("doc_id", F.lit(3))).alias("alg"),
        _pick(["", "validated", "train", "other"], F.pmod("doc_id", F.lit(4))).alias("sp"), "text")
    path = scratch_path(spark, "frequencies")
    freq = grapheme_table(d, ["ver", "lc", "alg", "sp"], "text")
    sinks.write_table(sinks.frequency_tables_to_save(freq, sinks.SAVE_DEFAULT), path)
    return tsv.read_results(spark, path).select("lc", "alg", "sp", "grapheme", F.col("count").alias("n"))


# ---------------------------------------------------------------- reported, work lists, matrix

def reported_record(spark, sf_dir):
    """Reported records per (ver, lc) with a zero record for datasets without reports."""
    r = load(spark, sf_dir, "conversations").select(
        _pick(["18.0", "20.0"], F.pmod("conv_id", F.lit(2))).alias("ver"), F.concat(F.lit("l"), (F.col("conv_id") % 3).cast("string")).alias("lc"),
        F.col("conv_id").alias("sentence_id"), F.col("role").alias("reason"))
    work = r.select("ver", "lc").unionByName(r.select(F.lit("21.0").alias("ver"), "lc")).distinct()
    return _arrays_as_text(pipeline.reported_statistics(r, work))


def _reported_sql() -> str:
    src = "SELECT CASE WHEN conv_id % 2 = 0 THEN '18.0' ELSE '20.0' END AS ver, 'l' || CAST(conv_id % 3 AS VARCHAR) AS lc, conv_id, role FROM conversations"
    per = f"SELECT ver, lc, conv_id, count(*) AS c FROM ({src}) GROUP BY ALL"
    reasons = [*dims.REPORT_REASONS, dims.OTHER]
    label = "CASE WHEN role IN (" + ", ".join(f"'{x}'" for x in dims.REPORT_REASONS) + f") THEN role ELSE '{dims.OTHER}' END"
    freq = " || '#' || ".join(f"CAST(count(*) FILTER (WHERE {label} = '{x}') AS VARCHAR)" for x in reasons)
    return f"""
WITH a AS (SELECT ver, lc, count(*) AS rep_sum, count(DISTINCT conv_id) AS rep_sen, {freq} AS rea_freq FROM ({src}) GROUP BY ALL),
s AS (SELECT ver, lc, {r3('avg(c)')} AS rep_avg, {r3('median(c)')} AS rep_med, {r3('stddev_pop(c)')} AS rep_std FROM ({per}) GROUP BY ALL),
h AS (SELECT ver, lc, string_agg(CAST(cnt AS VARCHAR), '#' ORDER BY bin) AS rep_freq
      FROM ({hist_sql(per, ['ver', 'lc'], 'c', bins.REPORTED, drop_first=True)}) GROUP BY ALL)
SELECT ver, lc, rep_sum, rep_sen, rep_avg, rep_med, rep_std, rep_freq, rea_freq FROM a JOIN s USING (ver, lc) JOIN h USING (ver, lc)
UNION ALL SELECT DISTINCT '21.0', lc, 0, 0, 0.0, 0.0, 0.0, '', '' FROM ({src})"""


def run_status(spark, sf_dir):
    """A41 + J9 + J10 + K13: work items with a status from what was done, exported and empty, counted per phase."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("string").alias("ver"), F.col("o_orderpriority").alias("lc"), F.col("o_orderstatus").alias("alg"))
    done = o.where("alg = 'P'")
    left = membership.work_left(o, done.where("ver < '1997'")).withColumn("status", F.lit("processed"))
    kept = done.where("ver < '1997'").select("ver", "lc").distinct().withColumn("status", F.lit("exists"))
    stats_phase = left.unionByName(kept).withColumn("phase", F.lit("stats"))
    manifest = sinks.manifest(done.where("ver >= '1996'"))
    todo = membership.exports_left(o, manifest).select("ver", "lc", F.lit("processed").alias("status"))
    made = manifest.select("ver", "lc", F.lit("exists").alias("status"))
    return matrix.run_counters(stats_phase.unionByName(todo.unionByName(made).withColumn("phase", F.lit("export"))))


RUN_STATUS_SQL = """
WITH o AS (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS ver, o_orderpriority AS lc, o_orderstatus AS alg FROM orders),
k AS (SELECT DISTINCT ver, lc FROM o WHERE alg = 'P' AND ver < '1997'), a AS (SELECT DISTINCT ver, lc FROM o),
m AS (SELECT * FROM o WHERE alg = 'P' AND ver >= '1996')
SELECT 'stats' AS phase, (SELECT count(*) FROM a) AS total, (SELECT count(*) FROM a) - (SELECT count(*) FROM k) AS processed,
  (SELECT count(*) FROM k) AS "exists", CAST(0 AS BIGINT) AS nodata
UNION ALL SELECT 'export', (SELECT count(*) FROM o), (SELECT count(*) FROM o) - (SELECT count(*) FROM m), (SELECT count(*) FROM m), 0"""


def release_locales(spark, sf_dir):
    """J11 + S7: locales with a dataset in a release; the fallback list counts when there are none."""
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    c = load(spark, sf_dir, "customer").select(F.concat(F.lit("r"), (F.col("c_nationkey") % 5).cast("string")).alias("release_dir"), F.col("c_nationkey").alias("locale_id"))
    other = load(spark, sf_dir, "region").select(F.col("r_name").alias("lc"))
    found = [tsv.locales_from_tables(n, c, r, other).withColumn("release", F.lit(r)) for r in ("r1", "r4", "none")]
    return found[0].unionByName(found[1]).unionByName(found[2])


def support_wide(spark, sf_dir):
    """The wide matrix, one column per version, all locales."""
    years = {str(1992 + i): v for i, v in enumerate(dims.VERSIONS[-12:])}
    ss = split_results(spark, sf_dir)
    ss = ss.withColumn("ver", F.coalesce(*[F.when(F.col("ver") == y, F.lit(v)) for y, v in years.items()]))
    wide = pipeline.support_matrix(ss, load(spark, sf_dir, "nation").select(F.col("n_name").alias("lc")))
    return wide.withColumn("lang", F.coalesce("lang", F.lit("")))


def _support_wide_sql() -> str:
    years = {str(1992 + i): v for i, v in enumerate(dims.VERSIONS[-12:])}
    case = "CASE CAST(year(l_shipdate) AS VARCHAR) " + " ".join(f"WHEN '{y}' THEN '{v}'" for y, v in years.items()) + " END"
    cols = ", ".join(f"max(CASE WHEN ver = '{v}' THEN cell END) AS {dims.version_column(v)}" for v in dims.VERSIONS)
    return f"""
WITH r AS (SELECT n.n_name AS lc, {case} AS ver, l_returnflag AS alg, l_quantity AS q FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
           JOIN nation n ON n.n_nationkey = s.s_nationkey),
c AS (SELECT lc, ver, CAST(round_even(sum(q) * 100.0 / 3600.0 * 10, 0) / 10 AS VARCHAR) || '|' || string_agg(DISTINCT alg, '|' ORDER BY alg) AS cell
      FROM r WHERE ver IS NOT NULL GROUP BY lc, ver)
SELECT n.n_name AS lc, '' AS lang, {cols} FROM nation n LEFT JOIN c ON c.lc = n.n_name GROUP BY n.n_name"""


def version_dimension(spark, sf_dir):
    """Ordinal, date, folder and column of version labels; unknown labels have none. Whole numbers where possible."""
    e = load(spark, sf_dir, "events").select(_pick([*dims.VERSIONS, "20", "x"], F.pmod("user_id", F.lit(22))).alias("ver"), "props")
    k = F.regexp_extract("props", r'"k": *([^}]*)\}', 1)
    e = e.withColumns({"num": int_or_null(k), "ord": version_ordinal("ver"), "day": version_date("ver").cast("string"),
                       "folder": F.when(version_ordinal("ver").isNotNull(), release_dir("ver")), "col": version_column("ver")})
    return e.groupBy("ver", "ord", "day", "folder", "col").agg(F.count(F.lit(1)).alias("n"), F.count("num").alias("numbers"), F.sum("num").alias("total"))


def _version_sql() -> str:
    table = values_list([(v, i, d, dims.release_dir(v)) for i, (v, d) in enumerate(zip(dims.VERSIONS, dims.VERSION_DATES))], ["ver", "ord", "day", "folder"], "v")
    labels = "[" + ", ".join(f"'{v}'" for v in [*dims.VERSIONS, "20", "x"]) + "]"
    return f"""
WITH e AS (SELECT ({labels})[user_id % 22 + 1] AS ver, TRY_CAST(regexp_extract(props, '"k": *([^}}]*)[}}]', 1) AS BIGINT) AS num FROM events)
SELECT e.ver, CAST(v.ord AS INTEGER) AS ord, v.day, v.folder, 'v' || replace(e.ver, '.', '_') AS col, count(*) AS n, count(num) AS numbers, CAST(sum(num) AS BIGINT) AS total
FROM e LEFT JOIN {table} ON v.ver = e.ver GROUP BY ALL"""


# ---------------------------------------------------------------- files

def tsv_round_trip(spark, sf_dir):
    """Clips exported as compressed TSV below release folders, read back by header, ingested twice."""
    base = scratch_path(spark, "release")
    c = release_clips(spark, sf_dir).withColumns({"release": release_dir("ver"), "alg": F.when(F.col("alg") == "", tsv.BUCKET_TOKEN).otherwise(F.col("alg"))})
    new = F.col("ver") == "20.0"
    for layout, part in (("old", c.where(~new).drop("accents", "age")), ("new", c.where(new).drop("accent"))):
        sinks.write_tsv(part.drop("ver"), f"{base}/layout={layout}", partition_by=("release", "lc", "alg", "sp"), compression="gzip")
    rows, bad = tsv.read_by_header(spark, base, tsv.CLIP_SCHEMA, "client_id")
    key = lambda name: F.regexp_extract("file", f"/{name}=([^/]*)/", 1).alias(name)
    rows = tsv.from_ingested(rows.select(F.regexp_extract("file", tsv.RELEASE_RE, 1).alias("ver"), key("lc"), key("alg"), key("sp"),
                                         "client_id", "path", "sentence", "accents", "age"))
    table = scratch_path(spark, "ingested")
    for _ in range(2):
        tsv.write_ingested(rows, table)
    got = tsv.read_ingested(spark, table)
    return got.groupBy("ver", "lc", "alg", "sp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("path").cast("long")).alias("paths"),
                                                     F.count("accents").alias("accents"), F.count("age").alias("ages"), F.max("sentence").alias("last"))


def _round_trip_sql() -> str:
    return f"""
SELECT ver, lc, alg, sp, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS paths,
  count(*) FILTER (WHERE ver = '20.0' AND accents <> 'nodata' AND CAST(client_id AS BIGINT) % 2 = 0) AS accents,
  count(*) FILTER (WHERE ver = '20.0' AND age <> 'nodata') AS ages, max(sentence) AS last
FROM ({_release_sql()}) GROUP BY ALL"""


def _broken_files(spark, sf_dir) -> DataFrame:
    """documents as files of broken lines: texts hold newlines, each third text a TAB, junk before each tenth record."""
    d = load(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", "^([^ ]+) ", "$1\t")).otherwise(F.col("text"))
    line = F.concat_ws("\t", F.lpad(F.col("doc_id").cast("string"), 64, "0"), text, "lang", "source", F.lit("1"), F.col("n_chars").cast("string"))
    junk = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("junk "), F.col("doc_id").cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    path = scratch_path(spark, "broken")
    d.select(F.concat(junk, line).alias("value")).write.text(path)
    return number_lines(spark, path)


def repair_files(spark, sf_dir):
    """S2 on files: records rebuilt from surplus TABs, newlines and junk between them."""
    rows, _ = repair_lines(_broken_files(spark, sf_dir), 6, SENTENCE_COLUMNS, header=False)
    return rows.drop("file", "ln")


def repair_junk(spark, sf_dir):
    """S2 + K7: the quarantined lines, written and read back."""
    _, problems = repair_lines(_broken_files(spark, sf_dir), 6, SENTENCE_COLUMNS, header=False)
    path = scratch_path(spark, "problems")
    sinks.write_problems(problems, path, ver="20.0", lc="xx")
    return tsv.read_results(spark, path).select("ver", "lc", "line", "reason")


def reported_files(spark, sf_dir):
    """S3: reported files of both layouts, columns by header; whole texts, with a TAB and their newlines in both."""
    c = load(spark, sf_dir, "conversations").select(
        F.lpad((F.col("conv_id") * 100 + F.col("turn")).cast("string"), 64, "0").alias("sentence_id"),
        F.concat(F.lit("s\t"), F.col("text")).alias("sentence"), F.concat(F.lit("l"), (F.col("conv_id") % 3).cast("string")).alias("locale"),
        F.col("role").alias("reason"), (F.col("conv_id") % 2).alias("new"))
    base = scratch_path(spark, "reported")
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # each task writes one file, with its header
    for name, order in (("new", ["sentence_id", "sentence"]), ("old", ["sentence", "sentence_id"])):
        columns = [*order, "locale", "reason"]
        rows = c.where(F.col("new") == int(name == "new"))
        head = F.when(first, F.lit("\t".join(columns) + "\n")).otherwise("")
        rows.select(F.concat(head, F.concat_ws("\t", *columns)).alias("value")).write.text(f"{base}/{name}")
    rows, _ = read_reported(spark, f"{base}/*")
    return rows.select("sentence_id", F.trim("sentence").alias("sentence"), "locale", "reason")


def plain_files(spark, sf_dir):
    """Sentence lines, durations and specs through files."""
    base = scratch_path(spark, "plain")
    d = load(spark, sf_dir, "documents")
    d.select(F.col("text").alias("value")).write.text(f"{base}/lines")
    lines = tsv.read_lines(spark, f"{base}/lines").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("sentence")).alias("total")).withColumn("source", F.lit("lines"))
    clips = d.select(F.col("doc_id").cast("string").alias("clip"), F.col("n_chars").alias("duration[ms]"), F.col("lang").alias("lc"))
    sinks.write_tsv(clips, f"{base}/dur", partition_by=("lc",))
    dur = tsv.read_by_header(spark, f"{base}/dur", tsv.DURATION_SCHEMA, "clip")[0]
    lc = F.regexp_extract("file", "/lc=([^/]*)/", 1)
    dur = dur.groupBy(F.when(lc != "__HIVE_DEFAULT_PARTITION__", lc).alias("source")).agg(F.count(F.lit(1)).alias("n"), F.sum("duration[ms]").alias("total"))
    specs = d.select(F.lit("x").alias("surplus"), F.col("n_chars").alias("duration"), F.col("doc_id").alias("clip_id"), F.lit("cv").alias("ds"))
    sinks.write_tsv(specs, f"{base}/specs")
    s = tsv.read_optional(spark, f"{base}/specs", tsv.SPEC_SCHEMA).agg(F.count("clip_id").alias("n"), F.sum("duration").alias("total")).withColumn("source", F.lit("specs"))
    none = tsv.read_optional(spark, f"{base}/absent", tsv.SPEC_SCHEMA).agg(F.count("clip_id").alias("n"), F.sum("duration").alias("total")).withColumn("source", F.lit("absent"))
    return lines.unionByName(dur.select("n", "total", "source")).unionByName(s).unionByName(none)


PLAIN_FILES_SQL = """
WITH l AS (SELECT DISTINCT s FROM (SELECT unnest(string_split(text, chr(10))) AS s FROM documents) WHERE s <> '')
SELECT count(*) AS n, CAST(sum(length(s)) AS BIGINT) AS total, 'lines' AS source FROM l
UNION ALL SELECT count(*), CAST(sum(n_chars) AS BIGINT), lang FROM documents GROUP BY lang
UNION ALL SELECT count(*), CAST(sum(n_chars) AS BIGINT), 'specs' FROM documents
UNION ALL SELECT 0, NULL, 'absent'"""

REPORTED_FILES_SQL = r"""
SELECT lpad(CAST(conv_id * 100 + turn AS VARCHAR), 64, '0') AS sentence_id,
  trim(CASE WHEN regexp_matches(text, '[\n\r]') THEN regexp_replace(regexp_replace('s ' || text, '[\n\r]', ' ', 'g'), ' {2,}', ' ', 'g') ELSE 's ' || text END) AS sentence,
  'l' || CAST(conv_id % 3 AS VARCHAR) AS locale, role AS reason FROM conversations"""

QUERIES = {f.__name__: f for f in (
    clips_unified, clips_prepared, split_durations, speed_placeholders, speed_by_age, silence_power, fillable, split_specs, split_texts,
    corpus_versions, corpus_growth, saved_frequencies, reported_record, run_status, release_locales, support_wide, version_dimension,
    tsv_round_trip, repair_files, repair_junk, reported_files, plain_files)}


def oracle_sql() -> dict[str, str]:
    power = "SELECT event_type, value * 1e-9 * 1000000000.0 AS p FROM events"
    unified = _release_sql()
    return {
        "clips_unified": f"""
SELECT ver, lc, age, gender, accents, 'nodata' AS variant, 'nodata' AS segment, 'nodata' AS sentence_domain, count(*) AS n, CAST(sum(up_votes) AS BIGINT) AS up,
  CAST(0 AS BIGINT) AS down, count(*) AS lowered, CAST(1 AS BIGINT) AS locales FROM ({unified}) GROUP BY ALL""",
        "clips_prepared": _prepared_sql() + """
SELECT ver, lc, alg, sp, count(*) AS clips, count(ms) AS timed, CAST(sum(ms) AS BIGINT) AS ms, bool_or(has_durations) AS has_durations FROM c GROUP BY ver, lc, alg, sp""",
        "split_durations": _prepared_sql() + f""",
h AS (SELECT ver, lc, alg, sp, string_agg(CAST(cnt AS VARCHAR), '#' ORDER BY bin) AS f FROM (
  {hist_sql('SELECT ver, lc, alg, sp, ms / 1000.0 AS x FROM c', ['ver', 'lc', 'alg', 'sp'], 'x', bins.DURATION)}) GROUP BY ALL),
s AS (SELECT ver, lc, alg, sp, lc <> 'l2' AND ver <> '1' AS timed, count(*) AS clips, {r3('sum(ms / 1000.0)')} AS total, {r3('avg(ms / 1000.0)')} AS mean FROM c GROUP BY ALL)
SELECT ver, lc, alg, sp, clips, CASE WHEN timed THEN total ELSE -1.0 END AS dur_total, CASE WHEN timed THEN mean ELSE -1.0 END AS dur_avg,
  CASE WHEN timed THEN f ELSE '' END AS dur_freq FROM s JOIN h USING (ver, lc, alg, sp)""",
        "speed_placeholders": _prepared_sql() + """
, s AS (SELECT ver, lc, alg, sp, count(ms) AS n FROM c GROUP BY ALL)
SELECT ver, lc, count(*) AS splits, CAST(sum(n) AS BIGINT) AS clips, count(*) FILTER (WHERE n = 0) AS empty FROM s GROUP BY ver, lc""",
        "speed_by_age": _speed_by_age_sql(),
        "silence_power": f"""
SELECT s.*, h.freq FROM (SELECT event_type, {r3('avg(p)')} AS sil_pwr_avg, {r3('median(p)')} AS sil_pwr_med, {r3('stddev_pop(p)')} AS sil_pwr_std
  FROM ({power}) GROUP BY event_type) s JOIN (SELECT event_type, string_agg(CAST(cnt AS VARCHAR), '#' ORDER BY bin) AS freq
  FROM ({hist_sql(power, ['event_type'], 'p', bins.POWER)}) GROUP BY event_type) h USING (event_type)""",
        "fillable": """
WITH e AS (SELECT event_type AS sp, user_id % 97 AS c, CASE WHEN event_id % 3 > 0 THEN CASE WHEN user_id % 2 = 0 OR event_id % 5 <> 0 THEN 'male' ELSE 'female' END END AS g FROM events),
v AS (SELECT sp, c, count(DISTINCT g) AS d, count(*) - count(g) AS blank FROM e GROUP BY ALL)
SELECT sp, CAST(sum(blank) AS BIGINT) AS fillable_recordings, count(*) AS fillable_voices FROM v WHERE d = 1 AND blank > 0 GROUP BY sp""",
        "split_specs": """
WITH p AS (SELECT DISTINCT (['1', '16.1', '20.0'])[l_partkey % 3 + 1] AS ver, l_returnflag AS sp, l_orderkey FROM lineitem)
SELECT p.ver, p.sp, count(*) AS n, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT) AS dur FROM p JOIN orders o ON o.o_orderkey = p.l_orderkey
WHERE (p.ver = '16.1' AND o_custkey % 4 = 0) OR (p.ver = '20.0' AND o_custkey % 4 < 3) GROUP BY p.ver, p.sp""",
        "split_texts": SPLIT_TEXTS_SQL,
        "corpus_versions": """
WITH c AS (SELECT doc_id, lang AS lc, text, doc_id % 11 > 0 AS used FROM documents), old AS (SELECT DISTINCT lang AS lc, text FROM documents WHERE doc_id % 3 = 0),
f AS (SELECT c.* FROM c SEMI JOIN old ON old.lc = c.lc AND old.text = c.text WHERE used)
SELECT '16.1' AS ver, lc, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids, 'index' AS kind FROM f GROUP BY lc
UNION ALL SELECT '20.0', lc, count(*), CAST(sum(doc_id) AS BIGINT), 'index' FROM c WHERE used GROUP BY lc
UNION ALL SELECT '20.0', lc, count(*), CAST(sum(doc_id) AS BIGINT), 'disabled' FROM c WHERE NOT used GROUP BY lc
UNION ALL SELECT '16.1', lc, count(*), CAST(sum(doc_id) AS BIGINT), 'not_found' FROM c WHERE used AND doc_id NOT IN (SELECT doc_id FROM f) GROUP BY lc""",
        "corpus_growth": CORPUS_GROWTH_SQL,
        "saved_frequencies": """
WITH g AS (SELECT lang AS lc, (['', 's1', 's99'])[doc_id % 3 + 1] AS alg, (['', 'validated', 'train', 'other'])[doc_id % 4 + 1] AS sp, unnest(string_split(text, '')) AS grapheme FROM documents)
SELECT lc, alg, sp, grapheme, count(*) AS n FROM g WHERE (alg = '' AND sp = '') OR (alg = 's1' AND sp IN ('validated', 'train')) GROUP BY ALL""",
        "reported_record": _reported_sql(),
        "run_status": RUN_STATUS_SQL,
        "release_locales": """
SELECT DISTINCT n_name AS lc, 'r' || CAST(c_nationkey % 5 AS VARCHAR) AS release FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_nationkey % 5 IN (1, 4)
UNION ALL SELECT r_name, 'none' FROM region""",
        "support_wide": _support_wide_sql(),
        "version_dimension": _version_sql(),
        "tsv_round_trip": _round_trip_sql(),
        "repair_files": """
SELECT lpad(CAST(doc_id AS VARCHAR), 64, '0') AS sentence_id,
  CASE WHEN strpos(text, chr(10)) > 0 THEN regexp_replace(replace(text, chr(10), ' '), ' {2,}', ' ', 'g') ELSE text END AS sentence,
  lang AS sentence_domain, source, '1' AS is_used, CAST(n_chars AS VARCHAR) AS clips_count FROM documents""",
        "repair_junk": "SELECT '20.0' AS ver, 'xx' AS lc, 'junk ' || CAST(doc_id AS VARCHAR) AS line, 'unrepairable' AS reason FROM documents WHERE doc_id % 10 = 0",
        "reported_files": REPORTED_FILES_SQL,
        "plain_files": PLAIN_FILES_SQL,
    }
