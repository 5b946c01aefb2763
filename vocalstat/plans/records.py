"""Queries for the whole published records (E1, E2), each beside its oracle SQL.

Stand-ins as in ``vocalstat.plans.jobs``: events as the clips of a release. Arrays
are compared as text, the form of the published tables (P19).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import list_to_text, matrix_to_text
from vocalstat.operators import audio, speed, splits, textcorpus
from vocalstat.plans import pipeline
from vocalstat.plans.driver import _pick, load
from vocalstat.plans.jobs import _clip_inputs, _prepared_sql, _versioned, release_clips
from vocalstat.plans.sqlgen import hist_sql, r3, summary_sql

KEYS = pipeline.KEYS
K = ", ".join(KEYS)


def as_text(df: DataFrame) -> DataFrame:
    """Lists as text, lists of lists with the row separator."""
    form = lambda c, t: matrix_to_text(c) if t.startswith("array<array") else list_to_text(c) if t.startswith("array") else F.col(c)
    return df.select(*[form(c, t).alias(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- split record

#: (token, text): the stand-in's values a0 and a2 are texts, a1 is a token, a3 is none.
ACCENTS = [("zero", "a0"), ("a1", "one"), ("two", "a2")]


def _presets(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    lcs = [f"l{i}" for i in range(4)]
    variants = spark.createDataFrame([(lc, "v1", "first", 0) for lc in lcs], "lc string, code string, text string, ord int")
    accents = spark.createDataFrame([(lc, t, x, i) for lc in lcs for i, (t, x) in enumerate(ACCENTS)], "lc string, token string, text string, ord int")
    return variants, accents


def split_record(spark, sf_dir):
    """The whole split record of every (version, locale, algorithm, split)."""
    return as_text(splits.split_stats(pipeline.prepared_clips(_clip_inputs(spark, sf_dir)), KEYS, *_presets(spark)))


def _matrix_sql(rows, cols, cell) -> str:
    """Text of a matrix of counts with fixed rows and columns."""
    line = lambda r: " || '#' || ".join(cell(r, c) for c in cols)
    return " || '|' || ".join(line(r) for r in rows)


def _demographics_sql() -> str:
    def cell(age, gender):
        test = " AND ".join([f"age = '{age}'"] * (age != "TOTAL") + [f"gender = '{gender}'"] * (gender != "TOTAL")) or "TRUE"
        return f"CAST(count(*) FILTER (WHERE {test}) AS VARCHAR)"

    return _matrix_sql([*dims.AGES, "TOTAL"], [*dims.GENDERS, "TOTAL"], cell)


def _hist_text(src: str, value: str, edges, name: str, **kw) -> str:
    return f"SELECT {K}, string_agg(CAST(cnt AS VARCHAR), '#' ORDER BY bin) AS {name} FROM ({hist_sql(src, KEYS, value, edges, **kw)}) GROUP BY {K}"


def _split_record_sql() -> str:
    per = lambda what: f"SELECT {K}, {what} AS item, count(*) AS n FROM c GROUP BY {K}, item"
    voice, sentence, up, down = per("client_id"), per("sentence"), per("up_votes"), per("0")
    accents = ["a0", "a1", "a2", "nodata", "a3"]
    counts = lambda f: " || '#' || ".join(f"CAST(count({f}) FILTER (WHERE accents = '{a}') AS VARCHAR)" for a in accents)
    ctes = {
        "k": f"""SELECT {K}, count(*) AS clips, count(DISTINCT client_id) AS uq_v, count(DISTINCT sentence) AS uq_s, count(DISTINCT lower(sentence)) AS uq_sl,
  lc <> 'l2' AND ver <> '1' AS timed, {r3('sum(ms / 1000.0)')} AS d0, {r3('avg(ms / 1000.0)')} AS d1, {r3('median(ms / 1000.0)')} AS d2, {r3('stddev_pop(ms / 1000.0)')} AS d3,
  CAST(sum(up_votes) AS BIGINT) AS uv_sum, {_demographics_sql()} AS dem_table, {counts('*')} AS acc_freq, {counts('DISTINCT client_id')} AS acc_ufreq FROM c GROUP BY {K}""",
        "du": f"SELECT {K}, {_demographics_sql()} AS dem_uq FROM (SELECT DISTINCT {K}, client_id, age, gender FROM c) GROUP BY {K}",
        "dh": _hist_text(f"SELECT {K}, ms / 1000.0 AS x FROM c", "x", bins.DURATION, "dh"),
        "sv": summary_sql(voice, KEYS, "n", "v", with_sum=False), "hv": _hist_text(voice, "n", bins.VOICES, "v_freq", drop_first=True),
        "ss": summary_sql(sentence, KEYS, "n", "s", with_sum=False), "hs": _hist_text(sentence, "n", bins.SENTENCES, "s_freq", drop_first=True),
        "su": summary_sql(up, KEYS, "n", "uv", with_sum=False),
        "hu": _hist_text(f"SELECT {K}, up_votes FROM c", "up_votes", bins.VOTES_UP, "uv_freq", closed_last=False, truncate=False),
        "sd": summary_sql(down, KEYS, "n", "dv", with_sum=False),
        "hd": _hist_text(f"SELECT {K}, 0 AS x FROM c", "x", bins.VOTES_DOWN, "dv_freq", closed_last=False, truncate=False),
    }
    dur = lambda a, b: f"CASE WHEN timed THEN {a} ELSE -1.0 END AS {b}"
    return _prepared_sql() + "".join(f",\n{n} AS ({q})" for n, q in ctes.items()) + f"""
SELECT {K}, clips, uq_v, uq_s, uq_sl, {dur('d0', 'dur_total')}, {dur('d1', 'dur_avg')}, {dur('d2', 'dur_med')}, {dur('d3', 'dur_std')},
  CASE WHEN timed THEN dh ELSE '' END AS dur_freq, v_avg, v_med, v_std, v_freq, s_avg, s_med, s_std, s_freq, uv_sum, uv_avg, uv_med, uv_std, uv_freq,
  CAST(0 AS BIGINT) AS dv_sum, dv_avg, dv_med, dv_std, dv_freq, dem_table, dem_uq, '' AS dem_fix_r, '' AS dem_fix_v,
  'nodata' AS var_rows, CAST(clips AS VARCHAR) AS var_freq, CAST(uq_v AS VARCHAR) AS var_ufreq, 'zero#a1#two#nodata#other' AS acc_rows, acc_freq, acc_ufreq
FROM {' JOIN '.join(n if n == 'k' else f'{n} USING ({K})' for n in ctes)}"""


# ---------------------------------------------------------------- speed record

def speed_record(spark, sf_dir):
    """The whole speed record of every split; lengths from the sentences themselves."""
    return as_text(speed.char_speed_stats(pipeline.prepared_clips(_clip_inputs(spark, sf_dir))))


def _speed_record_sql() -> str:
    case = lambda v, edges: "CASE " + " ".join(f"WHEN {v} >= {a} AND {v} < {b} THEN {a}" for a, b in zip(edges, edges[1:])) + " END"
    place = lambda v, edges: "CASE " + " ".join(f"WHEN {v} >= {a} AND {v} < {b} THEN {i}" for i, (a, b) in enumerate(zip(edges, edges[1:]))) + " END"
    dense = lambda label, labels: " || '#' || ".join(f"CAST(count(*) FILTER (WHERE {label} = '{x}') AS VARCHAR)" for x in labels)
    n = len(bins.CS_LOW) - 1
    freq = " || '#' || ".join(f"CAST(count(*) FILTER (WHERE pc = {i}) AS VARCHAR)" for i in range(n))
    by = lambda label, labels, name: (f"SELECT {K}, string_agg(t, '|' ORDER BY bc) AS {name} FROM "  # noqa: E731
                                      f"(SELECT {K}, bc, {dense(label, labels)} AS t FROM b WHERE bc IS NOT NULL GROUP BY {K}, bc) GROUP BY {K}")
    return _prepared_sql() + f""",
x AS (SELECT c.*, length(sentence) AS n, round_even(1000.0 * ((ms / 1000.0) / nullif(length(sentence), 0)), 0) AS s FROM c),
m AS (SELECT {K}, coalesce(avg(s) < {bins.CS_THRESHOLD}, FALSE) AS low, avg(n) < {bins.CHARS_THRESHOLD} AS short,
  {r3('avg(s)')} AS cs_avg, {r3('median(s)')} AS cs_med, {r3('stddev_pop(s)')} AS cs_std FROM x GROUP BY {K}),
b AS (SELECT x.*, CASE WHEN low THEN {case('s', bins.CS_LOW)} ELSE {case('s', bins.CS_HIGH)} END AS bc, CASE WHEN low THEN {place('s', bins.CS_LOW)} ELSE {place('s', bins.CS_HIGH)} END AS pc,
  CASE WHEN short THEN {case('n', bins.CHARS_SHORT)} ELSE {case('n', bins.CHARS_LONG)} END AS bl FROM x JOIN m USING ({K}) WHERE s IS NOT NULL),
f AS (SELECT {K}, {freq} AS cs_freq FROM b GROUP BY {K}),
o AS (SELECT {K}, bc, bl, count(*) AS n FROM b WHERE bc IS NOT NULL AND bl IS NOT NULL GROUP BY {K}, bc, bl),
g AS (SELECT * FROM (SELECT DISTINCT {K}, bc FROM o) JOIN (SELECT DISTINCT {K}, bl FROM o) USING ({K})),
l AS (SELECT {K}, bc, string_agg(CAST(coalesce(n, 0) AS VARCHAR), '#' ORDER BY bl) AS t, string_agg(CAST(bl AS VARCHAR), '#' ORDER BY bl) AS cols, sum(n) AS n
      FROM g LEFT JOIN o USING ({K}, bc, bl) GROUP BY {K}, bc),
s AS (SELECT {K}, CAST(sum(n) AS BIGINT) AS clips, string_agg(CAST(bc AS VARCHAR), '#' ORDER BY bc) AS cs_r, any_value(cols) AS cs2s_c, string_agg(t, '|' ORDER BY bc) AS cs2s FROM l GROUP BY {K}),
cg AS ({by('gender', dims.GENDERS, 'cs2g')}),
ca AS ({by('age', dims.AGES, 'cs2a')})
SELECT {K}, coalesce(cs_avg, 0.0) AS cs_avg, coalesce(cs_med, 0.0) AS cs_med, coalesce(cs_std, 0.0) AS cs_std, coalesce(clips, 0) AS clips, coalesce(cs_freq, '') AS cs_freq,
  coalesce(cs_r, '') AS cs_r, coalesce(cs2s_c, '') AS cs2s_c, coalesce(cs2s, '') AS cs2s, coalesce(cs2g, '') AS cs2g, coalesce(cs2a, '') AS cs2a
FROM m LEFT JOIN f USING ({K}) LEFT JOIN s USING ({K}) LEFT JOIN cg USING ({K}) LEFT JOIN ca USING ({K})"""


# ---------------------------------------------------------------- audio record

def measured_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as audio specs of releases 18.0 and 20.0; each fifth clip has none, each 13th has no speech."""
    e = load(spark, sf_dir, "events").where("event_id % 5 <> 0")
    speech = F.col("event_id") % 13 > 0
    ms = F.col("user_id") % 9000 + 500
    return e.select(
        F.col("event_id").alias("clip_id"), F.col("event_id").cast("string").alias("orig_path"), F.lit("cv").alias("ds"),
        F.concat(F.lit("l"), (F.floor(F.col("user_id") / 3) % 4).cast("string")).alias("lc"), _pick(["18.0", "20.0"], F.pmod("event_id", F.lit(2))).alias("ver"),
        _pick(["mp3", "wav", None], F.pmod("event_id", F.lit(3))).alias("orig_encoding"), (F.col("event_id") % 2 + 1).alias("orig_num_channels"),
        (F.col("event_id") % 3 * 16000 + 16000).alias("orig_sample_rate"), (F.col("event_id") % 4 * 32).alias("orig_bitrate_kbps"),
        ms.alias("duration"), F.when(speech, F.floor(ms * (F.col("event_id") % 10) / 10).cast("long")).alias("speech_duration"),
        F.when(speech, F.col("value") * F.lit(1e-8)).alias("speech_power"), (F.col("value") * F.lit(1e-11)).alias("silence_power"),
        F.when(speech, F.col("value") / 5 - 10).alias("est_snr"))


def clip_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as clip errors: each 17th clip of the releases, from three sources."""
    c = release_clips(spark, sf_dir).where("cast(path AS bigint) % 17 = 0")
    return c.select("ver", "lc", "path", _pick(["download", "decode", "length"], F.pmod(F.col("path").cast("long"), F.lit(3))).alias("source"), F.lit("cv").alias("ds"))


def audio_record(spark, sf_dir):
    """The whole audio record of every split; one without specs has zeros and empty lists."""
    c = pipeline.prepared_clips(pipeline.SplitInputs(clips=release_clips(spark, sf_dir))).select(*KEYS, "path")
    specs = audio.specs_for_splits(c, audio.dedup_specs(measured_specs(spark, sf_dir)))
    return as_text(audio.audio_stats(pipeline.materialize_df(specs, "specs"), KEYS, clip_errors(spark, sf_dir), c))


def _audio_record_sql() -> str:
    src = lambda v: f"SELECT {K}, {v} AS x FROM a"
    measures = {"vad": ("speech_duration / 1000.0", bins.DURATION, False), "vadp": ("100.0 * speech_duration / duration", bins.PERCENT, False),
                "sp_pwr": ("speech_power * 1000000.0", bins.POWER, False), "sil_pwr": ("silence_power * 1000000000.0", bins.POWER, False), "snr": ("est_snr", bins.SNR, True)}
    labels = {"enc": "encoding", "chan": "channels", "srate": "rate", "brate": "kbps"}
    ctes = {f"s_{m}": summary_sql(src(v), KEYS, "x", m, with_sum=False) for m, (v, _, _) in measures.items()}
    ctes |= {f"h_{m}": _hist_text(src(v), "x", e, f"{m}_freq", drop_first=d) for m, (v, e, d) in measures.items()}
    ctes |= {f"l_{m}": f"SELECT {K}, string_agg(x, '#' ORDER BY x) AS {m}_r, string_agg(CAST(n AS VARCHAR), '#' ORDER BY x) AS {m}_freq FROM "
                       f"(SELECT {K}, CAST({c} AS VARCHAR) AS x, count(*) AS n FROM a WHERE {c} IS NOT NULL GROUP BY {K}, x) GROUP BY {K}" for m, c in labels.items()}
    zero = lambda c: f"CASE WHEN clips IS NULL THEN coalesce({c}, 0.0) ELSE {c} END AS {c}"
    none = lambda c: f"CASE WHEN clips IS NULL THEN coalesce({c}, '') ELSE {c} END AS {c}"
    pick = "([{}])[event_id % {} + 1]"
    return _prepared_sql() + f""",
e AS (SELECT event_id, 'l' || CAST((user_id // 3) % 4 AS VARCHAR) AS lc, {pick.format("'mp3', 'wav', NULL", 3)} AS encoding, event_id % 2 + 1 AS channels,
  event_id % 3 * 16000 + 16000 AS rate, event_id % 4 * 32 AS kbps, user_id % 9000 + 500 AS duration,
  CASE WHEN event_id % 13 > 0 THEN ((user_id % 9000 + 500) * (event_id % 10)) // 10 END AS speech_duration, CASE WHEN event_id % 13 > 0 THEN value * CAST(1e-8 AS DOUBLE) END AS speech_power,
  value * CAST(1e-11 AS DOUBLE) AS silence_power, CASE WHEN event_id % 13 > 0 THEN value / 5 - 10 END AS est_snr FROM events WHERE event_id % 5 <> 0),
p AS (SELECT DISTINCT {K}, event_id FROM c),
a AS (SELECT {', '.join('p.' + x for x in KEYS)}, e.* EXCLUDE (lc, event_id) FROM p JOIN e ON e.lc = p.lc AND e.event_id = p.event_id WHERE ver = '20.0'),
q AS (SELECT {K}, count(*) AS clips, CAST(round_even(sum(duration) / 1000.0, 0) AS BIGINT) AS dur, count(*) FILTER (WHERE est_snr IS NULL) AS no_vad,
  count(*) FILTER (WHERE est_snr < {dims.LOW_SNR_THRESHOLD}) AS low_snr, count(*) FILTER (WHERE speech_power < {dims.LOW_POWER_THRESHOLD}) AS low_power,
  CAST(trunc(sum(speech_duration) / 1000.0) AS BIGINT) AS vad_sum FROM a GROUP BY {K}),
x AS (SELECT {K}, CAST(sum(n) AS BIGINT) AS errors, string_agg(source, '#' ORDER BY source) AS err_r, string_agg(CAST(n AS VARCHAR), '#' ORDER BY source) AS err_freq
  FROM (SELECT {K}, {pick.format("'download', 'decode', 'length'", 3)} AS source, count(*) AS n FROM p
        WHERE event_id % 17 = 0 GROUP BY {K}, source) GROUP BY {K})""" + "".join(f",\n{n} AS ({q})" for n, q in ctes.items()) + f"""
SELECT {K}, coalesce(clips, 0) AS clips, coalesce(dur, 0) AS dur, coalesce(no_vad, 0) AS no_vad, coalesce(low_snr, 0) AS low_snr, coalesce(low_power, 0) AS low_power,
  CASE WHEN clips IS NULL THEN 0 ELSE vad_sum END AS vad_sum, {', '.join(zero(f'{m}_{f}') for m in measures for f in ('avg', 'med', 'std'))}, {', '.join(none(f'{m}_freq') for m in measures)},
  {', '.join(none(f'{m}_{f}') for m in labels for f in ('r', 'freq'))}, coalesce(errors, 0) AS errors, {none('err_r')}, {none('err_freq')}
FROM (SELECT DISTINCT {K} FROM c) LEFT JOIN q USING ({K}) LEFT JOIN x USING ({K}) {' '.join(f'LEFT JOIN {n} USING ({K})' for n in ctes)}"""


# ---------------------------------------------------------------- text records by capability

def text_capabilities(spark, sf_dir):
    """A17 in E2: word and token fields of validator locales only, phoneme fields of phonemiser locales only; others have none."""
    base, index, rows = _versioned(spark, sf_dir)
    enrich = lambda d: textcorpus.enrich_sentences(d).withColumn("phonemised", F.reverse("normalized"))
    caps = spark.createDataFrame([("en", True, True), ("de", True, False), ("fr", False, True)], "lc string, has_val boolean, has_phon boolean")
    rec = pipeline.text_corpus_statistics(base, index.where("ver <> '18.0'"), rows.where("ver <> '18.0'"), caps, enrich)
    return rec.select(*KEYS, "has_val", "has_phon", "s_cnt", "uq_n", "w_sum", "w_med", "t_sum", "p_cnt")


TEXT_CAPABILITIES_SQL = r"""
WITH c AS (SELECT doc_id, lang AS lc, text, trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')) AS norm FROM documents WHERE doc_id % 11 > 0),
i AS (SELECT '16.1' AS ver, * FROM c WHERE doc_id % 4 < 3 UNION ALL SELECT '20.0', * FROM c),
s AS (SELECT DISTINCT CASE WHEN quality = 1 THEN 'validated' ELSE 'train' END AS sp, d.lang AS lc, l.doc_id, d.text FROM labels l JOIN documents d USING (doc_id)),
m AS (SELECT *, '' AS alg, '' AS sp FROM i
      UNION ALL SELECT i.*, 's1', s.sp FROM i JOIN s ON s.lc = i.lc AND s.doc_id = i.doc_id WHERE i.ver = '20.0'
      UNION ALL SELECT i.*, 's1', s.sp FROM i JOIN (SELECT DISTINCT sp, lc, text FROM s) s ON s.lc = i.lc AND s.text = i.text WHERE i.ver = '16.1'),
w AS (SELECT *, list_filter(string_split(norm, ' '), lambda x: x <> '') AS tokens FROM m),
t AS (SELECT ver, lc, alg, sp, count(DISTINCT token) AS t_sum FROM (SELECT ver, lc, alg, sp, unnest(tokens) AS token FROM w) GROUP BY ALL),
g AS (SELECT ver, lc, alg, sp, count(DISTINCT ch) FILTER (WHERE ch <> '') AS p_cnt FROM (SELECT ver, lc, alg, sp, unnest(string_split(norm, '')) AS ch FROM w) GROUP BY ALL),
r AS (SELECT ver, lc, alg, sp, lc IN ('en', 'de') AS has_val, lc IN ('en', 'fr') AS has_phon, count(*) AS s_cnt, count(DISTINCT norm) AS uq_n, CAST(sum(len(tokens)) AS BIGINT) AS w_sum, """ + \
    f"{r3('median(len(tokens))')}" + """ AS w_med FROM w GROUP BY ver, lc, alg, sp)
SELECT ver, lc, alg, sp, has_val, has_phon, s_cnt, uq_n, CASE WHEN has_val THEN w_sum END AS w_sum, CASE WHEN has_val THEN w_med END AS w_med,
  CASE WHEN has_val THEN t_sum END AS t_sum, CASE WHEN has_phon THEN p_cnt END AS p_cnt
FROM r LEFT JOIN t USING (ver, lc, alg, sp) LEFT JOIN g USING (ver, lc, alg, sp)"""


QUERIES = {f.__name__: f for f in (split_record, speed_record, audio_record, text_capabilities)}


def oracle_sql() -> dict[str, str]:
    return {"split_record": _split_record_sql(), "speed_record": _speed_record_sql(), "audio_record": _audio_record_sql(),
            "text_capabilities": TEXT_CAPABILITIES_SQL}
