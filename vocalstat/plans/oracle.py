"""DuckDB oracle SQL for the driver-table queries (same column names and types)."""

from __future__ import annotations

from vocalstat.functions import bins
from vocalstat.plans.sqlgen import hist_sql, r3, summary_sql, values_list

NORM = r"trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}]+', ' ', 'g'))"
TOKENS = f"list_filter(string_split({NORM}, ' '), lambda x: x <> '')"
DOCS = f"""SELECT doc_id, text, lang, source, {NORM} AS normalized, {TOKENS} AS tokens,
  CAST(coalesce(length(text), 0) AS BIGINT) AS char_cnt, CAST(len({TOKENS}) AS BIGINT) AS word_cnt
FROM documents"""
TOKEN_FREQ = f"SELECT lang, token, CAST(count(*) AS BIGINT) AS cnt FROM (SELECT lang, unnest(tokens) AS token FROM ({DOCS})) GROUP BY lang, token"
GRAPH_FREQ = ("SELECT lang, grapheme, CAST(count(*) AS BIGINT) AS cnt FROM "
              "(SELECT lang, unnest(string_split(text, '')) AS grapheme FROM documents WHERE text IS NOT NULL) "
              "GROUP BY lang, grapheme")


def _adaptive_char_hist() -> str:
    src = f"SELECT lang, source, char_cnt FROM ({DOCS})"
    choice = f"SELECT lang, source, {r3('avg(char_cnt)')} < {bins.CHARS_THRESHOLD} AS use_low FROM ({src}) GROUP BY lang, source"
    low = hist_sql(src, ["lang", "source"], "char_cnt", bins.CHARS_SHORT,
                   groups=f"SELECT lang, source FROM ({choice}) WHERE use_low")
    high = hist_sql(src, ["lang", "source"], "char_cnt", bins.CHARS_LONG,
                    groups=f"SELECT lang, source FROM ({choice}) WHERE NOT use_low")
    return f"SELECT * FROM ({low}) UNION ALL SELECT * FROM ({high})"


def _text_sql() -> dict[str, str]:
    tok_counts = f"SELECT lang, cnt FROM ({TOKEN_FREQ})"
    return {
        "char_stats_by_lang": f"""
SELECT lang, CAST(count(*) AS BIGINT) AS s_cnt, CAST(sum(char_cnt) AS BIGINT) AS c_sum,
  {r3('avg(char_cnt)')} AS c_avg, {r3('median(char_cnt)')} AS c_med, {r3('stddev_pop(char_cnt)')} AS c_std
FROM ({DOCS}) GROUP BY lang""",
        "char_hist_by_lang": hist_sql(f"SELECT lang, char_cnt FROM ({DOCS})", ["lang"], "char_cnt", bins.CHARS_LONG),
        "adaptive_char_hist": _adaptive_char_hist(),
        "word_stats": summary_sql(f"SELECT lang, word_cnt FROM ({DOCS})", ["lang"], "word_cnt", "w"),
        "word_hist": hist_sql(f"SELECT lang, word_cnt FROM ({DOCS})", ["lang"], "word_cnt", bins.WORDS,
                              drop_first=True),
        "token_freq_stats": f"""
SELECT lang, {r3('avg(cnt)')} AS t_avg, {r3('median(cnt)')} AS t_med, {r3('stddev_pop(cnt)')} AS t_std,
  CAST(count(*) AS BIGINT) AS t_sum
FROM ({tok_counts}) GROUP BY lang""",
        "token_count_hist": hist_sql(tok_counts, ["lang"], "cnt", bins.TOKENS, drop_first=True),
        "token_topk": f"""
SELECT lang, CAST(rnk AS INTEGER) AS rnk, token, cnt FROM (
  SELECT lang, token, cnt, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, token ASC) AS rnk
  FROM ({TOKEN_FREQ})) WHERE rnk <= 100""",
        "grapheme_freq": GRAPH_FREQ,
        "grapheme_topk": f"""
SELECT lang, CAST(rnk AS INTEGER) AS rnk, grapheme, cnt, g_cnt FROM (
  SELECT lang, grapheme, cnt, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, grapheme ASC) AS rnk,
         CAST(count(*) OVER (PARTITION BY lang) AS BIGINT) AS g_cnt
  FROM ({GRAPH_FREQ})) WHERE rnk <= 20""",
        "valid_sentences": f"""
SELECT d.lang, CAST(count(*) AS BIGINT) AS s_cnt, CAST(coalesce(sum(l.quality), 0) AS BIGINT) AS val,
  CAST(count(DISTINCT d.text) AS BIGINT) AS uq_s, CAST(count(DISTINCT d.normalized) AS BIGINT) AS uq_n
FROM ({DOCS}) d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""",
    }


def _tc_record_sql() -> str:
    """The whole text-corpus record, each statistic by itself, arrays as text."""
    from vocalstat.functions import dims
    from vocalstat.plans.driver import DOMAIN_LABELS
    labels = "[" + ", ".join(f"'{x}'" for x in DOMAIN_LABELS) + "]"
    k = ["lang", "source"]
    adaptive = _adaptive_char_hist()

    def joined(hist: str, name: str) -> str:
        return f"SELECT lang, source, string_agg(CAST(cnt AS VARCHAR), '#' ORDER BY bin) AS {name} FROM ({hist}) GROUP BY lang, source"

    def top(items: str, prefix: str) -> str:
        return f"""SELECT lang, source, CAST(any_value(total) AS BIGINT) AS {prefix}_cnt, string_agg(item, '#' ORDER BY rnk) AS {prefix}_items,
  string_agg(CAST(n AS VARCHAR), '#' ORDER BY rnk) AS {prefix}_freq
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY n DESC, item) AS rnk, count(*) OVER (PARTITION BY lang, source) AS total
      FROM (SELECT lang, source, item, count(*) AS n FROM ({items}) GROUP BY ALL)) WHERE rnk <= 100 GROUP BY lang, source"""

    tokens = "SELECT lang, source, token, count(*) AS cnt FROM (SELECT lang, source, unnest(tokens) AS token FROM d) GROUP BY ALL"
    old = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in dims.DOMAIN_MAP.items())
    order = "[" + ", ".join(f"'{x}'" for x in dims.DOMAINS) + "]"
    return f"""
WITH d AS ({DOCS}),
a AS (SELECT d.lang, d.source, count(*) AS s_cnt, count(DISTINCT text) AS uq_s, count(DISTINCT normalized) AS uq_n,
        CAST(coalesce(sum(l.quality), 0) AS BIGINT) AS val, CAST(sum(char_cnt) AS BIGINT) AS c_sum, {r3('avg(char_cnt)')} AS c_avg,
        {r3('median(char_cnt)')} AS c_med, {r3('stddev_pop(char_cnt)')} AS c_std, CAST(sum(word_cnt) AS BIGINT) AS w_sum, {r3('avg(word_cnt)')} AS w_avg,
        {r3('median(word_cnt)')} AS w_med, {r3('stddev_pop(word_cnt)')} AS w_std
      FROM d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.lang, d.source),
t AS (SELECT lang, source, CAST(count(*) AS BIGINT) AS t_sum, {r3('avg(cnt)')} AS t_avg, {r3('median(cnt)')} AS t_med, {r3('stddev_pop(cnt)')} AS t_std
      FROM ({tokens}) GROUP BY lang, source),
ch AS ({joined(adaptive, 'c_freq')}),
wh AS ({joined(hist_sql('SELECT lang, source, word_cnt FROM d', k, 'word_cnt', bins.WORDS, drop_first=True), 'w_freq')}),
th AS ({joined(hist_sql(tokens, k, 'cnt', bins.TOKENS, drop_first=True), 't_freq')}),
g AS ({top("SELECT lang, source, unnest(string_split(text, '')) AS item FROM d", 'g')}),
p AS ({top("SELECT lang, source, unnest(string_split(normalized, '')) AS item FROM d", 'p')}),
dl AS (SELECT lang, source, unnest(string_split(({labels})[doc_id % 14 + 1] || CASE WHEN doc_id % 5 = 0 THEN ',general' ELSE '' END, ',')) AS label FROM d),
dn AS (SELECT lang, source, CASE label {old} END AS domain, count(*) AS n FROM dl GROUP BY ALL),
dm AS (SELECT lang, source, CAST(count(*) AS INTEGER) AS dom_cnt, string_agg(domain, '#' ORDER BY list_position({order}, domain)) AS dom_items,
         string_agg(CAST(n AS VARCHAR), '#' ORDER BY list_position({order}, domain)) AS dom_freq
       FROM dn WHERE domain IS NOT NULL GROUP BY lang, source)
SELECT a.lang, a.source, TRUE AS has_val, TRUE AS has_phon, s_cnt, uq_s, uq_n, val, c_sum, c_avg, c_med, c_std, c_freq, w_sum, w_avg, w_med, w_std, w_freq,
  t_sum, t_avg, t_med, t_std, t_freq, g_cnt, g_items, g_freq, p_cnt, p_items, p_freq, coalesce(dom_cnt, 0) AS dom_cnt, dom_items, dom_freq
FROM a LEFT JOIN t USING (lang, source) LEFT JOIN ch USING (lang, source) LEFT JOIN wh USING (lang, source) LEFT JOIN th USING (lang, source)
  LEFT JOIN g USING (lang, source) LEFT JOIN p USING (lang, source) LEFT JOIN dm USING (lang, source)"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {"tc_record": _tc_record_sql()}
    out.update(_text_sql())
    return out


# ---------------------------------------------------------------- clip-side queries

def _lit(x):
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _clips_sql() -> str:
    from vocalstat.functions import dims
    from vocalstat.plans.driver import AGE_LABELS, GENDER_LABELS
    ages = "[" + ", ".join(_lit(a) for a in AGE_LABELS) + "]"
    genders = "[" + ", ".join(_lit(g) for g in GENDER_LABELS) + "]"
    backmap = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in dims.GENDER_BACKMAP.items())
    return f"""
SELECT event_type AS sp, CAST(user_id AS VARCHAR) AS client_id, event_id AS path, props AS sentence,
  lower(props) AS sentence_lower,
  coalesce(({ages})[user_id % 11 + 1], 'nodata') AS age,
  CASE coalesce(({genders})[user_id % 7 + 1], 'nodata') {backmap}
       ELSE coalesce(({genders})[user_id % 7 + 1], 'nodata') END AS gender,
  value
FROM events"""


def _per_item(src: str, keys: list[str], item: str, prefix: str, edges, drop_first=True):
    k = ", ".join(keys)
    counts = f"SELECT {k}, count(*) AS c FROM ({src}) WHERE {item} IS NOT NULL GROUP BY {k}, {item}"
    summ = f"""SELECT {k}, {r3('avg(c)')} AS {prefix}_avg, {r3('median(c)')} AS {prefix}_med,
  {r3('stddev_pop(c)')} AS {prefix}_std FROM ({counts}) GROUP BY {k}"""
    return summ, hist_sql(counts, keys, "c", edges, drop_first=drop_first)


def _margin_sql(src: str, keys: list[str], row: str, col: str, rows, cols, value: str | None) -> str:
    k = ", ".join(keys)
    cnt = f"count({value})" if value else "count(*)"
    rows = list(rows) + ["TOTAL"]
    cols = list(cols) + ["TOTAL"]
    labels = values_list([(r, c) for r in rows for c in cols], [row, col], alias="lab")
    return f"""
WITH s AS ({src}),
cube AS (
  SELECT {k}, CASE WHEN grouping({row}) = 1 THEN 'TOTAL' ELSE {row} END AS {row},
         CASE WHEN grouping({col}) = 1 THEN 'TOTAL' ELSE {col} END AS {col}, {cnt} AS n
  FROM s GROUP BY GROUPING SETS (({k}, {row}, {col}), ({k}, {row}), ({k}, {col}), ({k})))
SELECT g.{k}, lab.{row}, lab.{col}, CAST(coalesce(cube.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT {k} FROM s) g CROSS JOIN {labels}
LEFT JOIN cube ON cube.{k} = g.{k} AND cube.{row} = lab.{row} AND cube.{col} = lab.{col}"""


def _label_case(expr: str, edges) -> str:
    parts = " ".join(f"WHEN {expr} >= {edges[i]} AND {expr} < {edges[i + 1]} THEN {edges[i]}"
                     for i in range(len(edges) - 1))
    return f"CAST(CASE {parts} END AS BIGINT)"


def _speed_sql() -> dict[str, str]:
    rows = """SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS s_len,
  round_even(1000.0 * ((l_extendedprice / 20000.0) / CAST(CAST(l_quantity AS INTEGER) AS DOUBLE)), 0) AS char_speed
FROM lineitem"""
    choice = f"""SELECT l_returnflag, {r3('avg(char_speed)')} AS cs_avg, {r3('median(char_speed)')} AS cs_med,
  {r3('stddev_pop(char_speed)')} AS cs_std, {r3('avg(char_speed)')} < {bins.CS_THRESHOLD} AS use_low_cs,
  avg(s_len) < {bins.CHARS_THRESHOLD} AS use_short_len
FROM ({rows}) GROUP BY l_returnflag"""
    binned = f"""SELECT r.*, CASE WHEN c.use_low_cs THEN {_label_case('r.char_speed', bins.CS_LOW)}
    ELSE {_label_case('r.char_speed', bins.CS_HIGH)} END AS bin_cs,
  CASE WHEN c.use_short_len THEN {_label_case('r.s_len', bins.CHARS_SHORT)}
    ELSE {_label_case('r.s_len', bins.CHARS_LONG)} END AS bin_slen
FROM ({rows}) r JOIN ({choice}) c USING (l_returnflag)"""
    low = hist_sql(rows, ["l_returnflag"], "char_speed", bins.CS_LOW, closed_last=False, truncate=False,
                   groups=f"SELECT l_returnflag FROM ({choice}) WHERE use_low_cs")
    high = hist_sql(rows, ["l_returnflag"], "char_speed", bins.CS_HIGH, closed_last=False, truncate=False,
                    groups=f"SELECT l_returnflag FROM ({choice}) WHERE NOT use_low_cs")
    status = values_list([("O",), ("F",)], ["l_linestatus"], alias="st")
    return {
        "speed_stats": choice,
        "speed_hist": f"SELECT * FROM ({low}) UNION ALL SELECT * FROM ({high})",
        "speed_crosstab": f"""
WITH b AS ({binned}), obs AS (SELECT * FROM b WHERE bin_cs IS NOT NULL AND bin_slen IS NOT NULL),
r AS (SELECT DISTINCT l_returnflag, bin_cs FROM obs), c AS (SELECT DISTINCT l_returnflag, bin_slen FROM obs),
n AS (SELECT l_returnflag, bin_cs, bin_slen, count(*) AS n FROM obs GROUP BY ALL)
SELECT r.l_returnflag, r.bin_cs, c.bin_slen, CAST(coalesce(n.n, 0) AS BIGINT) AS n
FROM r JOIN c USING (l_returnflag) LEFT JOIN n USING (l_returnflag, bin_cs, bin_slen)""",
        "speed_by_status": f"""
WITH b AS ({binned}), obs AS (SELECT * FROM b WHERE bin_cs IS NOT NULL AND l_linestatus IS NOT NULL),
r AS (SELECT DISTINCT l_returnflag, bin_cs FROM obs),
n AS (SELECT l_returnflag, bin_cs, l_linestatus, count(*) AS n FROM obs GROUP BY ALL)
SELECT r.l_returnflag, r.bin_cs, st.l_linestatus, CAST(coalesce(n.n, 0) AS BIGINT) AS n
FROM r CROSS JOIN {status} LEFT JOIN n ON n.l_returnflag = r.l_returnflag AND n.bin_cs = r.bin_cs
  AND n.l_linestatus = st.l_linestatus""",
    }


def _clip_queries() -> dict[str, str]:
    from vocalstat.functions import dims
    from vocalstat.plans import driver
    c = _clips_sql()
    docs = "SELECT lang, text FROM documents"
    v_s, v_h = _per_item(c, ["sp"], "client_id", "v", bins.VOICES)
    s_s, s_h = _per_item(docs, ["lang"], "text", "s", bins.SENTENCES)
    votes = "SELECT l_returnflag, l_linenumber AS up_votes, CAST(l_quantity AS INTEGER) AS down_votes FROM lineitem"

    def vote(col, prefix):
        vc = f"SELECT l_returnflag, {col} AS v, count(*) AS w FROM ({votes}) WHERE {col} IS NOT NULL GROUP BY ALL"
        return f"""SELECT l_returnflag, CAST(sum(v * w) AS BIGINT) AS {prefix}_sum, {r3('avg(w)')} AS {prefix}_avg,
  {r3('median(w)')} AS {prefix}_med, {r3('stddev_pop(w)')} AS {prefix}_std FROM ({vc}) GROUP BY l_returnflag"""

    def vote_h(col, edges, kind):
        h = hist_sql(f"SELECT l_returnflag, {col} FROM ({votes})", ["l_returnflag"], col, edges,
                     closed_last=False, truncate=False)
        return f"SELECT *, '{kind}' AS kind FROM ({h})"

    timed = """SELECT l.l_returnflag, o.duration_ms / 1000.0 AS duration FROM lineitem l
LEFT JOIN (SELECT o_orderkey, min(CAST(floor(o_totalprice) AS BIGINT)) AS duration_ms FROM orders GROUP BY o_orderkey) o
  ON l.l_orderkey = o.o_orderkey"""
    specs = "SELECT event_id, event_type, user_id, value, value - 2.0 AS est_snr, value * 1e-6 AS speech_power FROM events"
    snr = f"SELECT event_type, CAST(est_snr AS DOUBLE) AS snr FROM ({specs})"
    bmap = {"view": ("", "validated"), "click": ("", "invalidated"), "signup": ("", "other"),
            "purchase": ("s1", "train"), "error": ("s1", "dev")}
    case_a = " ".join(f"WHEN '{k}' THEN '{a}'" for k, (a, b) in bmap.items())
    case_b = " ".join(f"WHEN '{k}' THEN '{b}'" for k, (a, b) in bmap.items())
    union_src = f"SELECT CASE sp {case_a} END AS alg, CASE sp {case_b} END AS sp, client_id FROM ({c})"
    reports = "SELECT conv_id AS sentence_id, role AS reason FROM conversations"
    rep_counts = f"SELECT sentence_id, count(*) AS c FROM ({reports}) WHERE sentence_id IS NOT NULL GROUP BY sentence_id"
    reasons = driver.REASONS + [dims.OTHER]
    rea_lab = values_list([(i, r) for i, r in enumerate(reasons)], ["reason_idx", "reason"], alias="lab")
    in_list = ", ".join(_lit(r) for r in driver.REASONS)
    return {
        "uniques": f"""
SELECT sp, CAST(count(*) AS BIGINT) AS clips,
  CAST(count(DISTINCT client_id) + max(CASE WHEN client_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uq_v,
  CAST(count(DISTINCT sentence) + max(CASE WHEN sentence IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uq_s,
  CAST(count(DISTINCT sentence_lower) + max(CASE WHEN sentence_lower IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uq_sl
FROM ({c}) GROUP BY sp""",
        "uniques_nullable": """
SELECT d.lang,
  CAST(count(DISTINCT l.quality) + max(CASE WHEN l.quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uq_with_null,
  CAST(count(DISTINCT l.quality) AS BIGINT) AS uq_non_null,
  CAST(count(DISTINCT l.toxic) + max(CASE WHEN l.toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uq_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""",
        "recs_per_voice": v_s,
        "recs_per_voice_hist": v_h,
        "recs_per_sentence": s_s,
        "recs_per_sentence_hist": s_h,
        "demographics_matrix": _margin_sql(c, ["sp"], "age", "gender", dims.AGES, dims.GENDERS, "path"),
        "demographics_unique": _margin_sql(f"SELECT DISTINCT sp, client_id, age, gender FROM ({c})", ["sp"],
                                           "age", "gender", dims.AGES, dims.GENDERS, None),
        "clips_union": f"""
WITH u AS (SELECT alg, sp, client_id FROM ({union_src})
           UNION ALL SELECT alg, 'clips' AS sp, client_id FROM ({union_src})
           WHERE alg = '' AND sp IN ('validated', 'invalidated', 'other'))
SELECT alg, sp, CAST(count(*) AS BIGINT) AS clips,
  CAST(count(DISTINCT client_id) + max(CASE WHEN client_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uq_v
FROM u GROUP BY alg, sp""",
        "vote_stats": f"SELECT * FROM ({vote('up_votes', 'uv')}) JOIN ({vote('down_votes', 'dv')}) USING (l_returnflag)",
        "vote_hist": f"{vote_h('up_votes', bins.VOTES_UP, 'up')} UNION ALL {vote_h('down_votes', bins.VOTES_DOWN, 'down')}",
        "duration_lookup": f"""
SELECT l_returnflag, {r3('sum(duration)')} AS dur_total, {r3('avg(duration)')} AS dur_avg,
  {r3('median(duration)')} AS dur_med, {r3('stddev_pop(duration)')} AS dur_std
FROM ({timed}) WHERE duration IS NOT NULL GROUP BY l_returnflag""",
        "duration_hist": hist_sql(timed, ["l_returnflag"], "duration", bins.DURATION),
        **_speed_sql(),
        "bad_counts": f"""
SELECT event_type, CAST(count(*) AS BIGINT) AS clips, CAST(count(*) FILTER (WHERE user_id % 20 = 0) AS BIGINT) AS no_vad,
  CAST(round_even(sum(CAST(trunc(value * 100) AS BIGINT)) / 1000.0, 0) AS BIGINT) AS dur,
  CAST(count(*) FILTER (WHERE user_id % 20 > 0 AND est_snr < {dims.LOW_SNR_THRESHOLD}) AS BIGINT) AS low_snr,
  CAST(count(*) FILTER (WHERE speech_power < {dims.LOW_POWER_THRESHOLD}) AS BIGINT) AS low_power
FROM ({specs}) GROUP BY event_type""",
        "bad_rows": f"""
SELECT DISTINCT event_id, event_type, user_id, value FROM ({specs})
WHERE est_snr IS NULL OR est_snr < {dims.LOW_SNR_THRESHOLD} OR speech_power < {dims.LOW_POWER_THRESHOLD}""",
        "snr_stats": f"""
SELECT event_type, {r3('avg(snr)')} AS snr_avg, {r3('median(snr)')} AS snr_med, {r3('stddev_pop(snr)')} AS snr_std
FROM ({snr}) WHERE snr IS NOT NULL GROUP BY event_type""",
        "snr_hist": hist_sql(snr, ["event_type"], "snr", bins.SNR, drop_first=True),
        "value_distributions": """
SELECT l_returnflag, measure, label, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT l_returnflag, 'enc' AS measure, CAST(l_linenumber AS VARCHAR) AS label FROM lineitem
  UNION ALL SELECT l_returnflag, 'chan', l_linestatus FROM lineitem
  UNION ALL SELECT l_returnflag, 'srate', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) FROM lineitem
  UNION ALL SELECT l_returnflag, 'brate', CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) FROM lineitem)
WHERE label IS NOT NULL GROUP BY ALL""",
        "reported_stats": f"""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM ({reports})) AS rep_sum,
  (SELECT CAST(count(DISTINCT sentence_id) + max(CASE WHEN sentence_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM ({reports})) AS rep_sen,
  {r3('avg(c)')} AS rep_avg, {r3('median(c)')} AS rep_med, {r3('stddev_pop(c)')} AS rep_std
FROM ({rep_counts})""",
        "reported_hist": f"""
SELECT CAST(b.bin AS INTEGER) AS bin, CAST(b.lo AS BIGINT) AS lo,
  CAST(count(s.c) FILTER (WHERE s.c >= b.lo AND (s.c < b.hi OR (b.is_last = 1 AND s.c = b.hi))) AS BIGINT) AS cnt
FROM {bins_table_sql(bins.REPORTED, True)} LEFT JOIN ({rep_counts}) s ON TRUE GROUP BY b.bin, b.lo""",
        "reason_freq": f"""
WITH r AS (SELECT CASE WHEN reason IN ({in_list}) THEN reason ELSE 'other' END AS reason FROM ({reports})),
n AS (SELECT reason, count(*) AS c FROM r GROUP BY reason)
SELECT CAST(lab.reason_idx AS INTEGER) AS reason_idx, lab.reason, CAST(coalesce(n.c, 0) AS BIGINT) AS cnt
FROM {rea_lab} LEFT JOIN n ON n.reason = lab.reason""",
    }


def bins_table_sql(edges, drop_first):
    from vocalstat.plans.sqlgen import bins_table
    return bins_table(edges, drop_first)


def _join_queries() -> dict[str, str]:
    from vocalstat.plans import driver
    rows = """SELECT n.n_name AS lc, CAST(year(l.l_shipdate) AS VARCHAR) AS ver, l.l_returnflag, l.l_linestatus, l.l_quantity
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey"""
    cells = f"""
WITH r AS ({rows}),
algs AS (SELECT lc, ver, list_sort(list(DISTINCT l_returnflag)) AS algs FROM r GROUP BY lc, ver),
val AS (SELECT lc, ver, sum(l_quantity) * 100.0 AS dur FROM r GROUP BY lc, ver)
SELECT algs.lc, algs.ver,
  CASE WHEN val.dur >= 0 THEN CAST({r3('val.dur / 3600.0', 1)} AS VARCHAR) ELSE '0' END || '|' || array_to_string(algs.algs, '|') AS cell
FROM algs LEFT JOIN val USING (lc, ver)"""
    corpus = "SELECT lang AS lc, CAST(doc_id AS VARCHAR) AS sentence_id, text AS sentence, source FROM documents"
    sp = f"""SELECT lc, sentence_id, sentence, source AS sp,
  CASE WHEN CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % 2 = 0 THEN '20.0' ELSE '16.1' END AS ver FROM ({corpus})"""
    ref = "SELECT DISTINCT d.lang, d.text FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)"
    vp = ", ".join(f"('{c}', '{t}', {i})" for i, (c, t) in enumerate(driver.VARIANT_PRESETS))
    ap = ", ".join(f"('{c}', '{t}', {i})" for i, (c, t) in enumerate(driver.ACCENT_PRESETS))
    big = 1 << 30
    return {
        "support_matrix": f"""
SELECT n.n_name AS lc, c.ver, c.cell FROM nation n LEFT JOIN ({cells}) c ON c.lc = n.n_name""",
        "support_matrix_counts": f"""
WITH r AS ({rows}),
s AS (SELECT lc, ver, '' AS alg, 'validated' AS sp FROM r GROUP BY lc, ver
      UNION ALL SELECT DISTINCT lc, ver, l_returnflag, l_linestatus FROM r)
SELECT CAST(count(*) AS BIGINT) AS total_splits, CAST(count(DISTINCT lc) AS BIGINT) AS total_lc,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT ver, lc, alg FROM s WHERE alg <> '')) AS total_algo FROM s""",
        "split_membership": f"""
WITH c AS ({corpus}), s AS ({sp}),
by_id AS (SELECT k.ver, k.lc, k.sp, c.sentence FROM (SELECT DISTINCT ver, lc, sp, sentence_id FROM s WHERE ver = '20.0') k
          JOIN c ON c.lc = k.lc AND c.sentence_id = k.sentence_id),
by_text AS (SELECT k.ver, k.lc, k.sp, c.sentence FROM (SELECT DISTINCT ver, lc, sp, sentence FROM s WHERE ver = '16.1') k
          JOIN c ON c.lc = k.lc AND c.sentence = k.sentence)
SELECT ver, lc, sp, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT sentence) AS BIGINT) AS n_text
FROM (SELECT * FROM by_id UNION ALL SELECT * FROM by_text) GROUP BY ver, lc, sp""",
        "found_texts": f"""
SELECT lang, CAST(count(*) AS BIGINT) AS n, (lang, text) IN (SELECT (lang, text) FROM ({ref})) AS found
FROM documents GROUP BY lang, found""",
        "new_sentences": """
SELECT lang, CAST(count(*) AS BIGINT) AS n_new FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY lang""",
        "version_filter": """
SELECT 'q' || CAST(l.quality AS VARCHAR) AS ver, d.lang, CAST(count(*) AS BIGINT) AS n,
  CAST(count(DISTINCT d.text) AS BIGINT) AS n_text
FROM documents d JOIN (SELECT DISTINCT doc_id, quality FROM labels) l ON d.doc_id = l.doc_id GROUP BY ALL""",
        "specs_upto_version": f"""
WITH f AS (SELECT s.s_nationkey AS lc, year(l.l_shipdate) AS ord, count(*) AS n, sum(l.l_quantity) AS q
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY ALL),
d AS (SELECT DISTINCT c.c_nationkey AS lc, year(o.o_orderdate) AS ver FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT d.lc, d.ver, CAST(sum(f.n) AS BIGINT) AS n, {r3('sum(f.q)')} AS q
FROM d JOIN f ON f.lc = d.lc AND f.ord <= d.ver GROUP BY d.lc, d.ver""",
        "incremental_work": """
SELECT DISTINCT strftime(o.o_orderdate, '%Y-%m-%d') AS ver, o.o_orderpriority AS lc FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l JOIN orders o2 ON l.l_orderkey = o2.o_orderkey
                  WHERE l.l_returnflag = 'R' AND strftime(l.l_shipdate, '%Y-%m-%d') = strftime(o.o_orderdate, '%Y-%m-%d')
                    AND o2.o_orderpriority = o.o_orderpriority)""",
        # a value is a preset by its text or, if no preset has that text, by its code
        "variant_freq": f"""
WITH p AS (SELECT * FROM (VALUES {vp}) AS t(code, text, ord)),
m AS (SELECT part.p_brand AS lc, CAST(part.p_size AS VARCHAR) AS client_id, part.p_type AS raw,
        coalesce((SELECT t.code FROM p t WHERE t.text = part.p_type), (SELECT t.code FROM p t WHERE t.code = part.p_type)) AS code
      FROM part)
SELECT m.lc, coalesce(m.code, m.raw) AS variant,
  CAST(min(CASE WHEN m.raw = 'nodata' THEN {big} ELSE p.ord END) AS BIGINT) AS ord, CAST(count(*) AS BIGINT) AS rec,
  CAST(count(DISTINCT m.client_id) AS BIGINT) AS voices
FROM m LEFT JOIN p ON p.code = m.code GROUP BY m.lc, coalesce(m.code, m.raw)""",
        "accent_freq": f"""
WITH p AS (SELECT * FROM (VALUES {ap}) AS t(token, text, ord)),
known AS (SELECT text AS name, token FROM p UNION ALL SELECT token, token FROM p WHERE token NOT IN (SELECT text FROM p)
          UNION ALL SELECT 'nodata', 'nodata'),
v AS (SELECT p_brand AS lc, p_name AS val, count(*) AS rec, count(DISTINCT CAST(p_size AS VARCHAR)) AS uv
      FROM part GROUP BY p_brand, p_name),
single AS (SELECT v.lc, known.token AS accent, v.rec, v.uv FROM v JOIN known ON known.name = v.val),
split AS (SELECT lc, unnest(string_split(val, ' ')) AS piece, rec, uv FROM v WHERE val NOT IN (SELECT name FROM known)),
several AS (SELECT s.lc, coalesce(known.token, 'other') AS accent, s.rec, s.uv FROM split s LEFT JOIN known ON known.name = s.piece),
n AS (SELECT lc, accent, sum(rec) AS rec, sum(uv) AS voices FROM (SELECT * FROM single UNION ALL SELECT * FROM several) GROUP BY lc, accent),
grid AS (SELECT g.lc, l.accent, l.ord FROM (SELECT DISTINCT p_brand AS lc FROM part) g
         CROSS JOIN (SELECT token AS accent, ord FROM p UNION ALL SELECT 'nodata', {big} UNION ALL SELECT 'other', {big + 1}) l)
SELECT grid.lc, grid.accent, CAST(grid.ord AS BIGINT) AS ord, CAST(coalesce(n.rec, 0) AS BIGINT) AS rec,
  CAST(coalesce(n.voices, 0) AS BIGINT) AS voices
FROM grid LEFT JOIN n ON n.lc = grid.lc AND n.accent = grid.accent""",
    }


def _audio_queries() -> dict[str, str]:
    vad = """SELECT l_returnflag, CAST(trunc(l_extendedprice) AS BIGINT) AS duration,
  CAST(trunc(l_quantity * 100) AS BIGINT) AS speech_duration FROM lineitem"""
    v = f"SELECT l_returnflag, speech_duration / 1000.0 AS vad, 100.0 * (CAST(speech_duration AS DOUBLE) / CAST(duration AS DOUBLE)) AS vadp FROM ({vad})"
    pw = "SELECT event_type, (value * 1e-6) * 1000000.0 AS p FROM events"
    return {
        "vad_stats": f"""
SELECT l_returnflag, CAST(trunc(sum(vad)) AS BIGINT) AS vad_sum, {r3('avg(vad)')} AS vad_avg, {r3('median(vad)')} AS vad_med,
  {r3('stddev_pop(vad)')} AS vad_std, {r3('avg(vadp)')} AS vadp_avg, {r3('median(vadp)')} AS vadp_med,
  {r3('stddev_pop(vadp)')} AS vadp_std
FROM ({v}) GROUP BY l_returnflag""",
        "vadp_hist": hist_sql(f"SELECT l_returnflag, vadp FROM ({v})", ["l_returnflag"], "vadp", bins.PERCENT),
        "power_stats": f"""
SELECT event_type, {r3('avg(p)')} AS sp_pwr_avg, {r3('median(p)')} AS sp_pwr_med, {r3('stddev_pop(p)')} AS sp_pwr_std
FROM ({pw}) WHERE p IS NOT NULL GROUP BY event_type""",
        "power_hist": hist_sql(pw, ["event_type"], "p", bins.POWER),
        "error_freq": """
WITH s AS (SELECT DISTINCT l_returnflag AS sp, l_orderkey AS path FROM lineitem),
e AS (SELECT s.sp, o.o_orderstatus AS source FROM s JOIN orders o ON o.o_orderkey = s.path),
n AS (SELECT sp, source, count(*) AS n FROM e GROUP BY sp, source)
SELECT sp, CAST(sum(n) OVER (PARTITION BY sp) AS BIGINT) AS errors, source, CAST(n AS BIGINT) AS n FROM n""",
    }


def _repair_queries() -> dict[str, str]:
    return {
        "repair_rows": """
SELECT lpad(CAST(doc_id AS VARCHAR), 64, '0') AS sentence_id,
  CASE WHEN strpos(text, chr(10)) > 0 THEN regexp_replace(replace(text, chr(10), ' '), ' {2,}', ' ', 'g')
       ELSE text END AS sentence,
  lang AS sentence_domain, source, '1' AS is_used, CAST(n_chars AS VARCHAR) AS clips_count
FROM documents""",
        "repair_problems": "SELECT 'unrepairable' AS reason, CAST(0 AS BIGINT) AS n WHERE FALSE",
    }


_base_oracle = oracle_sql


def oracle_sql() -> dict[str, str]:  # noqa: F811
    out = _base_oracle()
    out.update(_clip_queries())
    out.update(_join_queries())
    out.update(_repair_queries())
    out.update(_audio_queries())
    return out
