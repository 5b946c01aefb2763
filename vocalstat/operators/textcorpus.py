"""Text-corpus statistics A10-A17 (one row per group, e.g. (ver, lc, alg, sp)).

Inputs are sentence rows; every function names its columns as parameters so
the same plan runs on the corpus table and on any other text table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import bins, dims
from vocalstat.functions.exprs import char_count, domain_map, normalise, rint3, tokenise, word_count
from vocalstat.operators import stats
from vocalstat.operators.membership import row_text
from vocalstat.session import materialize


def enrich_sentences(df: DataFrame, sentence: str = "sentence") -> DataFrame:
    """Add normalized, tokens, char_cnt, word_cnt to sentence rows."""
    return (df.withColumn("normalized", normalise(sentence))
            .withColumn("tokens", tokenise("normalized"))
            .withColumn("char_cnt", char_count(sentence))
            .withColumn("word_cnt", word_count("tokens")))


def sentence_counts(df: DataFrame, keys: Sequence[str], sentence: str = "sentence",
                    normalized: str = "normalized", valid: str = "valid") -> DataFrame:
    """A10: s_cnt, val (sum of the validity flag), uq_s, uq_n (nulls dropped)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("s_cnt"),
        F.coalesce(F.sum(F.col(valid).cast("long")), F.lit(0)).cast("long").alias("val"),
        stats.distinct_non_null(stats.text_key(sentence)).alias("uq_s"),
        stats.distinct_non_null(stats.text_key(normalized)).alias("uq_n"),
    )


def char_stats(df: DataFrame, keys: Sequence[str], char_cnt: str = "char_cnt") -> tuple[DataFrame, DataFrame]:
    """c_sum/avg/med/std and the character-length histogram.

    The histogram uses SHORT bins when the group's rounded mean is below the
    threshold, else LONG (data-dependent bins: mean first, then bins, both from
    the same value-count table). Returns (summary, long histogram with ``bin, lo, cnt``).
    """
    vc = stats.value_counts(df, keys, char_cnt, name="_v", count="_w", drop_nulls=False)
    summ = stats.summary_from_counts(vc, keys, "_v", "_w", "c")
    choice = summ.select(*keys, (F.col("c_avg") < F.lit(bins.CHARS_THRESHOLD)).alias("use_low"))
    hist = stats.adaptive_histogram_from_counts(vc, keys, "_v", "_w", choice, bins.CHARS_SHORT, bins.CHARS_LONG)
    return summ.withColumn("c_sum", F.col("c_sum").cast("long")), hist


def word_stats(df: DataFrame, keys: Sequence[str], word_cnt: str = "word_cnt") -> tuple[DataFrame, DataFrame]:
    """w_sum/avg/med/std and the words histogram (first bin dropped)."""
    vc = stats.value_counts(df, keys, word_cnt, name="_v", count="_w", drop_nulls=False)
    summ = stats.summary_from_counts(vc, keys, "_v", "_w", "w")
    hist = stats.histogram_from_counts(vc, keys, "_v", "_w", bins.WORDS, drop_first=True)
    return summ.withColumn("w_sum", F.col("w_sum").cast("long")), hist


def token_table(df: DataFrame, keys: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """A13 frequency table: (keys, token, count)."""
    return stats.item_frequency(df, keys, tokens, name="token", count="count")


def token_stats(freq: DataFrame, keys: Sequence[str], count: str = "count") -> tuple[DataFrame, DataFrame]:
    """t_sum = distinct tokens; t_avg/med/std and t_freq over the token counts."""
    vc = stats.value_counts(freq, keys, count, name="_v", count="_w")
    summ = stats.summary_from_counts(vc, keys, "_v", "_w", "t", with_sum=False)
    # distinct tokens = total weight of the counts-of-counts table: reusing it
    # keeps one scan of the token table (a separate count over ``freq`` is pruned
    # to a different plan and would tokenise the text again)
    distinct = (vc.groupBy(*keys).agg(F.sum("_w").cast("long").alias("t_sum")) if keys else
                vc.agg(F.sum("_w").cast("long").alias("t_sum")))
    summ = stats.join_groups(summ, distinct, keys)
    hist = stats.histogram_from_counts(vc, keys, "_v", "_w", bins.TOKENS, drop_first=True)
    return summ, hist


def grapheme_table(df: DataFrame, keys: Sequence[str], text: str = "sentence",
                   item: str = "grapheme") -> DataFrame:
    """A14/A15 frequency table: code points of the raw text, (keys, item, count); an empty text has none."""
    return stats.item_frequency(df.where(F.col(text) != ""), keys, F.split(F.col(text), ""),
                                name=item, count="count")


def top_items(freq: DataFrame, keys: Sequence[str], item: str, k: int = 100,
              prefix: str = "g") -> DataFrame:
    """A14/A15 record fields: ``{p}_cnt`` (all distinct items), ``{p}_items``, ``{p}_freq`` (top k)."""
    top = stats.top_k(freq, keys, item, "count", k)
    arr = (top.groupBy(*keys)
           .agg(F.array_sort(F.collect_list(F.struct("rnk", F.col(item).alias("i"), F.col("count").alias("c")))).alias("_t")))
    arr = arr.select(*keys, F.transform("_t", lambda s: s["i"]).alias(f"{prefix}_items"),
                     F.transform("_t", lambda s: s["c"]).alias(f"{prefix}_freq"))
    cnt = freq.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}_cnt"))
    return stats.join_groups(cnt, arr, keys)


def domain_table(df: DataFrame, keys: Sequence[str], domain: str = "sentence_domain") -> DataFrame:
    """A16 stored table: raw domain labels (comma lists kept whole) and counts."""
    return stats.value_counts(df, keys, domain, name="sentence_domain", count="count")


def domain_counts(raw: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Comma lists split, labels mapped to current names, summed, fixed order.

    Returns (long (keys, dom_idx, domain, count) with count > 0 only,
    quarantine (keys, label, count) of labels not in the map, Q12).
    """
    parts = raw.select(*keys, F.explode(F.split(F.col("sentence_domain"), ",")).alias("label"), "count")
    mapped = parts.withColumn("domain", domain_map("label"))
    quarantine = mapped.where(F.col("domain").isNull()).groupBy(*keys, "label").agg(F.sum("count").alias("count"))
    order = F.array_position(F.array(*[F.lit(d) for d in dims.DOMAINS]), F.col("domain")).cast("int") - 1
    counts = (mapped.where(F.col("domain").isNotNull())
              .groupBy(*keys, "domain").agg(F.sum("count").cast("long").alias("count"))
              .where(F.col("count") > 0)
              .withColumn("dom_idx", order))
    return counts.select(*keys, "dom_idx", "domain", "count"), quarantine


#: Kinds of items that a sentence is counted by, and the measures among them.
CHARS, WORDS, TOKEN, GRAPHEME, PHONEME, DOMAIN, VALID, SENTENCE, NORMALIZED = "c", "w", "t", "g", "p", "d", "v", "s", "n"
MEASURES = {
    CHARS: stats.Measure(bins.CHARS_LONG, low_edges=bins.CHARS_SHORT, threshold=bins.CHARS_THRESHOLD),
    WORDS: stats.Measure(bins.WORDS, drop_first=True),
    TOKEN: stats.Measure(bins.TOKENS, drop_first=True),
}


def _short(text: Column) -> Column:
    """A text of its own up to 63 characters, the SHA-256 of a longer one (64 characters)."""
    return F.when(F.length(text) < 64, text).otherwise(F.sha2(text.cast("binary"), 256))


def item_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, kind, item, n): everything that the record counts.

    Each sentence gives its length, word count, validity and domain, its own and its normalised
    text (by digest if long), its tokens and its code points. Items are exploded and summed
    kind by kind, each from its own column, map-side first.
    """
    have = set(df.columns)
    opt = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    one = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("item"))
    count = lambda rows: rows.groupBy(*keys, "kind", "item").agg(F.count(F.lit(1)).alias("n"))
    once = F.array(one(CHARS, opt("char_cnt")), one(WORDS, opt("word_cnt")), one(VALID, opt("valid")), one(DOMAIN, opt("sentence_domain")),
                   one(SENTENCE, _short(F.col("sentence"))), one(NORMALIZED, _short(F.col("normalized"))))
    out = count(df.select(*keys, F.inline(once))).unionByName(
        count(df.select(*keys, F.lit(TOKEN).alias("kind"), F.explode("tokens").alias("item")))).unionByName(
        code_points(df, keys, "sentence", GRAPHEME))
    return out.unionByName(code_points(df, keys, "phonemised", PHONEME)) if "phonemised" in have else out


def code_points(df: DataFrame, keys: Sequence[str], text: str, kind: str) -> DataFrame:
    """(keys, kind, item, n): code points of a text column.

    Pieces between spaces are counted first, and the code points of each different piece weighted
    by its count: words repeat, so far fewer code points are exploded than the texts hold.
    """
    texts = df.where(F.col(text).isNotNull())
    pieces = texts.select(*keys, F.explode(F.split(F.col(text), " ")).alias("_p")).groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_w"))
    points = pieces.where("_p <> ''").select(*keys, F.explode(F.split("_p", "")).alias("item"), "_w").groupBy(*keys, "item").agg(F.sum("_w").alias("n"))
    spaces = texts.groupBy(*keys).agg(F.sum(F.length(text) - F.length(F.replace(F.col(text), F.lit(" "), F.lit("")))).alias("n"))
    spaces = spaces.where("n > 0").withColumn("item", F.lit(" "))
    return points.unionByName(spaces).withColumn("kind", F.lit(kind)).select(*keys, "kind", "item", "n")


def frequency(counts: DataFrame, keys: Sequence[str], kind: str, name: str) -> DataFrame:
    """The frequency table of one kind of item: (keys, name, count), nulls left out."""
    return counts.where((F.col("kind") == kind) & F.col("item").isNotNull()).select(*keys, F.col("item").alias(name), F.col("n").alias("count"))


def _base_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10 without distinct texts: s_cnt, val."""
    of = lambda kind: F.col("kind") == kind
    return counts.where(of(SENTENCE) | of(VALID)).groupBy(*keys).agg(
        F.sum(F.when(of(SENTENCE), F.col("n"))).alias("s_cnt"),
        F.coalesce(F.sum(F.when(of(VALID), F.col("n") * F.col("item").cast("long"))), F.lit(0)).alias("val"))


def distinct_texts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: uq_s, uq_n of groups whose counts are their own (not by signature)."""
    n = lambda kind: F.count_if((F.col("kind") == kind) & F.col("item").isNotNull())
    return counts.where(F.col("kind").isin(SENTENCE, NORMALIZED)).groupBy(*keys).agg(n(SENTENCE).alias("uq_s"), n(NORMALIZED).alias("uq_n"))


def records(counts: DataFrame, distinct: DataFrame, keys: Sequence[str], capabilities: DataFrame | None = None,
            lc: str = "lc", top: int = 100) -> DataFrame:
    """A10-A17 records from item counts per group; ``distinct`` has uq_s and uq_n.

    Lengths, words and token counts are summed up together, graphemes and phonemes ranked
    together, and one grouping puts the parts of a group into its record.
    """
    keys = list(keys)
    of = lambda *kinds: F.col("kind").isin(*kinds)
    token = F.col("kind") == TOKEN
    values = counts.where(of(CHARS, WORDS, TOKEN) & F.col("item").isNotNull()).select(
        *keys, F.col("kind").alias("measure"), F.when(token, F.col("n")).otherwise(F.expr("try_cast(CASE WHEN kind <> 't' THEN item END AS bigint)")).alias("value"),
        F.when(token, F.lit(1)).otherwise(F.col("n")).alias("weight"))
    values = materialize(values.groupBy(*keys, "measure", "value").agg(F.sum("weight").alias("weight")), "values")
    m = stats.measure_columns(stats.measure_table(values, keys, MEASURES), keys, (CHARS, WORDS, TOKEN))
    m = m.withColumns({"c_sum": F.col("c_sum").cast("long"), "w_sum": F.col("w_sum").cast("long"), "t_sum": F.col("t_n")})
    m = m.select(*keys, *[f"{p}_{f}" for p in "cwt" for f in ("sum", "avg", "med", "std", "freq")])
    letters = counts.where(of(GRAPHEME, PHONEME) & F.col("item").isNotNull()).withColumnRenamed("n", "count")
    ranked = top_items(letters, [*keys, "kind"], "item", top, "x")
    pick = lambda kind, f: F.first(F.when(F.col("kind") == kind, F.col(f"x_{f}")), ignorenulls=True).alias(f"{kind}_{f}")
    letters = ranked.groupBy(*keys).agg(*[pick(k, f) for k in (GRAPHEME, PHONEME) for f in ("cnt", "items", "freq")])
    doms, _ = domain_counts(frequency(counts, keys, DOMAIN, "sentence_domain"), keys)
    dom_arr = (doms.groupBy(*keys)
               .agg(F.array_sort(F.collect_list(F.struct("dom_idx", "domain", "count"))).alias("_d"))
               .select(*keys, F.size("_d").alias("dom_cnt"),
                       F.transform("_d", lambda s: s["domain"]).alias("dom_items"),
                       F.transform("_d", lambda s: s["count"]).alias("dom_freq")))
    rec = stats.assemble([_base_counts(counts, keys), distinct.select(*keys, "uq_s", "uq_n"), m, letters, dom_arr], keys)
    return _record(rec, keys, capabilities, lc)


def _record(rec: DataFrame, keys: Sequence[str], capabilities: DataFrame | None, lc: str) -> DataFrame:
    """The published columns; A17: words and tokens for validator locales, phonemes for phonemiser locales."""
    if capabilities is not None and lc in keys:
        rec = rec.join(capabilities.select(lc, "has_val", "has_phon"), lc, "left")
        has_val = F.coalesce(F.col("has_val"), F.lit(False))
        has_phon = F.coalesce(F.col("has_phon"), F.lit(False))
    else:
        has_val, has_phon = F.lit(True), F.lit(True)
    zero = F.lit(0).cast("long")
    empty = F.array().cast("array<long>")
    return rec.select(
        *keys, has_val.alias("has_val"), has_phon.alias("has_phon"), "s_cnt", "uq_s", "uq_n", "val",
        F.coalesce("c_sum", zero).alias("c_sum"), "c_avg", "c_med", "c_std", F.coalesce("c_freq", empty).alias("c_freq"),
        *[F.when(has_val, F.col(c)).alias(c) for c in ("w_sum", "w_avg", "w_med", "w_std", "w_freq",
                                                         "t_sum", "t_avg", "t_med", "t_std", "t_freq")],
        F.coalesce("g_cnt", zero).alias("g_cnt"), "g_items", "g_freq",
        F.when(has_phon, F.coalesce("p_cnt", zero)).alias("p_cnt"),
        F.when(has_phon, F.col("p_items")).alias("p_items"), F.when(has_phon, F.col("p_freq")).alias("p_freq"),
        F.coalesce("dom_cnt", F.lit(0)).alias("dom_cnt"), "dom_items", "dom_freq",
    )


def spread_counts(by_sig: DataFrame, groups: DataFrame, keys: Sequence[str], lc: str = "lc") -> DataFrame:
    """(keys, kind, item, n) from counts by signature; texts, which only distinct counts need, stay behind."""
    counted = by_sig.where(~F.col("kind").isin(SENTENCE, NORMALIZED)).unionByName(
        by_sig.where(F.col("kind") == SENTENCE).groupBy(lc, "sig").agg(F.sum("n").alias("n"))
        .withColumns({"kind": F.lit(SENTENCE), "item": F.lit(None).cast("string")}))
    return counted.join(groups, [lc, "sig"]).groupBy(*keys, "kind", "item").agg(F.sum("n").alias("n"))


def spread_distinct(by_sig: DataFrame, groups: DataFrame, keys: Sequence[str], lc: str = "lc") -> DataFrame:
    """A10: uq_s, uq_n per group. Texts are counted by the set of signatures they occur under (mostly one), then spread."""
    keys = list(keys)
    texts = by_sig.where(F.col("kind").isin(SENTENCE, NORMALIZED) & F.col("item").isNotNull())
    sets = texts.groupBy(lc, "kind", "item").agg(F.array_sort(F.collect_set("sig")).alias("sigs"))
    sets = sets.groupBy(lc, "kind", "sigs").agg(F.count(F.lit(1)).alias("n"))
    spread = sets.withColumn("sig", F.explode("sigs")).join(groups, [lc, "sig"]).select(*keys, "kind", "sigs", "n").distinct()
    n = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return spread.groupBy(*keys).agg(n(SENTENCE).alias("uq_s"), n(NORMALIZED).alias("uq_n"))


def counts_by_signature(corpus: DataFrame, tagged: DataFrame, lc: str = "lc",
                        enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``item_counts`` of the corpus rows by (lc, signature).

    ``enrich`` adds columns that follow from the row itself (``enrich_sentences`` if the corpus has no
    tokens). It runs on the tagged rows where they are counted, so that the sentences alone are moved
    and stored, not their normalised texts and tokens as well.
    """
    if enrich is None and "tokens" not in corpus.columns:
        enrich = enrich_sentences
    rows = corpus.withColumn("text", row_text("sentence")).join(tagged, [lc, "sentence_id", "text"])
    used = [c for c in ("char_cnt", "word_cnt", "valid", "sentence_domain", "sentence", "normalized", "tokens", "phonemised") if c in rows.columns]
    rows = materialize(rows.select(lc, "sig", *used), "tagged")
    return materialize(item_counts(enrich(rows) if enrich else rows, [lc, "sig"]), "sig-items", partition_by=("kind",))


def text_corpus_stats(df: DataFrame, keys: Sequence[str], capabilities: DataFrame | None = None,
                      lc: str = "lc", top: int = 100) -> DataFrame:
    """One text-corpus statistics record per group (record of A10-A17).

    ``df`` holds enriched sentence rows (see ``enrich_sentences``; ``valid`` and
    ``phonemised`` may be absent). ``capabilities`` is (lc, has_val, has_phon),
    a per-locale table bounded by the number of locales; word/token fields are
    filled for validator locales only, phoneme fields for phonemiser locales.
    """
    keys = list(keys)
    if "valid" not in df.columns:
        df = df.withColumn("valid", F.lit(None).cast("int"))
    if "phonemised" not in df.columns:
        df = df.withColumn("phonemised", F.lit(None).cast("string"))
    if "sentence_domain" not in df.columns:
        df = df.withColumn("sentence_domain", F.lit(None).cast("string"))
    rec = sentence_counts(df, keys)
    c_sum, c_hist = char_stats(df, keys)
    rec = rec.join(c_sum, keys, "left").join(stats.to_array(c_hist, keys, "bin", "cnt", "c_freq"), keys, "left")
    w_sum, w_hist = word_stats(df, keys)
    rec = rec.join(w_sum, keys, "left").join(stats.to_array(w_hist, keys, "bin", "cnt", "w_freq"), keys, "left")
    t_sum, t_hist = token_stats(token_table(df, keys), keys)
    rec = rec.join(t_sum, keys, "left").join(stats.to_array(t_hist, keys, "bin", "cnt", "t_freq"), keys, "left")
    rec = rec.join(top_items(grapheme_table(df, keys, "sentence", "grapheme"), keys, "grapheme", top, "g"), keys, "left")
    rec = rec.join(top_items(grapheme_table(df, keys, "phonemised", "phoneme"), keys, "phoneme", top, "p"), keys, "left")
    doms, _ = domain_counts(domain_table(df, keys), keys)
    dom_arr = (doms.groupBy(*keys)
               .agg(F.array_sort(F.collect_list(F.struct("dom_idx", "domain", "count"))).alias("_d"))
               .select(*keys, F.size("_d").alias("dom_cnt"),
                       F.transform("_d", lambda s: s["domain"]).alias("dom_items"),
                       F.transform("_d", lambda s: s["count"]).alias("dom_freq")))
    rec = rec.join(dom_arr, keys, "left")
    return _record(rec, keys, capabilities, lc)


__all__ = ["enrich_sentences", "sentence_counts", "char_stats", "word_stats", "token_table",
           "token_stats", "grapheme_table", "top_items", "domain_table", "domain_counts",
           "item_counts", "frequency", "distinct_texts", "spread_counts", "spread_distinct",
           "counts_by_signature", "records", "text_corpus_stats", "rint3"]
