"""Incremental sentence corpus A18 / A19 (with K8 version index, K9, K10).

The corpus is one table per locale (here: one table keyed by ``lc``) that
only grows: each run reads the newest release's validated sentences, keeps
the ones not yet in the corpus (J1 anti join on lc, sentence_id), enriches
them once (P7, P9-P12) and appends them (a real union, Q1 fixed). Version
indexes say which corpus sentences belong to each release.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import dims
from vocalstat.functions.exprs import is_valid_sentence, version_ordinal
from vocalstat.operators import membership
from vocalstat.operators.textcorpus import enrich_sentences

CORPUS_COLUMNS = ["lc", "sentence_id", "sentence", "sentence_domain", "source", "is_used", "clips_count",
                  "normalized", "phonemised", "tokens", "char_cnt", "word_cnt", "valid"]


def enrich_new(new: DataFrame, rules: DataFrame | None = None, phonemes: DataFrame | None = None) -> DataFrame:
    """P7, P9-P12 for new sentences. ``rules`` = (lc, allowed) regex per locale
    (one row per locale); locales without a rule get valid = null.
    ``phonemes`` = (lc, sentence_id, phonemised) when available (P12 is an input)."""
    df = enrich_sentences(new, "sentence")
    if rules is not None:
        df = df.join(rules.select("lc", "allowed"), "lc", "left")
        df = df.withColumn("valid", is_valid_sentence("normalized", F.col("allowed"))).drop("allowed")
    else:
        df = df.withColumn("valid", F.lit(None).cast("int"))
    if phonemes is not None:
        df = df.join(phonemes.select("lc", "sentence_id", "phonemised"), ["lc", "sentence_id"], "left")
    else:
        df = df.withColumn("phonemised", F.lit(None).cast("string"))
    return df


def extend_corpus(corpus: DataFrame | None, validated: DataFrame, rules: DataFrame | None = None,
                  phonemes: DataFrame | None = None, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(new corpus, added rows). ``validated`` = (lc, S2 columns) of the newest release."""
    cols = ["lc", "sentence_id", "sentence", "sentence_domain", "source", "is_used", "clips_count"]
    v = validated.select(*cols)
    if corpus is None:
        added = enrich_new(v, rules, phonemes).select(*CORPUS_COLUMNS)
        return added, added
    new = membership.new_rows(v, corpus, ["lc", "sentence_id"], force=force)
    added = enrich_new(new, rules, phonemes).select(*CORPUS_COLUMNS)
    base = corpus.select(*CORPUS_COLUMNS)
    if force:
        base = base.join(new.select("lc", "sentence_id"), ["lc", "sentence_id"], "left_anti")
    return base.unionByName(added), added


def version_indexes(corpus: DataFrame, versions: DataFrame, old_sentences: DataFrame | None = None
                    ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index (ver, lc, sentence_id), disabled (ver, lc, ...), not_found (ver, lc, ...)).

    ``versions`` = (ver, lc) datasets. From the first id version on, a release's
    index is every usable corpus id of its locale; older releases are matched by
    sentence text against their plain sentence files ``old_sentences`` (ver, lc, sentence).
    """
    cut = dims.VERSIONS.index(dims.SENTENCE_ID_FROM)
    usable = corpus.where(F.col("is_used") == 1)
    v = versions.select("ver", "lc").distinct()
    new_v = v.where(version_ordinal("ver") >= cut)
    idx_new = new_v.join(usable.select("lc", "sentence_id"), "lc")
    disabled = new_v.join(corpus.where((F.col("is_used") == 0) & F.col("sentence_id").isNotNull()), "lc")
    if old_sentences is None:
        return idx_new.distinct(), disabled, usable.limit(0).withColumn("ver", F.lit(None).cast("string"))
    old_v = v.where(version_ordinal("ver") < cut)
    old = old_sentences.join(old_v, ["ver", "lc"], "left_semi").select("ver", "lc", "sentence").distinct()
    # corpus rows of each old release, by text: an equi-join, so the text is never copied per version
    idx_old = old.join(usable.select("lc", "sentence", "sentence_id"), ["lc", "sentence"]).select("ver", "lc", "sentence_id")
    # the rest of the corpus per old release: ids first, rows afterwards
    ids = old_v.join(usable.select("lc", "sentence_id"), "lc")
    missing = membership.not_found(ids, idx_old, ["ver", "lc", "sentence_id"])
    not_found = missing.join(usable, ["lc", "sentence_id"]).select("ver", *usable.columns)
    index = idx_new.unionByName(idx_old).where(F.col("sentence_id").isNotNull()).distinct()
    return index, disabled, not_found
