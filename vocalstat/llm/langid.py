"""Language identification of web pages by Bayesian evidence fusion.

Evidence on a page: its visible text (likelihoods of hashed byte trigrams, one model a language,
trained on labelled documents), the language its markup declares, the suffix of its address, and
a prior of its host. How declarations and suffixes go with languages, and how often a language
occurs on a host, is counted over all pages by grouped aggregation, with the language that the
text alone suggests. A host's prior is smoothed towards its domain's, that towards the prior of
all pages; a page's own count is left out of its host's and domain's. The posterior is the normed
product of prior and likelihoods.

The known languages are those of all labelled documents, however rare. The trigram models are
trained on about ``TRAIN_ROWS`` doc_ids of each language, those with its smallest hashes and one at
least; languages and counts (languages x ``BUCKETS``) are what reaches the driver.

Defined cases: comments, scripts and tags that a page leaves open reach to its end; a "<" that no
tag follows is text; null html is the empty page, which the other evidence decides; a null or odd url
has the empty host; a declaration other than of the known languages counts as none; ties go to
the language first in code point order; without labelled documents the language is null; repeated
rows count each; null ids stay null; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import TMP, load, map_rows, whole_text
from vocalstat.session import materialize

TRAIN_ROWS = 5_000
BUCKETS = 1 << 14
#: Trigrams overlap, and pages quote other languages: a text counts as so many independent trigrams at most.
SATURATION = 20.0
PSEUDO = 1.0
#: Counts that a domain's prior weighs in its hosts', and the prior of all pages in a domain's.
HOST_WEIGHT, DOMAIN_WEIGHT = 10.0, 20.0

# What a page leaves open ends with the page, as in browsers; so no pattern reads the same text twice.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<[/!?A-Za-z][^>]*(?:>|\Z)")
_DECLARED = re.compile(r"<html\b[^<>]*?\s(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b", re.I)


def visible_text(page: str) -> str:
    return entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def declared_language(page: str) -> str | None:
    m = _DECLARED.search(page)
    return m[1].lower() if m else None


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the hashed byte trigrams of the lower-cased words, space between."""
    b = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    key = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - 14)
    n = np.bincount(key, minlength=BUCKETS)
    at = np.nonzero(n)[0]
    return at, n[at]


def _counts(langs: list, texts: list) -> dict:
    total: dict[str, np.ndarray] = {}
    for lang, text in zip(langs, texts):
        at, n = trigrams(text)
        total.setdefault(lang, np.zeros(BUCKETS, np.int64))[at] += n
    rows = [(lang, k, n[k]) for lang, n in total.items() for k in np.nonzero(n)[0]]
    return {"lang": [r[0] for r in rows], "bucket": [r[1] for r in rows], "n": [r[2] for r in rows]}


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in code point order, and log-probabilities (languages, BUCKETS) of their trigrams."""
    own = docs.where("lang IS NOT NULL").select(F.lower("lang").alias("lang"), F.xxhash64("doc_id").alias(f"{TMP}h"), whole_text().alias("text"))
    per = own.select("lang", f"{TMP}h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(f"{TMP}h").alias("low")).collect()
    langs = sorted(r["lang"] for r in per)
    # hashes are even over 2^64: the share of a language's ids that lies below its limit is rows / n
    limit = [(r["lang"], max(r["low"], min((rows << 64) // r["n"], (1 << 64) - 1) - (1 << 63))) for r in per]
    limits = docs.sparkSession.createDataFrame(limit, f"lang string, {TMP}limit long")
    sample = own.join(F.broadcast(limits), "lang").where(F.col(f"{TMP}h") <= F.col(f"{TMP}limit"))  # a row a language
    counts = map_rows(sample, _counts, "lang string, bucket int, n long", "lang", "text")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    n = np.full((len(langs), BUCKETS), PSEUDO / 4)
    at = {lang: i for i, lang in enumerate(langs)}
    for r in found:
        n[at[r["lang"]], r["bucket"]] += r["n"]
    return langs, np.log(n / n.sum(axis=1, keepdims=True))


EVIDENCE = "page_id long, host string, domain string, suffix string, declared string, best int, loglik array<double>"


def evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """The evidence on every page: address parts, declared language and text likelihoods."""
    def run(ids: list, hosts: list, texts: list) -> dict:
        out: dict = {c.split()[0]: [] for c in EVIDENCE.split(", ")}
        for page_id, host, page in zip(ids, hosts, texts):
            at, n = trigrams(visible_text(page))
            ll = model[:, at] @ n / (1.0 + n.sum() / SATURATION)
            ll = ll - ll.max() if len(ll) else ll
            parts = host.split(".")
            row = (page_id, host, ".".join(parts[-2:]), parts[-1], declared_language(page), int(np.argmax(ll)) if len(ll) else None, ll.tolist())
            for name, value in zip(out, row):
                out[name].append(value)
        return out

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    p = pages.select("page_id", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    return map_rows(p, run, EVIDENCE, "page_id", "host", "html")


def _tally(seen: DataFrame, n: int, *by: str) -> DataFrame:
    """How many pages of each group the text alone gives to each language, as an array."""
    each = [F.count_if(F.col("best") == k) for k in range(n)]
    return seen.groupBy(*by).agg(F.array(*each).alias(f"n_{by[0] if by else 'all'}"))


def identify(pages: DataFrame, docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: page_id, lang, probability, text_lang, declared, suffix, host."""
    langs, model = train(docs, rows)
    known, k = np.array(langs, object), len(langs)
    seen = materialize(evidence(pages, langs, model), "evidence")
    joined, total = seen, np.zeros(k)
    tables = {"declared": {}, "suffix": {}}
    if k:
        total = np.array((_tally(seen, k).first() or [[0] * k])[0], float)
        # languages x declarations of known languages: a bounded table; suffixes are joined like hosts
        declared = seen.where(F.col("declared").isin(langs))
        tables["declared"] = {r["declared"]: np.array(r["n_declared"], float) for r in _tally(declared, k, "declared").collect()}
        for by in ("suffix", "domain", "host"):
            joined = joined.join(_tally(seen, k, by), by)
    prior = (total + PSEUDO) / (total.sum() + PSEUDO * max(k, 1)) if k else total
    names = ("page_id", "lang", "probability", "text_lang", "declared", "suffix", "host")
    schema = pa.schema([(n, pa.int64() if n == "page_id" else pa.float64() if n == "probability" else pa.string()) for n in names])

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(c) for c in batch.schema.names}
            m = batch.num_rows
            lang, probability, text_lang = [None] * m, [None] * m, [None] * m
            if k and m:
                best = col["best"].to_numpy(zero_copy_only=False).astype(int)
                own = np.eye(k)[best]
                grid = lambda c: np.array(col[c].to_pylist(), float)
                domain, host = grid("n_domain") - own, grid("n_host") - own
                p = (domain + DOMAIN_WEIGHT * prior) / (domain.sum(axis=1, keepdims=True) + DOMAIN_WEIGHT)
                p = (host + HOST_WEIGHT * p) / (host.sum(axis=1, keepdims=True) + HOST_WEIGHT)
                suffix = np.maximum(grid("n_suffix") - own, 0.0)
                # P(suffix | language), smoothed by the suffix's share of all pages
                share = (suffix.sum(axis=1, keepdims=True) + PSEUDO) / (total.sum() + PSEUDO)
                s = (suffix + HOST_WEIGHT * share) / (total + HOST_WEIGHT)
                d = np.ones((m, k))
                for i, x in enumerate(col["declared"].to_pylist()):
                    if x in langs:  # P(declared | language), with a pseudo count for each language
                        d[i] = (np.maximum(tables["declared"].get(x, 0.0) - own[i], 0.0) + PSEUDO) / (total + PSEUDO * k)
                logp = grid("loglik") + np.log(p) + np.log(s) + np.log(d)
                logp -= logp.max(axis=1, keepdims=True)
                post = np.exp(logp)
                post /= post.sum(axis=1, keepdims=True)
                top = post.argmax(axis=1)
                lang, probability, text_lang = known[top].tolist(), post[np.arange(m), top].tolist(), known[best].tolist()
            row = {"page_id": col["page_id"], "lang": lang, "probability": probability, "text_lang": text_lang,
                   "declared": col["declared"], "suffix": col["suffix"], "host": col["host"]}
            yield pa.RecordBatch.from_pydict(row, schema=schema)

    ddl = ", ".join(f"{n} {'long' if n == 'page_id' else 'double' if n == 'probability' else 'string'}" for n in names)
    return joined.mapInArrow(fuse, ddl)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, over the whole ``pages``, from models of ``documents``."""
    return identify(load(spark, sf_dir, "pages"), load(spark, sf_dir, "documents"))
