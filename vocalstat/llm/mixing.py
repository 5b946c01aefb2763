"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its share, by weight, of a budget in words; no target is above ``MOST`` times
the source's size, and what is cut off is shared again by weight. A document's expected number of
copies is its source's target over its source's size, a whole part and a fraction. Fractions are
rounded by the pivotal method in words: two documents of a source are paired, and words move at
random from one to the other until one of the fractions is 0 or 1. The sum over the source stays
as it is, and so does each document's expectation.

The pairing is a reduction tree: rows are dealt by hash into leaves of about ``LEAF`` rows of one
source, a leaf leaves one unfinished row at most, and ``FAN`` leaves are combined on the next
level, until one row of a source is left. A hot source has more leaves, not larger ones. All
random numbers come from hashes of doc_id and text, so that reruns and lost tasks give the same mix.

Defined cases: null text has size 0; documents of size 0 take part with a fraction of their own
and no words; the null source is one source, last in order; equal doc_ids are told apart by text,
and rows that are equal in both are interchangeable; null ids are ids like others; empty tables
give empty results; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalstat.llm.common import TMP, load, map_rows, row_hash, whole_text
from vocalstat.operators.seq import prefix_sum
from vocalstat.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
LEAF = 1024
FAN = 64
SEED = 20


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, size): the number of words of each whole text."""
    d = docs.select("doc_id", "source", row_hash().alias("h"), whole_text().alias("text"))
    return map_rows(d, lambda i, s, h, t: {"doc_id": i, "source": s, "h": h,
                                           "size": [len(x.encode("utf-8", "surrogatepass").split()) for x in t]},
                    "doc_id long, source string, h long, size long", "doc_id", "source", "h", "text")


def source_targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, n, target. Weights repeat over the sources in code point order."""
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    s = prefix_sum(s.withColumn("nul", F.col("source").isNull()), [], ["nul", "source"], None, "place", inclusive=False)
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    s = materialize(s.select("source", "source_size", "n", w.alias("w"), (most * F.col("source_size")).alias("most")), "sources")
    budget = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    # the level at which sources below their limit share what those at it leave; rises until none is added
    full, level = -1, 0.0
    while True:
        at = F.col("w") * level >= F.col("most")
        n, used, left = s.agg(F.count_if(at), F.sum(F.when(at, F.col("most"))), F.sum(F.when(~at, F.col("w")))).first()
        if n == full or left is None:
            break
        full, level = n, (budget - (used or 0.0)) / left
    return s.select("source", "source_size", "n", F.least(F.col("most"), F.col("w") * level).alias("target"))


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    x = h.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def pivot(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Fractions after pairing in order: all 0 or 1 but for one at most; the sum of size * p stays."""
    p, held = p.copy(), -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if held < 0:
            held = j
            continue
        a, b = size[held], size[j]
        up = min(a * (1.0 - p[held]), b * p[j])  # words that can move to the held one
        down = min(a * p[held], b * (1.0 - p[j]))
        if u[j] * (up + down) < down:
            to, fro, moved = held, j, up
        else:
            to, fro, moved = j, held, down
        fills = size[to] * (1.0 - p[to]) <= moved
        empties = size[fro] * p[fro] <= moved
        p[to] = 1.0 if fills else p[to] + moved / size[to]
        p[fro] = 0.0 if empties else p[fro] - moved / size[fro]
        rest = [k for k in (held, j) if 0.0 < p[k] < 1.0]
        held = rest[0] if rest else -1
    return p


def _combine(level: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["r", "size", "h"], kind="stable")
        u = _uniform(g["r"].to_numpy(np.int64), level)
        free = (g["size"] == 0).to_numpy()
        p = g["p"].to_numpy(float)
        p = np.where(free, (u < p).astype(float), pivot(g["size"].to_numpy(float), np.where(free, 0.0, p), u))
        return g.assign(p=p)

    return run


def round_copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows with source_size, target and copies, a whole number that expects target / source_size."""
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same = rows["source"].eqNullSafe(targets["source"])
    r = rows.join(targets, same).drop(targets["source"]).withColumns({
        "whole": F.floor(per), "p": per - F.floor(per), "r": F.xxhash64(F.lit(SEED), "doc_id", "h"),
        "leaves": F.greatest(F.lit(1), F.ceil(F.col("n") / LEAF))})
    r = r.withColumn("leaf", F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id", "h"), "leaves")).drop("n")
    most = targets.agg(F.max("n")).first()[0] or 0
    level, leaves, done = 0, -(-most // LEAF), None
    schema = r.schema
    while True:
        out = materialize(r.groupBy("source", "leaf").applyInPandas(_combine(level), schema), f"level-{level}")
        whole = out.where("p = 0 OR p = 1")
        done = whole if done is None else done.unionByName(whole)
        r = out.where("p > 0 AND p < 1")
        if leaves <= 1:
            break
        r = r.withColumn("leaf", F.floor(F.col("leaf") / FAN))
        level, leaves = level + 1, -(-leaves // FAN)
    # one row of a source is left: its fraction is the chance of one more copy
    chance = F.pmod(F.xxhash64(F.lit(SEED + 2), "doc_id", "h"), F.lit(1 << 40)) / float(1 << 40)
    last = r.withColumn("p", F.when(chance < F.col("p"), 1.0).otherwise(0.0))
    return done.unionByName(last).select("doc_id", "source", "h", "size", "source_size", "target",
                                         (F.col("whole") + F.col("p")).cast("int").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, h, size, source_size, target, copies."""
    rows = materialize(sized(docs), "sizes")
    return round_copies(rows, materialize(source_targets(rows, weights, share, most), "targets"))


def take_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row as often as the mix takes it; columns as in ``docs``."""
    cols = [f"`{c}`" for c in docs.columns]
    key = [f"{TMP}id", f"{TMP}h"]
    m = materialize(mix(docs).select(F.col("doc_id").alias(key[0]), F.col("h").alias(key[1]), F.col("copies").alias(f"{TMP}copies")), "mix")
    d = docs.withColumns({f"{TMP}did": F.col("doc_id"), f"{TMP}dh": row_hash()})
    on = lambda t, a=f"{TMP}did", b=f"{TMP}dh": F.col(a).eqNullSafe(t[key[0]]) & (F.col(b) == t[key[1]])
    # rows that are repeated as a whole, mostly none, are numbered on both sides; all others meet by their key
    tied = materialize(m.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "tied")
    numbered = m.join(tied.withColumnsRenamed({key[0]: "ti", key[1]: "th"}), m[key[0]].eqNullSafe(F.col("ti")) & (m[key[1]] == F.col("th")), "left_semi")
    nth = lambda by, order: F.row_number().over(Window.partitionBy(*by).orderBy(order))
    numbered = numbered.withColumn(f"{TMP}n", nth(key, f"{TMP}copies"))
    again = d.join(tied, on(tied), "left_semi").withColumn(f"{TMP}dn", nth([f"{TMP}did", f"{TMP}dh"], F.lit(0)))
    again = again.join(numbered, on(numbered) & (F.col(f"{TMP}dn") == numbered[f"{TMP}n"]))
    single = m.groupBy(*key).agg(F.max(f"{TMP}copies").alias(f"{TMP}copies"), F.count(F.lit(1)).alias(f"{TMP}n")).where(f"{TMP}n = 1")
    once = d.join(single, on(single))
    repeat = lambda t: t.where(f"{TMP}copies > 0").withColumn(
        f"{TMP}k", F.explode(F.sequence(F.lit(1), F.col(f"{TMP}copies")))).select(*cols)
    return repeat(once).unionByName(repeat(again))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, over the whole ``documents``."""
    return mix(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
