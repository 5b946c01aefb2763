"""Mixing and packing: sums, bounds and round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import tables as T
from vocalstat.llm import mixing as M
from vocalstat.llm import packing as K


def test_pivot_keeps_the_sum_and_leaves_one():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 500):
        size, p = rng.integers(1, 900, n).astype(float), rng.random(n)
        out = M.pivot(size, p, rng.random(n))
        assert ((out == 0) | (out == 1)).sum() >= n - 1 and abs((size * out).sum() - (size * p).sum()) < 1e-6 * (1 + size.sum())


def test_pivot_keeps_the_expectation():
    rng = np.random.default_rng(3)
    size, p = np.array([3.0, 10.0, 5.0, 8.0]), np.array([0.2, 0.7, 0.5, 0.4])
    mean = np.mean([M.pivot(size, p, rng.random(4)) for _ in range(20_000)], axis=0)
    assert np.abs(mean - p).max() < 0.02


def plain_targets(sizes):
    """Resharing as stated: cut at twice the size, share the excess again by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    target = {s: total * w[s] / sum(w.values()) for s in names}
    while True:
        over = {s for s in names if target[s] >= 2 * sizes[s]}
        excess = sum(target[s] - 2 * sizes[s] for s in over)
        for s in over:
            target[s] = 2.0 * sizes[s]
        rest = [s for s in names if s not in over]
        if excess < 1e-9 * (1 + total) or not rest:
            return target
        for s in rest:
            target[s] += excess * w[s] / sum(w[r] for r in rest)


def check_mix(rows, out):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(T.words(r[1]))
    target = plain_targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(r[0]), len(T.words(r[1]))) for r in rows)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s]) for r in own)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own) + 1e-6
        assert all(r["taken"] <= 2 * r["size"] and r["taken"] in (r["copies"] * r["size"],) for r in own)


def test_op5(spark, tmp_path):
    sf = T.written(spark, tmp_path)
    out = M.op5_mixing(spark, sf).collect()
    check_mix(T.ROWS, out)
    assert sorted(map(str, out)) == sorted(map(str, M.op5_mixing(spark, sf).collect()))


def test_op5_deep_tree(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "LEAF", 8)
    monkeypatch.setattr(M, "FAN", 4)
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(1, 60), "en", "hot" if i % 3 else f"s{i % 7}", 0) for i in range(900)]
    check_mix(rows, M.op5_mixing(spark, T.written(spark, tmp_path, rows)).collect())


def test_op5_empty_and_wordless(spark, tmp_path):
    assert M.op5_mixing(spark, T.written(spark, tmp_path / "a", [])).count() == 0
    rows = [(1, "", "en", "a", 0), (2, None, "en", None, 0)]
    assert [r["taken"] for r in M.op5_mixing(spark, T.written(spark, tmp_path / "b", rows)).collect()] == [0, 0]


def test_mix_stage_repeats_rows(spark):
    d = T.docs(spark)
    out = M.take_mix(spark, d, "")
    assert out.columns == d.columns
    taken = sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect())
    texts, copies = {}, {}
    for r in d.select("doc_id", M.row_hash().alias("h"), "text").collect():
        texts[(r["doc_id"], r["h"])] = r["text"] or ""
    for r in M.mix(d).collect():
        copies[(r["doc_id"], r["h"])] = copies.get((r["doc_id"], r["h"]), 0) + r["copies"]
    assert taken == sorted((str(k[0]), texts[k]) for k, n in copies.items() for _ in range(n))
    assert M.take_mix(spark, d.limit(0), "").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t's<|endoftext|>12")), max_size=80))
def test_ids_are_the_tokenizers(text):
    assert K.token_ids(text) == K._tokenizer(K.VOCABULARY).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 300_000, "<|endoftext|> and <|endoftext|>", "a" * 100_000, "\n" * 50_000 + "x"])
def test_ids_of_odd_texts(text):
    assert K.token_ids(text) == K._tokenizer(K.VOCABULARY).encode(text, add_special_tokens=False).ids


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 30)), rng.normal(size=12)
    x = K.nnls(a, b)
    w = a.T @ (b - a @ x)
    assert (x >= 0).all() and (w <= 1e-6).all() and np.abs(w[x > 0]).max(initial=0) < 1e-6


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=30))
def test_packs_hold_every_piece_once(counts):
    packs = K.fit_packs(counts, 64, 16)
    held = {}
    for lengths, n in packs:
        assert sum(lengths) <= 64
        for length in lengths:
            held[length] = held.get(length, 0) + n
    assert held == counts
    best = sum(n for _, n in K._best_fit([], dict(counts), 64))
    assert sum(n for _, n in packs) <= best + max(2, 0.05 * best)


def check_packed(rows, out):
    ids = [[*K._tokenizer(K.VOCABULARY).encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows]
    expected = []
    for r, x in zip(rows, ids):
        cuts = [0, *range(len(x) - (len(x) - 1) // 2048 * 2048, len(x) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((str(r[0]), k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), *(r[c] for c in ("piece", "start", "length", "ids_crc32"))) for r in out) == sorted(expected)
    at = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 2048 for n in at.values())
    return len(at), sum(map(len, ids))


def test_op3(spark, tmp_path):
    check_packed(T.ROWS, K.op3_packing(spark, T.written(spark, tmp_path)).collect())
    assert K.op3_packing(spark, T.written(spark, tmp_path / "empty", [])).count() == 0


def test_op3_is_tight(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, tokens = check_packed(rows, K.op3_packing(spark, sf).collect())
    assert n <= 1.01 * tokens / 2048 + 1


def test_sequences_hold_the_ids(spark):
    d = T.docs(spark)
    packed = K.pack(d, keep_ids=True)
    rows = {r["sequence_id"]: r["ids"] for r in K.sequences(packed).collect()}
    for r in packed.collect():
        assert rows[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    assert K.pack_stage(spark, d, "").count() == packed.count()
