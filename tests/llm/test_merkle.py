"""The Merkle manifest against a plain one; descent of some requests; tampering."""

import random
import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm import tables as T
from vocalstat.llm import merkle as K


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(level):
    """Root over the digests, and for each the (place, others) of its runs, from the leaf up."""
    paths, under = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        nodes, owners = [], []
        for i in range(0, len(level), 3):
            run = level[i:i + 3]
            for k in range(len(run)):
                for o in under[i + k]:
                    paths[o].append((k, run[:k] + run[k + 1:]))
            nodes.append(H(run))
            owners.append(sum(under[i:i + 3], []))
        level, under = nodes, owners
    return level[0], paths


def fold(digest, path):
    for k, others in path:
        digest = H(others[:k] + [digest] + others[k:])
    return digest


def plain(rows):
    """The rows of op12 for (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    trees = {}
    for s in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        ordered = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (ordered, *tree([leaf(r) for r in ordered]))
    root, tops = tree([t[1] for t in trees.values()]) if trees else (None, [])
    out = []
    for (ordered, sub, paths), top in zip(trees.values(), tops):
        for r, path in zip(ordered, paths):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            again = fold(leaf((*r[:4], r[4].replace("\n", ""))) if bad else leaf(r), path + top)
            out.append((r[0], leaf(r), sub, root, H("".join(o) for _, o in path + top), again, again == root))
    return out


def in_order(rows):
    """(doc_id, source, lang, n_chars, text) of rows as the test tables have them."""
    return [(r[0], r[3], r[2], r[4], r[1]) for r in rows]


def many_rows(n=900, seed=6):
    """A hot source, hot rows that are equal throughout, sources of one row, ids that repeat."""
    rng = random.Random(seed)
    rows = [(i, f"line {i}\nmore", "en", "hot" if i % 3 else f"s{rng.randrange(40)}", i) for i in range(n)]
    rows += [(5, "the same row", "en", "hot", 1)] * 300 + [(None, None, None, None, None)] * 50
    rows += [(rng.randrange(60), f"x{i}", "de", None, 2) for i in range(60)]
    return rows + [(7, "", "en", f"lone {i}", 0) for i in range(30)]


@pytest.mark.parametrize("wide", [6, 1, 2])
def test_op12(spark, tmp_path, monkeypatch, wide):
    monkeypatch.setattr(K, "LEVELS", wide)
    monkeypatch.setattr(K, "WIDE", K.FAN ** wide)
    rows = T.ROWS if wide == 1 else T.ROWS + many_rows()
    sf = T.written(spark, tmp_path, rows)
    # _answer is imported anew by the tasks, unlike what _packs and _expand return
    answer = K._answer
    monkeypatch.setattr(K, "_answer", lambda asked, pack: with_levels(answer, wide, asked, pack))
    got = sorted((tuple(r) for r in K.op12_merkle_manifest(spark, sf).collect()), key=str)
    assert got == sorted(plain(in_order(rows)), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet/*.parquet')")
    assert sorted(con.execute(K.OP12_SQL).fetchall(), key=str) == got


def with_levels(answer, wide, asked, pack):
    from vocalstat.llm import merkle
    merkle.LEVELS, merkle.WIDE = wide, merkle.FAN ** wide
    try:
        return answer(asked, pack)
    finally:
        merkle.LEVELS, merkle.WIDE = 6, merkle.FAN ** 6


def test_op12_odd_tables(spark, tmp_path):
    assert K.op12_merkle_manifest(spark, T.written(spark, tmp_path / "none", [])).count() == 0
    one = [(3, "a\nb", "en", "only", 3)]
    got = K.op12_merkle_manifest(spark, T.written(spark, tmp_path / "one", one)).collect()
    assert [tuple(r) for r in got] == plain(in_order(one))
    assert got[0]["leaf"] == got[0]["root"] and got[0]["proof_sha256"] == sha256(b"").hexdigest()


def test_some_requests_and_ranks_that_no_tree_has(spark):
    rows = many_rows(400)
    d = T.docs(spark, rows)
    m = K.manifest(d.select(K.tree_key(F.col("source")).alias("tree"), "doc_id", K.leaf_digest(*map(F.col, K.COLUMNS)).alias("digest")), "doc_id", "digest")
    asked = spark.createDataFrame([("1hot", 0), ("1hot", 250), ("0", 3), ("1lone 4", 0), ("1hot", 10**6), ("1lone 4", 1), ("1nowhere", 0)], "tree string, rank long")
    found = K.proofs(m, asked)
    got = {(r["tree"], r["rank"]): r for r in found.withColumn("again", K.folded(F.col("leaf"), F.col("turns"), F.col("others"))).collect()}
    assert set(got) == {("1hot", 0), ("1hot", 250), ("0", 3), ("1lone 4", 0)}
    leaves = {(r["tree"], r["rank"]): r["digest"] for r in m.leaves.collect()}
    assert all(r["leaf"] == leaves[k] and r["again"] == r["root"] == m.root for k, r in got.items())
    store = {r["digest"]: r["records"] for r in m.trees.packs.collect()}
    assert all(rec["digest"] == K.node(rec["children"]) for records in store.values() for rec in records)
    assert len(store) == m.trees.packs.count()


def test_descent_follows_rank_digits():
    digests = [H([str(i)]) for i in range(23)]
    top, records = K.build_pack(digests, 3)
    root, paths = tree(digests)
    assert top == root
    found = K.descend_pack(top, records, 3, list(range(40)))
    assert sorted(found) == list(range(23))
    for k, (digest, turns, others) in found.items():
        assert digest == digests[k] and others == "".join("".join(o) for _, o in paths[k])
        assert turns == "".join(f"{place}{len(o) + 1}" for place, o in paths[k])
