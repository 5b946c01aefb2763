"""Fingerprints, SimHash near-dedup and exact dedup against plain versions."""

import base64
import hashlib
import random
import tracemalloc

import pytest

from tests.llm import tables as T
from vocalstat.llm import exact_dedup as X
from vocalstat.llm import fingerprint as P
from vocalstat.llm import simhash as S
from vocalstat.llm.components import connected_components


def test_fingerprint_is_a_multiset_hash():
    a, b = "one line\nand two\nand two\nthree", "three\nand two\none line\nand two"
    assert P.fingerprint(a) == P.fingerprint(b) != P.fingerprint("one line\nand two\nthree")
    fp = P.fingerprint(a)
    assert P.changed(fp, deleted="and two") == P.fingerprint("one line\nand two\nthree")
    assert P.changed(fp, inserted="more\nlines") == P.fingerprint(a + "\nmore\nlines")
    assert P.changed(P.changed(fp, inserted="x y z"), deleted="x y z") == fp
    assert P.likeness(fp, fp) == 1.0 and P.likeness(P.fingerprint(""), fp) == 0.0 and P.likeness(P.fingerprint(""), P.fingerprint("\n")) == 1.0


def test_fingerprint_blocks_and_likeness(monkeypatch):
    rng = random.Random(5)
    text = "\n".join(" ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(1, 40))) for _ in range(300))
    whole = P.fingerprint(text)
    monkeypatch.setattr(P, "BLOCK", 100)
    assert P.fingerprint(text) == whole
    other = " ".join(f"v{rng.randrange(999)}" for _ in range(6000))
    edited, fp = P.replace_end(text, whole, other)
    assert fp == P.fingerprint(edited) and 0.5 < P.likeness(whole, fp) < 0.95 and P.likeness(whole, P.fingerprint(other)) < 0.35


def plain_lanes(text):
    """Soft lanes by loops: pieces of words, hashed and paired with the piece before in the line."""
    m = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & m
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & m
        return x ^ (x >> 31)

    lanes, base = [0] * P.SOFT, 0x9E3779B97F4A7C15
    for line in text.encode().split(b"\n"):
        before = 0
        for word in line.split():
            for i in range(0, len(word), P.PIECE):
                h = mix(sum((b + 1) * pow(base, k, 1 << 64) for k, b in enumerate(word[i:i + P.PIECE])) & m)
                pair = mix((h + base * before) & m)
                lanes[pair % P.SOFT] += -1 if pair >> 63 else 1
                before = h
    return lanes


@pytest.mark.parametrize("block", [1 << 20, 300, 64, 17])
def test_lanes_equal_plain_ones_however_lines_are_cut(monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr(P, "BLOCK", block)
    word = lambda: "".join(rng.choices("abcé😀", k=rng.choice([1, 3, 9, 15, 16, 17, 33, 200])))
    for _ in range(25):
        text = "".join(rng.choice([" ", "  ", "\t", "\n", "\x0b", " \r\n"]) + word() for _ in range(rng.randrange(0, 60)))
        wide, soft = P.vector(text)
        assert soft.tolist() == plain_lanes(text)
        lines = [x for x in text.encode().split(b"\n") if x]
        digests = [hashlib.blake2b(x, digest_size=64).digest() for x in lines]
        assert wide.tolist() == [sum(int.from_bytes(d[8 * i:8 * i + 8], "little") for d in digests) % 2**64 for i in range(8)]


def test_one_line_of_64_megabytes_in_bounded_memory():
    for text in ("some words of one long line " * 2_400_000, "x" * 64_000_000):
        tracemalloc.start()
        P.fingerprint(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 500_000_000


def test_soft_lanes_of_long_texts_do_not_wrap():
    text = "the same phrase again\n" * 40_000
    fp = P.fingerprint(text)
    edited, efp = P.replace_end(text, fp, "other words that were not there before " * 100)
    assert efp == P.fingerprint(edited) and P.likeness(fp, efp) > 0.95
    assert abs(P.unpack(fp)[1]).max() >= 40_000
    ends = P.np.array([2**30, -2**30, -1, 0] * (P.SOFT // 4))
    assert (P.unpack(P.pack(P.np.zeros(P.WIDE, P.np.uint64), ends))[1] == ends).all()


def test_op1(spark, tmp_path):
    sf = T.written(spark, tmp_path)
    got = P.op1_fingerprints(spark, sf).collect()
    order = sorted(((-1 if r[0] is None else r[0]), r[1] or "") for r in T.ROWS)
    expected = []
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        k = len(a) // 4
        edited = a[:len(a) - k] + b[:k]
        f, e, n = P.fingerprint(a), P.fingerprint(edited), P.fingerprint(b)
        expected.append((i, len(a), hashlib.sha256(edited.encode()).hexdigest(), base64.b64encode(f).decode(),
                         base64.b64encode(e).decode(), P.likeness(f, e), P.likeness(f, n)))
    names = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *(r[n] for n in names)) for r in got) == sorted(expected)


def test_op1_empty(spark, tmp_path):
    assert P.op1_fingerprints(spark, T.written(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c d a b c d", "ÄÖ ÄÖ\tx\x0by", T.LONG[:3000], "K k\x85z"])
def test_simhash_by_bits(text):
    assert S.fingerprint(text) == T.simhash(text)


def near_fps(n=400, seed=3):
    """Fingerprints in chains and in a crowd around one, and scattered ones."""
    rng = random.Random(seed)
    out, crowd = [rng.getrandbits(64) for _ in range(n)], rng.getrandbits(64)
    for f in out[:60]:
        for _ in range(4):
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            out.append(f)
    out += [crowd ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(1, 24, 3)]
    return out


@pytest.mark.parametrize("cell", [64, 2])
def test_links_give_the_classes_of_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(S, "CELL", cell)
    fps = near_fps()
    of = T.classes(fps)
    rows = spark.createDataFrame([(S.signed(f),) for f in sorted(set(fps))], "fp long")
    roots = {r["node"] % 2**64: r["root"] % 2**64 for r in connected_components(S.links(rows)).collect()}
    got, expected = {}, {}
    for f in set(fps):
        got.setdefault(roots.get(f, f), set()).add(f)
        expected.setdefault(of[f], set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    links += [(7, 7), (1, 0), (0, 1)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = {x: x for link in links for x in link}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in link and link[0] != link[1] for link in links)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def expected_near(rows):
    fps = [T.simhash(r[1]) for r in rows]
    of, low = T.classes(fps), {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            low[of[f]] = min(low.get(of[f], r[0]), r[0])
    return sorted((str(r[0]), f"{f:016x}", low.get(of[f])) for r, f in zip(rows, fps))


def test_op2(spark, tmp_path):
    got = S.op2_simhash_pivots(spark, T.written(spark, tmp_path)).collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == expected_near(T.ROWS)


def test_op2_empty(spark, tmp_path):
    assert S.op2_simhash_pivots(spark, T.written(spark, tmp_path, [])).count() == 0


def test_near_stage_keeps_one_of_each(spark, tmp_path):
    d = T.docs(spark)
    out = S.drop_near_copies(spark, d, "")
    assert out.columns == d.columns
    fps, of = [T.simhash(r[1]) for r in T.ROWS], T.classes([T.simhash(r[1]) for r in T.ROWS])
    kept = [T.simhash(r["text"]) for r in out.collect()]
    assert sorted(of[f] for f in kept) == sorted({of[f] for f in fps})
    smallest = {}
    for r, f in zip(T.ROWS, fps):
        if r[0] is not None:
            smallest[of[f]] = min(smallest.get(of[f], 99), r[0])
    assert all(r["doc_id"] == smallest[of[T.simhash(r["text"])]] for r in out.collect() if of[T.simhash(r["text"])] in smallest)
    assert S.drop_near_copies(spark, d.limit(0), "").count() == 0


def test_op10(spark, tmp_path):
    got = X.op10_exact_dedup(spark, T.written(spark, tmp_path)).collect()
    groups = {}
    for r in T.ROWS:
        groups.setdefault(r[1] or "", []).append(r[0])
    key = lambda t: (t[4], str(t[0]), t[3])
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            won = i == keep and first
            first = first and not won
            expected.append((i, keep, len(ids), won, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def largest(rows):
    out = {}
    for i, text in ((r[0], r[1] or "") for r in rows):
        out[text] = max((x for x in (i, out.get(text)) if x is not None), default=None)
    return {hashlib.sha256(t.encode()).digest(): i for t, i in out.items()}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_index_takes_batches_in_any_order_and_outlives_its_table(spark, tmp_path, order):
    d = X.text_digests(T.docs(spark))
    cuts = ["doc_id <= 3", "doc_id > 3 AND doc_id <= 8", "doc_id > 8 OR doc_id IS NULL"]
    path = f"file://{tmp_path}/index"
    for k in order:
        index = X.DigestIndex(spark, path, 4)
        for _ in range(2):  # a batch that is repeated adds nothing
            index.append(d.where(cuts[k]))
        got = [(bytes(r["digest"]), r["keep_id"]) for r in index.rows().collect()]
        versions = spark.table(index.table).count()
        index.append(d.where(cuts[k]))
        assert spark.table(index.table).count() == versions
        index.close()
        assert not spark.catalog.tableExists(index.table)
    assert len(got) == len(dict(got)) and dict(got) == largest(T.ROWS)


def test_queries_leave_no_table(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    X.op10_exact_dedup(spark, T.written(spark, tmp_path)).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_many_equal_rows(spark):
    d = spark.range(100_000).selectExpr("cast(if(id < 99990, 7, id) as bigint) as doc_id", "'the same text' as text")
    got = X.exact_groups(d).groupBy("keep_id", "group_size", "kept").count().collect()
    assert sorted(map(tuple, got)) == [(99999, 100_000, False, 99_999), (99999, 100_000, True, 1)]


def test_exact_stage(spark):
    d = T.docs(spark)
    out = X.drop_exact_copies(spark, d, "")
    assert out.columns == d.columns
    kept = [(r["doc_id"], r["text"] or "") for r in out.collect()]
    assert sorted(t for _, t in kept) == sorted({r[1] or "" for r in T.ROWS})
    assert all(i == max((r[0] for r in T.ROWS if (r[1] or "") == t and r[0] is not None), default=None) for i, t in kept)
    assert X.drop_exact_copies(spark, d.limit(0), "").count() == 0
