"""Fill-in-middle against a plain version; the compressed set against a list."""

import hashlib
import random
import re

import duckdb
import pytest

from tests.llm import tables as T
from vocalstat.llm import fim as M


def plain(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, digest(text), digest(text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:i], text[i:j], text[j:]
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, i, j - i, digest(out), digest(text)


def odd_rows(n=150, seed=4):
    rng = random.Random(seed)
    few = ["<", ">", "P>", "S>", "<S", "<M", "é", "😀", "漢", "a", " ", "\n", "\\", "$1", " "]
    return [(1000 + i, "".join(rng.choice(few) for _ in range(rng.randrange(0, 12))), "en", "a", 1) for i in range(n)] + [
        (2000 + i, t, "en", "a", 1) for i, t in enumerate(["a<P>b", "<S>", "x<M>", "<p>", "< P>", "<<P", "😀" * 70_000, "ab" * 70_000, T.LONG + "é"])]


def test_op13(spark, tmp_path):
    rows = T.ROWS + odd_rows()
    sf = T.written(spark, tmp_path, rows)
    got = sorted((tuple(r) for r in M.op13_fill_in_middle(spark, sf).collect()), key=str)
    assert got == sorted((plain(r[0], r[1]) for r in rows), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet/*.parquet')")
    assert sorted(con.execute(M.OP13_SQL).fetchall(), key=str) == got


def test_op13_empty(spark, tmp_path):
    assert M.op13_fill_in_middle(spark, T.written(spark, tmp_path, [])).count() == 0


def check_select(b, expected, rng):
    assert len(b) == len(expected) and b.upto[-1] == len(expected)
    for k in {0, len(expected) - 1, *(rng.randrange(len(expected)) for _ in range(200))}:
        assert b.select(k) == expected[k]
    for k in (-1, len(expected)):
        with pytest.raises(IndexError):
            b.select(k)


@pytest.mark.parametrize("alphabet,kind", [(["x" * 2000], M.RunContainer), (["é", "a"], M.BitmapContainer), (["漢", "😀", "é"], M.BitmapContainer)])
def test_code_points_by_every_container(alphabet, kind):
    rng = random.Random(7)
    for size in (0, 1, M.SPAN - 1, M.SPAN, M.SPAN + 1, 3 * M.SPAN):
        text = ""
        while len(text.encode()) < size:
            text += rng.choice(alphabet) * rng.randrange(1, 400)
        data = text.encode()
        expected = [0]
        for c in text:
            expected.append(expected[-1] + len(c.encode()))
        b = M.boundaries(data)
        check_select(b, expected, rng)
        if size > M.SPAN:
            assert isinstance(b.containers[0], kind)


def test_words_make_arrays_and_sets_stay_small():
    rng = random.Random(8)
    text = " ".join("w" * rng.randrange(8, 40) for _ in range(20_000))
    unit = re.compile(rb"[^ ]* ?")
    b = M.boundaries(text.encode(), unit)
    expected = [0] + [m.end() for m in unit.finditer(text.encode()) if m.end() > m.start()]
    check_select(b, expected, rng)
    assert all(isinstance(c, M.ArrayContainer) for c in b.containers)
    long = M.boundaries(b"a" * 20_000_000)
    assert len(long) == 20_000_001 and long.select(12_345_678) == 12_345_678 and all(len(c.starts) == 1 for c in long.containers)


def test_units_other_than_code_points(spark):
    d = T.docs(spark, T.ROWS)
    rows = M.fill_in_middle(d, unit=r"[^\n]*\n?", cut=100)
    back = rows.select("doc_id", "n", "form", "prefix_units", "output", M.restore(rows["output"], rows["form"]).alias("text")).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in back) == sorted(str((x[0], x[1] or "")) for x in T.ROWS)
    for r in back:
        lines = re.findall(r"[^\n]*\n|[^\n]+", r["text"])
        assert r["n"] == len(lines)
        if r["form"] == "psm":
            assert r["output"].startswith("<P>" + "".join(lines[:r["prefix_units"]]) + "<S>")
