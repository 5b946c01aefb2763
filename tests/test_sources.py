"""S2/S3 repair contract (FIXTURES 2.7 + property test), TSV round trip, path keys, result read-back."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from vocalstat.sources import repair, sinks, tsv

ID = "a" * 64
HEADER = "\t".join(repair.SENTENCE_COLUMNS)


def write(path, lines):
    with open(path, "w", encoding="utf8") as f:
        f.write("\n".join(lines) + "\n")


def test_fixture_cases(spark):
    d = tempfile.mkdtemp()
    i1, i2, i3, i4, i5 = (c * 64 for c in "12345")
    lines = [HEADER,
             f"{i1}\tok\td\ts\t1\t2",
             f"{i2}\tone\ttwo\td\ts\t1\t3",
             f"{i3}\tbro", "ken\td\ts\t1\t4",
             "junk",
             f"{i4}\tx",
             f"{i5}\tfin\td\ts\t0\t5"]
    p = os.path.join(d, "validated_sentences.tsv")
    write(p, lines)
    rows, problems = repair.read_sentences(spark, p)
    got = {r.sentence_id: r.sentence for r in rows.collect()}
    assert got == {i1: "ok", i2: "one two", i3: "bro ken", i5: "fin"}
    assert sorted(r.line for r in problems.collect()) == [f"{i4}\tx", "junk"]


def test_property_every_line_accounted(spark):
    rnd = random.Random(11)
    d = tempfile.mkdtemp()
    lines, expect, junk = [HEADER], {}, 0
    for i in range(800):
        sid = f"{i:064x}"
        words = [rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rnd.randint(1, 6))]
        text = " ".join(words)
        cut = rnd.random()
        if cut < 0.15 and len(words) > 1:      # newline inside the sentence
            k = rnd.randint(1, len(words) - 1)
            lines.append(f"{sid}\t{' '.join(words[:k])}")
            lines.append(f"{' '.join(words[k:])}\tdom\tsrc\t1\t{i}")
        elif cut < 0.25 and len(words) > 1:    # TAB inside the sentence
            k = rnd.randint(1, len(words) - 1)
            lines.append(f"{sid}\t{' '.join(words[:k])}\t{' '.join(words[k:])}\tdom\tsrc\t1\t{i}")
        else:
            lines.append(f"{sid}\t{text}\tdom\tsrc\t1\t{i}")
        expect[sid] = text
        if rnd.random() < 0.03:
            lines.append(f"junk line {i}")
            junk += 1
    p = os.path.join(d, "validated_sentences.tsv")
    write(p, lines)
    # several blocks: small split size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows, problems = repair.read_sentences(spark, p)
        got = {r.sentence_id: r.sentence for r in rows.collect()}
        bad = problems.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expect
    assert bad == junk


def test_reported_old_and_new_layout(spark):
    d = tempfile.mkdtemp()
    new = os.path.join(d, "new")
    old = os.path.join(d, "old")
    os.makedirs(new)
    os.makedirs(old)
    write(os.path.join(new, "reported.tsv"), ["sentence_id\tsentence\tlocale\treason",
                                              f"{ID}\thello\ttr\trude", f"{'b' * 64}\tbro", "ken\ttr\tother"])
    write(os.path.join(old, "reported.tsv"), ["sentence\tsentence_id\tlocale\treason",
                                              f"hi\t{'c' * 64}\ttr\trude", "split", f"line\t{'d' * 64}\ttr\tx"])
    rows, problems = repair.read_reported(spark, [new, old])
    got = {r.sentence_id: (r.sentence, r.reason) for r in rows.collect()}
    # a fragment before a line whose id comes last is the start of its text
    assert got == {ID: ("hello", "rude"), "b" * 64: ("bro ken", "other"), "c" * 64: ("hi", "rude"),
                   "d" * 64: ("split line", "x")}
    assert problems.count() == 0


def test_tsv_round_trip_and_keys(spark):
    d = tempfile.mkdtemp()
    base = os.path.join(d, "cv-corpus-16.1-2023-12-06", "tr")
    os.makedirs(os.path.join(base, "s1"))
    header = "client_id\tpath\tsentence\tup_votes\tdown_votes\tage\tgender\taccent"
    write(os.path.join(base, "validated.tsv"), [header, "c1\tp1\tNA\t2\t0\tteens\tmale\t", "c2\tp2\t  x \t1\t1\t\t\tus"])
    write(os.path.join(base, "s1", "train.tsv"), [header, "c1\tp1\tNA\t2\t0\tteens\tmale\t"])
    df = tsv.read_clips(spark, [os.path.join(base, "validated.tsv"), os.path.join(base, "s1", "train.tsv")])
    got = sorted((r.ver, r.lc, r.alg, r.sp, r.sentence) for r in df.collect())
    assert got == [("16.1", "tr", "", "validated", "  x "), ("16.1", "tr", "", "validated", "NA"),
                   ("16.1", "tr", "s1", "train", "NA")]
    out = os.path.join(d, "out")
    sinks.write_tsv(df.select("client_id", "sentence", F.array(F.lit(1), F.lit(2)).alias("arr")), out)
    back = tsv.read_tsv(spark, out)
    assert sorted((r.client_id, r.sentence, r.arr) for r in back.collect()) == [
        ("c1", "NA", "1#2"), ("c1", "NA", "1#2"), ("c2", "  x ", "1#2")]


def test_results_keep_version_text(spark):
    d = tempfile.mkdtemp()
    df = spark.createDataFrame([("1", "tr", 1), ("16.1", "tr", 2), ("10.0", "de", 3)], "ver string, lc string, n int")
    sinks.write_table(df, d)
    back = tsv.read_results(spark, d)
    assert sorted(r.ver for r in back.collect()) == ["1", "10.0", "16.1"]


def _plain_repair(lines, ncols, digit_tail, id_len, idc, txc):
    """Spec: one pass over a file's lines, the open record joined, collapsed and split anew after every line."""
    import re
    id_re, spaces = re.compile("^[0-9a-fA-F]{%d}$" % id_len), re.compile(" {2,}")

    def fold(fields):
        extra = len(fields) - ncols
        return fields if extra <= 0 else fields[:txc] + [" ".join(fields[txc:txc + extra + 1])] + fields[txc + extra + 1:]

    has_id = lambda f: len(f) > idc and id_re.match(f[idc]) is not None
    valid = lambda f: (len(f) == ncols and has_id(f)
                       and all(f[-k].isdigit() and f[-k].isascii() for k in range(1, digit_tail + 1)))
    joined = lambda part: fold(spaces.sub(" ", " ".join(v for _, v in part)).split("\t"))
    rows, bad, part = [], [], []
    for ln, value in enumerate(lines):
        fields = fold(value.split("\t"))
        if txc < idc:  # the id line ends the record
            part.append((ln, value))
            if valid(fields) and len(part) == 1:
                rows.append((ln, fields))
            elif valid(joined(part)):
                rows.append((part[0][0], joined(part)))
            elif has_id(fields):
                bad += part
            else:
                continue
            part = []
        else:
            if valid(fields) or has_id(fields):
                bad += part
                part = []
            if valid(fields):
                rows.append((ln, fields))
            elif has_id(fields):
                part = [(ln, value)]
            elif not part:
                bad.append((ln, value))
            else:
                part.append((ln, value))
                if valid(joined(part)):
                    rows.append((part[0][0], joined(part)))
                    part = []
    return sorted(rows), sorted(bad + part)


def _line_frame(spark, lines, parts=5):
    return spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "file string, ln long, value string").repartition(parts)


def _repaired(spark, lines, *args):
    rows, problems = repair.repair_lines(_line_frame(spark, lines), args[0], None, args[3], args[4], args[1], args[2], header=False, dedup=False)
    got = sorted((r.ln, [r[f"c{i}"] for i in range(args[0])]) for r in rows.collect())
    return got, sorted((r.ln, r.line) for r in problems.collect())


def test_repair_matches_plain_version(spark):
    rnd = random.Random(5)
    pieces = ["a", "b c", "  ", " x  y ", "\t", "7", "12", "\t3\t4", "\t5\t", "", "ab" * 4, "f" * 8]
    for idc, txc, ncols, tail in ((0, 1, 5, 2), (0, 1, 4, 0), (1, 0, 4, 0), (1, 2, 5, 1)):
        lines = []
        for _ in range(2500):
            if rnd.random() < 0.4:
                n = rnd.choice([ncols, ncols, ncols, rnd.randint(1, ncols + 2)])
                row = ["f" * 8 if i == idc + max(0, n - ncols) * (txc < idc) else rnd.choice(["a", "b  c", "", "7"]) for i in range(n)]
                if tail and rnd.random() < 0.7:
                    row[-2:] = ["1", "2"]
                lines.append("\t".join(row))
            else:
                lines.append("".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 4))))
        want = _plain_repair(lines, ncols, tail, 8, idc, txc)
        assert _repaired(spark, lines, ncols, tail, 8, idc, txc) == want
        assert len(want[0]) > 100 and len(want[1]) > 100


def test_older_layout_rebuilds_what_stands_before(spark):
    lines = ["first half", f"second half\t{ID}\txx\tuser", "", "three", "", f"pieces\t{'b' * 64}\txx\tuser", f"broken\t{'c' * 64}\txx", "after it",
             f"the text\t{'d' * 64}\txx\tuser", "left over"]
    rows, bad = _repaired(spark, lines, 4, 0, 64, 1, 0)
    assert [(r[0], r[1][0]) for r in rows] == [(0, "first half second half"), (2, " three pieces"), (7, "after it the text")]
    assert [b[1] for b in bad] == [f"broken\t{'c' * 64}\txx", "left over"]


def test_open_record_of_millions_of_lines(spark):
    """Decided without gathering it: every line of it is quarantined, the rows around it are untouched."""
    n = 2_000_000
    line = (F.when(F.col("id") == 0, F.lit(f"{ID}\tok\td\ts\t1\t2")).when(F.col("id") == 1, F.lit(f"{'b' * 64}\topen"))
            .when(F.col("id") == n + 1, F.lit(f"{'c' * 64}\tlast\td\ts\t0\t3")).otherwise(F.concat(F.lit("piece "), F.col("id").cast("string"))))
    lines = spark.range(n + 2).select(F.lit("f").alias("file"), F.col("id").alias("ln"), line.alias("value"))
    rows, problems = repair.repair_lines(lines, 6, repair.SENTENCE_COLUMNS, header=False)
    assert sorted((r.ln, r.sentence) for r in rows.collect()) == [(0, "ok"), (n + 1, "last")]
    got = problems.agg(F.count(F.lit(1)), F.min("ln"), F.max("ln"), F.count_distinct("ln")).first()
    assert tuple(got) == (n, 1, n, n)
    assert not any("Python" in str(d._jdf.queryExecution().executedPlan()) for d in (rows, problems))
