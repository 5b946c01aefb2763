"""The rule cascade against a plain version; its order against all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from tests.llm import tables as T
from vocalstat.llm import cascade as C

REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    """Base statistics and verdict, from the rules' wording."""
    text = text or ""
    w = T.words(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if T.words(line)]
    n, chars, symbols, dup, rep = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    failed = n < 20 or 100 * rep > 30 * n
    letters = sum(any(c.isalpha() for c in x) for x in w)
    listed = sum(T.words(line)[0][0] in "-*•‣·" for line in lines)
    dotted = sum(T.words(line)[-1].endswith(("...", "…")) for line in lines)
    kept = not (failed or symbols * 10 > n or not 3 * n <= chars <= 10 * n or letters * 10 < 7 * n or 2 * dup > len(lines)
                or 10 * listed > 9 * len(lines) or 10 * dotted > 3 * len(lines))
    return n, chars, symbols, dup, rep, failed, kept


def odd_texts(n=400, seed=1):
    rng = random.Random(seed)
    few = ["a", "bé", "😀", "#", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "- ", "...\n", "…\n", "word "]
    return ["".join(rng.choice(few) if rng.random() < 0.4 else f"w{rng.randrange(rng.choice([2, 3, 50]))} " for _ in range(rng.randrange(0, 90)))
            for _ in range(n)] + ["", " \n", "one", "x " * 8, "x " * 9, "a b c d e f g h " * 2, "a b c d e f g h i " + "a b c d e f g h"]


def test_statistics_equal_plain_ones(monkeypatch):
    for block in (1 << 20, 16):
        monkeypatch.setattr(C, "BLOCK", block)
        for text in odd_texts():
            t = C.Text(text)
            assert (*(t[s] for s in REPORT), any(C.fails(r, t) for r in C.BASE), not any(C.fails(r, t) for r in C.RULES)) == plain(text), text


def test_long_texts():
    for text in (T.LONG * 50, "\n" * 3_000_000, "a" * 5_000_000, "- x...\n" * 200_000):
        t = C.Text(text)
        assert t["n_words"] == len(text.split()) and t["n_repeat_words"] in (0, t["n_words"])


def test_op11(spark, tmp_path):
    rows = T.ROWS + [(100 + i, t, "en", "a", 1) for i, t in enumerate(odd_texts(60, 2))]
    sf = T.written(spark, tmp_path, rows)
    got = [tuple(r) for r in C.op11_rule_cascade(spark, sf).collect()]
    assert sorted(got, key=str) == sorted(((r[0], *plain(r[1])) for r in rows), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet/*.parquet')")
    assert sorted(con.execute(C.OP11_SQL).fetchall(), key=str) == sorted(got, key=str)


def test_op11_empty(spark, tmp_path):
    assert C.op11_rule_cascade(spark, T.written(spark, tmp_path, [])).count() == 0
    assert C.plan(T.docs(spark, [])) == list(C.RULES)


def work(order, trials, rules, known=()):
    """Seconds that an order takes on the sampled rows, statistics computed once a row."""
    total = 0.0
    for t in trials:
        have = C._asked(known, set())
        for r in order:
            new = C._asked(r.needs, have)
            total += t.seconds.get(r.name, 0.0) + sum(t.seconds.get(s, 0.0) for s in new)
            have |= new
            if t.mask >> rules.index(r) & 1:
                break
    return total


def made(seed, rules):
    rng = random.Random(seed)
    seconds = {s: rng.choice([1e-3, 1e-2, 1e-1]) for s in (*C.STATISTICS, *(r.name for r in rules))}
    out = []
    for mask in rng.sample(range(1 << len(rules)), 6):
        n = rng.randrange(1, 50)
        out.append(C.Trial(mask, n, {k: n * v for k, v in seconds.items()}))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_order_is_within_four_times_the_best(seed):
    rules = list(C.RULES[:3] + C.RULES[4:6])
    trials = made(seed, rules)
    best = min(work(p, trials, rules) for p in permutations(rules))
    mine = C.order_rules(rules, trials)
    assert sorted(r.name for r in mine) == sorted(r.name for r in rules)
    assert best <= work(mine, trials, rules) <= 4 * best + 1e-9


def test_dear_rules_that_add_nothing_come_late():
    cheap, dear, other = C.RULES[2], C.RULES[1], C.RULES[5]
    names = [cheap, dear, other]
    cost = {"word_ids": 0.1, "n_words": 0.0, "n_symbols": 0.1, "n_repeat_words": 9.0, "line_counts": 1.0, "n_lines": 0.0, "n_dup_lines": 0.0}
    seen = [C.Trial(0b011, 50, {k: 50 * v for k, v in cost.items()}), C.Trial(0b100, 5, {k: 5 * v for k, v in cost.items()}),
            C.Trial(0, 45, {k: 45 * v for k, v in cost.items()})]
    assert C.order_rules(names, seen) == [cheap, other, dear]
    assert C.order_rules(names, seen, first=("n_repeat_words",))[0] == dear  # computed anyhow


def test_cascade_stops_at_the_first_rejection(spark):
    d = T.docs(spark)
    a, b = C.judge(d, C.RULES), C.judge(d, C.RULES[::-1])
    assert sorted(str((r["doc_id"], r["kept"])) for r in a.collect()) == sorted(str((r["doc_id"], r["kept"])) for r in b.collect())
    names = [r.name for r in C.RULES]
    assert all(r["rules_run"] == (names.index(r["rejected_by"]) + 1 if r["rejected_by"] else len(names)) for r in a.collect())
    read = []
    rule = C.Rule("dear", ("n_words",), lambda n: read.append(n))
    t = C.Text("few words")
    assert any(C.fails(r, t) for r in (C.RULES[0], rule)) and not read and "n_repeat_words" not in t.values


def test_trials_count_every_sampled_row(spark):
    d = T.docs(spark)
    seen = C.trials(d, sample=10**6)
    assert sum(t.n for t in seen) == len(T.ROWS)
    expected = Counter(sum(C.fails(r, C.Text(x[1] or "")) << i for i, r in enumerate(C.RULES)) for x in T.ROWS)
    assert {t.mask: t.n for t in seen} == dict(expected)
    assert all(v >= 0 for t in seen for v in t.seconds.values()) and sum(t.seconds["word_ids"] for t in seen) > 0


def test_passing_keeps_columns_and_clean_documents(spark):
    clean = [(1000 + i, " ".join(random.Random(i).choices(re.findall(r"\w+", T.COPY + " of the and more plain words here"), k=60)) + "\nline two", "en", "a", 1) for i in range(20)]
    d = T.docs(spark, T.ROWS + clean)
    out = C.passing(spark, d)
    assert out.columns == d.columns
    kept = out.collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(str(x[:2]) for x in T.ROWS + clean if plain(x[1])[-1])
    assert {r["doc_id"] for r in kept} >= {c[0] for c in clean if plain(c[1])[-1]}
    assert C.passing(spark, d.limit(0)).count() == 0
