"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A rule rejects a text by a condition over a few statistics. Statistics are computed when the first
rule asks for them and kept for the rules after it. A text that a rule rejects meets no further
rule. Rules all have to let a text pass, so their order changes the work and the rule that is named,
never the verdict.

The order comes from a sample of about ``SAMPLE`` rows of the table: on it every rule is run and
every statistic timed. Rows with the same set of rejecting rules are summed in the tasks, so that
the driver gets a row for each such set. Then rules are chosen greedily: the next one is that with
the most rejections per second among the rows that the rules chosen before let pass, where
statistics that those rules have computed cost nothing more. So a dear rule that rejects what a
cheap one has rejected already comes late, whatever it rejects by itself.

``judge`` may be asked to report statistics; these are computed for every row, besides those that
the cascade needs.

Defined cases: null text counts as empty; the empty text has no words and fails ``few_words``; whole
texts are read, in blocks of words, however long; repeated rows are judged each, null ids stay null;
rules that tie keep the order they are given in; an empty table leaves the rules in the order given;
further columns are not read by ``judge`` and kept by ``passing``.
"""

from __future__ import annotations

import re
import time
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import TMP, load, map_rows, whole_text

#: Rows of the sample, in expectation.
SAMPLE = 2_000
SEED = 11
WINDOW = 8
#: Bytes of a text that are split into words at once.
BLOCK = 1 << 20
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BULLET = re.compile(r"[\x20\x09-\x0D]*[-*•‣·]")
_DOTS = re.compile(r"(?:\.\.\.|…)[\x20\x09-\x0D]*\Z")


class Text:
    """A text and its statistics, each computed once, when first asked for; ``seconds`` has what each took."""

    def __init__(self, text: str):
        self.text, self.values, self.seconds = text, {}, {}
        self._nested = 0.0

    def __getitem__(self, name: str):
        if name not in self.values:
            outer, self._nested = self._nested, 0.0
            start = time.perf_counter()
            self.values[name] = STATISTICS[name](self)
            took = time.perf_counter() - start
            self.seconds[name] = took - self._nested  # without the statistics that it asked for
            self._nested = outer + took
        return self.values[name]


def _word_ids(t: Text) -> tuple[np.ndarray, list[bytes]]:
    """Words as numbers in order of their first place, and the distinct words in that order."""
    data = t.text.encode("utf-8", "surrogatepass")
    known: dict = defaultdict(count().__next__)
    parts, start = [], 0
    while start < len(data):
        stop = len(data)
        if stop - start > BLOCK and (space := _SPACE.search(data, start + BLOCK)):
            stop = space.start()
        words = data[start:stop].split()  # bytes split at ASCII white space only
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        start = stop + 1
    return np.concatenate(parts) if parts else np.empty(0, np.int32), list(known)


def _repeat_words(t: Text) -> int:
    """Words in windows of ``WINDOW`` words that the text holds twice or more."""
    ids, distinct = t["word_ids"]
    if len(ids) <= WINDOW or len(distinct) == len(ids):
        return 0
    grams, width = ids.astype(np.int64), 1
    while width < WINDOW:  # windows of twice the width, numbered from pairs of numbers
        pairs = grams[:-width] * (int(grams.max()) + 1) + grams[width:]
        grams, width = np.unique(pairs, return_inverse=True)[1], 2 * width
    found = np.flatnonzero(np.bincount(grams)[grams] > 1)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, found, 1)
    np.subtract.at(edges, found + WINDOW, 1)
    return int(np.count_nonzero(np.cumsum(edges)))


def _lines(text: str):
    """The lines that hold a word, one at a time."""
    start = 0
    while start <= len(text):
        stop = text.find("\n", start)
        stop = len(text) if stop < 0 else stop
        line = text[start:stop]
        if line.strip(SPACES):
            yield line
        start = stop + 1


def _line_counts(t: Text) -> tuple[int, int, int, int]:
    """Lines with a word: all, those equal to one before, those that begin as a list, those that end in dots."""
    seen, n, bullets, dots = set(), 0, 0, 0
    for line in _lines(t.text):
        n += 1
        seen.add(line)
        bullets += _BULLET.match(line) is not None
        dots += _DOTS.search(line, max(0, len(line) - 64)) is not None
    return n, n - len(seen), bullets, dots


def _letter_words(t: Text) -> int:
    ids, distinct = t["word_ids"]
    has = np.fromiter((any(map(str.isalpha, w.decode("utf-8", "surrogatepass"))) for w in distinct), bool, len(distinct))
    return int(has[ids].sum()) if len(ids) else 0


STATISTICS: dict[str, Callable[[Text], object]] = {
    "word_ids": _word_ids,
    "n_words": lambda t: len(t["word_ids"][0]),
    "word_chars": lambda t: len(t.text) - sum(map(t.text.count, SPACES)),
    "n_symbols": lambda t: sum(map(t.text.count, SYMBOLS)),
    "line_counts": _line_counts,
    "n_lines": lambda t: t["line_counts"][0],
    "n_dup_lines": lambda t: t["line_counts"][1],
    "n_list_lines": lambda t: t["line_counts"][2],
    "n_dotted_lines": lambda t: t["line_counts"][3],
    "n_repeat_words": _repeat_words,
    "n_letter_words": _letter_words,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the values of ``needs`` in order."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., bool]


#: What the contract calls the base, then the usual heuristics for web text; shares are compared in whole numbers.
BASE = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
RULES = BASE + (
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: c < 3 * n or c > 10 * n),
    Rule("letters", ("n_letter_words", "n_words"), lambda a, n: 10 * a < 7 * n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
    Rule("lists", ("n_list_lines", "n_lines"), lambda b, n: 10 * b > 9 * n),
    Rule("cut_lines", ("n_dotted_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
)


def fails(rule: Rule, t: Text) -> bool:
    return rule.rejects(*[t[name] for name in rule.needs])


@dataclass
class Trial:
    """Sampled rows with the same set of rejecting rules (bits of ``mask``): their number and the seconds of each statistic and rule."""

    mask: int
    n: int
    seconds: dict[str, float]


def trials(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[Trial]:
    """Every rule on a sample of the rows, summed by the set of rules that reject."""
    rows = docs.count()
    if not rows:
        return []
    some = docs.select(whole_text().alias("text")).sample(min(1.0, sample / rows), SEED)

    def run(texts: list) -> dict:
        n, seconds = Counter(), defaultdict(Counter)
        for text in texts:
            t, mask, own = Text(text), 0, {}
            for i, rule in enumerate(rules):
                for name in rule.needs:
                    t[name]
                start = time.perf_counter()
                mask |= fails(rule, t) << i
                own[rule.name] = time.perf_counter() - start
            n[mask] += 1
            seconds[mask].update(t.seconds | own)
        flat = [(m, k, s) for m in n for k, s in [("", 0.0), *seconds[m].items()]]
        return {"mask": [m for m, _, _ in flat], "n": [n[m] if not k else 0 for m, k, _ in flat],
                "name": [k for _, k, _ in flat], "seconds": [s for _, _, s in flat]}

    found: dict[int, Trial] = {}
    summed = map_rows(some, run, "mask long, n long, name string, seconds double", "text").groupBy("mask", "name")
    for r in summed.agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds")).collect():  # sampled rows times statistics at most
        trial = found.setdefault(r["mask"], Trial(r["mask"], 0, {}))
        trial.n += r["n"]
        trial.seconds[r["name"]] = r["seconds"]
    return list(found.values())


def _asked(needs: Sequence[str], known: set[str]) -> set[str]:
    """Statistics that ``needs`` have computed, those of others included, but for the known ones."""
    out: set[str] = set()
    todo = [n for n in needs if n not in known]
    while todo:
        name = todo.pop()
        out.add(name)
        todo += [n for n in DEPENDS.get(name, ()) if n not in known and n not in out]
    return out


#: Statistics that statistics ask for.
DEPENDS = {"n_words": ("word_ids",), "n_repeat_words": ("word_ids",), "n_letter_words": ("word_ids",),
           "n_lines": ("line_counts",), "n_dup_lines": ("line_counts",), "n_list_lines": ("line_counts",), "n_dotted_lines": ("line_counts",)}


def order_rules(rules: Sequence[Rule], seen: Sequence[Trial], first: Sequence[str] = ()) -> list[Rule]:
    """The rules by rejections per second among the rows that the ones before let pass.

    ``first`` are statistics that are computed anyhow, so that they cost a rule nothing.
    """
    left, known, out = list(enumerate(rules)), _asked(first, set()), []
    alive = list(seen)
    while left and alive:
        def gain(item: tuple[int, Rule]) -> float:
            i, rule = item
            seconds = sum(t.seconds.get(s, 0.0) for t in alive for s in (rule.name, *_asked(rule.needs, known)))
            return sum(t.n for t in alive if t.mask >> i & 1) / max(seconds, 1e-9)

        best = max(left, key=gain)
        if gain(best) == 0.0:
            break  # no rule rejects any of the rows left
        left.remove(best)
        out.append(best[1])
        known |= _asked(best[1].needs, known)
        alive = [t for t in alive if not t.mask >> best[0] & 1]
    # rules that reject nothing more in the sample: the cheapest first
    seconds = lambda rule: sum(t.seconds.get(s, 0.0) for t in seen for s in (rule.name, *_asked(rule.needs, known)))
    return out + sorted((r for _, r in left), key=seconds)


def judge(docs: DataFrame, rules: Sequence[Rule], report: Sequence[str] = (), keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The key columns, kept, the rule that rejected, the number of rules that ran, and the reported statistics."""
    rules, report = tuple(rules), tuple(report)
    kept = docs.select(*keys, whole_text().alias(f"{TMP}text"))

    def run(*columns: list) -> dict:
        *ids, texts = columns
        out = {k: v for k, v in zip(keys, ids)} | {"kept": [], "rejected_by": [], "rules_run": []} | {s: [] for s in report}
        for text in texts:
            t, name, n = Text(text), None, 0
            for rule in rules:
                n += 1
                if fails(rule, t):
                    name = rule.name
                    break
            out["kept"].append(name is None)
            out["rejected_by"].append(name)
            out["rules_run"].append(n)
            for s in report:
                out[s].append(t[s])
        return out

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
                       + ["kept boolean", "rejected_by string", "rules_run int"] + [f"{s} long" for s in report])
    return map_rows(kept, run, schema, *keys, f"{TMP}text")


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE, first: Sequence[str] = ()) -> list[Rule]:
    """The rules in the order that a sample of the table speaks for."""
    return order_rules(rules, trials(docs, rules, sample), first)


def passing(spark: SparkSession, docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that every rule lets pass, with the columns of ``docs``."""
    ordered = tuple(plan(docs, rules, sample))
    fields = docs.schema.fields

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = batch.column(place).to_pylist()
            ok = [not any(fails(r, t) for r in ordered) for t in (Text(x or "") for x in texts)]
            yield batch.filter(pa.array(ok, pa.bool_()))

    place = [f.name for f in fields].index("text")
    return docs.mapInArrow(run, docs.schema)


def op11_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document, over the whole ``documents``."""
    docs = load(spark, sf_dir, "documents")
    report = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    verdict = judge(docs, plan(docs, first=report), report)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return verdict.select("doc_id", *report, base_failed.alias("base_failed"), (F.col("kept") & ~base_failed).alias("kept"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT r, i, CASE WHEN i + 7 <= len(w) THEN array_to_string(w[i:i + 7], ' ') END AS gram FROM p),
twice AS (SELECT r, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 AS again FROM g),
marks AS (SELECT r, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM twice),
rep AS (SELECT r, count(*) FILTER (WHERE covered) AS n_repeat_words FROM marks GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
per_line AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09-\x0D]*[-*•‣·]')) AS listed,
    count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS dotted
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS letters, coalesce(n, 0) AS n, coalesce(listed, 0) AS listed, coalesce(dotted, 0) AS dotted
  FROM d LEFT JOIN rep USING (r) LEFT JOIN per_line USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * letters < 7 * n_words
       OR 2 * n_dup_lines > n OR 10 * listed > 9 * n OR 10 * dotted > 3 * n) AS kept
FROM b
"""
