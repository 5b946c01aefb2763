"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

Three patterns give the base spans. Besides, every run of 20 or more characters of the secret
alphabet that no base span touches is scored by two first-order character Markov models; runs
whose log-likelihood ratio a character is above a limit become spans of kind ``random``, be
they of letters only or not. A character that repeats the one before it never speaks for a
random string, so that rules of dashes and drawn-out letters are not reported.

The models are counted over all documents: values that the base patterns found and strings
drawn evenly from usual alphabets are random; words, alone and joined to identifiers, and runs of
the secret alphabet outside base spans, digits included, are ordinary. A run with a piece of
letters and digits as long as a reported run's may be a secret itself and isn't counted as
ordinary, apart from its words. Text rarely holds UUIDs, versions, timestamps and paths, so drawn
ones make up half of the ordinary model. Only transition counts, a fixed number, reach the driver.
The limit is fitted to labelled samples of both classes that the models have not seen.

Defined cases: null and empty texts have no spans; whole texts are scanned, however long;
repeated rows are scanned each; null ids stay null; without documents the models know the
drawn strings only and no run is above the limit by letters alone; empty tables give empty
results; further columns are not read. Spans are found, cut out and compared in one pass from left to
right, so that the time grows with the text.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import load, map_rows, whole_text

DRAWN = 2_000
UNIFORM = 0.02
SEED = 4

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
PIECE = re.compile(r"[A-Za-z0-9]{20,}")
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_OTHER = len(ALPHABET)
_CODE = np.full(256, _OTHER, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
STATES = _OTHER + 1


def base_finds(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the fixed patterns, each kind by itself, in code points."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end(), m.start(1)) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    for run in RUN.finditer(text):  # both others lie inside runs of the wider alphabet
        a, b = run.span()
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= 20]
        out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text, a, b)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns."""
    return [s[:3] for s in base_finds(text)]


def outside(text: str, spans: list) -> str:
    """The text without the spans (in order of their starts, overlapping or not), a space for each."""
    parts, at = [], 0
    for s in spans:
        if s[1] > at:
            parts.append(text[at:s[1]])
        at = max(at, s[2])
    return " ".join([*parts, text[at:]])


def _codes(s: str) -> np.ndarray:
    return _CODE[np.frombuffer(s.encode("latin-1", "replace"), np.uint8)]


def transitions(strings: list[str]) -> np.ndarray:
    """How often each state is followed by each character; a string starts in the state of no character."""
    c = _codes("\n" + "\n".join(strings))  # the line end has that state
    steps = (c[:-1] * STATES + c[1:])[c[1:] != _OTHER]
    return np.bincount(steps, minlength=STATES * STATES)


def drawn_strings(n: int = DRAWN, seed: int = SEED) -> list[str]:
    """Random strings of usual alphabets, the same on every run; plain hex is left to the base patterns."""
    rng = random.Random(seed)
    kinds = (ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:52])
    return ["".join(rng.choices(kinds[i % len(kinds)], k=rng.randint(20, 40))) for i in range(n)]


#: Usual parts of paths, versions and file names.
PARTS = ("usr", "lib", "home", "data", "src", "main", "test", "build", "release", "beta", "alpha", "rc", "linux", "x86", "amd", "python", "java", "site", "packages",
         "image", "photo", "report", "final", "copy", "backup", "config", "user", "index", "page", "news", "article", "version", "update", "service", "node", "module")


def drawn_names(n: int = DRAWN, seed: int = SEED) -> list[str]:
    """Ordinary strings with digits: UUIDs, versions, timestamps, numbers, paths and file names, counted-up characters."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    word = lambda: rng.choice(PARTS)
    upper = lambda w: rng.choice((w, w, w.capitalize(), w.upper()))
    hexes = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    steps = "0123456789abcdefghijklmnopqrstuvwxyz"

    def one(kind: int) -> str:
        if kind == 0:
            u = "-".join(map(hexes, (8, 4, 4, 4, 12)))
            return u.upper() if rng.random() < 0.2 else u
        if kind == 1:
            sep = rng.choice("_-")
            return sep.join([f"v{digits(1)}", digits(1), digits(rng.randint(1, 2)), word() + digits(rng.randint(0, 1)), f"20{digits(6)}", f"{word()}{digits(rng.randint(0, 2))}", f"x{digits(2)}"])
        if kind == 2:
            sep = rng.choice(("-", "/", "_", ""))
            return sep.join([f"20{digits(2)}", digits(2), digits(2), digits(2), digits(2), digits(2), digits(rng.randint(3, 6))])
        if kind == 3:
            return rng.choice(("-", "/", "_")).join(digits(rng.randint(3, 10)) for _ in range(rng.randint(3, 4)))
        if kind == 4:
            return "/".join(upper(word()) + digits(rng.choice((0, 0, 1, 2, 4))) for _ in range(rng.randint(4, 7)))
        if kind == 5:
            return rng.choice("_-").join(upper(word()) + digits(rng.choice((0, 0, 1, 3, 8))) for _ in range(rng.randint(4, 6)))
        at = rng.randint(0, 12)
        run = steps[at:at + rng.randint(20, 24)]
        return run.upper() if rng.random() < 0.3 else run

    return [one(i % 7) for i in range(n)]


def identifiers(words: list[str]) -> list[str]:
    """Ordinary names: words as they are, and neighbours joined as code joins them."""
    out = list(words)
    for a, b in zip(words[::2], words[1::2]):
        out += [f"{a}_{b}", a + b.capitalize(), f"{a}-{b}", f"{a}/{b}"]
    return out


def _labelled(texts: list) -> dict:
    n = np.zeros((2, STATES * STATES), np.int64)
    for text in texts:
        finds = base_finds(text)
        text_outside = outside(text, finds)
        words = re.findall(r"[A-Za-z]+", text_outside)
        n[1] += transitions([text[v:b] for _, _, b, v in finds])
        n[0] += transitions(identifiers(words) + [run for run in TOKEN.findall(text_outside) if not PIECE.search(run)])
    label, step = np.nonzero(n)
    return {"label": label.tolist(), "step": step.tolist(), "n": n[label, step].tolist()}


def _shares(n: np.ndarray) -> np.ndarray:
    """Transition probabilities, with a uniform part, so that what neither class has seen speaks for none."""
    n = n.reshape(STATES, STATES) + 1e-9
    return (1 - UNIFORM) * n / n.sum(axis=1, keepdims=True) + UNIFORM / STATES


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition, random over ordinary, as (STATES, STATES)."""
    counts = map_rows(docs.select(whole_text().alias("text")), _labelled, "label int, step int, n long", "text")
    n = np.zeros((2, STATES * STATES))
    for label, step, k in counts.groupBy("label", "step").agg(F.sum("n")).collect():  # 2 x STATES^2 rows at most
        n[label, step] += k
    random_ = _shares(n[1] + transitions(drawn_strings()))
    ordinary = (_shares(n[0]) + _shares(transitions(drawn_names()))) / 2
    model = np.log(random_) - np.log(ordinary)
    np.fill_diagonal(model, np.minimum(model.diagonal(), 0.0))
    return model


def held_out(model: np.ndarray, n: int = DRAWN) -> tuple[np.ndarray, np.ndarray]:
    """Ratios of random and of ordinary strings that were drawn anew."""
    return tuple(np.array([ratio(w, model) for w in draw(n, SEED + 1)]) for draw in (drawn_strings, drawn_names))


def fit_limit(model: np.ndarray) -> float:
    """The limit with the largest sum of recall and specificity on the held-out strings, halfway to the next ratio."""
    yes, no = held_out(model)
    limits = np.unique(np.concatenate([yes, no]))
    recall = 1 - np.searchsorted(np.sort(yes), limits, side="right") / len(yes)
    clear = np.searchsorted(np.sort(no), limits, side="right") / len(no)
    best = int(np.argmax(recall + clear))
    return float(limits[best:best + 2].mean())


def ratio(s: str, model: np.ndarray) -> float:
    """Mean log-likelihood ratio a character."""
    c = np.concatenate([[_OTHER], _codes(s)])
    return float(model[c[:-1], c[1:]].mean())


def all_spans(text: str, model: np.ndarray, least: float) -> list[tuple[str, int, int]]:
    """Base spans and those of the models, by start, then kind."""
    base = base_spans(text)
    out, at, reach = list(base), 0, 0
    for m in RUN.finditer(text):  # runs and base spans come in order of their starts
        a, b = m.span()
        while at < len(base) and base[at][1] < b:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= a and ratio(m[0], model) > least:
            out.append(("random", a, b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, model: np.ndarray, least: float | None = None) -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end, value) for every row; the limit is fitted unless given."""
    least = fit_limit(model) if least is None else least

    def run(ids: list, texts: list) -> dict:
        return {"doc_id": ids, "spans": [[{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in all_spans(t, model, least)] for t in texts]}

    return map_rows(docs.select("doc_id", whole_text().alias("text")), run,
                    "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>", "doc_id", "text")


def _digest(ids: list, spans: list) -> dict:
    named = [[f"{s['kind']}:{s['start']}:{s['end']}" for s in row] for row in spans]
    count = lambda kind: [sum(s["kind"] == kind for s in row) for row in spans]
    base = [",".join(n for n, s in zip(names, row) if s["kind"] != "random") for names, row in zip(named, spans)]
    return {"doc_id": ids, "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"), "n_random": count("random"),
            "base_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in base], "spans": [",".join(n) for n in named]}


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, over the whole ``documents``."""
    docs = load(spark, sf_dir, "documents")
    model = train(docs)
    return map_rows(scan(docs, model), _digest,
                    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long", "doc_id", "spans")
