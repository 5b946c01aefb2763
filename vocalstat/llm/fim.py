"""Fill-in-middle transformation over a Roaring-style set of cut places.

The places where a text may be cut are byte offsets of its UTF-8 form: the start, and the end of
each unit (a code point by default, or each match of a pattern, matched left to right). They are
kept as a compressed set: the offsets' high bits choose a container of 2^16 places, and each
container is the smallest of an array of its low halves, a bitmap, or runs of neighbours. So the
code points of plain ASCII text are a few runs, mixed text makes bitmaps, words make arrays. The
k-th place is found by binary search over the containers' cumulative cardinalities and a local
select in one of them: the array's element, the run that the rank falls into by cumulative run
lengths, or the bitmap's word by cumulative bit counts and the bit in it.

Two ranks drawn from hashes of the id cut a text into prefix, middle and suffix, written with
sentinels as PSM or SPM; some texts stay plain. ``restore`` rebuilds the text from output and form.

Defined cases: null text counts as empty; an empty text, or one that holds a sentinel, stays plain;
whole texts are cut, their places found block by block, however long; a null id is hashed as an
empty decimal; rows repeated with their id are cut alike; empty tables give empty results;
further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import load, map_rows, whole_text

SEED = 1
#: Of 100 texts so many are cut, and of 100 cut ones so many are written suffix first.
CUT, SPM = 90, 20
SENTINELS = ("<P>", "<S>", "<M>")
#: Places that a container spans.
SPAN = 1 << 16


def _breaks(low: np.ndarray) -> np.ndarray:
    """Places in ``low`` after which a run of neighbours ends."""
    return (low[1:] - low[:-1] > 1).nonzero()[0]


class ArrayContainer:
    """Sorted low halves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return 2 * len(low)


class BitmapContainer:
    """A bit a place, with the number of bits before each word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return SPAN // 8


class RunContainer:
    """Starts of runs of neighbours, with the number of places before each."""

    def __init__(self, low: np.ndarray):
        first = np.concatenate([[0], _breaks(low) + 1])
        self.starts, self.before = low[first].astype(np.uint16), first.astype(np.int32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return 4 * runs


@dataclass
class BoundarySet:
    """Offsets in ascending order, by container; ``upto[i]`` offsets stand in the containers before the i-th."""

    keys: list[int] = field(default_factory=list)
    containers: list = field(default_factory=list)
    upto: list[int] = field(default_factory=lambda: [0])

    def __len__(self) -> int:
        return self.upto[-1]

    def add(self, key: int, low: np.ndarray) -> None:
        """The offsets of one span, by their sorted low halves; spans come in order."""
        runs = 1 + len(_breaks(low))
        kind = min((RunContainer, ArrayContainer, BitmapContainer), key=lambda c: c.size(low, runs))
        self.keys.append(key)
        self.containers.append(kind(low))
        self.upto.append(self.upto[-1] + len(low))

    def select(self, k: int) -> int:
        """The k-th offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        i = bisect_right(self.upto, k) - 1
        return self.keys[i] * SPAN + self.containers[i].select(k - self.upto[i])


def _code_points(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """By span, the low halves of the offsets at which a code point starts, and of the end."""
    raw = np.frombuffer(data, np.uint8)
    for key in range(len(raw) // SPAN + 1):
        part = raw[key * SPAN:(key + 1) * SPAN]
        start = np.ones(len(part) + (len(part) < SPAN), bool)  # the end lies in the last span
        np.not_equal(part & 0xC0, 0x80, out=start[:len(part)])
        yield key, start.nonzero()[0]


def _matches(data: bytes, unit: re.Pattern) -> Iterator[tuple[int, np.ndarray]]:
    """By span, the low halves of the start, the end of each match but an empty one, and the end of the data."""
    key, low, last = 0, [0], 0
    for end in chain((m.end() for m in unit.finditer(data)), [len(data)]):
        if end > last:
            if end // SPAN > key:
                if low:
                    yield key, np.array(low)
                key, low = end // SPAN, []
            low.append(end % SPAN)
            last = end
    yield key, np.array(low)


def boundaries(data: bytes, unit: re.Pattern | None = None) -> BoundarySet:
    """Where UTF-8 data may be cut: at code points, or after each match of ``unit`` (a pattern over bytes)."""
    out = BoundarySet()
    for key, low in _matches(data, unit) if unit else _code_points(data):
        if len(low):
            out.add(key, low)
    return out


def ranks(doc_id: int | None, n: int, seed: int = SEED) -> tuple[int, int, int, int]:
    """Ranks of both cuts among the n + 1 places, and two numbers below 100: for the choice to cut and for the form."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return a, b, h3 % 100, h4 % 100


def transform(doc_id: int | None, text: str, unit: re.Pattern | None = None, cut: int = CUT, spm: int = SPM, seed: int = SEED) -> tuple:
    """(units, form, units of the prefix, of the middle, output); both counts null for a plain text."""
    data = text.encode("utf-8", "surrogatepass")
    places = boundaries(data, unit)
    n = len(places) - 1
    a, b, dice, order = ranks(doc_id, n, seed)
    if not text or dice >= cut or any(s in text for s in SENTINELS):
        return n, "plain", None, None, text
    i, j = places.select(a), places.select(b)
    prefix, middle, suffix = (part.decode("utf-8", "surrogatepass") for part in (data[:i], data[i:j], data[j:]))
    p, s, m = SENTINELS
    if order < spm:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, unit: str | None = None, cut: int = CUT, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n units, form, prefix_units, middle_units, output.

    ``unit`` is a pattern over UTF-8 bytes (say ``rb"[^ ]* ?"`` as text), or none for code points.
    """
    pattern = re.compile(unit.encode(), re.DOTALL) if unit else None
    names = ("n", "form", "prefix_units", "middle_units", "output")

    def run(ids: list, texts: list) -> dict:
        rows = [transform(i, t, pattern, cut, spm, seed) for i, t in zip(ids, texts)]
        return {"doc_id": ids} | {name: [r[k] for r in rows] for k, name in enumerate(names)}

    return map_rows(docs.select("doc_id", whole_text().alias("text")), run,
                    "doc_id long, n long, form string, prefix_units long, middle_units long, output string", "doc_id", "text")


def restore(output: Column, form: Column) -> Column:
    """The text, from output and form: a cut text holds no sentinel, so each is found by itself."""
    p, s, m = SENTINELS
    between = lambda a, b: F.split_part(F.split_part(output, F.lit(a), F.lit(2)), F.lit(b), F.lit(1))
    after = F.split_part(output, F.lit(m), F.lit(2))
    return (F.when(form == "psm", F.concat(between(p, s), after, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), after, between(s, p))).otherwise(output))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rebuilt, over the whole ``documents``."""
    d = fill_in_middle(load(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return d.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                    digest(F.col("output")).alias("output_sha256"), digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 AS plain,
    CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 AS spm FROM d),
c AS (SELECT *, least(a, b) AS i, greatest(a, b) AS j, substr(t, 1, least(a, b)) AS pre, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS mid,
    substr(t, greatest(a, b) + 1) AS suf FROM r)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form, CASE WHEN NOT plain THEN i END AS prefix_chars, CASE WHEN NOT plain THEN j - i END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM c
"""
