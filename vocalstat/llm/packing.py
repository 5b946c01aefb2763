"""Packing documents into sequences by fitted patterns.

1. Documents are tokenised once and cut to pieces of at most ``MAX`` tokens. Pieces go to a table
   with their place among the pieces of their length and task.
2. Only the histogram of lengths (``MAX`` rows at most, whatever the corpus) reaches the driver.
   Lengths are rounded up to ``GRID`` units; patterns are the ways to fill a sequence with one,
   two or three of them. Non-negative least squares fits how often each pattern repeats, with
   less weight on short lengths, which fit anywhere. Counts are rounded down, and each repeat
   takes exact lengths that fill its sequence to the last token, as far as there are such.
3. Residual pieces go through best fit by decreasing length, on the histogram: all pieces of one
   length and all sequences of one room at once. Residual pieces of over half a sequence are
   placed, and their room filled, before the patterns of shorter pieces are taken. On sparse
   histograms the fit may take pieces that others need; so smaller shares of the repeats are
   tried too, and the plan with clearly fewer sequences counts.
4. The plan says for each length which ranks go where. It is a few thousand rows for any corpus.
   Ranks are the place in the task plus an offset per (task, length); the pieces are placed by a
   binary search in the plan.

Defined cases: null counts as empty, and an empty text is the end token alone; a long text is
cut so that its first piece is the shorter one; pieces of equal length are interchangeable;
repeated rows and null ids are packed like others; an empty table needs no sequence; further
columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vocalstat.llm.common import load, whole_text
from vocalstat.session import materialize

MAX = 2048
GRID = 128
END = 0
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Units below this share of a sequence count ``LIGHT`` in the fit.
SHORT, LIGHT = 1 / 8, 0.1
#: Shares of the fitted repeats that are tried; a smaller one counts if it saves more than ``SLACK``.
SHARES, SLACK = (1.0, 0.75, 0.5, 0.25), 0.001


@lru_cache(1)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(1)
def _ranks(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, vocabulary: str = VOCABULARY, ranks: str = RANKS) -> list[int]:
    """The ids that ``tokenizers`` gives, by the same vocabulary as ranks, which is several times as fast.

    Texts in which the tokenizer may see a special token, and those that the ranks' library can't
    split, go through the tokenizer itself.
    """
    if "<|" not in text:
        try:
            return _ranks(ranks).encode_ordinary(text)
        except BaseException as e:  # its panics, as on very long white space, have no public type
            if type(e).__name__ != "PanicException":
                raise
    return _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("ids", pa.list_(pa.int32()))])


def token_pieces(docs: DataFrame, most: int = MAX, vocabulary: str = VOCABULARY, ranks: str = RANKS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, part, place and, if kept, ids."""
    fields = [f for f in PIECES if keep_ids or f.name != "ids"]
    schema = pa.schema(fields)
    ddl = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, place long" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            out = {f.name: [] for f in fields}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*token_ids(text, vocabulary, ranks), END], "<u4")
                stop, start, piece = len(ids) - (len(ids) - 1) // most * most, 0, 0
                while start < len(ids):
                    own, n = ids[start:stop], stop - start
                    row = (doc_id, piece, start, n, zlib.crc32(own.tobytes()), part, seen[n], own.astype(np.int32))
                    for name, value in zip(PIECES.names, row):
                        if name in out:
                            out[name].append(value)
                    seen[n] += 1
                    start, stop, piece = stop, stop + most, piece + 1
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, ddl)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    tol = 1e-9 * max(1.0, np.abs(b).max(initial=0.0)) * len(b)
    for _ in range(3 * len(b)):
        w = a.T @ (b - a @ x)
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= tol:
            break
        passive[j] = True
        while True:
            cols = np.nonzero(passive)[0]
            own = a[:, cols]
            z = np.linalg.lstsq(own.T @ own, own.T @ b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0.0
                x[cols] = z
                break
            low = z <= 0
            step = np.min(x[cols][low] / np.maximum(x[cols][low] - z[low], 1e-300))
            x[cols] += step * (z - x[cols])
            gone = cols[low & (x[cols] <= tol)]
            passive[gone if len(gone) else cols[low]] = False
            x[~passive] = 0.0
            if not passive.any():
                break
    return x


def patterns(grid: int, there: np.ndarray) -> list[tuple[int, ...]]:
    """Units of one, two or three pieces that can fill a sequence to the last token.

    A piece of ``u`` units is up to a unit shorter than that, half a unit on average. So two
    pieces fill a sequence with one unit more than ``grid``, three with one or two more.
    """
    units = [int(u) for u in np.nonzero(there)[0] if u]
    have, out = set(units), []
    for a in units:
        if a == grid:
            out.append((a,))
        for b in units:
            if b <= a and a + b == grid + 1:
                out.append((a, b))
            out += [(a, b, c) for over in (1, 2) if a >= b >= (c := grid + over - a - b) >= 1 and c in have]
    return out


def _fill(way: tuple[int, ...], n: int, left: dict[int, int], unit: int, most: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Up to ``n`` full sequences of a pattern, as runs of equal lengths, taken from what is left."""
    for short in product(range(unit), repeat=len(way) - 1):
        lengths = [u * unit - d for u, d in zip(way, short)]
        last = most - sum(lengths)
        if not unit * (way[-1] - 1) < last <= unit * way[-1]:
            continue
        lengths.append(last)
        m = min(n, *(left.get(x, 0) // lengths.count(x) for x in lengths))
        if m > 0:
            for x in lengths:
                left[x] -= m
            n -= m
            yield tuple(lengths), m
        if not n:
            return


def fit_packs(counts: dict[int, int], most: int = MAX, grid: int = GRID) -> list[tuple[tuple[int, ...], int]]:
    """Packs (lengths, how many sequences) that hold every piece of the histogram {length: count} once."""
    unit = -(-most // grid)
    hist = np.zeros(grid + 1)
    for length, n in counts.items():
        hist[-(-length // unit)] += n
    if not (ways := patterns(grid, hist)):
        return _best_fit([], dict(counts), most)
    a = np.zeros((grid + 1, len(ways)))
    for j, way in enumerate(ways):
        np.add.at(a[:, j], list(way), 1.0)
    weight = np.where(np.arange(grid + 1) < SHORT * grid, LIGHT, 1.0)
    x = nnls(a * weight[:, None], hist * weight)
    fitted = [(ways[j], float(x[j]) + 1e-9) for j in np.argsort(-x, kind="stable") if x[j] > 1e-9]
    best = None
    for share in SHARES:
        packs = _take(fitted, share, dict(counts), unit, most)
        n = sum(k for _, k in packs)
        if best is None or n < best[0] * (1 - SLACK):
            best = n, packs
    return best[1]


def _take(fitted: list[tuple[tuple[int, ...], float]], share: float, left: dict[int, int], unit: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs from a share of the fitted repeats, and best fit for what they leave."""
    half, packs = most // 2 // unit, []
    # Patterns around a piece over half a sequence come first. Such pieces that no pattern holds
    # need a sequence each, so their room is filled before the other patterns are taken.
    for way, x in fitted:
        if max(way) > half and (n := int(share * x)):
            packs += _fill(way, n, left, unit, most)
    packs = _best_fit(packs, left, most, most // 2)
    for way, x in fitted:
        if max(way) <= half and (n := int(share * x)):
            packs += _fill(way, n, left, unit, most)
    return _best_fit(packs, left, most)


def _best_fit(packs: list[tuple[tuple[int, ...], int]], rest: dict[int, int], most: int, opens: int = 0) -> list[tuple[tuple[int, ...], int]]:
    """Put the rest, longest first, where the least room remains; equal pieces and equal packs at once.

    Only pieces of over ``opens`` tokens open sequences; what finds no room stays in ``rest``.
    """
    rooms: dict[int, list[list]] = defaultdict(list)
    open_ = np.zeros(most + 1, np.int64)

    def add(lengths: tuple[int, ...], n: int) -> None:
        room = most - sum(lengths)
        rooms[room].append([lengths, n])
        open_[room] += n

    for lengths, n in packs:
        add(lengths, n)
    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            fits = np.nonzero(open_[length:])[0]
            if not len(fits) and length <= opens:
                break
            if not len(fits):
                each = most // length
                if n >= each:
                    add((length,) * each, n // each)
                if n % each:
                    add((length,) * (n % each), 1)
                n = 0
                break
            room = length + int(fits[0])
            pack = rooms[room][-1]
            m = min(n, pack[1])
            pack[1] -= m
            open_[room] -= m
            if not pack[1]:
                rooms[room].pop()
            add((*pack[0], length), m)
            n -= m
        rest[length] = n
    return [(lengths, n) for room in sorted(rooms) for lengths, n in rooms[room]]


def _plan(packs: list[tuple[tuple[int, ...], int]], counts: dict[int, int], most: int) -> tuple[np.ndarray, ...]:
    """First position, sequence and offset of each run of pieces; a position counts by length, then rank."""
    first = np.zeros(most + 2, np.int64)
    for length, n in counts.items():
        first[length + 1] = n
    first = np.cumsum(first)
    nexts, runs, sequence = first.copy(), [], 0
    for lengths, n in packs:
        offset = 0
        for length in lengths:
            runs.append((nexts[length], sequence, offset))
            nexts[length] += n
            offset += length
        sequence += n
    runs.sort()
    return first, *(np.array([r[k] for r in runs], np.int64) for k in range(3))


def pack(docs: DataFrame, most: int = MAX, vocabulary: str = VOCABULARY, ranks: str = RANKS, keep_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence_id and offset; with ``keep_ids`` also its token ids."""
    pieces = materialize(token_pieces(docs, most, vocabulary, ranks, keep_ids), "pieces")
    dealt = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "dealt")
    counts = {r[0]: r[1] for r in dealt.groupBy("length").agg(F.sum("n")).collect()}  # a row per length
    first, lo, sequence, offset = _plan(fit_packs(counts, most), counts, most)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    names = [c for c in pieces.columns if c not in ("part", "place")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            position = first[at("length")] + at("ahead") + at("place")
            run = np.searchsorted(lo, position, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence[run] + position - lo[run]), pa.array(offset[run])],
                names=[*names, "sequence_id", "offset"])

    return pieces.join(ahead, ["part", "length"]).select(*names, "place", "ahead").mapInArrow(
        place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from ``pack(..., keep_ids=True)``.

    A sequence holds at most ``MAX`` tokens, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def _placed(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: where each piece of the documents goes."""
    return _placed(docs)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document, over the whole ``documents``."""
    return _placed(load(spark, sf_dir, "documents"))
