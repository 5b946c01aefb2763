"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

A paragraph is a line that isn't empty. It is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane modulo powers of two. The order
of paragraphs doesn't matter, and inserting or deleting a paragraph adds or subtracts its vector.

The vector has two parts. ``WIDE`` lanes modulo 2^64 come from a 512-bit digest of the paragraph:
equal multisets of paragraphs have equal sums, others differ but by chance of about 2^-512.
``SOFT`` lanes modulo 2^32 sum signed hashes of the paragraph's word pairs, so that the cosine
of two fingerprints' soft lanes estimates the share of word pairs in common. A text of Spark's
2^31 bytes has at most 2^30 pairs, so no lane wraps. Likeness is 1 for equal fingerprints and
otherwise that cosine, cut to 0..1.

In the stored bytes the soft lanes have their sign in the lowest bit and stand by bytes, all
lowest ones first: the higher bytes of short texts are runs of zeros, which take no room.

Defined cases: null counts as empty; a text without paragraphs has the zero fingerprint, which
is like itself (1) and like no other (0); words of over 16 bytes, so also text without spaces,
are hashed in pieces of 16 bytes; long texts are hashed in blocks of lines; equal doc_ids are
ordered by their text; null ids come first; empty tables give empty results; further columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalstat.llm.common import load, whole_text
from vocalstat.session import materialize

WIDE = 8
SOFT = 128
#: Bytes of text that are hashed at once; a longer paragraph is cut between pieces.
BLOCK = 1 << 20
PIECE = 16
_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        _powers = tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, b)])) for b in (_BASE, _INVERSE))
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _soft(block: bytes, last: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.uint64]:
    """Soft lanes of the lines in a block: signed counts of hashed neighbours among the pieces of words.

    ``last`` is the hash of the piece before, if the block goes on with a line; that of the last piece comes back.
    """
    b = np.frombuffer(block, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    at = np.arange(len(b))
    word = np.maximum.accumulate(np.where(space, at + 1, 0))  # where the word of each byte starts
    start = np.nonzero(~space & ((at - word) % PIECE == 0))[0]
    if not len(start):
        return np.zeros(SOFT, np.int64), last
    gaps = np.append(np.nonzero(space)[0], len(b))
    stop = np.minimum(gaps[np.searchsorted(gaps, start)], start + PIECE)
    power, inverse = _tables(len(b))
    total = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:len(b)], dtype=np.uint64)])
    h = _mix((total[stop] - total[start]) * inverse[start])
    before = np.concatenate([[last], h[:-1]])
    lines = np.cumsum(b == 10)[start]
    before[np.concatenate([[False], lines[1:] != lines[:-1]])] = 0  # pairs stay inside a paragraph
    pair = _mix(h + _BASE * before)
    sign = 1 - 2 * (pair >> np.uint64(63)).astype(np.int64)
    return np.bincount((pair % np.uint64(SOFT)).astype(np.int64), weights=sign, minlength=SOFT).astype(np.int64), h[-1]


def _parts(line: bytes) -> Iterator[bytes]:
    """A long line in parts of about ``BLOCK`` bytes, cut at white space, or between pieces of a longer word."""
    start = 0
    while len(line) - start > BLOCK + PIECE:
        stop = start + BLOCK
        if gap := _GAP.search(line, stop, stop + BLOCK):
            stop = gap.start()
        else:
            word = start + max(line[start:stop].rfind(c) for c in _SPACES) + 1  # a part starts at white space or at a piece
            stop -= (stop - word) % PIECE
        yield line[start:stop]
        start = stop
    yield line[start:]


def _blocks(lines: list[bytes]) -> Iterator[tuple[bytes, bool]]:
    """Lines in blocks, and whether a block goes on with the line of the one before."""
    held, size = [], 0
    for line in lines:
        if held and size + len(line) > BLOCK:
            yield b"\n".join(held), False
            held, size = [], 0
        if len(line) > BLOCK:
            for i, part in enumerate(_parts(line)):
                yield part, i > 0
            continue
        held.append(line)
        size += len(line) + 1
    if held:
        yield b"\n".join(held), False


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The summed vector of a text's paragraphs: wide lanes modulo 2^64, soft lanes not yet reduced."""
    lines = [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x]
    wide = np.zeros(WIDE, np.uint64)
    if lines:
        digests = b"".join(hashlib.blake2b(x, digest_size=8 * WIDE).digest() for x in lines)
        wide = np.frombuffer(digests, "<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
    soft, last = np.zeros(SOFT, np.int64), np.uint64(0)
    for block, goes_on in _blocks(lines):
        lanes, last = _soft(block, last if goes_on else np.uint64(0))
        soft += lanes
    return wide, soft


def pack(wide: np.ndarray, soft: np.ndarray) -> bytes:
    lanes = soft.astype("<i4")
    lanes = (lanes << 1) ^ (lanes >> 31)
    return wide.astype("<u8").tobytes() + lanes.view(np.uint8).reshape(SOFT, 4).T.tobytes()


def unpack(fp: bytes) -> tuple[np.ndarray, np.ndarray]:
    lanes = np.frombuffer(fp, np.uint8, 4 * SOFT, 8 * WIDE).reshape(4, SOFT).T.copy().view("<u4").ravel().astype(np.int64)
    return np.frombuffer(fp, "<u8", WIDE), (lanes >> 1) ^ -(lanes & 1)


def fingerprint(text: str) -> bytes:
    return pack(*vector(text))


def changed(fp: bytes, deleted: str = "", inserted: str = "") -> bytes:
    """The fingerprint after the paragraphs of ``deleted`` go and those of ``inserted`` come."""
    (w, s), (dw, ds), (iw, isoft) = unpack(fp), vector(deleted), vector(inserted)
    return pack(w - dw + iw, s - ds + isoft)


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    x, y = unpack(a)[1].astype(float), unpack(b)[1].astype(float)
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return float(min(1.0, max(0.0, x @ y / norm))) if norm else 0.0


def replace_end(text: str, fp: bytes, donor: str) -> tuple[str, bytes]:
    """The text with its last quarter replaced from the start of ``donor``, and its fingerprint.

    Only the paragraphs after the last line end that stays are hashed again.
    """
    k = len(text) // 4
    stays = text[:len(text) - k]
    edited = stays + donor[:k]
    line = stays.rfind("\n") + 1
    return edited, changed(fp, text[line:], edited[line:])


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
            "near_edited double, near_next double, part int, head string, tail string")
_NAMES = [c.split()[0] for c in COMPARED.split(", ")]
_SCHEMA = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
                          "int": pa.int32()}[t]) for n, t in (c.split() for c in COMPARED.split(", "))])


def _compare(doc_id, text: str, fp: bytes, following: str, fp_following: bytes) -> dict:
    edited, efp = replace_end(text, fp, following)
    return {"doc_id": doc_id, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": fp, "edited_fingerprint": efp,
            "near_edited": likeness(fp, efp), "near_next": likeness(fp, fp_following)}


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted partition with the one after it; leave the last row's text, and
    the first row's, which the partition before needs."""
    part, held, head = TaskContext.get().partitionId(), None, None
    for batch in batches:
        out = []
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            now = (i, t, fingerprint(t))
            if held is None:
                head = t
            else:
                out.append(_compare(*held, *now[1:]))
            held = now
        yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
    if held is not None:
        row = {"doc_id": held[0], "part": part, "head": head, "tail": held[1]}
        yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_compare(r["doc_id"], r["tail"], fingerprint(r["tail"]), r["head"], fingerprint(r["head"]))
               for r in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its text edited from the next document, by ascending doc_id.

    The texts are shuffled once, into ranges of doc_id, and compared while they are read in order.
    Only the last text of each range meets the first of the next range afterwards: one row a range.
    """
    ordered = docs.select("doc_id", whole_text().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    done = materialize(ordered.mapInArrow(_in_order, COMPARED), "compared")
    ends = done.where("part IS NOT NULL").select("part", "doc_id", "head", "tail")
    order = ends.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))
    order = order.select("part", F.coalesce("next", F.min("part").over(Window.partitionBy())).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("head"))
    met = ends.drop("head").join(order, "part").join(heads, "next").select("doc_id", "head", "tail")
    return done.where("part IS NULL").unionByName(met.mapInArrow(_at_ends, COMPARED)).drop("part", "head", "tail")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, over the whole ``documents``."""
    c = compare_with_next(load(spark, sf_dir, "documents"))
    return c.withColumns({n: F.translate(F.base64(n), "\r\n", "") for n in ("fingerprint", "edited_fingerprint")})
