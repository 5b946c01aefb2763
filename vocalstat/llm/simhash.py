"""SimHash near-dedup over pivot distance tables.

A table of reference fingerprints is an anchor and the anchor with one bit flipped at each of the
64 places. The distances of a fingerprint to them are its row of the pivot table. By the triangle
inequality two fingerprints within r bits differ by at most r in every coordinate; and as the
coordinates come in six groups of references, two within 2 bits have equal coordinates (relative
to the anchor's) in at least four groups. So the coordinates of each four groups are a key, and
candidates are the fingerprints that share a key: 15 keys, of 42 bits or more, for each distinct
fingerprint. A coordinate relative to the anchor's is one bit of the fingerprint, so the neighbour
references reduce to bit blocks, four of six, as in block banding. Candidates are discarded by the largest coordinate difference over a second table
of scattered references, and survivors are verified by their exact distance.

Exact copies of a fingerprint are one node. A key shared by two fingerprints gives its one pair
straight from the grouped minimum and maximum. A key shared by up to ``CELL`` fingerprints is
compared inside its cell, where only verified links leave the task. Members of larger cells (a
large group of near copies) are linked exactly without pairs: two fingerprints are within 2 bits
if and only if a third is within 1 bit of both, so each member is dealt to itself and its 64
neighbours and linked to the smallest member there.

Defined cases: null and empty texts have fingerprint zero and link like any other; fewer than
three words give one shingle of all words; repeated shingles count as often as they occur; rows
repeated with their id stay as rows; null ids get the smallest id of their component; empty
tables give empty results; further columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import TMP, keep_rows, load, map_rows, row_hash, whole_text
from vocalstat.llm.components import connected_components
from vocalstat.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
ANCHOR = 0x5851F42D4C957F2D
GROUPS = ((0, 11), (11, 22), (22, 33), (33, 44), (44, 54), (54, 64))
#: The largest cell that is compared inside a task; larger ones are linked through shared neighbours.
CELL = 64
SCATTERED = tuple(xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(16))
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text, unsigned."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    k = min(shingle, len(words))
    stops = (ends[k - 1:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, h, fp) per row: the text's hash and its SimHash as a signed long."""
    d = docs.select("doc_id", row_hash().alias("h"), whole_text().alias("text"))
    return map_rows(d, lambda i, h, t: {"doc_id": i, "h": h, "fp": [signed(fingerprint(x, shingle)) for x in t]},
                    "doc_id long, h long, fp long", "doc_id", "h", "text")


def _distance(fp: Column, reference: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(signed(reference))))


def _pivot_keys(fps: np.ndarray) -> np.ndarray:
    """(fingerprints, keys): for each four groups of references, their pivot coordinates packed into 48 bits."""
    anchor = np.bitwise_count(fps ^ np.uint64(ANCHOR)).astype(np.int64)
    parts = []
    for lo, hi in GROUPS:
        refs = np.array([ANCHOR ^ (1 << i) for i in range(lo, hi)], np.uint64)
        coords = anchor[:, None] - np.bitwise_count(fps[:, None] ^ refs).astype(np.int64)  # 1 or -1
        parts.append((((coords + 1) // 2) << np.arange(hi - lo)).sum(axis=1).astype(np.uint64))
    keys = []
    for n, four in enumerate(combinations(range(len(GROUPS)), len(GROUPS) - MAX_BITS)):
        key = np.full(len(fps), n, np.uint64)
        for g in four:  # 4 + 4 x 11 bits: nothing is lost
            key = (key << np.uint64(11)) | parts[g]
        keys.append(key)
    return np.stack(keys, axis=1)


def _deal(batches):
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        keys = _pivot_keys(fps)
        yield pa.RecordBatch.from_pydict({"fp": np.repeat(fps.view(np.int64), keys.shape[1]),
                                          "key": keys.ravel().view(np.int64)})


def _survives(a: Column, b: Column) -> Column:
    gaps = [F.abs(_distance(a, p) - _distance(b, p)) for p in SCATTERED]
    return (F.greatest(*gaps) <= MAX_BITS) & (F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS)


def _cell_links(members: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside one cell of at most CELL distinct fingerprints."""
    x = np.array(members, dtype=np.int64).view(np.uint64)
    table = np.bitwise_count(x[:, None] ^ np.array(SCATTERED, np.uint64)).astype(np.int16)
    i, j = np.triu_indices(len(x), 1)
    near = np.abs(table[i] - table[j]).max(axis=1, initial=0) <= MAX_BITS
    i, j = i[near], j[near]
    near = np.bitwise_count(x[i] ^ x[j]) <= MAX_BITS
    return x[i[near]].view(np.int64), x[j[near]].view(np.int64)


def _links_in_cells(batches):
    for batch in batches:
        found = [_cell_links(m) for m in batch.column("members").to_pylist()]
        u = np.concatenate([a for a, _ in found] or [np.empty(0, np.int64)])
        v = np.concatenate([b for _, b in found] or [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_pydict({"u": u, "v": v})


def links(fps: DataFrame) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints (fp) which a chain of distances of at most 2 joins."""
    dealt = fps.select("fp").mapInArrow(_deal, "fp long, key long")
    cells = materialize(dealt.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1"), "cells")
    pairs = cells.where("n = 2").select("u", "v").distinct().where(_survives(F.col("u"), F.col("v")))
    full = materialize(dealt.join(cells.where("n > 2").select("key", "n"), "key"), "full-cells")
    inside = (full.where(F.col("n") <= CELL).groupBy("key").agg(F.collect_list("fp").alias("members"))
              .select("members").mapInArrow(_links_in_cells, "u long, v long"))
    crowded = full.where(F.col("n") > CELL).select("fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)])
    at = crowded.select("fp", F.explode(near).alias("at"))
    # the smallest member at each place, by map-side minimum; then each member's links to those
    low = at.groupBy("at").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").select("at", "v")
    shared = at.join(low, "at").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.unionByName(inside).unionByName(shared).distinct()


def near_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, h, fp, root, component_id) per row; root names the component, component_id is its smallest doc_id."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    linked = connected_components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    linked = linked.join(nodes, "fp")
    lowest = linked.groupBy("root").agg(F.min("low").alias("least"))
    named = linked.join(lowest, "root").select("fp", "root", F.lit(True).alias("many"), "least")
    of_fp = nodes.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("many"), F.col("least")).otherwise(F.col("low")).alias("component_id"))
    # the components are a table of their own, so that AQE can split a fingerprint that many rows share
    return rows.join(materialize(of_fp, "components"), "fp").select("doc_id", "h", "fp", "root", "component_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest doc_id stays; columns as in ``docs``."""
    g = near_groups(docs).select(F.col("doc_id").alias(f"{TMP}id"), F.col("h").alias(f"{TMP}h"), "root")
    g = materialize(g.groupBy(f"{TMP}id", f"{TMP}h", "root").agg(F.count(F.lit(1)).alias("n")), "groups")
    row = F.struct(F.col(f"{TMP}id").isNull(), F.col(f"{TMP}id"), F.col(f"{TMP}h"))  # ids before null, then the text's hash
    first = g.groupBy("root").agg(F.min(row).alias("first"), F.sum("n").alias("rows")).where("rows > 1").select("root", "first")
    g = g.join(materialize(first, "first"), "root")
    return keep_rows(docs, g.where(row != F.col("first")), g.where((row == F.col("first")) & (F.col("n") > 1)))


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, over the whole ``documents``."""
    return near_groups(load(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
