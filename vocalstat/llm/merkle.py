"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent from its root.

A leaf is the digest of a row's columns. The leaves of a tree (a source) stand in order, and every
``FAN`` consecutive nodes become one node, until one is left: the tree's own root. These roots, in
order of their trees, are the leaves of one more tree, whose root names the whole dataset.

The store holds digest-to-children records, packed by subtree: a pack has the digest of its top
and the records of up to ``LEVELS`` levels below it, so a pack of any tree has a bounded size.
Equal subtrees have equal digests and are stored once. Places in a tree come from a range
partition and the counts of its parts, so that neither a hot tree nor a hot row is gathered; packs
of one height are built together, a shuffle a height, each of 1 / FAN ** LEVELS of the one before.

A request is a tree and a leaf's rank in it. Requests descend together: a frontier of packs, the
root's first, meets the store by digest. Within a pack the digits of the rank in base ``FAN``, the
highest first, select a child at each record; the unselected children are collected. What a pack
adds is a segment of the path; segments are reversed, so that a proof reads from the leaf up. It
has the others' digests (``others``), and two figures a level (``turns``): the place in the run and
the run's length. ``folded`` recomputes the root from a leaf and its proof.

Defined cases: a null column is written ``-``, an empty text has length 0; whole texts are hashed;
the null source is a tree of its own, first in order; rows with equal ids stand in order of their
leaves, and rows that are equal throughout are leaves each, interchangeable; null ids come first
and are never tampered with; a tree of one leaf is that leaf, without records; a rank that a tree
does not have gets no row; an empty table has no root and gives empty results; further columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalstat.llm.common import load
from vocalstat.session import materialize

FAN = 3
#: Levels of a pack: it has up to FAN ** LEVELS leaves.
LEVELS = 6
WIDE = FAN ** LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves that a tree of so many levels can have, for all that a long can count.
_ROOM = [FAN ** k for k in range(40)]

PACK = "tree string, seg long, height int, digest string, records array<struct<digest:string,children:array<string>>>"
ROW_MASK = (1 << 33) - 1


# ---------------------------------------------------------------- leaves and places

def leaf_digest(*columns: Column) -> Column:
    """H of the columns, each as ``-`` or its length in bytes and its value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def tree_key(source: Column) -> Column:
    """A tree's name, null included, that sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("1"), source), F.lit("0"))


def ranked(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves`` (tree, ...) with rank, the place in its tree by ``order``, and height, the tree's levels.

    Rows that tie throughout are told apart by their place in the input, so that a range may end
    between them.
    """
    p = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["tree", *order, "salt"]
    rows = leaves.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(p, *by).sortWithinPartitions(*by)
    rows = materialize(rows.select(*leaves.columns, F.spark_partition_id().alias("part"),
                                   F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_MASK)).alias("place")), "ranged")
    parts = rows.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", "tree", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("leaves"))
    height = F.size(F.filter(F.array(*map(F.lit, _ROOM)), lambda x: x < F.col("leaves")))
    placed = rows.join(materialize(parts, "parts"), ["part", "tree"])
    return placed.select(*leaves.columns, (F.col("place") + F.col("shift")).alias("rank"), height.alias("height"))


# ---------------------------------------------------------------- store

def node(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def build_pack(digests: list[str], levels: int) -> tuple[str, dict[str, list[str]]]:
    """The top of so many levels over ``digests``, and the records below it."""
    records: dict[str, list[str]] = {}
    for _ in range(levels):
        runs = [digests[i:i + FAN] for i in range(0, len(digests), FAN)]
        digests = [node(run) for run in runs]
        records.update(zip(digests, runs))
    return digests[0], records


def _packs(tier: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        height = group["height"][0].as_py()
        top, records = build_pack(group["digest"].to_pylist(), max(0, min(LEVELS, height - LEVELS * tier)))
        return pa.table({"tree": group["tree"][:1], "seg": group["seg"][:1], "height": group["height"][:1], "digest": pa.array([top]),
                         "records": pa.array([[{"digest": d, "children": c} for d, c in records.items()]], _RECORDS)})

    return run


_RECORDS = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))


@dataclass
class Store:
    """``packs`` (digest, records), ``tops`` (tree, height, digest), both stored; ``tiers``: packs on a path at most."""

    packs: DataFrame
    tops: DataFrame
    tiers: int


def build(leaves: DataFrame) -> Store:
    """The records over ranked leaves (tree, rank, height, digest)."""
    tier, nodes, made, tops = 0, leaves.select("tree", "rank", "height", "digest"), [], []
    while True:
        seg = nodes.withColumn("seg", F.floor(F.col("rank") / WIDE).cast("long"))
        packs = materialize(seg.groupBy("tree", "seg").applyInArrow(_packs(tier), PACK), f"packs-{tier}")
        made.append(packs.select("digest", "records"))
        last = F.col("height") <= LEVELS * (tier + 1)
        tops.append(packs.where(last).select("tree", "height", "digest"))
        nodes = packs.where(~last).select("tree", F.col("seg").alias("rank"), "height", "digest")
        tier += 1
        if nodes.isEmpty():
            break
    union = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(union(dfs[1:]))
    # equal subtrees are stored once; their records are equal, so any will do
    return Store(materialize(union(made).groupBy("digest").agg(F.first("records").alias("records")), "store"), materialize(union(tops), "tops"), tier)


# ---------------------------------------------------------------- descent

def descend_pack(top: str, records: dict[str, list[str]], levels: int, wanted: list[int], turns: str = "", others: str = "") -> dict[int, tuple[str, str, str]]:
    """(digest, turns, others) of the wanted places below ``top``, by the digits of each; places that do not exist are left out."""
    at = {0: (top, turns, others)}
    for level in range(levels - 1, -1, -1):
        below = {}
        for q in sorted({k // FAN ** level for k in wanted}):
            above, place = at.get(q // FAN), q % FAN
            children = records[above[0]] if above else []
            if place < len(children):
                rest = "".join(children[:place] + children[place + 1:])
                below[q] = (children[place], f"{place}{len(children)}{above[1]}", rest + above[2])
        at = below
    return at


def _records(cell) -> dict[str, list[str]]:
    return {r["digest"]: r["children"] for r in cell.as_py()}


def _expand(tier: int):
    """Frontier rows with their packs to the frontier below: every top of a pack one tier lower."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                levels = min(LEVELS, row["height"][0].as_py() - LEVELS * tier)
                found = descend_pack(row["digest"][0].as_py(), _records(row["records"][0]), levels, range(WIDE),
                                     row["turns"][0].as_py(), row["others"][0].as_py())
                seg, n = row["seg"][0].as_py(), len(found)
                digests, turns, others = zip(*found.values())
                same = {c: pa.array(row[c].to_pylist() * n, row.schema.field(c).type) for c in ("tree", "height", "top")}
                yield pa.RecordBatch.from_pydict(same | {"seg": pa.array([seg * WIDE + k for k in found], pa.int64()), "digest": pa.array(digests),
                                                         "turns": pa.array(turns), "others": pa.array(others)}).select(_FRONTIER)

    return run


def _answer(asked: pa.Table, pack: pa.Table) -> pa.Table:
    """The requests of one pack at the leaves, with their leaves and proofs."""
    found = {}
    if asked.num_rows and pack.num_rows:
        row = pack.slice(0, 1)
        ranks = [r % WIDE for r in asked["rank"].to_pylist()]
        found = descend_pack(row["digest"][0].as_py(), _records(row["records"][0]), min(LEVELS, row["height"][0].as_py()), ranks,
                             row["turns"][0].as_py(), row["others"][0].as_py())
        keep = [i for i, k in enumerate(ranks) if k in found]
        asked, got = asked.take(keep), [found[ranks[i]] for i in keep]
    else:
        asked, got = asked.slice(0, 0), []
    top = pack["top"][0].as_py() if pack.num_rows else None
    for name, values in (("digest", [g[0] for g in got]), ("turns", [g[1] for g in got]), ("others", [g[2] for g in got]), ("top", [top] * len(got))):
        asked = asked.append_column(name, pa.array(values, pa.string()))
    return asked.drop_columns(["seg"])


_FRONTIER = ["tree", "seg", "height", "digest", "turns", "others", "top"]
FRONTIER = "tree string, seg long, height int, digest string, turns string, others string, top string"


def descend(store: Store, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests (tree, rank, ...) with digest, turns, others and top: the leaf, its proof, its tree's root.

    ``starts`` (tree, height, digest, turns, others) has the root of every tree that is asked and
    the path above it.
    """
    starts = starts.select("tree", F.lit(0).cast("long").alias("seg"), "height", "digest", "turns", "others", F.col("digest").alias("top"))
    tiers = F.greatest(F.lit(1), F.ceil(F.col("height") / LEVELS))
    frontier = None
    for tier in range(store.tiers - 1, -1, -1):
        here = starts.where(tiers == tier + 1)
        here = here if frontier is None else here.unionByName(frontier)
        met = here.join(store.packs, "digest")
        if tier:
            below = met.mapInArrow(_expand(tier), FRONTIER)
            asked = requests.select("tree", F.floor(F.col("rank") / WIDE ** tier).cast("long").alias("seg")).distinct()
            frontier = materialize(below.join(asked, ["tree", "seg"], "left_semi"), f"frontier-{tier}")
    asked = requests.withColumn("seg", F.floor(F.col("rank") / WIDE).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    return asked.groupBy("tree", "seg").cogroup(met.groupBy("tree", "seg")).applyInArrow(
        _answer, f"{schema}, digest string, turns string, others string, top string")


# ---------------------------------------------------------------- manifest

@dataclass
class Manifest:
    """A dataset's leaves (tree, rank, ... as given), the stores of its trees and of the tree over them, and the root (none if empty)."""

    leaves: DataFrame
    trees: Store
    over: Store
    over_leaves: DataFrame
    root: str | None


def manifest(leaves: DataFrame, *order: str) -> Manifest:
    """The manifest of leaves (tree, digest, ...); those of a tree stand in ``order``."""
    placed = materialize(ranked(leaves, *order), "leaves")
    trees = build(placed)
    over_leaves = materialize(ranked(trees.tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "of"), "over")
    over = build(over_leaves)
    root = over.tops.first()  # one row at most
    return Manifest(placed, trees, over, over_leaves, root["digest"] if root else None)


def proofs(m: Manifest, requests: DataFrame) -> DataFrame:
    """The requests (tree, rank, ...) with leaf, turns, others (from the leaf up to the root), subroot and root."""
    asked = m.over_leaves.select("tree", "rank", "of")
    tops = m.over.tops.select("tree", "height", "digest", F.lit("").alias("turns"), F.lit("").alias("others"))
    above = descend(m.over, tops, asked).select(F.col("of").alias("tree"), "digest", "turns", "others")
    starts = materialize(above.join(m.trees.tops.select("tree", "height"), "tree"), "starts")
    found = descend(m.trees, starts, requests)
    return found.withColumnsRenamed({"digest": "leaf", "top": "subroot"}).withColumn("root", F.lit(m.root).cast("string"))


def folded(leaf: Column, turns: Column, others: Column) -> Column:
    """The root that a leaf and a proof give."""
    def step(acc: Column, i: Column) -> Column:
        place, run = (F.substring(turns, 2 * i + k, F.lit(1)).cast("int") for k in (1, 2))
        left = F.substring(others, acc["at"], 64 * place)
        right = F.substring(others, acc["at"] + 64 * place, 64 * (run - 1 - place))
        return F.struct(F.sha2(F.concat(left, acc["digest"], right).cast("binary"), 256).alias("digest"), (acc["at"] + 64 * (run - 1)).alias("at"))

    start = F.struct(leaf.alias("digest"), F.lit(1).alias("at"))
    levels = F.sequence(F.lit(0), F.floor(F.length(turns) / 2).cast("int") - 1)
    return F.when(F.length(turns) == 0, leaf).otherwise(F.aggregate(levels, start, step)["digest"])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document, over the whole ``documents``."""
    docs = load(spark, sf_dir, "documents")
    columns = [F.col(c) for c in COLUMNS]
    cut = [F.replace(c, F.lit("\n"), F.lit("")) if name == "text" else c for name, c in zip(COLUMNS, columns)]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, leaf_digest(*cut))
    leaves = docs.select(tree_key(F.col("source")).alias("tree"), "doc_id", leaf_digest(*columns).alias("digest"), tampered.alias("tampered"))
    m = manifest(materialize(leaves, "digests"), "doc_id", "digest")
    found = proofs(m, m.leaves.select("tree", "rank", "doc_id", "tampered"))
    again = folded(F.coalesce("tampered", "leaf"), F.col("turns"), F.col("others"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("others").cast("binary"), 256).alias("proof_sha256"),
                        again.alias("folded_root"), (again == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    return f"sha256({' || '.join(part(text if c == 'text' else c) for c in COLUMNS)})"


_HALF = "xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)"
OP12_SQL = f"""
WITH RECURSIVE
d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, leaf) AS r, * FROM (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {_sql_leaf('text')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda a, bit: {_HALF})), 4294967295) % 2 = 0
      THEN {_sql_leaf("replace(text, chr(10), '')")} END AS tampered FROM documents)),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY r) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
up AS (SELECT tree, 0 AS lvl, pos, leaf AS digest, n FROM p
  UNION ALL SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3),
t AS MATERIALIZED (SELECT tree, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
over_up AS (SELECT 0 AS lvl, pos, subroot AS digest, n FROM t
  UNION ALL SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM over_up WHERE n > 1 GROUP BY lvl, pos // 3),
others AS (
  SELECT p.r, u.lvl, u.pos, u.pos < p.pos // CAST(pow(3, u.lvl) AS BIGINT) AS before, u.digest FROM p JOIN up u
    ON u.tree = p.tree AND u.n > 1 AND u.pos // 3 = p.pos // CAST(pow(3, u.lvl + 1) AS BIGINT) AND u.pos <> p.pos // CAST(pow(3, u.lvl) AS BIGINT)
  UNION ALL SELECT p.r, t.height + u.lvl, u.pos, u.pos < t.pos // CAST(pow(3, u.lvl) AS BIGINT), u.digest FROM p JOIN t ON t.tree = p.tree JOIN over_up u
    ON u.n > 1 AND u.pos // 3 = t.pos // CAST(pow(3, u.lvl + 1) AS BIGINT) AND u.pos <> t.pos // CAST(pow(3, u.lvl) AS BIGINT)),
steps AS MATERIALIZED (SELECT p.r, l.lvl, coalesce(string_agg(digest, '' ORDER BY o.pos) FILTER (WHERE before), '') AS l, coalesce(string_agg(digest, '' ORDER BY o.pos) FILTER (WHERE NOT before), '') AS g
  FROM p JOIN t ON t.tree = p.tree, LATERAL (SELECT unnest(range(t.height + (SELECT max(lvl) FROM over_up))) AS lvl) l LEFT JOIN others o ON o.r = p.r AND o.lvl = l.lvl GROUP BY p.r, l.lvl),
proof AS (SELECT r, sha256(string_agg(l || g, '' ORDER BY lvl)) AS h FROM steps GROUP BY r),
fold AS (SELECT r, 0 AS lvl, coalesce(tampered, leaf) AS digest FROM p
  UNION ALL SELECT f.r, f.lvl + 1, sha256(s.l || f.digest || s.g) FROM fold f JOIN steps s ON s.r = f.r AND s.lvl = f.lvl),
last AS (SELECT r, arg_max(digest, lvl) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, leaf, subroot, (SELECT digest FROM over_up WHERE n = 1) AS root, coalesce(h, sha256('')) AS proof_sha256, folded_root,
  folded_root = (SELECT digest FROM over_up WHERE n = 1) AS verified
FROM p JOIN t USING (tree) LEFT JOIN proof ON proof.r = p.r JOIN last ON last.r = p.r
"""
