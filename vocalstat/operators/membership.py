"""Membership and lookup joins J1-J4, J9-J12 (semi / anti / lookup, never multiplying).

The reference only ever asks "is this row in that set?" or "what is this
key's value?"; each is a left_semi / left_anti join or a left join against a
right side made unique first. Catalyst picks hash / sort-merge / broadcast;
AQE converts to broadcast at run time when the right side turns out small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import dims
from vocalstat.functions.exprs import version_ordinal
from vocalstat.session import materialize


def new_rows(candidates: DataFrame, existing: DataFrame, on: Sequence[str], force: bool = False) -> DataFrame:
    """Candidate rows whose key is not in ``existing`` (all of them when forced)."""
    if force:
        return candidates
    return candidates.join(existing.select(*on).distinct(), list(on), "left_anti")


def found(rows: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    """J2 (semi): rows whose key occurs in ``reference``."""
    return rows.join(reference.select(*on), list(on), "left_semi")


def not_found(rows: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    """J2 / K10 (anti): rows whose key does not occur in ``reference``."""
    return rows.join(reference.select(*on), list(on), "left_anti")


def corpus_rows_of_splits(corpus: DataFrame, splits: DataFrame, split_keys: Sequence[str] = ("alg", "sp"),
                          lc: str = "lc", ver: str = "ver", sentence_id: str = "sentence_id",
                          sentence: str = "sentence", id_from: str = dims.SENTENCE_ID_FROM) -> DataFrame:
    """Corpus rows used by each split, keeping the split keys.

    From ``id_from`` on, match by sentence id; before, by sentence text. The
    split side is made distinct on (keys, match key) first, so a sentence
    recorded many times yields one corpus row per split (inner join on a
    distinct right side = semi join that keeps the split keys). A corpus that
    carries versions (from ``restrict_to_index``) is matched within the version.
    """
    ordv = version_ordinal(F.col(ver))
    cut = dims.VERSIONS.index(id_from)
    keys = [ver, lc, *split_keys]
    on = [ver, lc] if ver in corpus.columns else [lc]
    by_id = (splits.where(ordv >= cut).select(*keys, sentence_id).where(F.col(sentence_id).isNotNull()).distinct()
             .join(corpus, [*on, sentence_id]))
    by_text = (splits.where(ordv < cut).select(*keys, sentence).where(F.col(sentence).isNotNull()).distinct()
               .join(corpus, [*on, sentence]))
    return by_id.unionByName(by_text)


def restrict_to_index(corpus: DataFrame, index: DataFrame, on: Sequence[str] = ("lc", "sentence_id"),
                      ver: str = "ver", usable_only: bool = True) -> DataFrame:
    """J4 + F1: corpus rows listed in a version index (keeps the index's ``ver``), is_used = 1."""
    c = corpus.where(F.col("is_used") == 1) if usable_only and "is_used" in corpus.columns else corpus
    idx = index.select(ver, *on).distinct()
    return c.join(idx, list(on))


def corpus_members(corpus: DataFrame, index: DataFrame, splits: DataFrame, id_from: str = dims.SENTENCE_ID_FROM) -> DataFrame:
    """F1 + J3 + J4 without the texts: (lc, sentence_id, text, ver, alg, sp), one row a corpus row and group it belongs to.

    A usable corpus row belongs to every version whose index lists it (alg = sp = ''),
    and there to the splits that use it: by sentence id from ``id_from`` on, by text
    before. ``text`` is the text's digest. Buckets get the first algorithm (Q14).
    """
    usable = corpus.where(F.col("is_used") == 1) if "is_used" in corpus.columns else corpus
    rows = usable.select("lc", "sentence_id", row_text("sentence").alias("text")).distinct()
    listed = materialize(rows.join(index.select("ver", "lc", "sentence_id").distinct(), ["lc", "sentence_id"]), "listed")
    cut = dims.VERSIONS.index(id_from)
    at = version_ordinal(F.col("ver"))
    used = splits.withColumn("alg", F.when(F.col("alg") == "", F.lit(dims.ALGORITHMS[0])).otherwise(F.col("alg")))
    by_id = used.where((at >= cut) & F.col("sentence_id").isNotNull()).select("ver", "lc", "alg", "sp", "sentence_id").distinct()
    by_text = used.where((at < cut) & F.col("sentence").isNotNull()).select("ver", "lc", "alg", "sp", row_text("sentence").alias("text")).distinct()
    cols = ["lc", "sentence_id", "text", "ver", "alg", "sp"]
    return (listed.withColumns({"alg": F.lit(""), "sp": F.lit("")}).select(*cols)
            .unionByName(listed.join(by_id, ["ver", "lc", "sentence_id"]).select(*cols))
            .unionByName(listed.join(by_text, ["ver", "lc", "text"]).select(*cols)))


def row_text(sentence: str) -> Column:
    """Digest of a row's text, empty for null: tells corpus rows of one id apart."""
    return F.coalesce(F.unhex(F.sha2(F.col(sentence).cast("binary"), 256)), F.lit(b""))


def signatures(members: DataFrame, row: Sequence[str] = ("lc", "sentence_id", "text"),
               group: Sequence[str] = ("ver", "alg", "sp"), within: Sequence[str] = ("lc",)) -> tuple[DataFrame, DataFrame]:
    """Rows by the set of groups they belong to: (row columns, sig) and (within, sig, group columns).

    A row belongs to few groups (versions times splits), and many rows to the same ones;
    what is counted once a signature is then spread over its groups.
    """
    row, group, within = list(row), list(group), list(within)
    sets = members.groupBy(*row).agg(F.array_sort(F.collect_set(F.struct(*group))).alias("groups"))
    tagged = materialize(sets.withColumn("sig", F.unhex(F.sha2(F.to_json("groups").cast("binary"), 256))), "signatures")
    groups = tagged.select(*within, "sig", F.inline("groups")).distinct()
    return tagged.select(*row, "sig"), materialize(groups, "groups")


def work_left(possible: DataFrame, done: DataFrame, no_data: DataFrame | None = None,
              keys: Sequence[str] = ("ver", "lc"), force: bool = False) -> DataFrame:
    """(ver, lc) work items = possible - already computed - known to have no data."""
    todo = possible.select(*keys).distinct()
    if not force:
        todo = todo.join(done.select(*keys), list(keys), "left_anti")
    if no_data is not None:
        todo = todo.join(no_data.select(*keys), list(keys), "left_anti")
    return todo


def exports_left(splits: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("ver", "lc", "alg"),
                 force: bool = False) -> DataFrame:
    """Training-split exports not yet made (anti join on the export manifest)."""
    todo = splits.select(*keys).distinct()
    return todo if force else todo.join(manifest.select(*keys), list(keys), "left_anti")


def locales_of_release(datasets: DataFrame, languages: DataFrame, release_dir: str) -> DataFrame:
    """J11 + S7: locales of one release = languages with a dataset row in that release."""
    d = datasets.where(F.col("release_dir") == F.lit(release_dir)).select(F.col("locale_id").alias("id"))
    return languages.join(d, "id", "left_semi").select(F.col("name").alias("lc")).orderBy("lc")


def presets_of_locale(presets: DataFrame, lc: str | None = None, group: str | None = "preset") -> DataFrame:
    """J12 + F2: preset rows (accents: ``group = 'preset'``), optionally of one locale,
    with a dense order column per locale for fixed output order."""
    p = presets
    if group is not None and "group" in p.columns:
        p = p.where(F.col("group") == F.lit(group))
    if lc is not None:
        p = p.where(F.col("lc") == F.lit(lc))
    if "ord" not in p.columns:
        p = p.withColumn("ord", F.monotonically_increasing_id())
    return p
