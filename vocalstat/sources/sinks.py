"""Sinks K1-K14. Writers are partitioned by the dataset keys and use dynamic
partition overwrite, so re-running a subset of datasets rewrites only their
partitions (the incremental contract of J9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalstat.functions import dims
from vocalstat.functions.exprs import version_ordinal
from vocalstat.functions.exprs import list_to_text, matrix_to_text

SAVE_NONE, SAVE_DEFAULT, SAVE_DETAILED = 0, 1, 2


def arrays_as_text(df: DataFrame) -> DataFrame:
    """P19 at the sink: arrays joined with '#', matrices rows joined with '|'."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.ArrayType):
            cols.append(matrix_to_text(f.name).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(list_to_text(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_tsv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
              header: bool = True, compression: str | None = None) -> None:
    """K1: TAB-separated, no quoting, backslash escape, values written as they are.

    A TAB or line end inside a value is written as ``\\t``, ``\\n`` or ``\\r``: the
    writer would otherwise wrap the value in its quote character.
    """
    df = arrays_as_text(df)
    for c, t in df.dtypes:
        if t == "string" and c not in partition_by:
            for raw, mark in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
                df = df.withColumn(c, F.replace(F.col(f"`{c}`"), F.lit(raw), F.lit(mark)))
    w = (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("sep", "\t").option("header", header)
         .option("quote", "\u0000").option("escape", "\\").option("emptyValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ("lc", "ver"), mode: str = "overwrite") -> None:
    """K2 / K3: one JSON row per line, partitioned by (lc, ver)."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("lc", "ver"), mode: str = "overwrite") -> None:
    """Parquet result table, dynamic partition overwrite."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def frequency_tables_to_save(freq: DataFrame, level: int, alg: str = "alg", sp: str = "sp") -> DataFrame:
    """K6: which frequency rows are saved: DETAILED all; DEFAULT the global table
    and the first algorithm's validated/train/dev/test; NONE nothing."""
    if level == SAVE_DETAILED:
        return freq
    if level == SAVE_NONE:
        return freq.limit(0)
    glob = (F.coalesce(F.col(alg), F.lit("")) == "") & (F.coalesce(F.col(sp), F.lit("")) == "")
    main = (F.col(alg) == F.lit(dims.ALGORITHMS[0])) & F.col(sp).isin("validated", *dims.TRAINING_SPLITS)
    return freq.where(glob | main)


def version_index(corpus_rows: DataFrame, ver: str | None = None) -> DataFrame:
    """K8: sorted unique sentence ids (per ver, lc)."""
    keys = ["ver", "lc"] if "ver" in corpus_rows.columns else ["lc"]
    df = corpus_rows.select(*keys, "sentence_id").where(F.col("sentence_id").isNotNull()).distinct()
    if ver is not None and "ver" not in df.columns:
        df = df.withColumn("ver", F.lit(ver))
    return df.sortWithinPartitions("lc", "sentence_id")


def disabled_sentences(sentences: DataFrame) -> DataFrame:
    """K9 (Q11 D): is_used = 0 rows; only a sentence id is required."""
    return sentences.where((F.col("is_used") == 0) & F.col("sentence_id").isNotNull())


def export_splits(df: DataFrame, path: str, compression: str = "gzip",
                  partition_by: Sequence[str] = ("ver", "lc", "alg")) -> None:
    """Training-split export as compressed TSV, one folder per (ver, lc, alg)."""
    write_tsv(df, path, partition_by=partition_by, mode="overwrite", compression=compression)


def manifest(df: DataFrame, keys: Sequence[str] = ("ver", "lc", "alg")) -> DataFrame:
    """K13 manifest rows of what was exported (used by the J10 anti join)."""
    return df.select(*keys).distinct().withColumn("exported_at", F.current_timestamp())


def write_reported(df: DataFrame, path: str) -> None:
    """K4: reported statistics, one folder per locale holding all its versions."""
    write_table(df, path, partition_by=("lc",))


def combined(df: DataFrame, keys: Sequence[str] = ("lc", "ver", "alg", "sp")) -> DataFrame:
    """The combined table over everything, ordered by (lc, ver[, alg, sp])."""
    return df.orderBy(*[k for k in keys if k in df.columns])


def write_problems(problems: DataFrame, path: str, ver: str | None = None, lc: str | None = None) -> None:
    """K7: quarantined lines (file, ln, line, reason) with their dataset keys, appended."""
    p = problems
    if ver is not None:
        p = p.withColumn("ver", F.lit(ver))
    if lc is not None:
        p = p.withColumn("lc", F.lit(lc))
    parts = [c for c in ("lc", "ver") if c in p.columns]
    w = p.write.mode("append")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def write_dataset_specs(specs_by_dataset: DataFrame, path: str, existing: DataFrame | None = None) -> DataFrame:
    """Audio specs of each (ver, lc) dataset, written once: datasets already
    present in ``existing`` are skipped (anti join on keys), the rest appended."""
    todo = specs_by_dataset
    if existing is not None:
        todo = todo.join(existing.select("ver", "lc").distinct(), ["ver", "lc"], "left_anti")
    todo.write.mode("append").partitionBy("lc", "ver").parquet(path)
    return todo


def write_spec_log(specs: DataFrame, path: str) -> None:
    """Audio specs stored once, below the first version that has them.

    ``specs`` carries repaired version labels (see ``audio.dedup_specs``); rows of unknown versions meet
    no dataset and are left out. A row that later versions repeat is not stored again.
    """
    at = version_ordinal("ver")
    rest = [c for c in specs.columns if c != "ver"]
    first = specs.where(at.isNotNull()).groupBy(*rest).agg(F.min(at).alias("since"))
    (first.withColumn("since", F.lpad(F.col("since").cast("string"), 2, "0")).write.mode("overwrite").partitionBy("since").parquet(path))
