"""Sources S1, S4-S10, S12: plain scans with explicit schemas.

Every reader takes paths (files, folders or globs) and returns a DataFrame;
the dataset keys (version, locale, algorithm, split) come from the file path
through ``_metadata.file_path``, so one scan covers every dataset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalstat.functions import dims
from vocalstat.functions.exprs import version_ordinal

CLIP_SCHEMA = T.StructType([
    T.StructField("client_id", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("sentence_id", T.StringType()), T.StructField("sentence", T.StringType()),
    T.StructField("sentence_domain", T.StringType()), T.StructField("up_votes", T.IntegerType()),
    T.StructField("down_votes", T.IntegerType()), T.StructField("age", T.StringType()),
    T.StructField("gender", T.StringType()), T.StructField("accents", T.StringType()),
    T.StructField("variant", T.StringType()), T.StructField("locale", T.StringType()),
    T.StructField("segment", T.StringType()),
])
DURATION_SCHEMA = T.StructType([T.StructField("clip", T.StringType()), T.StructField("duration[ms]", T.LongType())])
ERROR_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("path", "source", "ds", "lc", "ver")])
SPEC_SCHEMA = T.StructType([
    T.StructField("clip_id", T.LongType()), T.StructField("orig_path", T.StringType()),
    T.StructField("orig_encoding", T.StringType()), T.StructField("orig_sample_rate", T.LongType()),
    T.StructField("orig_num_channels", T.ShortType()), T.StructField("orig_bitrate_kbps", T.ShortType()),
    T.StructField("duration", T.LongType()), T.StructField("speech_duration", T.LongType()),
    T.StructField("speech_power", T.DoubleType()), T.StructField("silence_power", T.DoubleType()),
    T.StructField("est_snr", T.DoubleType()), T.StructField("ver", T.StringType()),
    T.StructField("ds", T.StringType()), T.StructField("lc", T.StringType()),
])

# release directory -> version label, e.g. cv-corpus-16.1-2023-12-06 -> 16.1
RELEASE_RE = r"cv-corpus-([0-9]+(?:\.[0-9]+)?)"


def read_tsv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
             columns: Sequence[str] | None = None, header: bool = True,
             quarantine: bool = False) -> DataFrame:
    """TAB-separated, header, no quoting, no escaping; only the empty field is null (Q20).

    With a schema, rows whose field count or types do not fit are kept aside
    in ``_corrupt_record`` when ``quarantine`` (instead of silently trimmed).
    """
    r = (spark.read.option("sep", "\t").option("header", header).option("quote", "")
         .option("escape", "").option("nullValue", "").option("emptyValue", "")
         .option("mode", "PERMISSIVE").option("enforceSchema", False))
    if schema is not None:
        if quarantine:
            schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
            r = r.option("columnNameOfCorruptRecord", "_corrupt_record")
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", False)
    df = r.csv(paths)
    if columns:
        df = df.select(*columns)
    return df


def keys_from_path(df: DataFrame, release_re: str = RELEASE_RE, path_col: str | None = None) -> DataFrame:
    """S4 keys: ver, lc, alg ('' for buckets), sp from ``.../<release>/<lc>/[<alg>/]<sp>.tsv``."""
    p = F.col(path_col) if path_col else F.col("_metadata.file_path")
    parts = F.split(p, "/")
    n = F.size(parts)
    sp = F.regexp_replace(F.element_at(parts, -1), r"\.tsv$", "")
    prev = F.element_at(parts, -2)
    prev2 = F.element_at(parts, -3)
    is_alg = F.col("_sp").isin(*dims.TRAINING_SPLITS)
    return (df.withColumn("_sp", sp)
            .withColumn("ver", F.regexp_extract(p, release_re, 1))
            .withColumn("lc", F.when(is_alg, prev2).otherwise(prev))
            .withColumn("alg", F.when(is_alg, prev).otherwise(F.lit("")))
            .withColumn("sp", F.col("_sp")).drop("_sp")
            .where(n > 0))


def read_by_header(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                   first_column: str) -> tuple[DataFrame, DataFrame]:
    """Read TSV files whose layouts differ between releases in one scan.

    Each file's header (the line starting with ``first_column``) maps its
    fields by name; columns of ``schema`` absent from a file come back null.
    Rows shorter than their header are padded with nulls, longer ones are
    quarantined (S1).
    Only the empty field is null (Q20); numbers are parsed with ``try_cast``.
    Returns (rows with ``file`` + schema columns, quarantine (file, line)).
    """
    raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
    is_header = F.col("value").startswith(first_column + "\t") | (F.col("value") == first_column)
    headers = raw.where(is_header).select("file", F.split("value", "\t", -1).alias("_h")).dropDuplicates(["file"])
    body = raw.where(~is_header & (F.col("value") != "")).join(headers, "file")
    fields = F.split("value", "\t", -1)
    ok = F.size(fields) <= F.size("_h")
    bad = body.where(~ok).select("file", F.col("value").alias("line"))
    pad = F.array_repeat(F.lit(None).cast("string"), F.greatest(F.size("_h") - F.size(fields), F.lit(0)))
    m = F.map_from_arrays(F.col("_h"), F.concat(fields, pad))
    cols = []
    for f in schema.fields:
        v = F.try_element_at(m, F.lit(f.name))
        v = F.when(v == "", None).otherwise(v)
        cols.append((v if isinstance(f.dataType, T.StringType) else v.try_cast(f.dataType)).alias(f.name))
    rows = body.where(ok).select("file", *cols, F.col("_h"))
    return rows, bad


def read_clips(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S4 scan: the rows of ``read_clips_checked``."""
    return read_clips_checked(spark, paths)[0]


def read_clips_checked(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """S4 scan: bucket and split files of all datasets in one read, keys from paths.

    Files of older releases lack columns or call ``accents`` ``accent``; fields
    are mapped by each file's header, so layouts may be mixed in one read.
    Returns (rows, quarantine (file, line) of rows with too many fields).
    """
    schema = T.StructType(list(CLIP_SCHEMA.fields) + [T.StructField("accent", T.StringType())])
    rows, bad = read_by_header(spark, paths, schema, "client_id")
    present = F.array_contains("_h", "accents")
    rows = rows.withColumn("accents", F.when(present, F.col("accents")).otherwise(F.col("accent"))).drop("accent", "_h")
    return keys_from_path(rows, path_col="file"), bad


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Plain sentence files, one per line: distinct non-empty lines."""
    return spark.read.text(paths).where(F.col("value") != "").distinct().withColumnRenamed("value", "sentence")


def locales_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Locale codes of a release from a JSON metadata document {"locales": {lc: ...}}."""
    doc = spark.read.option("multiLine", True).text(path, wholetext=True)
    m = F.from_json(F.get_json_object("value", "$.locales"), "map<string,string>")
    return doc.select(F.explode(F.map_keys(m)).alias("lc")).distinct().orderBy("lc")


def locales_from_tables(languages: DataFrame, datasets: DataFrame, release_dir: str,
                        fallback: DataFrame | None = None) -> DataFrame:
    """Locales of a release from (languages, datasets); the fallback list (e.g. S6)
    counts only when the tables name no locale of the release."""
    from vocalstat.operators.membership import locales_of_release
    found = locales_of_release(datasets, languages, release_dir)
    if fallback is not None:
        none = found.agg((F.count(F.lit(1)) == 0).alias("_none"))  # one row
        found = found.unionByName(fallback.select("lc").distinct().join(none, how="inner").where("_none").select("lc"))
    return found.orderBy("lc")


def locales_of(spark: SparkSession, document: str, languages: DataFrame, datasets: DataFrame, release_dir: str) -> DataFrame:
    """S6, then S7: the locales of a release from its JSON document, or from the tables where there is none."""
    if path_exists(spark, document):
        return locales_from_json(spark, document)
    return locales_from_tables(languages, datasets, release_dir)


def read_presets(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Variant presets (lc, code, text) or accent presets (lc, token, text, group = 'preset').

    A per-locale order column ``ord`` is added from the file order (presets are
    small reference tables, broadcast where used).
    """
    df = read_tsv(spark, path).withColumn("_mid", F.monotonically_increasing_id())
    if kind == "accents":
        df = df.where(F.col("group") == "preset") if "group" in df.columns else df
    from pyspark.sql import Window
    w = Window.partitionBy("lc").orderBy("_mid")
    return df.withColumn("ord", F.row_number().over(w) - 1).drop("_mid")


def read_durations(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Clip durations per locale (lc from the folder name), ms as long."""
    df = read_tsv(spark, paths, DURATION_SCHEMA)
    lc = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.select(lc.alias("lc"), "clip", F.col("duration[ms]").alias("duration_ms"))


def newest_duration_files(spark: SparkSession, base: str, name: str = "clip_durations.tsv", release_re: str = RELEASE_RE) -> list[str]:
    """Of the duration files below release folders, each locale's from its newest release.

    Chosen from the files' paths alone, listed by Spark's file source; no file is opened. One path a locale.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(base).select("path")
              .withColumns({"ord": version_ordinal(F.regexp_extract("path", release_re, 1)), "lc": F.element_at(F.split("path", "/"), -2)}))
    best = listed.where(F.col("ord").isNotNull()).groupBy("lc").agg(F.max_by("path", "ord").alias("path"))
    return sorted(r["path"] for r in best.collect())


def read_newest_durations(spark: SparkSession, base: str, name: str = "clip_durations.tsv") -> DataFrame:
    """S4 + S9: the newest release's durations serve all versions; (lc, clip, duration_ms)."""
    files = newest_duration_files(spark, base, name)
    if not files:
        return spark.createDataFrame([], "lc string, clip string, duration_ms bigint")
    return read_durations(spark, files)


def read_spec_log(spark: SparkSession, path: str, upto: str | None = None) -> DataFrame:
    """The spec rows that a dataset of version ``upto`` may use: the log's folders up to its ordinal.

    ``since`` is the ordinal of the first version that has a row (see ``sinks.write_spec_log``), a folder
    name of two digits, so the condition prunes folders and no row is compared.
    """
    log = read_results(spark, path)
    return log if upto is None else log.where(F.col("since") <= f"{dims.VERSIONS.index(upto):02d}")


def read_optional(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """An optional input; absent path gives an empty frame of the right schema."""
    if not path or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = read_tsv(spark, path)  # by header: the file may have further columns, in any order
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's own file systems have the path; other failures are raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that a writer finished, in order: one per run."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(f.getPath().getParent().getName() for f in found or [])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Read back our own result table (Parquet, partitioned); ver stays a string (Q15)."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")  # partition values stay text: '1' never becomes 1.0
    try:
        df = spark.read.option("basePath", path).option("mergeSchema", False).parquet(path)
    finally:
        spark.conf.set(key, before)
    return df


BUCKET_TOKEN = "_bucket"  # an empty partition value would come back as null


def write_ingested(df: DataFrame, path: str) -> None:
    """S4 sink: the ingested clip table, Parquet partitioned by (ver, lc, alg, sp);
    bucket rows (alg '') are stored under a non-empty token. A dataset written
    again replaces its own partitions, so a repeated run changes nothing."""
    out = df.withColumn("alg", F.when(F.col("alg") == "", F.lit(BUCKET_TOKEN)).otherwise(F.col("alg")))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ver", "lc", "alg", "sp").parquet(path))


def from_ingested(df: DataFrame) -> DataFrame:
    return df.withColumn("alg", F.when(F.col("alg") == BUCKET_TOKEN, F.lit("")).otherwise(F.col("alg")))


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """S4 read-back: partition values as text, bucket token back to ''."""
    return from_ingested(read_results(spark, path))


def ingest(spark: SparkSession, paths: str | Sequence[str], out: str, existing: str | None = None,
           problems: str | None = None) -> DataFrame:
    """Scan release folders, skip datasets already ingested (anti join on keys), write the rest.

    Lines with too many fields go to ``problems`` (K7) when it is given. A failed
    lookup of ``existing`` is an error; only a missing path means nothing is there.
    """
    clips, bad = read_clips_checked(spark, paths)
    clips = clips.drop("file")
    if existing and path_exists(spark, existing):
        done = read_ingested(spark, existing).select("ver", "lc").distinct()
        clips = clips.join(done, ["ver", "lc"], "left_anti")
    write_ingested(clips, out)
    if problems:
        bad.write.mode("overwrite").option("sep", "\t").csv(problems)
    return clips
