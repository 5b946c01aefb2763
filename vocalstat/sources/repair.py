"""Read TAB-separated text whose fields may contain TABs and newlines.

Contract (SURVEY 2.1.1, our semantics). A line is a record when it has
exactly ``ncols`` fields, a ``id_len``-character id in the id column and (S2)
``digit_tail`` digit-only last fields. Surplus fields are folded into the text
field joined by one space (Q16). A record broken over lines is rebuilt by
joining the following lines with one space (runs of spaces collapsed) until it
is valid. Everything else is quarantined line by line, never dropped (Q17).

The id may stand before the text (newer files) or after it (older reported
files). In the first case a record starts at a line with an id, and what follows
is its rest until it is complete. In the second it ends at a line with an id, and
the lines before that, back to the line after the record before, are the start of its text
(text first, id second). With other orders nothing is joined.

Plan, built-in functions only:
1. ``number_lines``: line numbers per file from the scan's file/block metadata and
   ``monotonically_increasing_id`` (block offsets from a table of block counts).
2. Valid lines leave the scan as they are; they are neither shuffled nor stored.
3. What decides about invalid lines is narrow, and stored without their texts: whether a line
   has an id, its number of TABs, whether it ends in digits. Line number less running
   count names an island (a run of neighbours); running counts of ids and TABs name the
   record group in it and tell at which line a record is complete. Running sums are
   distributed (``operators.seq``), so an open record of any length is decided
   without holding it, or its group, in one task.
4. Lines of records that are complete are read again, meet by record and are joined; every
   other invalid line is quarantined by itself. Only a record that comes out is ever gathered.
5. Optional dedup per file: a hash aggregate on the record fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalstat.operators.seq import prefix_sums
from vocalstat.session import materialize

SENTENCE_COLUMNS = ["sentence_id", "sentence", "sentence_domain", "source", "is_used", "clips_count"]
REPORTED_COLUMNS = ["sentence_id", "sentence", "locale", "reason"]


def number_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, ln, value) with ln = 0-based line number within each file.

    The lines are scanned once for the counts of their blocks and again by whoever
    reads the result; nothing but the counts is stored. Both scans have to cut the files alike,
    so the number of cuts is pinned, and a block without a count is an error.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_blk"),
                                        F.monotonically_increasing_id().alias("_mid"), "value")
    blocks = raw.groupBy("file", "_blk").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(blocks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).select("file", "_blk", "_m0", "_off"), "blocks")
    # one row per file block, broadcast while it is small
    j = raw.join(blocks, ["file", "_blk"], "left")
    ln = F.coalesce(F.col("_off") + F.col("_mid") - F.col("_m0"), F.raise_error(F.lit("the files were cut otherwise than when their lines were counted")).cast("long"))
    return j.select("file", ln.alias("ln"), "value")


def _fields(s: Column) -> Column:
    return F.split(s, "\t", -1)


ID_PATTERN = "^[0-9a-fA-F]{%d}$"


def _has_id(arr: Column, id_col: Column, id_len: int) -> Column:
    """The id field is ``id_len`` hex characters (a sha256 id when 64)."""
    return F.coalesce(F.try_element_at(arr, id_col + 1).rlike(ID_PATTERN % id_len), F.lit(False))


def _fold(arr: Column, ncols: int, text_col: Column) -> Column:
    """Surplus fields merged into the text field, joined by one space."""
    n = F.size(arr)
    extra = n - F.lit(ncols)
    head = F.slice(arr, F.lit(1), text_col)
    merged = F.array(F.array_join(F.slice(arr, text_col + 1, extra + 1), " "))
    tail = F.slice(arr, text_col + extra + 2, F.lit(ncols) - text_col - 1)
    return F.when(n > F.lit(ncols), F.concat(head, merged, tail)).otherwise(arr)


def _valid(arr: Column, ncols: int, id_col: Column, id_len: int, digit_tail: int) -> Column:
    ok = (F.size(arr) == F.lit(ncols)) & _has_id(arr, id_col, id_len)
    for k in range(1, digit_tail + 1):
        ok = ok & F.coalesce(F.try_element_at(arr, F.lit(-k)).rlike(r"^[0-9]+$"), F.lit(False))
    return ok


def _collapse(s: Column) -> Column:
    return F.regexp_replace(s, " {2,}", " ")


def _positions(lines: DataFrame, id_col: int | str, text_col: int | str, header: bool) -> DataFrame:
    """Lines without the header, with ``_idc`` and ``_txc``: by number, or by the names in each file's header."""
    named = isinstance(id_col, str) or isinstance(text_col, str)
    if not header:
        if named:
            raise ValueError("column names need header=True")
        return lines.withColumns({"_idc": F.lit(id_col), "_txc": F.lit(text_col)})
    body = lines.where(F.col("ln") > 0)
    if not named:
        return body.withColumns({"_idc": F.lit(id_col), "_txc": F.lit(text_col)})
    place = lambda c: (F.array_position("_h", F.lit(c)).cast("int") - 1) if isinstance(c, str) else F.lit(c)
    heads = lines.where(F.col("ln") == 0).select("file", _fields(F.col("value")).alias("_h"))
    return body.join(materialize(heads.select("file", place(id_col).alias("_idc"), place(text_col).alias("_txc")), "headers"), "file")


def _records_of(bad: DataFrame, valid: DataFrame, ncols: int) -> tuple[DataFrame, DataFrame]:
    """Which invalid lines make which record: (file, ln, _rec) and the lines of ``valid`` that close one, (file, ln, _rec).

    ``bad`` = (file, ln, _id, _tabs, _tail, _idc, _txc, _ends), ``valid`` = (file, ln, _ends);
    ``_rec`` is the first line of the record.
    """
    p = prefix_sums(bad.select("file", "ln", F.col("_id").cast("int").alias("_i"), "_tabs", "_tail", "_idc", "_txc", "_ends"),
                    ["file"], ["ln"], [(None, "_cnt", True), ("_i", "_upto", True), ("_tabs", "_t", True)])
    island = F.col("ln") - F.col("_cnt")
    group = F.col("_upto") - F.when(F.col("_ends"), F.col("_i")).otherwise(0)  # an id starts its group, or ends it
    p = materialize(p.withColumns({"_island": island, "_group": group}), "bad-lines")
    by = ["file", "_island", "_group"]
    facts = p.groupBy(*by).agg(
        F.min("ln").alias("_rec"), F.max("ln").alias("_last"), F.min(F.col("_t") - F.col("_tabs")).alias("_t0"), F.max("_i").alias("_has"),
        F.max("_idc").alias("_idc0"), F.max("_txc").alias("_txc0"), F.min_by("_tabs", "ln").alias("_tabs0"), F.max("_ends").alias("_ends0"))
    full = F.col("_t") - F.col("_t0") + 1 >= F.lit(ncols)
    # the id stays a field of its own if a TAB follows it on its line; the last fields are digits on the closing line itself
    starts = (F.col("_idc0") < F.col("_txc0")) & (F.col("_has") == 1) & (F.col("_tabs0") > F.col("_idc0")) & (F.col("ln") > F.col("_rec")) & F.col("_tail")
    closed = p.join(facts, by).where(full & starts)
    closed = closed.groupBy(*by).agg(F.min("ln").alias("_close"), F.min("_rec").alias("_rec"))
    # fragments at the end of an island, before a valid line whose id comes last: that line ends their record
    ends = facts.where(F.col("_ends0") & (F.col("_has") == 0)).select("file", (F.col("_last") + 1).alias("ln"), "_island", "_group", "_rec")
    closing = materialize(valid.where("_ends").join(ends, ["file", "ln"]), "closing")
    every = closed.unionByName(closing.select(*by, F.col("ln").alias("_close"), "_rec"))
    return p.select(*by, "ln").join(every, by).where(F.col("ln") <= F.col("_close")).select("file", "ln", "_rec"), closing.select("file", "ln", "_rec")


def repair_lines(lines: DataFrame, ncols: int, names: Sequence[str] | None = None, id_col: int | str = 0,
                 text_col: int | str = 1, digit_tail: int = 2, id_len: int = 64, header: bool = True,
                 dedup: bool = True) -> tuple[DataFrame, DataFrame]:
    """Repair numbered lines (file, ln, value) into records and quarantined lines.

    ``id_col`` / ``text_col`` are 0-based field positions, or a header name
    (S3: the id column moved between releases, so it is looked up per file
    in the header line). Returns (rows: file, ln, <names...>; problems: file,
    ln, line, reason); ln of a rebuilt row is its first line.
    """
    names = list(names) if names else [f"c{i}" for i in range(ncols)]
    df = _positions(lines, id_col, text_col, header).withColumn("value", F.coalesce("value", F.lit("")))
    idc, txc = F.col("_idc"), F.col("_txc")
    arr = _fields(F.col("value"))
    folded = _fold(arr, ncols, txc)
    ends = (txc == 0) & (idc == 1)
    df = df.withColumns({"_ok": _valid(folded, ncols, idc, id_len, digit_tail), "_ends": ends})
    good = df.where(F.col("_ok"))

    size = F.size(arr)
    tail = F.lit(True) if not digit_tail else size > digit_tail
    for k in range(1, digit_tail + 1):
        tail = tail & F.coalesce(F.try_element_at(arr, F.lit(-k)).rlike(r"^[0-9]+$"), F.lit(False))
    bad = df.where(~F.col("_ok"))
    facts = materialize(bad.select(
        "file", "ln", _has_id(folded, idc, id_len).alias("_id"), (size - 1).alias("_tabs"), tail.alias("_tail"), "_idc", "_txc", "_ends"), "invalid")
    inner, closing = _records_of(facts, good.select("file", "ln", "_ends"), ncols)
    inner = materialize(inner, "record-lines")

    parts = bad.join(inner, ["file", "ln"]).select("file", "_rec", "ln", "value", "_txc")
    # a valid line closes a record only where its id comes last, right after the text; else no valid line is moved for it
    closes = isinstance(id_col, str) or isinstance(text_col, str) or (text_col == 0 and id_col == 1)
    if closes:
        parts = parts.unionByName(good.join(closing, ["file", "ln"]).select("file", "_rec", "ln", "value", "_txc"))
    whole = parts.groupBy("file", "_rec").agg(F.array_sort(F.collect_list(F.struct("ln", "value"))).alias("_l"), F.max("_txc").alias("_txc"))
    text = _collapse(F.array_join(F.transform("_l", lambda x: x["value"]), " "))
    rebuilt = whole.select("file", F.col("_rec").alias("ln"), _fold(_fields(text), ncols, txc).alias("_rec"))
    problems = bad.join(inner, ["file", "ln"], "left_anti").select("file", "ln", F.col("value").alias("line"), F.lit("unrepairable").alias("reason"))
    # a valid line that closes a record of several lines is no row of its own
    alone = good.join(closing, ["file", "ln"], "left_anti") if closes else good
    recs = alone.select("file", "ln", folded.alias("_rec")).unionByName(rebuilt)
    rows = recs.select("file", "ln", *[F.element_at("_rec", i + 1).alias(n) for i, n in enumerate(names)])
    if dedup:
        # duplicates within a file (one file is one dataset) keep their first line;
        # a long min buffer keeps this a hash aggregate (a string ``first`` buffer,
        # as in dropDuplicates, would force a sort on the full text)
        rows = rows.groupBy("file", *names).agg(F.min("ln").alias("ln")).select("file", "ln", *names)
    return rows, problems


def read_sentences(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Validated-sentence files (6 fields, id first, two digit fields last), deduplicated."""
    rows, problems = repair_lines(number_lines(spark, paths), len(SENTENCE_COLUMNS), SENTENCE_COLUMNS,
                                  id_col=0, text_col=1, digit_tail=2, dedup=True)
    rows = (rows.withColumn("is_used", F.col("is_used").cast("int"))
            .withColumn("clips_count", F.col("clips_count").cast("int")))
    return rows, problems


def read_reported(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """S3: reported files (4 fields); id and text positions from each file's header; no dedup."""
    lines = number_lines(spark, paths)
    hdr = lines.where(F.col("ln") == 0).select("file", F.split("value", "\t").alias("_h"))
    rows, problems = repair_lines(lines, 4, ["f0", "f1", "f2", "f3"], id_col="sentence_id", text_col="sentence",
                                  digit_tail=0, dedup=False)
    j = rows.join(hdr, "file")
    named = j.select("file", "ln", *[
        F.element_at(F.array("f0", "f1", "f2", "f3"), F.array_position("_h", F.lit(c)).cast("int")).alias(c)
        for c in REPORTED_COLUMNS])
    return named, problems
