"""Column expressions (projections P1-P24). All JVM-side, no Python UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalstat.functions import dims


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int = 3) -> Column:
    """P18 dec3/dec2/dec1: half-even rounding at the scaled value (Math.rint)."""
    scale = float(10 ** digits)
    return F.rint(col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def rint3(c: str | Column) -> Column:
    return round_half_even(c, 3)


def truncate_long(c: str | Column) -> Column:
    """Toward-zero truncation; NaN / infinity become null instead of failing."""
    return col(c).try_cast("long")


def nodata(c: str | Column) -> Column:
    """Null text demographics become the literal ``nodata``."""
    return F.coalesce(col(c), F.lit(dims.NODATA))


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_or_keep(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Lookup with fall-through: mapped value if the key is known, else the value."""
    return F.coalesce(F.try_element_at(literal_map(mapping), col(c)), col(c))


def gender_backmap(c: str | Column) -> Column:
    """Newer gender labels back to the older ones, other values kept."""
    return map_or_keep(c, dims.GENDER_BACKMAP)


def domain_map(c: str | Column) -> Column:
    """P5: old domain label to current; null for an unknown label (quarantined)."""
    return F.try_element_at(literal_map(dims.DOMAIN_MAP), col(c))


def char_count(c: str | Column) -> Column:
    """Code points, null as 0."""
    return F.coalesce(F.length(col(c)), F.lit(0))


def normalise(c: str | Column, drop_pattern: str = r"[^\p{L}\p{M}\p{N}]+") -> Column:
    """P9 (re-aimed): lower case, runs of non letters/digits to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(col(c)), drop_pattern, " "))


def tokenise(normalised: str | Column) -> Column:
    """P10: whitespace tokens of a normalised sentence, empty pieces removed."""
    return F.filter(F.split(col(normalised), " "), lambda x: x != F.lit(""))


def word_count(tokens: str | Column) -> Column:
    """Number of tokens; null stays null regardless of legacy size mode."""
    return F.when(col(tokens).isNull(), None).otherwise(F.size(col(tokens)))


def is_valid_sentence(c: str | Column, allowed_pattern: str | Column) -> Column:
    """P9 validity: 1 when the sentence matches the locale's allowed-alphabet pattern."""
    pat = F.lit(allowed_pattern) if isinstance(allowed_pattern, str) else allowed_pattern
    return F.when(col(c).isNull() | pat.isNull(), None).when(F.regexp_like(col(c), pat), 1).otherwise(0)


def ms_to_s(c: str | Column) -> Column:
    """P13."""
    return col(c).cast("double") / F.lit(1000.0)


def char_speed(duration_s: str | Column, length: str | Column) -> Column:
    """Ms per character, half-even; zero or missing length gives null (Q7)."""
    return F.rint(F.lit(1000.0) * F.try_divide(col(duration_s).cast("double"), col(length).cast("double")))


def vad_percentage(speech_ms: str | Column, duration_ms: str | Column) -> Column:
    """P15."""
    return F.lit(100.0) * F.try_divide(col(speech_ms).cast("double"), col(duration_ms).cast("double"))


def hours(seconds: str | Column) -> Column:
    """Hours with one decimal (half-even), 0 when the duration is unknown (< 0)."""
    return F.when(col(seconds) >= 0, round_half_even(col(seconds) / F.lit(3600.0), 1)).otherwise(F.lit(0.0))


def version_ordinal(c: str | Column) -> Column:
    """P20: version label to its ordinal (never compared as a float, Q9); null for an unknown label,
    which then meets no condition on versions (``unknown_versions`` lists such rows)."""
    at = F.array_position(F.array(*[F.lit(v) for v in dims.VERSIONS]), col(c)).cast("int")
    return F.when(at > 0, at - F.lit(1))


def unknown_versions(df: DataFrame, ver: str = "ver") -> DataFrame:
    """Rows whose version label isn't in the version list: the quarantine of P20."""
    return df.where(version_ordinal(ver).isNull())


def version_date(c: str | Column) -> Column:
    """P20: version label to its cut-off date."""
    return F.try_element_at(literal_map(dict(zip(dims.VERSIONS, dims.VERSION_DATES))), col(c)).cast("date")


def release_dir(c: str | Column) -> Column:
    """P20: version label to its release directory name."""
    return F.when(col(c).isin("1", "2", "3"), F.concat(F.lit("cv-corpus-"), col(c))).otherwise(
        F.concat(F.lit("cv-corpus-"), col(c), F.lit("-"), F.date_format(version_date(c), "yyyy-MM-dd")))


def version_column(c: str | Column) -> Column:
    """P20: version label to the matrix column name."""
    return F.concat(F.lit("v"), F.regexp_replace(col(c), r"\.", "_"))


def list_to_text(arr: str | Column, sep: str = dims.SEP_COL) -> Column:
    """P19 list2str (sink only)."""
    return F.array_join(F.transform(col(arr), lambda x: x.cast("string")), sep)


def matrix_to_text(mat: str | Column) -> Column:
    """P19 arr2str (sink only)."""
    return F.array_join(F.transform(col(mat), lambda r: F.array_join(F.transform(r, lambda x: x.cast("string")), dims.SEP_COL)), dims.SEP_ROW)


def int_or_null(c: str | Column) -> Column:
    """Cast to integer where possible."""
    return col(c).try_cast("long")


def bin_index(value: str | Column, edges: Sequence[float], closed_last: bool = True,
              truncate: bool = True, drop_first: bool = False, sentinel: int | None = None) -> Column:
    """0-based bin of a value over fixed edges.

    Bins are [e_i, e_i+1); the last one also holds e_m when ``closed_last``
    (numpy form) and not otherwise (``cut`` / vote form). With ``drop_first``
    the first bin is not reported and the others are renumbered from 0.
    Values outside the range, values in a dropped bin, and nulls give
    ``sentinel`` (null by default). With ``truncate`` the value is first cut
    toward zero (P17), as the published statistics do.
    """
    x = truncate_long(value) if truncate else col(value)
    m = len(edges) - 1
    first = 1 if drop_first else 0
    out = F.lit(sentinel).cast("int")
    expr = F.when(x.isNull() | (x < F.lit(edges[first])), out)
    for i in range(first, m):
        expr = expr.when(x < F.lit(edges[i + 1]), F.lit(i - first))
    if closed_last:
        expr = expr.when(x == F.lit(edges[m]), F.lit(m - 1 - first))
    return expr.otherwise(out)


def unify_clips(df: DataFrame, lc: str | Column | None = None) -> DataFrame:
    """One clip schema over every release layout.

    Missing optional columns become ``nodata`` (locale becomes the dataset
    locale), ``accent`` is read as ``accents`` value by value, genders are
    mapped back, and a lower-case sentence is added.
    """
    have = set(df.columns)

    def opt(name: str) -> Column:
        return nodata(F.col(name).cast("string")) if name in have else F.lit(dims.NODATA)

    if "accents" in have and "accent" in have:
        accents = nodata(F.coalesce(F.col("accents"), F.col("accent")))
    elif "accent" in have:
        accents = opt("accent")
    else:
        accents = opt("accents")
    if "locale" in have:
        locale = F.col("locale").cast("string")
    elif lc is not None:
        locale = col(lc)
    else:
        locale = F.col("lc") if "lc" in have else F.lit(None).cast("string")
    keys = [c for c in ("ver", "lc", "alg", "sp") if c in have]
    return df.select(
        *keys,
        F.col("client_id"),
        F.col("path"),
        opt("sentence_id").alias("sentence_id"),
        F.col("sentence"),
        opt("sentence_domain").alias("sentence_domain"),
        F.col("up_votes").cast("int").alias("up_votes"),
        F.col("down_votes").cast("int").alias("down_votes"),
        opt("age").alias("age"),
        gender_backmap(opt("gender")).alias("gender"),
        accents.alias("accents"),
        opt("variant").alias("variant"),
        locale.alias("locale"),
        opt("segment").alias("segment"),
        F.lower(F.col("sentence")).alias("sentence_lower"),
    )
