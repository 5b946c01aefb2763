"""Helpers that write the DuckDB oracle SQL for the driver-table queries.

The oracle is independent SQL (DuckDB dialect): per-bin FILTER counts, CUBE,
plain joins. It shares only the literal constants with the Spark plans.
"""

from __future__ import annotations

from collections.abc import Sequence


def r3(expr: str, digits: int = 3) -> str:
    scale = 10 ** digits
    return f"CAST(round_even(CAST(({expr}) AS DOUBLE) * {scale}, 0) / {scale} AS DOUBLE)"


def values_list(rows: Sequence[Sequence], names: Sequence[str], alias: str = "t") -> str:
    def lit(x):
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        return str(x)
    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(names)})"


def bins_table(edges: Sequence[float], drop_first: bool = False) -> str:
    m = len(edges) - 1
    first = 1 if drop_first else 0
    rows = [(i - first, edges[i], edges[i + 1], 1 if i == m - 1 else 0) for i in range(first, m)]
    return values_list(rows, ["bin", "lo", "hi", "is_last"], alias="b")


def hist_sql(src: str, keys: Sequence[str], value: str, edges: Sequence[float], closed_last: bool = True,
             drop_first: bool = False, truncate: bool = True, groups: str | None = None,
             weight: str | None = None, count: str = "cnt") -> str:
    """Dense (keys, bin, lo, cnt) histogram of ``value`` over rows of ``src``."""
    k = ", ".join(keys)
    kg = ", ".join(f"g.{c}" for c in keys)
    v = f"trunc({value})" if truncate else f"({value})"
    w = f"({weight})" if weight else "1"
    cond_last = "OR (b.is_last = 1 AND s._v = b.hi)" if closed_last else ""
    groups = groups or f"SELECT DISTINCT {k} FROM ({src}) q"
    join_keys = " AND ".join(f"s.{c} IS NOT DISTINCT FROM g.{c}" for c in keys) or "TRUE"
    return f"""
SELECT {kg + ',' if keys else ''} CAST(b.bin AS INTEGER) AS bin, CAST(b.lo AS BIGINT) AS lo,
       CAST(coalesce(sum(CASE WHEN s._v >= b.lo AND (s._v < b.hi {cond_last}) THEN s._w END), 0) AS BIGINT) AS {count}
FROM ({groups}) g
CROSS JOIN {bins_table(edges, drop_first)}
LEFT JOIN (SELECT {k + ',' if keys else ''} {v} AS _v, {w} AS _w FROM ({src}) q WHERE ({value}) IS NOT NULL) s
  ON {join_keys} AND s._v >= b.lo AND s._v <= b.hi
GROUP BY {kg + ',' if keys else ''} b.bin, b.lo
"""


def summary_sql(src: str, keys: Sequence[str], value: str, prefix: str, with_sum: bool = True,
                sum_type: str = "BIGINT", with_count: bool = False) -> str:
    k = ", ".join(keys)
    cols = []
    if with_count:
        cols.append(f"CAST(count({value}) AS BIGINT) AS {prefix}_cnt")
    if with_sum:
        cols.append(f"CAST(sum({value}) AS {sum_type}) AS {prefix}_sum")
    cols += [f"{r3(f'avg({value})')} AS {prefix}_avg",
             f"{r3(f'median({value})')} AS {prefix}_med",
             f"{r3(f'stddev_pop({value})')} AS {prefix}_std"]
    return f"SELECT {k + ',' if keys else ''} {', '.join(cols)} FROM ({src}) q WHERE ({value}) IS NOT NULL " + \
        (f"GROUP BY {k}" if keys else "")
