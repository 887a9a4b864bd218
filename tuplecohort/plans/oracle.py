"""Plain-SQL twins of the registered queries, for DuckDB.

Small text helpers that spell out a bottom-k tuple sketch in ordinary SQL
(window functions and joins), so every Spark query can be checked against an
engine that knows nothing about sketches.  The md5 key hash is computed the
same way by both engines (first 15 hex digits of ``md5(key)``).
"""

from __future__ import annotations

from typing import Sequence

T60 = 1 << 60  # fixed value: theta scale of the sketch format


def md5_60(k: str) -> str:
    return f"('0x' || substr(md5({k}), 1, 15))::BIGINT"


def est(n: str, theta: str) -> str:
    return (f"round(CAST({n} AS DOUBLE) / (CAST({theta} AS DOUBLE) / "
            f"CAST({T60} AS DOUBLE)), 6)")


def nse(a: str, b: str, cols: Sequence[str]) -> str:
    if not cols:
        return "TRUE"
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def _lst(cols: Sequence[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in cols)


def build(name: str, src: str, groups: Sequence[tuple[str, str]], key: str,
          metrics: Sequence[tuple[str, str]], k: int, key_is_list: bool = False) -> str:
    """CTEs ``{name}_th (groups..., theta)`` and ``{name}_e (groups..., h, v0..)``.

    ``groups``: (SQL expression, alias); ``metrics``: (value expression, predicate)."""
    g = [a for _, a in groups]
    gsel = "".join(f"{e} AS {a}, " for e, a in groups)
    ok = " AND ".join(f"({v}) IS NOT NULL" for v, _ in metrics)
    ms = ", ".join(f"CASE WHEN {p} THEN CAST({v} AS DOUBLE) ELSE 0.0 END AS m{i}"
                   for i, (v, p) in enumerate(metrics))
    if key_is_list:
        base = f"(SELECT *, UNNEST(CASE WHEN {key} IS NULL OR len({key}) = 0 THEN [NULL] ELSE {key} END) AS __kv FROM {src})"
        kv = "CAST(__kv AS VARCHAR)"
    else:
        base = src
        kv = f"CAST({key} AS VARCHAR)"
    vs = ", ".join(f"sum(m{i}) AS v{i}" for i in range(len(metrics)))
    ve = ", ".join(f"v{i}" for i in range(len(metrics)))
    gby = (_lst(g) + ", ") if g else ""
    part = f"PARTITION BY {_lst(g)} " if g else ""
    return f"""{name}_rows AS (
  SELECT {gsel}CASE WHEN {ok} AND {kv} IS NOT NULL AND {kv} <> '' THEN {kv} END AS k, {ms}
  FROM {base}),
{name}_g AS (SELECT DISTINCT {_lst(g) if g else '0 AS __one'} FROM {name}_rows),
{name}_t AS (SELECT {gby}{md5_60('k')} AS h, {vs} FROM {name}_rows WHERE k IS NOT NULL GROUP BY {gby}k),
{name}_r AS (SELECT *, row_number() OVER ({part}ORDER BY h) AS rn FROM {name}_t),
{name}_th AS (SELECT {_lst(g, 'gg.') + ', ' if g else ''}COALESCE(max(CASE WHEN r.rn = {k + 1} THEN r.h END), {T60}) AS theta
  FROM {name}_g gg LEFT JOIN {name}_r r ON {nse('gg', 'r', g)} GROUP BY {_lst(g, 'gg.') if g else 'ALL'}),
{name}_e AS (SELECT {gby}h, {ve} FROM {name}_r WHERE rn <= {k})"""


def merge(name: str, parts: str, groups: Sequence[str], n_values: int, k: int) -> str:
    """Merge sketches held in CTEs ``{parts}_th`` / ``{parts}_e`` (which may carry
    extra part columns) down to ``groups``; yields ``{name}_th`` and ``{name}_e``."""
    g = list(groups)
    vs = ", ".join(f"sum(e.v{i}) AS v{i}" for i in range(n_values))
    ve = ", ".join(f"v{i}" for i in range(n_values))
    gby = (_lst(g) + ", ") if g else ""
    part = f"PARTITION BY {_lst(g)} " if g else ""
    return f"""{name}_mt AS (SELECT {gby}min(theta) AS mt FROM {parts}_th GROUP BY {_lst(g) if g else 'ALL'}),
{name}_u AS (SELECT {_lst(g, 'e.') + ', ' if g else ''}e.h, {vs} FROM {parts}_e e JOIN {name}_mt m ON {nse('e', 'm', g)}
  WHERE e.h < m.mt GROUP BY {_lst(g, 'e.') + ', ' if g else ''}e.h),
{name}_r AS (SELECT *, row_number() OVER ({part}ORDER BY h) AS rn FROM {name}_u),
{name}_th AS (SELECT {_lst(g, 'm.') + ', ' if g else ''}COALESCE(max(CASE WHEN r.rn = {k + 1} THEN r.h END), m.mt) AS theta
  FROM {name}_mt m LEFT JOIN {name}_r r ON {nse('m', 'r', g)} GROUP BY {_lst(g, 'm.') + ', ' if g else ''}m.mt),
{name}_e AS (SELECT {gby}h, {ve} FROM {name}_r WHERE rn <= {k})"""


def estimate(name: str, groups: Sequence[str], cond: str | None = None,
             extra: Sequence[tuple[str, str]] = ()) -> str:
    """``groups..., est_keys, retained, theta [, extra...]`` of sketch ``name``,
    optionally filtered by ``cond`` over ``v0, v1, ...`` (theta resets when
    nothing survives).  ``extra``: (aggregate over surviving entries ``e``, alias)."""
    g = list(groups)
    c = cond or "TRUE"
    ex_in = "".join(f", {expr} AS {a}" for expr, a in extra)
    ex_out = "".join(f", {a}" for _, a in extra)
    theta = f"CASE WHEN n = 0 THEN {T60} ELSE theta END" if cond else "theta"
    inner = f"""SELECT {_lst(g, 'th.') + ', ' if g else ''}th.theta, count(e.h) AS n{ex_in}
  FROM {name}_th th LEFT JOIN (SELECT * FROM {name}_e WHERE {c}) e ON {nse('th', 'e', g)}
  GROUP BY {_lst(g, 'th.') + ', ' if g else ''}th.theta"""
    return f"""SELECT {_lst(g) + ', ' if g else ''}{est('n', theta)} AS est_keys, CAST(n AS BIGINT) AS retained,
  CAST({theta} AS BIGINT) AS theta{ex_out}
FROM ({inner}) q"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
