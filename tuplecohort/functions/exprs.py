"""Tuple expressions: ``$i`` strings or Python callables.

An expression is evaluated once per tuple.  It can be written two ways:

* a Python callable taking the tuple's ``values`` Column (``ARRAY<DOUBLE>``)
  and returning a Column, e.g. ``lambda v: (slot(v, 0) >= 4) & (slot(v, 1) > 0)``;
* a string in which ``$0``, ``$1`` ... name the tuple slots, e.g.
  ``"$0 >= 4 && $1 > 0"``.  The rest of the string is Spark SQL; bare names
  refer to other columns of the same row (outer references).

The string helper only rewrites tokens, outside quoted text: ``$i`` becomes a
null-safe slot read (null when the slot does not exist), ``&&``, ``||`` and a
lone ``!`` become ``AND``, ``OR`` and ``NOT`` with operands taken as conditions
(true, or a number > 0), ``/`` a division that gives null for a zero divisor,
and a double-quoted name a back-quoted identifier.  Everything else is parsed
and type-checked by Spark itself.

Result coercion follows the aggregation's rules: a filter keeps a tuple when
its result is true or a number > 0 (null and NaN keep nothing); a collapse turns
a null result into 0.0.  NaN follows Spark inside a comparison: it is larger
than any number.
"""

from __future__ import annotations

import re
from typing import Callable, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

TupleExpr = Union[str, Callable[[Column], Column]]

_TOKEN = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"[^"]*"|`(?:[^`]|``)*`|\$\d+|&&|\|\||!(?!=)|/|[(),]"""
                    r"""|[\w.]+|\s+|.""", re.S)


def slot(values: Column, i: int) -> Column:
    """Slot ``i`` of a tuple, null when out of range (never an error)."""
    return F.get(values, i)


def to_spark_sql(expr: str, values_sql: str) -> str:
    """Rewrite a ``$i`` expression into Spark SQL over the array ``values_sql``."""
    if not isinstance(expr, str) or not expr.strip():
        raise ValueError("expression must be a non-empty string")
    tokens = [_one(t, values_sql) for t in _TOKEN.findall(expr)]
    out, rest = _level(tokens, 0)
    return out + "".join(tokens[rest:])


def _one(token: str, values_sql: str) -> str:
    if token.startswith('"'):
        return "`" + token[1:-1].replace("`", "``") + "`"
    if token.startswith("$") and token[1:].isdigit():
        return f"get({values_sql}, {int(token[1:])})"
    return token


def _level(tokens: list[str], at: int) -> tuple[str, int]:
    """The tokens up to the closing bracket of this level; operands of a logical sign become conditions."""
    parts, operand, signs = [], [], 0

    def close() -> str:
        text = "".join(operand)
        body = text.strip()
        negations = 0
        while body.startswith("!"):
            body, negations = body[1:].strip(), negations + 1
        if not body or not (signs or negations):
            return text
        return "NOT " * negations + truthy_sql(body)

    while at < len(tokens) and tokens[at] != ")":
        t = tokens[at]
        if t in ("&&", "||"):
            signs += 1
            parts += [close(), " AND " if t == "&&" else " OR "]
            operand = []
        elif t == ",":
            parts += [close(), ","]
            operand, signs = [], 0
        elif t == "(":
            inner, at = _level(tokens, at + 1)
            operand.append(f"({inner})")
        elif t == "/":
            divisor, at = _primary(tokens, at + 1)
            operand.append(f"/ nullif({divisor}, 0)" if divisor else "/")
            continue
        else:
            operand.append(t)
        at += 1
    return "".join(parts) + close(), at


def _primary(tokens: list[str], at: int) -> tuple[str, int]:
    """The number, name, slot, call or bracket that starts at ``at``."""
    while at < len(tokens) and tokens[at].isspace():
        at += 1
    sign = ""
    while at < len(tokens) and tokens[at] in "+-":
        sign, at = sign + tokens[at], at + 1
    out = ""
    if at < len(tokens) and tokens[at] not in ("(", ")", ","):
        out, at = tokens[at], at + 1
    if at < len(tokens) and tokens[at] == "(":
        inner, at = _level(tokens, at + 1)
        out, at = f"{out}({inner})", at + 1
    return sign + out if out else "", at


def truthy_sql(sql: str) -> str:
    return f"coalesce(nanvl(CAST(({sql}) AS DOUBLE), CAST(0 AS DOUBLE)) > 0, false)"


def as_double_sql(sql: str) -> str:
    return f"coalesce(CAST(({sql}) AS DOUBLE), CAST(0 AS DOUBLE))"


def truthy(c: Column) -> Column:
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)) > 0, F.lit(False))


def as_double(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def predicate_on(values_name: str, expr: TupleExpr) -> Column:
    """Boolean Column of ``expr`` over the array column named ``values_name``."""
    if callable(expr):
        return truthy(expr(F.col(values_name)))
    return F.expr(truthy_sql(to_spark_sql(expr, _quote(values_name))))


def value_on(values_name: str, expr: TupleExpr) -> Column:
    """Double Column of ``expr`` over the array column named ``values_name``."""
    if callable(expr):
        return as_double(expr(F.col(values_name)))
    return F.expr(as_double_sql(to_spark_sql(expr, _quote(values_name))))


def _quote(name: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))
