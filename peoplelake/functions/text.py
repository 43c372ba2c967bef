"""Text formatting. Formats are SQL expression templates, so a whole narrative is one parsed expression."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text of a missing number, the Indian units for money, and the longest id.
MISSING = "n/a"
CRORE, LAKH = "1e7", "1e5"
ID_LENGTH = 512


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# ``format_number`` rounds half-even on the binary value, as C ``printf`` does.
def fixed_sql(c: str, digits: int) -> str:
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return f"format_number(CAST({c} AS DOUBLE), '{pattern}')"


def whole_sql(c: str) -> str:
    """Integer, 0 when missing or unparseable."""
    return f"coalesce(try_cast({c} AS BIGINT), 0L)"


def percent_sql(c: str, digits: int = 1) -> str:
    return f"coalesce(concat({fixed_sql(f'CAST({c} AS DOUBLE) * 100', digits)}, '%'), '{MISSING}')"


def money_sql(c: str, currency: str = "INR") -> str:
    v = f"CAST({c} AS DOUBLE)"
    return (
        f"coalesce(concat({quoted(currency + ' ')}, CASE WHEN {v} >= {CRORE} THEN concat({fixed_sql(f'{v} / {CRORE}', 2)}, ' Cr') "
        f"WHEN {v} >= {LAKH} THEN concat({fixed_sql(f'{v} / {LAKH}', 2)}, ' L') ELSE format_number({v}, 0) END), '{MISSING}')"
    )


FORMATS = {
    "": lambda c: f"CAST({c} AS STRING)",
    "int": lambda c: f"CAST({whole_sql(c)} AS STRING)",
    "grouped": lambda c: f"format_number({whole_sql(c)}, 0)",
    "pct": percent_sql,
    "money": money_sql,
    "f2": lambda c: fixed_sql(c, 2),
    "signed1": lambda c: f"concat(CASE WHEN {c} >= 0 THEN '+' ELSE '' END, {fixed_sql(c, 1)})",
}


def render_sql(template: str) -> str:
    """SQL text that fills the ``{column:format}`` slots of a template; a missing plain value reads ``None``."""
    pieces: list[str] = []
    for literal, field, spec, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(quoted(literal))
        if field is not None:
            pieces.append(f"coalesce({FORMATS[spec or ''](field)}, 'None')")
    return f"concat({', '.join(pieces)})"


def render(template: str) -> Column:
    return F.expr(render_sql(template))


def money(c: str, currency: str = "INR") -> Column:
    """Money text of a SQL expression: crore and lakh units, else thousands-separated."""
    return F.expr(money_sql(c, currency))


def percent(c: str, digits: int = 1) -> Column:
    return F.expr(percent_sql(c, digits))


def whole(c: str) -> Column:
    return F.expr(whole_sql(c))


def stable_id_sql(*parts: str, **named: str) -> str:
    """Dot-joined segments, then ``key=value`` segments in key order, spaces as underscores.

    An id of over 512 characters keeps its head and ends in a hash of the whole, so different ids stay different.
    """
    segments = [quoted(p) for p in parts]
    segments += [f"concat({quoted(k + '=')}, coalesce(CAST({named[k]} AS STRING), 'None'))" for k in sorted(named)]
    whole = f"replace(concat_ws('.', {', '.join(segments)}), ' ', '_')"
    return f"if(length({whole}) <= {ID_LENGTH}, {whole}, concat(substring({whole}, 1, {ID_LENGTH - 33}), '~', md5({whole})))"


def stable_id(*parts: str, **named: str) -> Column:
    """Chunk id from literal parts and named SQL expressions."""
    return F.expr(stable_id_sql(*parts, **named))


def plain(c: Column, dtype: str) -> Column:
    """Value as a reader expects it; doubles never in scientific notation."""
    if dtype == "double":
        wide = F.call_function("format_number", c, F.lit("0.0###############"))
        return F.when(F.abs(c) < 1e7, c.cast("string")).otherwise(wide)
    return c.cast("string")


def fixed_point(c: Column, digits: int) -> Column:
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", c.cast("double"), F.lit(pattern))


def squash_whitespace_ends(c: Column) -> Column:
    """Strip every kind of whitespace from both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")
