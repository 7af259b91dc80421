"""Column helpers that reproduce the source catalog's SQL semantics with
built-in (JVM, codegen-friendly) Spark expressions. No Python UDFs.

S1  NULL || 'x' is 'x'            -> nz_concat
S2  ASC NULLS LAST, DESC NULLS FIRST -> asc_nulls_last / desc_nulls_first
S5  substr(x, 0, n) == substr(x, 1, n) -> substr1
S6  substr(x, p, 0) is NULL, not ''    -> substr1(..., zero_len_is_null=True)
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nz_concat(*parts) -> Column:
    """Concatenation where NULL behaves as empty text (S1).

    Plain strings are literals; pass ``F.col(name)`` for columns.
    """
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("", *cols)


def asc_nulls_last(c) -> Column:
    return _c(c).asc_nulls_last()


def desc_nulls_first(c) -> Column:
    return _c(c).desc_nulls_first()


def trunc_toward_zero(c, scale: int = 0) -> Column:
    """Numeric truncation toward zero at ``scale`` decimals."""
    c = _c(c)
    if scale == 0:
        return F.signum(c) * F.floor(F.abs(c))
    f = 10.0 ** scale
    return F.signum(c) * F.floor(F.abs(c) * f) / f


def number_text(c, fmt: str) -> Column:
    """to_char(number, fmt) for formats of 9s, group commas and one point, e.g.
    ``999,999.9``; ``FM`` in front drops the padding, ``%`` at the end follows
    the number. No zero stands before the point; a number too wide for the
    format is shown as #. NULL stays NULL."""
    percent = "%" if fmt.endswith("%") else ""
    body = fmt.removeprefix("FM").removesuffix("%")
    whole, _, decimals = body.partition(".")
    if not re.fullmatch(r"9[9,]*", whole) or not re.fullmatch(r"9*", decimals):
        raise ValueError(f"unsupported number format {fmt!r}")
    n = F.round(_c(c).cast("decimal(38,10)"), len(decimals))
    text = F.format_number(n, len(decimals))
    if "," not in whole:
        text = F.replace(text, F.lit(","), F.lit(""))
    if decimals:
        text = F.regexp_replace(text, r"^(-?)0\.", "$1.")
    width = len(body) + 1                                   # a place for the sign
    text = F.when(F.abs(n) >= F.lit(10 ** whole.count("9")), "#" * width).otherwise(text)
    return F.concat(text if fmt.startswith("FM") else F.lpad(text, width, " "), F.lit(percent))


def substr1(c, pos: int, length: int | None = None, zero_len_is_null: bool = True) -> Column:
    """substr with position 0 treated as 1 (S5) and, by default, a
    zero length giving NULL rather than '' (S6)."""
    c = _c(c)
    p = 1 if pos == 0 else pos
    if length is None:
        return F.substring(c, p, 2147483647)
    if length <= 0:
        return F.lit(None).cast("string") if zero_len_is_null else F.lit("")
    return F.substring(c, p, length)


def before_last(c, sep: str) -> Column:
    """Text before the last ``sep``; NULL when ``sep`` does not occur."""
    c = _c(c)
    parts = F.split(c, re.escape(sep))
    return F.when(F.instr(c, sep) > 0,
                  F.array_join(F.slice(parts, 1, F.size(parts) - 1), sep))


def after_last(c, sep: str) -> Column:
    """Text after the last ``sep``; the whole text when absent."""
    return F.substring_index(_c(c), sep, -1)


def is_yes(c) -> Column:
    return F.upper(F.trim(_c(c))).isin("YES", "Y", "TRUE", "ENABLED")


def quoted(c) -> Column:
    """Wrap text in single quotes (for remedy strings)."""
    return nz_concat("'", _c(c), "'")
