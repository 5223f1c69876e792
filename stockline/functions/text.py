"""Text helpers with the reference's missing-value semantics made explicit."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse_ws(x) -> Column:
    """Collapse every whitespace run to one blank, then trim."""
    return F.trim(F.regexp_replace(_c(x), r"\s+", " "))


def concat_blank(*parts) -> Column:
    """T-SQL CONCAT: a NULL part counts as '' (T2, X2)."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


def split_part(x, delim: str, n: int) -> Column:
    """Part ``n`` (0-based) of ``x`` split on the literal ``delim``; NULL when
    absent instead of an ANSI error (T9, X5)."""
    return F.get(F.split(_c(x), re.escape(delim)), n)


def zero_pad(x, width: int) -> Column:
    """Zeros in front up to ``width`` characters; a longer text stays whole
    (``lpad`` alone would cut it)."""
    t = _c(x).cast("string")
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def base_code(sku) -> Column:
    """Base code of a variant sku: the text before the first '-' (sku_2)."""
    return F.substring_index(_c(sku), "-", 1)


def title_case(x) -> Column:
    """Python ``str.title()``: upper-case the first letter after every
    non-letter, lower-case the rest (T8). ``initcap`` only splits on blanks."""
    pieces = F.split(F.lower(_c(x)), r"(?<=[^\p{L}])")
    cap = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.when(_c(x).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def phone_digits(x) -> Column:
    """Phone text such as '5511900000001.0' → '+5511900000001' via
    float → int → text, truncating like ``int(float(x))`` (X9)."""
    n = _c(x).try_cast("double").cast("bigint")
    return F.when(n.isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.lit("+"), n.cast("string")))


def clean_text(x) -> Column:
    """'nan', NULL, None → ''; otherwise the text without whitespace of any
    kind at its ends (X26)."""
    t = F.regexp_replace(_c(x), r"^\s+|\s+$", "")
    return F.when(F.lower(t) == "nan", F.lit("")).otherwise(F.coalesce(t, F.lit("")))


def two_decimals(x) -> Column:
    """Fixed two-decimal text without grouping commas."""
    return F.format_string("%.2f", _c(x).cast("double"))
