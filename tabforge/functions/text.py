"""String extraction functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnOrName, col

# Patterns that must match the reference's results.
TITLE_PATTERN = r" ([A-Za-z]+)\."
SURNAME_PATTERN = r"([A-Za-z]+),"


def title(name: ColumnOrName) -> Column:
    """H1: honorific before a period; '' when absent."""
    return F.regexp_extract(col(name), TITLE_PATTERN, 1)


def surname(name: ColumnOrName) -> Column:
    """H2: last ASCII-letter run before a comma; '' when absent."""
    return F.regexp_extract(col(name), SURNAME_PATTERN, 1)


def title_by_split(name: ColumnOrName) -> Column:
    """H3: text after the first comma, up to the next period, stripped;
    NULL when there is no comma (``split(',')[1]``).

    ``substring_index`` cuts the segment directly, so a long text is not
    turned into an array of all its comma-separated pieces.
    """
    x = col(name)
    between = F.substring_index(F.substring_index(x, ",", 2), ",", -1)
    return F.when(F.instr(x, ",") > 0, F.trim(F.substring_index(between, ".", 1)))


def surname_by_split(name: ColumnOrName) -> Column:
    """H3: text before the first comma, stripped."""
    return F.trim(F.substring_index(col(name), ",", 1))


def first_char(c: ColumnOrName) -> Column:
    """H4: first character (deck letter of a cabin)."""
    return F.substring(col(c), 1, 1)


def drop_last(c: ColumnOrName, n: int = 2) -> Column:
    """H5: ``s[:-n]``; strings shorter than ``n`` give ''."""
    x = col(c)
    keep = F.greatest(F.length(x) - F.lit(n), F.lit(0))
    return F.substring(x, F.lit(1), keep)


def plain_number(c: ColumnOrName) -> Column:
    """Text of a value as the reference prints it: doubles from 1e-4 up to 1e16 without an
    exponent ("10000000.0", "0.0001"), others with a signed exponent of two digits or more
    ("1e-05", "1e+16"); values of other types as their plain cast."""
    x = col(c)
    text = x.cast("string")
    size = F.abs(text.try_cast("double"))
    digits = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.regexp_extract(text, "^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, "E(-?)([0-9]+)$", 2)
    sign = F.when(F.regexp_extract(text, "E(-?)([0-9]+)$", 1) == "-", "-").otherwise("+")
    wide = F.concat(mantissa, F.lit("e"), sign, F.lpad(power, F.greatest(F.lit(2), F.length(power)), F.lit("0")))
    shown = F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(wide)
    is_float = F.typeof(x).isin("double", "float")
    return F.when(is_float & text.contains("E"), shown).otherwise(text)


def composite_key(*cols: ColumnOrName, sep: str = "-", missing: str = "nan") -> Column:
    """H6: stringify columns and join with ``sep``; NULL prints as ``missing``
    (``concat_ws`` alone would skip it), doubles as in ``plain_number``."""
    parts = [F.coalesce(plain_number(c), F.lit(missing)) for c in cols]
    return F.concat_ws(sep, *parts)


def sentinel_key(key: ColumnOrName, cond: Column, sentinel: str = "Alone") -> Column:
    """H7: rewrite a key to the sentinel where ``cond`` holds."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(sentinel)).otherwise(col(key))
