"""Text, code and amount-formatting expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_blank(col: Column | str) -> Column:
    """True for NULL and for the empty string."""
    return _c(col).isNull() | (_c(col) == "")


def any_like(col: Column | str, patterns: Iterable[str]) -> Column:
    """True when the column matches one of the LIKE patterns; NULL counts as no match."""
    test = F.lit(False)
    for pattern in patterns:
        test = test | _c(col).like(pattern)
    return F.coalesce(test, F.lit(False))


def map_codes(col: Column | str, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Translate codes; unknown codes and NULL become ``default``."""
    items = list(mapping.items())
    expr = F.when(_c(col) == items[0][0], F.lit(items[0][1]))
    for code, text in items[1:]:
        expr = expr.when(_c(col) == code, F.lit(text))
    return expr.otherwise(F.lit(default))


def mask_if(flag: Column, col: Column | str, mask: str = "XXXXXXXX") -> Column:
    return F.when(flag, F.lit(mask)).otherwise(_c(col))


def implied_decimal(col: Column | str, precision: int = 26, scale: int = 4) -> Column:
    """Amount without its decimal point.

    NULL becomes zero (``00000`` at scale 4); a number too large for the type becomes NULL.
    """
    kind = f"decimal({precision},{scale})"
    value = F.when(_c(col).isNull(), F.lit(0).cast(kind)).otherwise(_c(col).try_cast(kind))
    return F.replace(value.cast("string"), F.lit("."), F.lit(""))


def format_amount(col: Column | str, scale: int = 2, precision: int = 17, default: str = "0.00") -> Column:
    """Rounded amount with thousands separators."""
    return F.coalesce(F.format_number(_c(col).cast(f"decimal({precision},{scale})"), scale), F.lit(default))


def number_from_text(col: Column | str, precision: int = 26, scale: int = 4) -> Column:
    """Numeric value of text; blank or dirty text becomes NULL instead of failing."""
    return _c(col).try_cast(f"decimal({precision},{scale})")


def sum_text(col: Column | str, precision: int = 26, scale: int = 4) -> Column:
    """Sum of a text column that holds numbers and blanks."""
    return F.sum(number_from_text(col, precision, scale)).cast(f"decimal({precision},{scale})")


def token(col: Column | str, sep: str, index: int) -> Column:
    """0-based token of separated text, NULL beyond the end."""
    return F.get(F.split(_c(col), re.escape(sep), -1), F.lit(index))


def first_token(col: Column | str, sep: str = ",") -> Column:
    return F.substring_index(_c(col), sep, 1)


def last_token(col: Column | str, sep: str = ",") -> Column:
    """Text after the last separator; empty when there is no separator."""
    return F.when(F.instr(_c(col), sep) > 0, F.substring_index(_c(col), sep, -1)).otherwise(F.lit(""))


def title_lines(col: Column | str, count: int = 4, width: int = 60) -> list[Column]:
    """Cut a title in ``count`` lines of at most ``width`` characters.

    A title with line breaks is cut at them; a title without is cut in fixed slices.
    """
    title = _c(col)
    broken = F.instr(title, "\n") > 0
    return [
        F.when(broken, F.substring(token(title, "\n", i), 1, width)).otherwise(
            F.substring(title, i * width + 1, width)
        )
        for i in range(count)
    ]


def join_nonblank(cols: Sequence[Column | str], sep: str = ",") -> Column:
    """Join the non-blank parts; NULL and '' are skipped alike."""
    return F.concat_ws(sep, *[F.nullif(_c(c), F.lit("")) for c in cols])


def strip_chars(col: Column | str, chars: str) -> Column:
    return F.translate(_c(col), chars, "")


def day_span(days: Column, start: Column | str, end: Column | str) -> Column:
    """Opening-hours text of an array of (number, name) structs: ``Mon to Fri - 9 to 17``.

    The first and last day are taken by weekday number, not by the order of collection.
    """
    ordered = F.array_sort(days)
    first = F.element_at(ordered, 1)["name"]
    last = F.element_at(ordered, -1)["name"]
    span = F.when(F.size(ordered) > 1, F.concat(first, F.lit(" to "), last)).otherwise(first)
    return F.concat(span, F.lit(" - "), _c(start), F.lit(" to "), _c(end))
