"""Symbol text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUOTE = "USDT"


def symbol_list(text: str) -> list[str]:
    """The symbols named in a comma-separated argument: trimmed, upper case, blanks dropped."""
    return [name for name in (part.strip().upper() for part in text.split(",")) if name]


def symbols_in(text: Column) -> Column:
    """`symbol_list` as an array expression."""
    names = F.transform(F.split(text, ","), lambda part: F.upper(F.trim(part)))
    return F.filter(names, lambda name: name != "")


def base_asset(symbol: Column) -> Column:
    """Every occurrence of the quote text goes, as long as the symbol ends with it."""
    return F.when(symbol.endswith(QUOTE), F.replace(symbol, F.lit(QUOTE), F.lit(""))).otherwise(symbol)


def quote_asset(symbol: Column) -> Column:
    return F.when(symbol.endswith(QUOTE), F.lit(QUOTE))
