"""Request addresses as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(value: object) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def query_string(base: Column | str, params: Mapping[str, object], encode: bool = False) -> Column:
    """``base?k=v&k=v`` in the order of ``params``; values may be columns."""
    base = base if isinstance(base, Column) else F.lit(base)
    pairs = []
    for name, value in params.items():
        text = _text(value)
        pairs.append(F.concat(F.lit(f"{name}="), F.url_encode(text) if encode else text))
    return F.concat(base, F.lit("?"), F.concat_ws("&", *pairs))


def url_param(url: Column | str, name: str, value: object) -> Column:
    """The address with one parameter's value replaced, of whatever form; unchanged when it has no such parameter."""
    url = F.col(url) if isinstance(url, str) else url
    literal = F.regexp_replace(_text(value), r"([\\$])", r"\\$1")
    return F.regexp_replace(url, F.lit(rf"(?<=[?&]\Q{name}\E=)[^&#]*"), literal)
