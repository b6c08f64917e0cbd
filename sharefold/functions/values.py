"""Numbers, ratios, codes and exchange prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal text that a gated ratio must match, progress labels, exchange prefixes.
DECIMAL_TEXT = r"^[-+]?[0-9]+\.[0-9]+$"
PROGRESS_LABELS = {
    "001": "董事会预案",
    "002": "股东大会通过",
    "003": "股东大会否决",
    "004": "实施中",
    "005": "停止实施",
    "006": "完成实施",
}
PROGRESS_DEFAULT = "未定义"
EXCHANGE_PREFIXES = {"1": "SH", "2": "SZ"}

# Spark prints a JSON number of magnitude under 1e-3 or from 1e7 with an exponent. The feeds' own text form of
# the same number keeps twelve digits, so it is plain decimal from 1e-4 up to 1e12; those still count as decimal text.
_EXPONENT_TEXT = r"^[-+]?[0-9]\.[0-9]+E-?[0-9]+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_double(value: Column | str) -> Column:
    return _col(value).try_cast("double")


def to_bigint(value: Column | str) -> Column:
    return _col(value).try_cast("bigint")


def zero_if_null(value: Column | str) -> Column:
    """Missing epoch counts as 0, that is 1970-01-01 08:00 Beijing."""
    return F.coalesce(_col(value), F.lit(0).cast("bigint"))


def is_decimal_text(text: Column | str, from_json: bool = False) -> Column:
    """Is the text digits, a point and digits? ``from_json`` allows for Spark's spelling of JSON numbers."""
    text = _col(text)
    plain = text.rlike(DECIMAL_TEXT)
    if not from_json:
        return plain
    size = F.abs(text.try_cast("double"))
    return plain | (text.rlike(_EXPONENT_TEXT) & (size >= F.lit(1e-4)) & (size < F.lit(1e12)))


def scale_ratio(text: Column | str, gated: bool = False, from_json: bool = False) -> Column:
    """Fraction to percent. Gated: only decimal text is multiplied, any other number passes as it is."""
    text = _col(text)
    number = text.try_cast("double")
    percent = number * F.lit(100.0)
    if not gated:
        return percent
    return F.when(is_decimal_text(text, from_json), percent).otherwise(number)


def code_label(code: Column | str, labels: dict[str, str] | None = None, default: str = PROGRESS_DEFAULT) -> Column:
    """Label of a code; unknown and missing codes get ``default``."""
    table = PROGRESS_LABELS if labels is None else labels
    code = _col(code)
    label = F.lit(default)
    for key, text in table.items():
        label = F.when(code == key, F.lit(text)).otherwise(label)
    return label


def exchange_symbol(code: Column | str, kind: Column | str) -> Column:
    """Exchange prefix and code; NULL for a type that is not listed, which callers reject."""
    kind = _col(kind).cast("string")
    prefix = F.lit(None).cast("string")
    for key, text in EXCHANGE_PREFIXES.items():
        prefix = F.when(kind == key, F.lit(text)).otherwise(prefix)
    return F.concat(prefix, _col(code).cast("string"))


def share_id(code: Column | str, kind: Column | str) -> Column:
    """Code followed by type, the share id of the flow feed."""
    return F.concat(_col(code).cast("string"), _col(kind).cast("string"))
