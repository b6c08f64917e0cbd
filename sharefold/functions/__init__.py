"""Column expressions; each takes and returns Spark columns."""

from sharefold.functions.clock import as_of_ms, bj_to_epoch, date_head, epoch_to_bj
from sharefold.functions.text import (
    anchor_head,
    anchor_url,
    decode_body,
    first_cell_text,
    span_texts,
    unwrap_assignment,
    unwrap_jsonp,
)
from sharefold.functions.urls import query_string, url_param
from sharefold.functions.values import (
    code_label,
    exchange_symbol,
    is_decimal_text,
    scale_ratio,
    share_id,
    to_bigint,
    to_double,
    zero_if_null,
)

__all__ = [
    "anchor_head",
    "anchor_url",
    "as_of_ms",
    "bj_to_epoch",
    "code_label",
    "date_head",
    "decode_body",
    "epoch_to_bj",
    "exchange_symbol",
    "first_cell_text",
    "is_decimal_text",
    "query_string",
    "scale_ratio",
    "share_id",
    "span_texts",
    "to_bigint",
    "to_double",
    "unwrap_assignment",
    "unwrap_jsonp",
    "url_param",
    "zero_if_null",
]
