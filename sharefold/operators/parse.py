"""Landed bodies to typed item rows: decode, unwrap, read the envelope, one row per unit, project fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold import feeds as fd
from sharefold.feeds import FeedSpec, Field
from sharefold.functions import (
    anchor_head,
    anchor_url,
    decode_body,
    epoch_to_bj,
    first_cell_text,
    scale_ratio,
    span_texts,
    to_bigint,
    to_double,
    unwrap_assignment,
    unwrap_jsonp,
    zero_if_null,
)
from sharefold.functions.clock import MINUTE_PATTERN, SECOND_PATTERN
from sharefold.functions.text import first_match
from sharefold.session import jvm_charsets

LENIENT_JSON = {
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "allowComments": "true",
    "allowUnquotedControlChars": "true",
    "allowBackslashEscapingAnyCharacter": "true",
}

# A comma before a closing bracket, outside strings (which are matched first and kept).
_TRAILING = r",\s*[\]}]"
_STRING_OR_TRAILING = r"""("(?:[^"\\]|\\[\s\S])*+"|'(?:[^'\\]|\\[\s\S])*+')|,(?=\s*[\]}])"""

# What a page can be: fine, worth asking for again, or of a changed shape.
OK, REFETCH, BAD_SHAPE = "ok", "refetch", "bad_shape"

LINEAGE = ("feed", "url", "fetched_at", "page_no", "page_size", "share_code")
COUNTERS = ("total_rows", "total_pages", "reported_page", "reported_size")


def envelope_schema(spec: FeedSpec) -> str:
    """DDL of a feed's envelope. Leaves are text, so one odd value never costs the rest of its row."""
    if spec.unit == "positional":
        element = "array<array<string>>" if spec.nested else "array<string>"
    else:
        keys = dict.fromkeys(str(f.source) for f in spec.fields if f.source not in (None, ""))
        element = "array<struct<" + ", ".join(f"`{k}`: string" for k in keys) + ">>"
    counters = "".join(f", `{theirs}` bigint" for _, theirs in spec.counters)
    return f"`{spec.array}` {element}{counters}"


def lenient_json(text: Column | str, schema: str) -> Column:
    """JSON text as a struct; fields are NULL where the text is no such JSON. Bare and single-quoted keys, comments,
    control characters in strings, needless escapes and trailing commas are read."""
    text = F.col(text) if isinstance(text, str) else text
    text = F.when(text.rlike(_TRAILING), F.regexp_replace(text, _STRING_OR_TRAILING, "$1")).otherwise(text)
    return F.from_json(text, schema, LENIENT_JSON)


def body_text(spec: FeedSpec, body: Column | str = "body") -> Column:
    """Unwrapped text of the body column in a feed's charset and wrapper. To be selected within ``jvm_charsets``."""
    text = decode_body(body, spec.charset, jvm_charsets=True)
    if spec.wrapper == "jsonp":
        return unwrap_jsonp(text)
    if spec.wrapper == "assignment":
        return unwrap_assignment(text)
    return text


def parse_envelope(df: DataFrame, spec: FeedSpec, body: str = "body") -> DataFrame:
    """Replaces the body by ``units`` (array), the paging counters and ``page_state``."""
    if spec.unit == "html":
        return _parse_html(df, spec, body)
    kept = [c for c in df.columns if c != body]
    with jvm_charsets(df.sparkSession):
        read = df.select(*kept, lenient_json(body_text(spec, body), envelope_schema(spec)).alias("_env"))
    ours = {name: F.col(f"_env.`{theirs}`") for name, theirs in spec.counters}
    # A body that is not the feed's JSON gives a struct of NULLs, so the test is on what every good page carries.
    required = list(ours.values()) or [F.col(f"_env.`{spec.array}`")]
    present = required[0].isNotNull()
    for column in required[1:]:
        present = present & column.isNotNull()
    units = F.col(f"_env.`{spec.array}`")
    good = _fetched(df) & F.coalesce(present, F.lit(False))
    return read.select(
        *kept,
        *[ours[c].alias(c) if c in ours else F.lit(None).cast("bigint").alias(c) for c in COUNTERS],
        F.when(good, F.lit(OK)).otherwise(F.lit(REFETCH)).alias("page_state"),
        F.when(good, F.get(units, F.lit(0)) if spec.nested else units).alias("units"),
    )


def _fetched(df: DataFrame) -> Column:
    return F.coalesce(F.col("status"), F.lit(200)) == 200 if "status" in df.columns else F.lit(True)


def _with_table(df: DataFrame, text: Column, table_id: str, *kept: str) -> DataFrame:
    """``kept`` and ``_table``, the inner text of the table with this id: NULL where it is not there or has no end.

    A table inside it is no part of its rows, its cells' own texts or their spans. It is taken out and leaves a line break,
    so that the texts around it stay apart. How deep a piece lies is the running sum of tags that open and close a table.
    """
    opening = rf"(?is)<table[^>]*\bid\s*=\s*[\"']?{table_id}(?![\w-])[\"']?[^>]*>(.*)$"
    pieces = df.select(*kept, F.split(first_match(text, opening), r"(?i)(?=</?table\b)", -1).alias("_pieces"))
    step = F.transform("_pieces", lambda p: F.when(p.rlike(r"(?i)^</table\b"), -1).when(p.rlike(r"(?i)^<table\b"), 1).otherwise(0))
    steps = pieces.select(*kept, "_pieces", step.alias("_steps"))
    depth = F.transform("_steps", lambda _, i: F.aggregate(F.slice("_steps", 1, i + 1), F.lit(1), lambda d, s: d + s))
    depths = steps.select(*kept, "_pieces", depth.alias("_depths"))
    end = F.array_position("_depths", 0).cast("int")
    own = F.transform(
        F.slice("_pieces", 1, end - 1),
        lambda p, i: F.when(F.get("_depths", i) == 1, F.regexp_replace(p, r"(?i)^</table\b", "<br")).otherwise(F.lit("")),
    )
    return depths.select(*kept, F.when(end > 0, F.array_join(own, "")).alias("_table"))


def html_rows(table: Column) -> tuple[Column, Column]:
    """Header count and array of body rows of one table's inner text. End tags may be missing, as HTML allows: a part
    ends where the next one begins."""
    head = F.regexp_extract(table, r"(?is)<thead\b[^>]*>(.*?)(?=</thead\b|<tbody\b|\z)", 1)
    body = F.regexp_extract(table, r"(?is)<tbody\b[^>]*>(.*?)(?=</tbody\b|<tbody\b|\z)", 1)
    headers = F.size(F.regexp_extract_all(head, F.lit(r"(?i)(<th\b)"), F.lit(1)))
    rows = F.regexp_extract_all(body, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr\b|<tr\b|\z)"), F.lit(1))
    return headers, rows


def _parse_html(df: DataFrame, spec: FeedSpec, body: str) -> DataFrame:
    kept = [c for c in df.columns if c != body]
    with jvm_charsets(df.sparkSession):
        read = _with_table(df, body_text(spec, body), fd.NOTICE_TABLE_ID, *kept)
    headers, rows = html_rows(F.col("_table"))
    read = read.select(*kept, headers.alias("_headers"), rows.alias("_rows"))
    shaped = F.col("_headers") == fd.NOTICE_COLUMNS
    state = F.when(~_fetched(df), REFETCH).when(shaped, OK).otherwise(BAD_SHAPE)
    return read.select(
        *kept,
        *[F.lit(None).cast("bigint").alias(c) for c in COUNTERS],
        state.alias("page_state"),
        F.when(_fetched(df) & shaped, F.col("_rows")).alias("units"),
    )


def html_table(
    df: DataFrame, html: str, table_id: str, n_cols: int, cells: dict[str, tuple[int, str]]
) -> DataFrame:
    """Rows of the table with this id: ``row_pos`` and one text column per entry of ``cells``.

    ``cells`` maps a column to (cell number from 1, kind of cell). A page whose header count differs from
    ``n_cols`` keeps one row with ``shape_ok`` false and no cells, so callers can set it aside.
    """
    kept = [c for c in df.columns if c != html]
    headers, rows = html_rows(F.col("_table"))
    read = _with_table(df, F.col(html), table_id, *kept).select(*kept, headers.alias("_headers"), rows.alias("_rows"))
    shaped = F.coalesce(F.col("_headers") == n_cols, F.lit(False))
    flat = read.select(
        *kept, shaped.alias("shape_ok"), F.posexplode_outer(F.when(shaped, F.col("_rows"))).alias("row_pos", "_row")
    ).withColumn("_cells", _cells_of(F.col("_row")))
    return flat.select(
        *kept,
        "shape_ok",
        "row_pos",
        *[_cell(F.col("_cells"), number, kind).alias(name) for name, (number, kind) in cells.items()],
    )


def _cells_of(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(r"(?is)<td\b[^>]*>(.*?)(?=</td\b|<td\b|\z)"), F.lit(1))


def _cell(cells: Column, number: int, kind: str) -> Column:
    cell = F.get(cells, F.lit(number - 1))
    if kind == fd.CELL_TEXT:
        return first_cell_text(cell)
    spans = span_texts(cell)
    if kind == fd.CELL_SPAN:
        return F.get(spans, F.lit(0))
    # Both ends of a range: one span is its left end, of two the second is its right end.
    if kind == fd.CELL_LEFT:
        return F.when(F.size(spans).isin(1, 2), F.element_at(spans, 1)).otherwise(F.lit(""))
    if kind == fd.CELL_RIGHT:
        return F.when(F.size(spans) == 2, F.element_at(spans, 2)).otherwise(F.lit(""))
    # One span is the value; of two, the last one stands; any other number leaves it empty.
    return F.when(F.size(spans).isin(1, 2), F.element_at(spans, -1)).otherwise(F.lit(""))


def explode_units(pages: DataFrame, units: str = "units", keep_empty: bool = False, nested: bool = False) -> DataFrame:
    """One row per unit with its place ``unit_pos``; pages without units vanish unless ``keep_empty``.

    ``nested``: the array holds arrays and only its first element is a page.
    """
    kept = [c for c in pages.columns if c != units]
    page = F.get(F.col(units), F.lit(0)) if nested else F.col(units)
    # The inner form would make Spark test the array's size below the explode and so parse each body again for it.
    rows = pages.select(*kept, F.posexplode_outer(page).alias("unit_pos", "unit"))
    return rows if keep_empty else rows.where(F.col("unit_pos").isNotNull())


def nonempty_pages(pages: DataFrame, units: str = "units") -> DataFrame:
    return pages.where(F.size(F.coalesce(F.col(units), F.array())) > 0)


def project_positional(
    df: DataFrame, fields: Sequence[Field], unit: str = "unit", separator: str = ","
) -> DataFrame:
    """Comma-joined units to columns by position; a position the unit lacks is NULL."""
    kept = [c for c in df.columns if c != unit]
    cut = df.select(*kept, F.split(F.col(unit), separator, -1).alias("_parts"))
    part = F.col("_parts")
    return cut.select(*kept, *[_typed(f, F.get(part, F.lit(f.source))) for f in fields if _in_unit(f)])


def project_keys(df: DataFrame, fields: Sequence[Field], unit: str = "unit") -> DataFrame:
    """Object units to columns by key."""
    kept = [c for c in df.columns if c != unit]
    return df.select(*kept, *[_typed(f, F.col(f"{unit}.`{f.source}`")) for f in fields if _in_unit(f)])


def project_cells(df: DataFrame, fields: Sequence[Field], unit: str = "unit") -> DataFrame:
    """Table rows to columns by cell number."""
    kept = [c for c in df.columns if c != unit]
    cut = df.select(*kept, _cells_of(F.col(unit)).alias("_cells"))
    columns = []
    for f in fields:
        if f.kind == fd.CONSTANT:
            columns.append(F.lit(f.source).alias(f.name))
        elif _in_unit(f):
            columns.append(_cell(F.col("_cells"), f.source, f.kind).alias(f.name))
    return cut.select(*kept, *columns)


def _in_unit(f: Field) -> bool:
    return f.kind not in (fd.SHARE_CODE, fd.SHARE_NAME)


def _typed(f: Field, raw: Column) -> Column:
    if f.kind == fd.NUMBER:
        out = to_double(raw)
    elif f.kind == fd.COUNT:
        out = to_bigint(raw)
    elif f.kind == fd.PERCENT:
        out = scale_ratio(raw)
    elif f.kind == fd.GATED_PERCENT:
        out = scale_ratio(raw, gated=True, from_json=True)
    elif f.kind == fd.SECOND_STAMP:
        out = epoch_to_bj(zero_if_null(to_bigint(raw)), "ms", SECOND_PATTERN)
    elif f.kind == fd.MINUTE_STAMP:
        out = epoch_to_bj(to_bigint(raw), "ms", MINUTE_PATTERN)
    elif f.kind == fd.HEAD:
        out = anchor_head(raw)
    elif f.kind == fd.LINK:
        out = anchor_url(raw)
    elif f.kind == fd.CONSTANT:
        out = F.lit(f.source)
    else:
        out = raw
    return out.alias(f.name)


def project_units(units: DataFrame, spec: FeedSpec) -> DataFrame:
    """A feed's unit rows to its item fields. Timelines also keep ``created_ms`` for the incremental cuts,
    and missing dates of object feeds are flagged in ``<field>_is_missing``."""
    if spec.unit == "positional":
        return project_positional(units, spec.fields)
    if spec.unit == "html":
        return project_cells(units, spec.fields)
    for f in spec.fields:
        if f.kind == fd.SECOND_STAMP:
            units = units.withColumn(f"{f.name}_is_missing", to_bigint(F.col(f"unit.`{f.source}`")).isNull())
        elif f.kind == fd.MINUTE_STAMP:
            units = units.withColumn("created_ms", to_bigint(F.col(f"unit.`{f.source}`")))
    return project_keys(units, spec.fields)


def parse_feed(landing: DataFrame, spec: FeedSpec, keep_empty: bool = False) -> DataFrame:
    """Item rows of one feed's landed responses, each with its page's lineage, counters and state.

    ``keep_empty`` keeps one row for a page without units, so a single written pass serves items, page counters
    and the list of pages to ask for again. The name of a per-share feed's share is added by ``enrich_share``.
    """
    pages = parse_envelope(landing, spec)
    rows = project_units(explode_units(pages, keep_empty=keep_empty), spec)
    if spec.per_share:
        rows = rows.withColumn("symbol", F.col("share_code"))
    return rows


def split_corrupt(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable pages and pages to ask for again."""
    return pages.where(F.col("page_state") == OK), pages.where(F.col("page_state") != OK)
