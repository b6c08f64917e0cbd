"""Response bytes to text, wrappers, links and table cells."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The link pattern of the timelines ([^\n] because Java's dot stops at more line ends).
LINK_PATTERN = r"(<a[^\n]+/a>)"

_OPEN_TAG = r"(?i)(<a(?:\s(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)?/?>)"
_HREF = r"(?i)\shref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
_ENTITY_OR_TEXT = r"(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&\w+;|[^&]+|&)"


def _named_entities() -> Column:
    """A map from the named entities of HTML, as written in text, to their code points: one literal, which Spark reads
    once while it plans."""
    pairs = ",".join(f"{name}={code}" for name, code in {**name2codepoint, "apos": 39}.items())
    return F.str_to_map(F.lit(pairs), F.lit(","), F.lit("="))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _decoder(charset: str):
    """Arrow-batched decoder for a charset Spark's ``decode`` refuses; undecodable bodies become NULL."""

    def one(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        try:
            return raw.decode(charset)
        except UnicodeDecodeError:
            return None

    @F.pandas_udf("string")
    def decode(bodies: pd.Series) -> pd.Series:
        return bodies.map(one)

    return decode


def decode_body(body: Column | str, charset: str = "UTF-8", jvm_charsets: bool = False) -> Column:
    """Text of a response body; NULL when the bytes are not valid in the charset.

    UTF-8 stays in the JVM. Other charsets do so too when the session has both
    ``spark.sql.legacy.javaCharsets`` and ``spark.sql.legacy.codingErrorAction`` on (``jvm_charsets``), as the
    library's own sessions do; otherwise a pandas UDF reads them.
    """
    body = _col(body)
    if charset.lower() == "utf-8":
        return F.try_validate_utf8(body.cast("string"))
    if jvm_charsets:
        text = F.decode(body, charset)
        return F.when(~F.contains(text, F.lit("�")), text)
    return _decoder(charset)(body)


def first_match(text: Column, pattern: str) -> Column:
    # Unlike regexp_extract this tells "no match" (NULL) from an empty match, and reads a large body only once.
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def unwrap_jsonp(text: Column | str) -> Column:
    """What stands between the first ``(`` and the last ``)``; NULL when there is no such pair."""
    return first_match(_col(text), r"(?s)^[^(]*\((.*)\)[^)]*$")


def unwrap_assignment(text: Column | str) -> Column:
    """What follows the first run of ``=``; NULL when there is none."""
    return first_match(_col(text), r"(?s)^[^=]*=+(.*)$")


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _code(name: Column) -> Column:
    """Code point of an entity's name, what stands between ``&`` and ``;``; NULL for one that names none."""
    number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7))
    return F.coalesce(number, F.try_element_at(_named_entities(), name)).try_cast("int")


def _character(code: Column) -> Column:
    """The character of a code point, NULL where there is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _entity(piece: Column) -> Column:
    """The character that an entity names, NULL for one that names none."""
    return _held(F.translate(piece, "&;", ""), lambda name: _held(_code(name), _character))


def unescape(text: Column) -> Column:
    """Text with its entities, numbered or named, as characters; what is no entity stays."""
    pieces = F.regexp_extract_all(text, F.lit(_ENTITY_OR_TEXT), F.lit(1))
    read = F.transform(pieces, lambda p: F.when(p.rlike("^&.+;$"), F.coalesce(_entity(p), p)).otherwise(p))
    return F.when(F.contains(text, F.lit("&")), F.array_join(read, "")).otherwise(text)


def anchor_head(text: Column | str) -> Column:
    """Text before the link block; the whole text when it holds no link."""
    text = _col(text)
    # An earlier copy of the same link text would itself have matched, so the first place is the match's place.
    return _held(
        F.regexp_extract(text, LINK_PATTERN, 1),
        lambda link: F.when(link == "", text).otherwise(F.substring(text, F.lit(1), F.position(link, text) - 1)),
    )


def anchor_url(text: Column | str) -> Column:
    """Address of the last link; '' without a link, NULL when the last link has no address."""
    text = _col(text)

    def address(link: Column) -> Column:
        last_tag = F.try_element_at(F.regexp_extract_all(link, F.lit(_OPEN_TAG), F.lit(1)), F.lit(-1))
        # A value in quotes loses them; one without holds none.
        value = F.regexp_replace(F.regexp_extract(last_tag, _HREF, 1), r"\A[\"']|[\"']\z", "")
        return F.when(link == "", F.lit("")).otherwise(_held(F.nullif(value, F.lit("")), unescape))

    return _held(F.regexp_extract(text, LINK_PATTERN, 1), address)


def span_texts(cell: Column) -> Column:
    """Texts of the spans in a table cell, empty ones left out."""
    found = F.regexp_extract_all(cell, F.lit(r"(?is)<span\b[^>]*>([^<]*)"), F.lit(1))
    return F.transform(F.filter(found, lambda t: t != ""), unescape)


def first_cell_text(cell: Column) -> Column:
    """First text that stands directly in a table cell, outside its child elements."""
    outside = F.split(F.regexp_replace(cell, r"(?is)<(\w+)\b[^>]*>.*?</\1>|<[^>]+>", "\u0001"), "\u0001")
    return unescape(F.get(F.filter(outside, lambda t: t != ""), F.lit(0)))
