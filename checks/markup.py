"""Checks over pages, part and documents: charsets, links, tables, addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table, wide_table
from sharefold import feeds as fd
from sharefold.functions import anchor_head, anchor_url, decode_body, url_param
from sharefold.operators.parse import html_table


@check("SELECT page_id, url, length(html) AS n FROM pages")
def scan_pages(spark, sf_dir):
    landed = table(spark, sf_dir, "pages").select("page_id", "url", F.encode("html", "UTF-8").alias("body"))
    return landed.select("page_id", "url", F.length(decode_body("body")).alias("n").cast("bigint"))


@check("SELECT doc_id, length(text) AS n, md5(text) AS digest FROM documents")
def decode_utf8(spark, sf_dir):
    landed = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("body"))
    read = landed.select("doc_id", decode_body("body").alias("text"))
    return read.select("doc_id", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("digest"))


@check(
    r"""
    WITH found AS (SELECT page_id, html, regexp_extract(html, '(<a[^\n]+/a>)', 1) AS link FROM pages),
    tags AS (SELECT page_id, html, link, list_extract(regexp_extract_all(link, '<a(?:\s[^>]*)?>'), -1) AS tag FROM found)
    SELECT page_id,
      CASE WHEN link = '' THEN length(html) ELSE strpos(html, link) - 1 END AS head_chars,
      md5(CASE WHEN link = '' THEN html ELSE substr(html, 1, strpos(html, link) - 1) END) AS head_digest,
      CASE WHEN link = '' THEN '' ELSE replace(regexp_extract(tag, 'href="([^"]*)"', 1), '&amp;', '&') END AS url
    FROM tags"""
)
def anchor_split(spark, sf_dir):
    pages = wide_table(spark, sf_dir, "pages", "page_id").select(
        "page_id", anchor_head("html").alias("head"), anchor_url("html").alias("url")
    )
    return pages.select(
        "page_id", F.length("head").cast("bigint").alias("head_chars"), F.md5("head").alias("head_digest"), "url"
    )


NOTICE_CELLS = {
    "content": (2, fd.CELL_SPAN),
    "profit": (3, fd.CELL_TEXT),
    "increase": (4, fd.CELL_SPANS),
    "increase_from": (4, fd.CELL_LEFT),
    "increase_to": (4, fd.CELL_RIGHT),
    "day": (8, fd.CELL_SPAN),
}


def notices(spark, sf_dir):
    """A page per part whose table has three rows; parts of odd size have a header too few."""
    heads = F.repeat(F.lit("<th>h</th>"), 8 - F.col("p_size") % 2)

    def row(content, profit, increase, day):
        cells = [F.lit("1"), content, profit, increase, F.lit("why"), F.lit("<span>k</span>"), F.lit("<span>9</span>"), day]
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit('<td class="c">'), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))

    def span(text):
        return F.concat(F.lit("<span>"), text, F.lit("</span>"))

    name, price, size = F.col("p_name"), F.col("p_retailprice").cast("string"), F.col("p_size").cast("string")
    rows = F.concat(
        row(span(name), price, span(size), span(F.lit("2018-08-10"))),
        row(span(name), price, F.concat(span(size), F.lit("~"), span(price)), span(F.lit("2018-08-11"))),
        row(F.lit("none"), F.concat(F.lit("<b>x</b>"), price), F.lit(""), F.lit("")),
    )
    page = F.concat(
        F.lit('<html><body><table><tr><td>other</td></tr></table><table class="t" id="Table2"><thead><tr>'),
        heads,
        F.lit("</tr></thead><tbody>"),
        rows,
        F.lit("</tbody></table></body></html>"),
    )
    return wide_table(spark, sf_dir, "part", "p_partkey").select("p_partkey", page.alias("html"))


@check(
    """
    SELECT p_partkey, 0 AS row_pos, p_name AS content, CAST(p_retailprice AS DOUBLE) AS profit,
      CAST(p_size AS VARCHAR) AS increase, CAST(p_size AS VARCHAR) AS increase_from, '' AS increase_to,
      '2018-08-10' AS day FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, 1, p_name, p_retailprice, CAST(p_retailprice AS VARCHAR), CAST(p_size AS VARCHAR),
      CAST(p_retailprice AS VARCHAR), '2018-08-11' FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, 2, NULL, p_retailprice, '', '', '', NULL FROM part WHERE p_size % 2 = 0"""
)
def html_table_rows(spark, sf_dir):
    rows = html_table(notices(spark, sf_dir), "html", "Table2", 8, NOTICE_CELLS)
    filled = rows.where(F.col("row_pos").isNotNull()).drop("shape_ok")
    return filled.withColumn("profit", F.col("profit").try_cast("double"))


@check(
    "SELECT p_size % 2 = 0 AS shape_ok, count(*) AS pages, sum(CASE WHEN p_size % 2 = 0 THEN 3 ELSE 0 END)::BIGINT AS notices "
    "FROM part GROUP BY 1"
)
def html_shape_check(spark, sf_dir):
    rows = html_table(notices(spark, sf_dir), "html", "Table2", 8, NOTICE_CELLS)
    first = F.coalesce(F.col("row_pos"), F.lit(0)) == 0
    return rows.groupBy("shape_ok").agg(F.count_if(first).alias("pages"), F.count("row_pos").alias("notices"))


@check(
    """
    SELECT p_partkey, row_pos, p_name AS content, CAST(p_retailprice AS DOUBLE) AS profit, CAST(p_size AS VARCHAR) AS increase,
      CAST(p_size AS VARCHAR) AS increase_from, '' AS increase_to, '2018-08-1' || row_pos AS day
    FROM part, (SELECT unnest([0, 1, 2]) AS row_pos)"""
)
def html_nested_rows(spark, sf_dir):
    """Tables inside cells, two deep; the second row's cells and the last row lack their end tags."""
    inner = F.lit(
        '<table class="i"><thead><tr><th>x</th></tr></thead><tbody><tr><td><span>in</span></td>'
        "<td>a<TABLE><tr><td>deep</td></tr></TABLE >b</td></tr></tbody></table>"
    )

    def span(text):
        return F.concat(F.lit("<span>"), text, F.lit("</span>"))

    def row(n, cell_end, row_end):
        name, price, size = F.col("p_name"), F.col("p_retailprice").cast("string"), F.col("p_size").cast("string")
        cells = [inner, F.concat(inner, span(name)), F.concat(inner, price, inner), F.concat(span(size), inner)]
        cells += [F.lit("why"), span(F.lit("k")), inner, F.concat(inner, span(F.lit(f"2018-08-1{n}")))]
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit(cell_end)) for c in cells], F.lit(row_end))

    page = F.concat(
        F.lit("<table><tr><td><table id=Table2><thead><tr>" + "<th>h" * 8 + "</thead><tbody>"),
        row(0, "</td>", "</tr>"),
        row(1, "", "</tr>"),
        row(2, "</td>", ""),
        F.lit("</tbody></table></td></tr><tr><td>after</td></tr></table>"),
    )
    pages = wide_table(spark, sf_dir, "part", "p_partkey").select("p_partkey", page.alias("html"))
    rows = html_table(pages, "html", "Table2", 8, NOTICE_CELLS).drop("shape_ok")
    return rows.withColumn("profit", F.col("profit").try_cast("double"))


@check(
    "SELECT page_id, regexp_extract(url, '[?&]page=([0-9]+)', 1) AS page FROM pages "
    "WHERE regexp_matches(url, '[?&]page=[0-9]+')"
)
def nonempty_date(spark, sf_dir):
    """Rows whose field is filled; the page number of the address stands for the date."""
    field = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"[?&]page=([0-9]+)", 1).alias("page")
    )
    return field.where(F.col("page") != "")


@check("SELECT page_id, regexp_replace(url, '([?&]page=)[0-9]+', '\\1' || (page_id + 7)) AS url FROM pages")
def url_param_query(spark, sf_dir):
    next_page = url_param("url", "page", F.col("page_id") + 7)
    return table(spark, sf_dir, "pages").select("page_id", next_page.alias("url"))
