"""The nine feeds: where each field comes from, how it is typed, and how its table is keyed.

Names, positions, object keys and stored columns are fixed values: they are what the sources send and what the
stored tables are called, spelling included. Everything else in the library is driven by these records.
"""

from __future__ import annotations

from dataclasses import dataclass

# Kinds of item fields.
TEXT, NUMBER, COUNT = "text", "number", "count"
PERCENT, GATED_PERCENT = "percent", "gated_percent"
SECOND_STAMP, MINUTE_STAMP = "second_stamp", "minute_stamp"
HEAD, LINK, CONSTANT, SHARE_CODE, SHARE_NAME = "head", "link", "constant", "share_code", "share_name"
# Kinds of table cells.
CELL_TEXT, CELL_SPAN, CELL_SPANS = "cell_text", "cell_span", "cell_spans"
CELL_LEFT, CELL_RIGHT = "cell_left", "cell_right"
# Ways a stored column is derived from an item field.
SAME, DATE_AT_SPACE, DATE_AT_T, LABEL, LOCAL_MINUTE = "same", "date_at_space", "date_at_t", "label", "local_minute"


@dataclass(frozen=True)
class Field:
    """One item field: its name, its place in the unit (position, key or cell number) and its kind."""

    name: str
    source: int | str | None
    kind: str = TEXT


@dataclass(frozen=True)
class Stored:
    """One column of the stored table: its name, the item field it is made of and how."""

    name: str
    item: str
    how: str = SAME


@dataclass(frozen=True)
class FeedSpec:
    name: str
    table: str
    wrapper: str | None  # "jsonp", "assignment" or None
    unit: str  # "positional", "object" or "html"
    fields: tuple[Field, ...]
    stored: tuple[Stored, ...]
    key: tuple[str, ...]
    sticky: tuple[str, ...]
    page_size: int
    params: tuple[tuple[str, str], ...] = ()
    page_param: str | None = None
    charset: str = "UTF-8"
    array: str = "data"
    nested: bool = False
    counters: tuple[tuple[str, str], ...] = ()  # (our name, envelope name)
    per_share: bool = False
    timeline: bool = False
    by_day: bool = False  # every run refreshes one day only

    @property
    def partition(self) -> str:
        """Partition column of the stored table; always a function of the key, so a key has one partition.

        A feed that refreshes one day has a partition per day. The other dated feeds bring many days in each
        response and have few rows a day, so theirs are months.
        """
        if self.timeline:
            return "id_range"
        return self.key[-1] if self.by_day else "month"

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(s.name for s in self.stored)


# --- fixed values: sources, fields and stored columns of the nine feeds --------------------------------------------

BASIC_INDEX = FeedSpec(
    name="basic_index",
    table="crawler_basic_index",
    wrapper="jsonp",
    unit="positional",
    counters=(("total_rows", "recordsFiltered"),),
    page_size=300,
    page_param="p",
    params=(
        ("cb", "{callback}"),
        ("type", "CT"),
        ("token", "{token}"),
        ("sty", "FCOIATC"),
        ("js", "(%7Bdata%3A%5B(x)%5D%2CrecordsFiltered%3A(tot)%7D)"),
        ("cmd", "C._A"),
        ("st", "(ChangePercent)"),
        ("sr", "-1"),
        ("p", "{page}"),
        ("ps", "{size}"),
        ("_", "{stamp}"),
    ),
    fields=(
        Field("type", 0),
        Field("symbol", 1),
        Field("name", 2),
        Field("last_price", 3, NUMBER),
        Field("change_amount", 4, NUMBER),
        Field("change_rate", 5, NUMBER),
        Field("turnover_volume", 6, NUMBER),
        Field("turnover_amount", 7, NUMBER),
        Field("highest", 9, NUMBER),
        Field("lowest", 10, NUMBER),
        Field("price_open", 11, NUMBER),
        Field("prev_close", 12, NUMBER),
        Field("quantity_ratio", 14, NUMBER),
        Field("turnover_hand", 15, NUMBER),
        Field("pe_ratio", 16, NUMBER),
        Field("pb_ratio", 17, NUMBER),
        Field("market_begin_time", 23),
        Field("last_update_time", 24),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("shares_type", "type"),
        Stored("latest_price", "last_price"),
        Stored("rise_fall_ratio", "change_rate"),
        Stored("rise_fall_price", "change_amount"),
        Stored("volumn", "turnover_volume"),
        Stored("price", "turnover_amount"),
        Stored("max_price", "highest"),
        Stored("min_pirce", "lowest"),
        Stored("open_price", "price_open"),
        Stored("close_price", "prev_close"),
        Stored("change_volumn", "turnover_hand"),
        Stored("quantity_ratio", "quantity_ratio"),
        Stored("pe_ratio", "pe_ratio"),
        Stored("pb_ratio", "pb_ratio"),
        Stored("date", "last_update_time", DATE_AT_SPACE),
    ),
    key=("shares_code", "date"),
    sticky=("shares_name", "shares_type"),
    by_day=True,
)

MAIN_INFLUX = FeedSpec(
    name="main_influx",
    table="crawler_main_influx",
    wrapper="assignment",
    unit="positional",
    nested=True,
    per_share=True,
    page_size=1,
    params=(
        ("type", "hff"),
        ("rtntype", "2"),
        ("js", "{{data:[(x)]}}"),
        ("cb", "var%20aff_data="),
        ("check", "{check}"),
        ("acces_token", "{token}"),
        ("id", "{share_id}"),
        ("_", "{stamp}"),
    ),
    fields=(
        Field("symbol", None, SHARE_CODE),
        Field("name", None, SHARE_NAME),
        Field("last_update_time", 0),
        Field("main_influx_price", 1, NUMBER),
        Field("main_influx_ratio", 2, NUMBER),
        Field("huge_influx_price", 3, NUMBER),
        Field("huge_influx_ratio", 4, NUMBER),
        Field("large_influx_price", 5, NUMBER),
        Field("large_influx_ratio", 6, NUMBER),
        Field("middle_influx_price", 7, NUMBER),
        Field("middle_influx_ratio", 8, NUMBER),
        Field("small_influx_price", 9, NUMBER),
        Field("small_influx_ratio", 10, NUMBER),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("main_influx_price", "main_influx_price"),
        Stored("main_influx_ratio", "main_influx_ratio"),
        Stored("huge_influx_price", "huge_influx_price"),
        Stored("huge_influx_ratio", "huge_influx_ratio"),
        Stored("large_influx_price", "large_influx_price"),
        Stored("large_influx_ratio", "large_influx_ratio"),
        Stored("middle_influx_price", "middle_influx_price"),
        Stored("middle_influx_ratio", "middle_influx_ratio"),
        Stored("small_influx_price", "small_influx_price"),
        Stored("small_influx_ratio", "small_influx_ratio"),
        Stored("date", "last_update_time", DATE_AT_SPACE),
    ),
    key=("shares_code", "date"),
    sticky=("shares_name",),
)

FINANCIAL_NOTICE = FeedSpec(
    name="financial_notice",
    table="crawler_financial_disclosure",
    wrapper=None,
    unit="html",
    per_share=True,
    page_size=1,
    fields=(
        Field("symbol", None, SHARE_CODE),
        Field("name", None, SHARE_NAME),
        Field("forecast_content", 2, CELL_SPAN),
        Field("forecast_left", 3, CELL_TEXT),
        Field("forecast_right", "", CONSTANT),
        Field("increase_left", 4, CELL_SPANS),
        Field("increase_right", "", CONSTANT),
        Field("change_reason", 5, CELL_TEXT),
        Field("preview_type", 6, CELL_SPAN),
        Field("previous_year_profit", 7, CELL_SPAN),
        Field("announcement_date", 8, CELL_SPAN),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("performance_change", "forecast_content"),
        Stored("expected_net_profit_left", "forecast_left"),
        Stored("expected_net_profit_right", "forecast_right"),
        Stored("performance_change_ratio_left", "increase_left"),
        Stored("performance_change_ratio_right", "increase_right"),
        Stored("performance_change_reason", "change_reason"),
        Stored("preview_type", "preview_type"),
        Stored("previous_year_profit", "previous_year_profit"),
        Stored("announcement_date", "announcement_date", DATE_AT_SPACE),
    ),
    key=("shares_code", "announcement_date"),
    sticky=("shares_name",),
)

SHAREHOLDER_CHANGE = FeedSpec(
    name="shareholder_change",
    table="crawler_shareholders",
    charset="GBK",
    wrapper="assignment",
    unit="positional",
    counters=(("total_pages", "pages"),),
    page_size=300,
    page_param="page",
    params=(
        ("pagesize", "{size}"),
        ("page", "{page}"),
        ("js", "var%20{callback}"),
        ("param", ""),
        ("sortRule", "-1"),
        ("sortType", "BDJZ"),
        ("tabid", "all"),
        ("code", ""),
        ("name", ""),
        ("rt", "{stamp}"),
    ),
    fields=(
        Field("symbol", 0),
        Field("name", 1),
        Field("shareholders_name", 4),
        Field("change_type", 5),
        Field("change_share", 6, NUMBER),
        Field("change_share_ratio", 7, NUMBER),
        Field("total_hold", 9, NUMBER),
        Field("total_equity_ratio", 10, NUMBER),
        Field("total_share", 11, NUMBER),
        Field("total_share_ratio", 12, NUMBER),
        Field("begin_date", 13),
        Field("end_date", 14),
        Field("announcement_date", 15),
        Field("change_equity_ratio", 16, NUMBER),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("shareholders_name", "shareholders_name"),
        Stored("change_type", "change_type"),
        Stored("change_share", "change_share"),
        Stored("change_equity_ratio", "change_equity_ratio"),
        Stored("change_share_ratio", "change_share_ratio"),
        Stored("total_hold", "total_hold"),
        Stored("total_equity_ratio", "total_equity_ratio"),
        Stored("total_share", "total_share"),
        Stored("total_share_ratio", "total_share_ratio"),
        Stored("begin_date", "begin_date", DATE_AT_SPACE),
        Stored("end_date", "end_date", DATE_AT_SPACE),
        Stored("announcement_date", "announcement_date", DATE_AT_SPACE),
    ),
    key=("shares_code", "announcement_date"),
    sticky=("shares_name",),
)

SHARE_BUYBACK = FeedSpec(
    name="share_buyback",
    table="crawler_share_buyback",
    wrapper="assignment",
    unit="object",
    counters=(("total_pages", "pages"),),
    page_size=100,
    page_param="pageindex",
    params=(
        ("pageindex", "{page}"),
        ("pagesize", "{size}"),
        ("orderby", "dim_date"),
        ("order", "desc"),
        ("jsonp_callback", "var%20{callback}=(x)"),
        ("market", "(0,1,2,3)"),
        ("rt", "{stamp}"),
    ),
    fields=(
        Field("symbol", "dim_scode"),
        Field("name", "securityshortname"),
        Field("new_price", "newprice", NUMBER),
        Field("buyback_price_range_left", "repurpricelower", NUMBER),
        Field("buyback_price_range_right", "repurpricecap", NUMBER),
        Field("close_price", "cprice", NUMBER),
        Field("buyback_volumn_range_left", "repurnumlower", NUMBER),
        Field("buyback_volumn_range_right", "repurnumcap", NUMBER),
        Field("share_ratio_left", "ltszxx", NUMBER),
        Field("share_ratio_right", "ltszsx", NUMBER),
        Field("equity_ratio_left", "zszxx", NUMBER),
        Field("equity_ratio_right", "zszsx", NUMBER),
        Field("buyback_amount_range_left", "repuramountlower", NUMBER),
        Field("buyback_amount_range_right", "repuramountlimit", NUMBER),
        Field("impl_progress", "repurprogress"),
        Field("begin_date", "repurstartdate", SECOND_STAMP),
        Field("announcement_date", "dim_tradedate", SECOND_STAMP),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("buyback_price_range_left", "buyback_price_range_left"),
        Stored("buyback_price_range_right", "buyback_price_range_right"),
        Stored("close_price", "close_price"),
        Stored("buyback_volumn_range_left", "buyback_volumn_range_left"),
        Stored("buyback_volumn_range_right", "buyback_volumn_range_right"),
        Stored("share_ratio_left", "share_ratio_left"),
        Stored("share_ratio_right", "share_ratio_right"),
        Stored("equity_ratio_left", "equity_ratio_left"),
        Stored("equity_ratio_right", "equity_ratio_right"),
        Stored("buyback_amount_range_left", "buyback_amount_range_left"),
        Stored("buyback_amount_range_right", "buyback_amount_range_right"),
        Stored("begin_date", "begin_date", DATE_AT_SPACE),
        Stored("impl_progress", "impl_progress", LABEL),
        Stored("announcement_date", "announcement_date", DATE_AT_SPACE),
    ),
    key=("shares_code", "announcement_date"),
    sticky=("shares_name",),
)

SHARE_PLEDGE = FeedSpec(
    name="share_pledge",
    table="crawler_share_pledge",
    wrapper="assignment",
    unit="object",
    counters=(("total_pages", "pages"),),
    page_size=200,
    page_param="pageindex",
    params=(
        ("pageindex", "{page}"),
        ("pagesize", "{size}"),
        ("orderby", "updatedate"),
        ("order", "desc"),
        ("jsonp_callback", "var%20{callback}=(x)"),
        ("rt", "{stamp}"),
    ),
    fields=(
        Field("symbol", "scode"),
        Field("name", "sname"),
        Field("shareholders_name", "gd_name"),
        Field("pledge_number", "new_zy_count", COUNT),
        Field("pledge_volumn", "amtsharefrozen", NUMBER),
        Field("pledge_price", "sz", NUMBER),
        Field("share_ratio", "zb", PERCENT),
        Field("equity_datio", "zzb", NUMBER),
        Field("close_position_range_left", "pcx_minvalue", NUMBER),
        Field("close_position_range_right", "pcx_maxvalue", NUMBER),
        Field("warning_position_range_left", "yjx_minvalue", NUMBER),
        Field("warning_position_range_right", "yjx_maxvalue", NUMBER),
        Field("update_date", "updatedate", SECOND_STAMP),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("shareholders_name", "shareholders_name"),
        Stored("pledge_number", "pledge_number"),
        Stored("pledge_volumn", "pledge_volumn"),
        Stored("pledge_price", "pledge_price"),
        Stored("share_ratio", "share_ratio"),
        Stored("equity_datio", "equity_datio"),
        Stored("close_position_range_left", "close_position_range_left"),
        Stored("close_position_range_right", "close_position_range_right"),
        Stored("warning_position_range_left", "warning_position_range_left"),
        Stored("warning_position_range_right", "warning_position_range_right"),
        Stored("update_date", "update_date", DATE_AT_SPACE),
    ),
    key=("shares_code", "update_date"),
    sticky=("shares_name",),
)

RESTRICTED_RELEASE = FeedSpec(
    name="restricted_release",
    table="crawler_restricted_circulation",
    wrapper="assignment",
    unit="object",
    counters=(("total_pages", "pages"),),
    page_size=300,
    page_param="p",
    params=(
        ("token", "{token}"),
        ("st", "ltsj"),
        ("sr", "-1"),
        ("p", "{page}"),
        ("ps", "{size}"),
        ("type", "XSJJ_NJ_PC"),
        ("js", "var%20{callback}={{pages:(tp),data:(x)}}"),
        ("filter", "(gpdm=)"),
        ("rt", "{stamp}"),
    ),
    fields=(
        Field("symbol", "gpdm"),
        Field("name", "sname"),
        Field("circulation_date", "ltsj"),
        Field("shareholders_num", "gpcjjgds", COUNT),
        Field("share_num", "jjsl", NUMBER),
        Field("real_share_num", "kjjsl", NUMBER),
        Field("non_share_num", "wltsl", NUMBER),
        Field("real_share_price", "jjsz", NUMBER),
        Field("equity_ratio", "zzb", GATED_PERCENT),
        Field("share_ratio", "zb", GATED_PERCENT),
        Field("close_price", "newPrice", NUMBER),
        Field("share_type", "xsglx"),
        Field("before_range", "jjqesrzdf", NUMBER),
        Field("after_range", "jjhesrzdf", NUMBER),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("shareholders_num", "shareholders_num"),
        Stored("share_num", "share_num"),
        Stored("real_share_num", "real_share_num"),
        Stored("non_share_num", "non_share_num"),
        Stored("real_share_price", "real_share_price"),
        Stored("equity_ratio", "equity_ratio"),
        Stored("share_ratio", "share_ratio"),
        Stored("close_price", "close_price"),
        Stored("share_type", "share_type"),
        Stored("before_range", "before_range"),
        Stored("after_range", "after_range"),
        Stored("circulation_date", "circulation_date", DATE_AT_T),
    ),
    key=("shares_code", "circulation_date"),
    sticky=("shares_name",),
)

_TIMELINE_COUNTERS = (("reported_page", "page"), ("total_pages", "maxPage"), ("reported_size", "count"))

ANNOUNCEMENT = FeedSpec(
    name="announcement",
    table="crawler_company_announcement",
    wrapper=None,
    unit="object",
    array="list",
    counters=_TIMELINE_COUNTERS,
    per_share=True,
    timeline=True,
    page_size=20,
    page_param="page",
    params=(("symbol_id", "{symbol}"), ("count", "{size}"), ("source", "公告"), ("page", "{page}")),
    fields=(
        Field("symbol", None, SHARE_CODE),
        Field("name", None, SHARE_NAME),
        Field("announce_type", "", CONSTANT),
        Field("announce_title", "description", HEAD),
        Field("announce_url", "description", LINK),
        Field("announce_date", "created_at", MINUTE_STAMP),
        Field("announce_id", "id", COUNT),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("announce_title", "announce_title"),
        Stored("announce_url", "announce_url"),
        Stored("announce_type", "announce_type"),
        Stored("announce_date", "announce_date", LOCAL_MINUTE),
        Stored("announce_id", "announce_id"),
    ),
    key=("announce_id",),
    sticky=("shares_code", "shares_name"),
)

NEWS = FeedSpec(
    name="news",
    table="crawler_company_news",
    wrapper=None,
    unit="object",
    array="list",
    counters=_TIMELINE_COUNTERS,
    per_share=True,
    timeline=True,
    page_size=20,
    page_param="page",
    params=(("symbol_id", "{symbol}"), ("count", "{size}"), ("source", "自选股新闻"), ("page", "{page}")),
    fields=(
        Field("symbol", None, SHARE_CODE),
        Field("name", None, SHARE_NAME),
        Field("news_title", "title"),
        Field("news_text", "description", HEAD),
        Field("news_url", "description", LINK),
        Field("date", "created_at", MINUTE_STAMP),
        Field("news_id", "id", COUNT),
    ),
    stored=(
        Stored("shares_code", "symbol"),
        Stored("shares_name", "name"),
        Stored("news_title", "news_title"),
        Stored("news_url", "news_url"),
        Stored("date", "date", LOCAL_MINUTE),
        Stored("news_id", "news_id"),
    ),
    key=("news_id",),
    sticky=("shares_code", "shares_name"),
)

# Id and header count of the notice table.
NOTICE_TABLE_ID = "Table2"
NOTICE_COLUMNS = 8

# --- end of fixed values -------------------------------------------------------------------------------------------

FEEDS: dict[str, FeedSpec] = {
    spec.name: spec
    for spec in (
        BASIC_INDEX,
        MAIN_INFLUX,
        FINANCIAL_NOTICE,
        SHAREHOLDER_CHANGE,
        SHARE_BUYBACK,
        SHARE_PLEDGE,
        RESTRICTED_RELEASE,
        ANNOUNCEMENT,
        NEWS,
    )
}


def feed(name: str) -> FeedSpec:
    try:
        return FEEDS[name]
    except KeyError:
        raise ValueError(f"unknown feed {name!r}; known: {', '.join(FEEDS)}") from None
