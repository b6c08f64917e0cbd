"""Landed responses and stored tables as DataFrames."""

from sharefold.sources.landing import LANDING_SCHEMA, deal_pages, read_landing, read_landing_files, stream_landing, stream_landing_files
from sharefold.sources.tables import read_table

__all__ = ["LANDING_SCHEMA", "deal_pages", "read_landing", "read_landing_files", "read_table", "stream_landing", "stream_landing_files"]
