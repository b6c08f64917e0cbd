"""JSON-lines dumps, stored tables and routed outputs."""

from sharefold.sinks.files import write_jsonl, write_routed
from sharefold.sinks.tables import merge_into_table, pin, read_stored, resume

__all__ = ["merge_into_table", "pin", "read_stored", "resume", "write_jsonl", "write_routed"]
