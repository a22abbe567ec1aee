"""Output table names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from tributary.errors import ExtractError

# Fixed value: the characters a table name is made of.
SAFE_CHARACTERS = "A-Za-z0-9_.-"


def safe_segment(name: str) -> str:
    """Turn any name into one usable as a path segment; never empty, never dots only."""
    return re.sub(f"[^{SAFE_CHARACTERS}]", "_", name).strip(".") or "table"


def child_name(table: str, sublist: str) -> str:
    return f"{table}_{safe_segment(sublist)}"


def child_names(table: str, sublists: Iterable[str]) -> dict[str, str]:
    """Table name per sublist; two sublists that end up with one name are an error."""
    names: dict[str, str] = {}
    for sublist in sublists:
        name = child_name(table, sublist)
        clash = [s for s, n in names.items() if n == name]
        if clash or name == table:
            raise ExtractError(f"sublists {clash + [sublist]} would share the table name '{name}'")
        names[sublist] = name
    return names


def default_table_name(mode: str, *, record_type: str = "", search_id: str = "", script_id: str = "") -> str:
    """Name used when the caller gives none."""
    if mode == "record":
        return safe_segment(record_type)
    if mode == "sql":
        return "sql_result"
    if mode == "saved_search":
        return safe_segment(search_id) if search_id else "saved_search"
    if mode == "endpoint":
        return f"endpoint_{safe_segment(script_id)}"
    raise ExtractError(f"unknown mode '{mode}'")
