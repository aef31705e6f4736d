"""Row keys and text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_key(*parts: Column | str, sep: str = "_") -> Column:
    """``a_b_c`` row key; null when any part is null (SQL ``concat`` rule)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.concat(*cols)


def prefix_successor(prefix: str) -> str | None:
    """Smallest string greater than every string that starts with ``prefix``.

    Returns None when no such bound exists (prefix of only max code points),
    meaning the range is open-ended.
    """
    chars = list(prefix)
    while chars:
        last = ord(chars[-1])
        if last < 0x10FFFF:
            chars[-1] = chr(last + 1)
            return "".join(chars)
        chars.pop()
    return None


def tab_line(*cols: Column | str, fill_nulls: bool = False) -> Column:
    """Tab-joined text of the columns (cast to string).

    ``concat_ws`` skips nulls, which shifts later fields left; with
    ``fill_nulls=True`` a null becomes an empty field instead.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if fill_nulls:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    return F.concat_ws("\t", *parts)
