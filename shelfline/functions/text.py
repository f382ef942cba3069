"""Text, key and hash columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(value: Column) -> Column:
    """64 hex digits, used for personal data."""
    return F.sha2(value.cast("string"), 256)


def record_checksum(*tracked: Column) -> Column:
    """Hash over the tracked attributes only, so it changes exactly when they do."""
    cells = [F.coalesce(c.cast("string"), F.lit("")) for c in tracked]
    return F.sha2(F.concat_ws("|", *cells), 256)


def stable_key(*parts: Column) -> Column:
    """60-bit surrogate key from natural key parts; needs no shuffle, no sequence,
    and gives the same key when a lost task runs again."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def zero_padded_key(prefix: str | Column, number: Column, width: int) -> Column:
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(head, F.format_string(f"%0{width}d", number.cast("bigint")))


def short_code(name: Column) -> Column:
    return F.upper(F.substring(name, 1, 3))


def title_from_code(code: Column) -> Column:
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def split_first(value: Column, separator: str = "/") -> Column:
    return F.substring_index(value, separator, 1)


def code_lookup(code: Column, entries: Mapping[str, object]) -> Column:
    """Value of a code in a small fixed table; NULL for an unknown code."""
    cells = [F.lit(x) for pair in entries.items() for x in pair]
    return F.try_element_at(F.create_map(*cells), code)
