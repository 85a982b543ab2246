"""Keys, hashes and names as column expressions.

Names compare without case and trailing blanks. Ids are derived from names, so that they need no
lookup, stay the same through delete and re-creation, and are unique in the whole fleet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The name of an index of type 0, and the schema of database-level triggers.
HEAP, DB_LEVEL = "<<HEAP>>", "<<DB>>"
#: The hash of a missing definition.
NO_HASH = "0" * 64

_FULL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name_key(name) -> Column:
    """The form in which names compare: lower case, no trailing blanks."""
    return F.lower(F.rtrim(_col(name)))


def encoded(part) -> Column:
    """A part of a key with its length before it, so that no separator inside can forge another key; '-' for null."""
    text = _col(part).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def item_id(*parts) -> Column:
    """A 60-bit id of the parts; check it with ``operators.identity.id_collisions``."""
    digest = F.sha2(F.concat_ws("\x1f", *(encoded(p) for p in parts)), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def row_hash(columns: Iterable[str], of: Callable[[str], Column] = F.col) -> Column:
    """SHA-256 of the row as JSON: columns by name, nulls left out, times to the microsecond. ``of`` says where a column is."""
    row = F.struct(*(of(c) for c in sorted(columns)))
    return F.sha2(F.to_json(row, {"timestampFormat": _FULL, "timestampNTZFormat": _FULL}), 256)


def content_hash(text) -> Column:
    """SHA-256 of a definition, so many zeros for none."""
    return F.coalesce(F.sha2(_col(text), 256), F.lit(NO_HASH))


def row_checksum(columns: Iterable[str]) -> Column:
    """A 60-bit checksum of the row that tells nulls of different columns apart: of its ``row_hash``."""
    return F.conv(F.substring(row_hash(columns), 1, 15), 16, 10).cast("long")


def quoted(name) -> Column:
    """The name in brackets, closing ones doubled."""
    return F.concat(F.lit("["), F.replace(_col(name), F.lit("]"), F.lit("]]")), F.lit("]"))


def qualified_name(*names) -> Column:
    """The quoted names, joined by dots; nulls are left out."""
    return F.concat_ws(".", *(quoted(n) for n in names))


def namespaced(*names) -> Column:
    """Instance and database as one name."""
    return F.concat_ws("\\", *(_col(n) for n in names))


def last_part(name) -> Column:
    """What follows the last dot."""
    return F.element_at(F.split(_col(name), "[.]"), -1)


def joined(*parts) -> Column:
    """The parts in a row; nulls are empty."""
    return F.concat(*(F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts))


def chosen(n, *values) -> Column:
    """The n-th of the values, null beyond them."""
    n = _col(n)
    out = F.lit(None)
    for k, v in reversed(list(enumerate(values, 1))):
        out = F.when(n == k, _col(v)).otherwise(out)
    return out


def stale_minutes(since, now) -> Column:
    """Whole minutes between two times, from the boundaries of seconds."""
    seconds = F.unix_timestamp(_col(now).cast("timestamp")) - F.unix_timestamp(_col(since).cast("timestamp"))
    return F.floor(seconds / 60).cast("long")


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def variant_cast(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Casts the named columns; values that don't fit become null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in columns.items()})


def sentinel_name(name, kind) -> Column:
    """An index's name, or the sentinel for one of type 0."""
    return F.when(_col(kind) == 0, F.lit(HEAP)).otherwise(_col(name))


def as_variant(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns of JSON text as variants: every value keeps the type that it has in its row. What isn't JSON becomes null."""
    return df.withColumns({c: F.try_parse_json(c) for c in columns})


def variant_fields(df: DataFrame, column: str, fields: dict[str, str], paths: dict[str, str] | None = None) -> DataFrame:
    """Adds the fields (name: declared type) of a variant column; a value that its declared type can't hold is null.

    A field lies at ``$.name`` if ``paths`` doesn't say otherwise.
    """
    return df.withColumns({name: F.try_variant_get(column, (paths or {}).get(name, f"$.{name}"), kind) for name, kind in fields.items()})
