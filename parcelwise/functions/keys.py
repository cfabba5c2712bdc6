"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: stands in for NULL so that a missing part still hashes.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column | str) -> Column:
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    return F.md5(F.concat_ws("-", *[F.coalesce(column.cast("string"), F.lit(NULL_PART)) for column in columns]))


def key_if_found(found: Column, *parts: Column | str) -> Column:
    """Key of a looked-up row, NULL when the lookup missed. Hashing after the join keeps the shuffle narrow."""
    return F.when(found.isNotNull(), surrogate_key(*parts))


def packed_key(key: Column) -> Column:
    """The 16 bytes of a key, half its text. Equal only for equal keys: other texts get 17 zero bytes in front."""
    return F.when(key.rlike("^[0-9a-f]{32}$"), F.unhex(key)).otherwise(F.concat(F.lit(b"\0" * 17), key.cast("binary")))


def packed(rows: DataFrame, *names: str) -> DataFrame:
    """Hashed keys as bytes, for lookups and groupings that don't return them; natural ids stay as they are."""
    return rows.withColumns({name: packed_key(F.col(name)) for name in names if name.endswith("_key")})
