"""Deterministic row ids (KEY1).

An id is the MD5 of the text forms of its parts joined by ``|``, printed as a
dashed 36-character UUID. Part order matters; a null part is written as the
word ``None``. Doubles are written with Spark's ``cast(... as string)``, which
agrees with Python's ``str`` for 0 and for 1e-3 <= |v| < 1e7.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

NULL_TEXT = "None"
SEPARATOR = "|"


def _as_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(NULL_TEXT))


def dashed_uuid(hex32: Column) -> Column:
    return F.concat_ws(
        "-",
        F.substring(hex32, 1, 8),
        F.substring(hex32, 9, 4),
        F.substring(hex32, 13, 4),
        F.substring(hex32, 17, 4),
        F.substring(hex32, 21, 12),
    )


def stable_id(*parts: Column | str) -> Column:
    """KEY1: md5(part1|part2|...) as a dashed UUID string."""
    if not parts:
        raise ValueError("stable_id needs at least one part")
    payload = F.concat_ws(SEPARATOR, *[_as_text(p) for p in parts])
    return dashed_uuid(F.md5(payload))


def widen_floats(df, cols):
    """Cast float32 columns to double before they enter an id (see module doc)."""
    out = df
    for c in cols:
        if isinstance(df.schema[c].dataType, FloatType):
            out = out.withColumn(c, F.col(c).cast("double"))
    return out
