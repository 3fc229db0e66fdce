"""Reading several fields out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_once(rows: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add a parsed value that is computed once per row.

    Were it a plain column, a later filter on one of its fields, or the one that Spark adds below
    an explode of one, would bring a second copy of the whole parse along; filters are not pushed
    through a generator.
    """
    return rows.select("*", F.explode(F.array(parsed)).alias(name))


def as_variant(raw: Column) -> Column:
    """JSON text as VARIANT, NULL where it is no JSON, or an object that has a field twice.

    Stored in Parquet it is read by path without parsing the text again.
    """
    return F.try_parse_json(raw)


def variant_field(value: Column, path: str, kind: str) -> Column:
    """A value of a VARIANT by its path, ``field`` or ``object.field``; NULL where it is missing or of no use as ``kind``."""
    if "'" in path:
        raise ValueError(f"no quotes in a path: {path!r}")
    return F.try_variant_get(value, "$" + "".join(f"['{step}']" for step in path.split(".")), kind)
