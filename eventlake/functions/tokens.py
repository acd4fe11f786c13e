"""Keys, tokens and text forms used by the destinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _truthy(df: DataFrame, name: str) -> Column:
    """Column usable as a token part: not null, not an empty text, not zero."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return col.isNotNull() & (col != "")
    return col.isNotNull() & (col != 0)


def idempotency_token(df: DataFrame) -> Column:
    """``lsn:<lsn>`` (column ``lsn`` or ``source_lsn``), else ``eid:<event_id>``, else ``koffset:<topic>:<partition>:<offset>``.

    Empty and zero values fall through, and unknown parts show as ``?``. The
    token derives from data only, so a replay builds the same one.
    """
    def part(name: str) -> Column:
        if name not in df.columns:
            return F.lit("?")
        return F.coalesce(F.col(name).cast("string"), F.lit("?"))

    token = F.concat(
        F.lit("koffset:"),
        F.concat_ws(":", part("raw_topic"), part("raw_partition"), part("raw_offset")),
    )
    for name, prefix in (("event_id", "eid:"), ("source_lsn", "lsn:"), ("lsn", "lsn:")):
        if name in df.columns:
            token = F.when(
                _truthy(df, name), F.concat(F.lit(prefix), F.col(name).cast("string"))
            ).otherwise(token)
    return token


def index_name(pattern: str, ts: Column) -> Column:
    """Rotating index name; a missing time counts as 1970-01-01."""
    day = F.coalesce(ts, F.timestamp_seconds(F.lit(0)))
    name = F.lit(pattern)
    # Pattern tokens and their date formats.
    for token, fmt in (
        ("{yyyy_mm_dd}", "yyyy.MM.dd"), ("{yyyy_mm}", "yyyy.MM"), ("{yyyy}", "yyyy"),
    ):
        if token in pattern:
            name = F.replace(name, F.lit(token), F.date_format(day, fmt))
    return name


def _double_text(col: Column) -> Column:
    """Shortest decimal text of a double, plain between 1e-4 and 1e16."""
    text = col.cast("string")
    plain = F.regexp_replace(col.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(col)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).cast("int")
    sign = F.when(power < 0, "-").otherwise("+")
    science = F.concat(mantissa, F.lit("e"), sign, F.lpad(
        F.abs(power).cast("string"),
        F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0"),
    ))
    return (
        F.when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(science)
    )


def field_text(df: DataFrame, name: str) -> Column:
    """A field as the hot store keeps it: text of its JSON value."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _double_text(col.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, "True").when(~col, "False")
    if isinstance(dtype, T.TimestampType):
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def record_json(df: DataFrame) -> Column:
    """Whole row as one JSON document; null fields are left out."""
    return F.to_json(F.struct(*df.columns))
