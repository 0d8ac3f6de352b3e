"""Output encoders: JSON records and time-series line protocol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_records(df: DataFrame, fields: dict[str, str] | None = None, key: str | None = None) -> DataFrame:
    """Encode every row as one JSON object in column ``value``.

    ``fields`` maps wire names to column names (default: all columns, same
    names).  With ``key`` the frame also carries a ``key`` string column, the
    shape a message sink expects.
    """
    fields = fields or {c: c for c in df.columns}
    value = F.to_json(F.struct(*[F.col(c).alias(n) for n, c in fields.items()]))
    cols = [value.alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def _escape_tag(c: Column) -> Column:
    # Line protocol: commas, blanks and equals signs in tag values are escaped.
    return F.regexp_replace(c, r"([,= ])", r"\\$1")


def datapoints(df: DataFrame, measurement: str, time_ms: str, value: str, key: str | None = None,
               field: str = "value") -> DataFrame:
    """Project (time, value[, key]) rows to time-series points.

    Output columns: ``key`` (or null), ``time_ms``, ``value`` and ``line``, the
    point in line protocol: ``measurement[,key=K] field=V time_ns``.  Keyed
    points carry the key as tag ``key``; re-keying and value mapping are plain
    projections before this call.
    """
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    tag = F.concat(F.lit(","), F.lit("key="), _escape_tag(k)) if key else F.lit("")
    line = F.concat(F.lit(measurement), tag, F.lit(f" {field}="), F.col(value).cast("string"), F.lit(" "),
                    (F.col(time_ms).cast("bigint") * F.lit(1000000)).cast("string"))
    return df.select(k.alias("key"), F.col(time_ms).cast("bigint").alias("time_ms"),
                     F.col(value).alias("value"), line.alias("line"))
