"""CSV scan with a declared schema and malformed-row dropping.

The reader's own DROPMALFORMED mode drops a different set of rows depending
on which columns a query asks for (the parser only converts projected
columns). Here every line is parsed against the *full* schema with
``from_csv`` in PERMISSIVE mode plus a corrupt-record column, and a line is
kept only when that column is NULL. Which rows survive is therefore the same
for a full read, a pruned read and ``count()``.

Lines are read as text: quoted fields may hold the delimiter, and with
``multi_line`` line breaks as well (:mod:`orbitfit.sources.records`). The header
of every file is removed.

Timestamps are parsed per load by ``time_parser``, in column expressions
(:mod:`orbitfit.functions.times`): ``"strict"`` takes valid dates only, ``"lenient"``
rolls over (month 13 is next January). Without it the session's
``spark.sql.legacy.timeParserPolicy`` decides when the query runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.functions.times import parse_timestamp
from orbitfit.sources.records import read_records

# The location table's declared columns and timestamp pattern.
LOCATION_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampType(), True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("base", T.StringType(), True),
])
LOCATION_TIME_FORMAT = "M/d/yyyy H:mm:ss"

_BAD = "_corrupt_record"


def set_time_parser_policy(spark: SparkSession, policy: str) -> None:
    """Session switch between ``CORRECTED`` (strict) and ``LEGACY`` (lenient) parsing.

    It applies when a query runs, so set it before running the read.
    """
    policy = policy.upper()
    if policy not in ("CORRECTED", "LEGACY", "EXCEPTION"):
        raise ValueError(f"unknown time parser policy {policy!r}")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", policy)


def read_csv_stable(spark: SparkSession, path: str, schema: T.StructType = LOCATION_SCHEMA,
                    header: bool = True, sep: str = ",",
                    timestamp_format: str | None = LOCATION_TIME_FORMAT, time_parser: str | None = None,
                    multi_line: bool = False) -> DataFrame:
    """Typed rows of the CSV files under ``path``; malformed records dropped.

    ``timestamp_format`` and ``time_parser`` (see :func:`parse_csv_lines`) apply to
    ``timestamp`` and ``timestamp_ntz`` columns. ``multi_line``: quoted fields may
    hold line breaks; a doubled quote then stands for one, as in RFC 4180.
    """
    if multi_line:
        return parse_csv_lines(read_records(spark, path, sep, header), schema, sep, timestamp_format,
                               time_parser=time_parser, escape='"')
    # Raw lines through the CSV reader with a separator that no text holds and
    # without quotes: it takes the first non-blank line of every file as header.
    lines = spark.read.csv(path, schema="value string", sep="\uffff", quote="", escape="", header=header,
                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return parse_csv_lines(lines, schema, sep, timestamp_format, time_parser=time_parser)


def parse_csv_lines(lines: DataFrame, schema: T.StructType = LOCATION_SCHEMA, sep: str = ",",
                    timestamp_format: str | None = LOCATION_TIME_FORMAT, column: str = "value",
                    time_parser: str | None = None, escape: str | None = None) -> DataFrame:
    """Typed rows of the CSV records in ``column``; blank and malformed ones dropped.

    ``time_parser``: ``"strict"`` or ``"lenient"``, for this load alone and by
    ``timestamp_format``; None leaves it to the session's policy.
    """
    own = set()
    if time_parser is not None:
        if not timestamp_format:
            raise ValueError("time_parser needs a timestamp_format")
        own = {f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    lines = lines.where(F.length(F.trim(F.col(column))) > 0)
    read_as = [T.StructField(f.name, T.StringType(), True) if f.name in own else f for f in schema.fields]
    full = T.StructType([*read_as, T.StructField(_BAD, T.StringType(), True)])
    opts = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    if escape:
        opts["escape"] = escape
    if timestamp_format:
        opts["timestampFormat"] = timestamp_format
        opts["timestampNTZFormat"] = timestamp_format
    parsed = lines.select(F.from_csv(F.col(column), full.simpleString(), opts).alias("r"))
    parsed = parsed.where(F.col(f"r.{_BAD}").isNull()).select("r.*")
    times = {n: parse_timestamp(F.col(f"`{n}`"), timestamp_format, time_parser, schema[n].dataType) for n in own}
    for n, t in times.items():
        parsed = parsed.where(F.col(f"`{n}`").isNull() | t.isNotNull())
    return parsed.select(*[times.get(f.name, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields])


def write_location_csv(df: DataFrame, path: str) -> None:
    """Write ``time, lat, lon, base`` rows as CSV with header and the location pattern."""
    (df.select("time", "lat", "lon", "base").write.mode("overwrite")
       .option("header", "true").option("timestampFormat", LOCATION_TIME_FORMAT)
       .option("timestampNTZFormat", LOCATION_TIME_FORMAT)
       .csv(path))
