"""Registered source queries: the CSV scan (S1, S2, P9, M14) over derived data.

``csv_points`` turns every ``events`` row into a location record (time,
lat, lon, base), writes it as CSV with the location timestamp pattern into
the cluster's shared folder, reads it back with the stable malformed-row
policy and returns the parsed rows. ``timestamp_ntz`` keeps the round trip
independent of the session time zone. The file belongs to the scope that the
query runs in (``session.Scope``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitfit.session import work_path
from orbitfit.sources.csv import LOCATION_TIME_FORMAT, parse_csv_lines, read_csv_stable, write_location_csv
from orbitfit.sources.tables import table

LOCATION_NTZ_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("base", T.StringType(), True),
])


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"), F.col("value").alias("lat"), F.col("user_id").cast("double").alias("lon"),
        F.col("event_type").alias("base"))


def _as_text(back: DataFrame) -> DataFrame:
    return back.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "lat", "lon", "base")


def csv_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "csv_points")
    write_location_csv(_locations(spark, sf_dir), path)
    return _as_text(read_csv_stable(spark, path, LOCATION_NTZ_SCHEMA))


def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a record whose quoted base holds line breaks, a delimiter and quotes, written as
    text and read back record by record."""
    note = F.concat(F.col("base"), F.lit('\n"user", '), F.col("lon").cast("long").cast("string"), F.lit("\n\nend"))
    line = F.concat_ws(",", F.date_format("time", LOCATION_TIME_FORMAT), F.col("lat").cast("string"),
                       F.col("lon").cast("string"), F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"')))
    path = work_path(spark, "csv_multiline")
    _locations(spark, sf_dir).select(line.alias("value")).write.text(path)
    return _as_text(read_csv_stable(spark, path, LOCATION_NTZ_SCHEMA, header=False, multi_line=True))


def csv_time_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as lines, every third one dated a year back and twelve months on, loaded by both
    parsers in one query: the strict one drops those lines, the lenient one rolls them over."""
    loc, odd = _locations(spark, sf_dir), F.col("lon") % 3 == 0
    back = F.concat((F.month("time") + 12).cast("string"), F.date_format("time", "/d/"),
                    (F.year("time") - 1).cast("string"), F.date_format("time", " H:mm:ss"))
    line = F.concat_ws(",", F.when(odd, back).otherwise(F.date_format("time", LOCATION_TIME_FORMAT)),
                       F.col("lat").cast("string"), F.col("lon").cast("string"), F.col("base"))
    lines = loc.select(line.alias("value"))
    loads = [_as_text(parse_csv_lines(lines, LOCATION_NTZ_SCHEMA, time_parser=p)).withColumn("parser", F.lit(p))
             for p in ("strict", "lenient")]
    return loads[0].unionByName(loads[1])


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line, by ``event_id % 7`` with a bad date (0), a bad
    number (1), a field too few (2) or one too many (3); the others parse."""
    kind = F.col("event_id") % 7
    good = [F.date_format("ts", LOCATION_TIME_FORMAT), F.col("value").cast("string"),
            F.col("user_id").cast("string"), F.col("event_type")]
    line = (F.when(kind == 0, F.concat_ws(",", F.lit("13/32/2014 0:00:00"), *good[1:]))
            .when(kind == 1, F.concat_ws(",", good[0], F.lit("n/a"), *good[2:]))
            .when(kind == 2, F.concat_ws(",", *good[:3]))
            .when(kind == 3, F.concat_ws(",", *good, F.lit("more")))
            .otherwise(F.concat_ws(",", *good)))
    return _as_text(parse_csv_lines(table(spark, sf_dir, "events").select(line.alias("value")), LOCATION_NTZ_SCHEMA))


_EVENTS = ("SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, value AS lat, "
           "CAST(user_id AS DOUBLE) AS lon, ")
SQL = {
    "csv_malformed": f"{_EVENTS} event_type AS base FROM events WHERE event_id % 7 > 3",
    "csv_points": f"{_EVENTS} event_type AS base FROM events",
    "csv_multiline": (f"{_EVENTS} event_type || chr(10) || '\"user\", ' || CAST(user_id AS VARCHAR) || chr(10) || chr(10) "
                      "|| 'end' AS base FROM events"),
    "csv_time_parsers": (f"{_EVENTS} event_type AS base, 'strict' AS parser FROM events WHERE user_id % 3 <> 0 "
                         f"UNION ALL {_EVENTS} event_type AS base, 'lenient' AS parser FROM events"),
}

QUERIES = {"csv_points": csv_points, "csv_malformed": csv_malformed, "csv_multiline": csv_multiline,
           "csv_time_parsers": csv_time_parsers}
