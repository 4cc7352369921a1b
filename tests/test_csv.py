import datetime as dt

import pytest

from orbitfit.sources.csv import read_csv_stable, set_time_parser_policy

# Header, column order and time pattern of the location table. One good row, a bad date, a bad number, an empty number,
# an unparseable time, a fifth field and a missing field.
LINES = [
    "time,lat,lon,base",
    "4/1/2014 0:11:00,40.769,-73.9549,B02512",
    "13/45/2014 0:11:00,40.7,-73.9,B02512",
    "4/1/2014 0:17:00,abc,-73.9,B02512",
    "4/1/2014 0:21:00,,-73.9,B02512",
    "notatime,40.7,-73.9,B02512",
    "4/1/2014 0:28:00,40.7,-73.9,B02512,extra",
    "4/1/2014 0:35:00,40.7,-73.9",
]


@pytest.fixture
def csv_path(tmp_path):
    p = tmp_path / "loc.csv"
    p.write_text("\n".join(LINES) + "\n")
    return str(p)


def _policy(spark):
    return spark.conf.get("spark.sql.legacy.timeParserPolicy")


def test_corrected_parser_keeps_two_rows_for_every_projection(spark, csv_path):
    old = _policy(spark)
    set_time_parser_policy(spark, "CORRECTED")
    try:
        df = read_csv_stable(spark, csv_path)
        full = df.collect()
        assert len(full) == 2
        assert full[0]["time"] == dt.datetime(2014, 4, 1, 0, 11) and full[0]["lat"] == 40.769
        assert full[1]["lat"] is None
        assert df.select("lat", "lon").count() == 2
        assert len(df.select("lat", "lon").collect()) == 2
        assert df.count() == 2
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", old)


def test_legacy_parser_is_lenient_but_stable(spark, csv_path):
    old = _policy(spark)
    set_time_parser_policy(spark, "LEGACY")
    try:
        df = read_csv_stable(spark, csv_path)
        rows = df.collect()
        assert len(rows) == 3
        assert dt.datetime(2015, 2, 14, 0, 11) in [r["time"] for r in rows]
        assert df.select("lat").count() == 3 and df.count() == 3
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", old)


def test_csv_round_trip_is_time_zone_independent(spark):
    """The events timestamps are wall-clock values (timestamp_ntz): the CSV
    round trip gives the oracle's text in any session time zone."""
    import duckdb

    import __spark_entry__ as entry
    from sf_dirs import SF_SMALL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    want = sorted(con.execute(entry.oracle_sql()["csv_points"]).fetchall())
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = sorted(tuple(r) for r in entry.queries()["csv_points"](spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want and len(got) > 0


@pytest.mark.parametrize("split", ["57", "301", "1000", "128m"])
def test_quoted_line_breaks_for_any_split_size(spark, tmp_path, split):
    """Records of several files against Python's csv reader, whatever splits they fall into."""
    import csv
    import io
    import random

    from orbitfit.sources.records import read_records
    rng = random.Random(1)
    notes = ["plain", "a,b", "line\nbreak", 'say "hi"', '"\n"', "\n\n\n", '""', "x" * 80, "cr\r\nlf", 'q"\n' * 30, "ü\n日本"]
    want = []
    for f in range(3):
        rows = [[str(f * 1000 + i), rng.choice(notes), str(i)] for i in range(200)]
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8") as h:
            csv.writer(h, lineterminator="\n" if f else "\r\n").writerows([["id", "note\nof, the", "x"], *rows])
        want += [tuple(r) for r in rows]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        got = [tuple(next(csv.reader(io.StringIO(r["value"], newline="")))) for r in read_records(spark, str(tmp_path)).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted(want)


def test_records_joined_by_shuffle_and_too_long(spark, tmp_path, monkeypatch):
    from orbitfit.sources import records
    text = "a,b\n" + "".join(f'{i},"x\n{"y" * (i % 40)}\n"\n' for i in range(100))
    (tmp_path / "a.csv").write_text(text)
    want = sorted(f'{i},"x\n{"y" * (i % 40)}\n"' for i in range(100))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        monkeypatch.setattr(records, "BROADCAST_SPLITS", 0)
        assert sorted(r["value"] for r in records.read_records(spark, str(tmp_path)).collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "a.csv").write_text('a,b\n1,"never closed\n' + "x\n" * 100)
    assert records.read_records(spark, str(tmp_path)).first()["value"].startswith('1,"never closed\nx\nx')
    with pytest.raises(Exception, match="never closed"):
        records.read_records(spark, str(tmp_path), max_record=50).collect()


@pytest.mark.parametrize("line,closed,opened", [
    ("a,b", False, True), ('a,"b', True, False), ('"a"', False, False), ('b",c', False, False), ('"a""b', True, False),
    ('5" pipe,x', False, False), ('""', False, True), ('"",""', False, True), ("", False, True), ('"', True, False),
    ('a"b,"c', True, True), ('"a" x,"b"', False, False)])
def test_end_state(line, closed, opened):
    from orbitfit.sources.records import end_state
    assert (end_state(line, False, ","), end_state(line, True, ",")) == (closed, opened)


def test_two_loads_with_different_parsers(spark, csv_path):
    """One query, two policies, whatever the session says; the lenient one equals the session's lenient parser."""
    old = _policy(spark)
    try:
        both = []
        for policy in ("CORRECTED", "LEGACY"):
            set_time_parser_policy(spark, policy)
            strict = read_csv_stable(spark, csv_path, time_parser="strict")
            lenient = read_csv_stable(spark, csv_path, time_parser="lenient")
            both.append(sorted(map(str, strict.unionAll(lenient).collect())))
            assert strict.count() == 2 and lenient.count() == 3 == lenient.select("lat").count()
        assert both[0] == both[1]
        assert sorted(map(str, read_csv_stable(spark, csv_path).collect())) == sorted(map(str, lenient.collect()))
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", old)


TIMES = ["4/1/2014 0:11:00", "13/45/2014 0:11:00", "2/29/2015 1:2:3", "2/29/2016 1:2:3", "notatime", None, "",
         "0/0/2014 25:61:61", " 4/1/2014 0:11:00 x", "4/31/2014 0:00:00", "12/31/9999 23:59:59", "999/1/2014 0:00:00",
         "1/99999/2014 0:00:00", "4/1/0014 0:11:00", "04/01/2014 00:11:00"]


def test_lenient_times_equal_the_legacy_parser(spark):
    from orbitfit.sources.csv import parse_csv_lines
    lines = spark.createDataFrame([(f"{t},1.0,2.0,b",) for t in TIMES if t], "value string")
    old = _policy(spark)
    try:
        set_time_parser_policy(spark, "LEGACY")
        want = parse_csv_lines(lines).collect()
        assert parse_csv_lines(lines, time_parser="lenient").collect() == want and len(want) == len(TIMES) - 3
        set_time_parser_policy(spark, "CORRECTED")
        assert parse_csv_lines(lines, time_parser="strict").count() == 5
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", old)


def test_time_patterns(spark):
    from pyspark.sql import functions as F

    from orbitfit.functions.times import parse_timestamp
    def parse(text, pattern, how="strict"):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(parse_timestamp(F.col("t"), pattern, how)).first()[0]
    assert parse("2014-02-03T04:05:06.25", "yyyy-MM-dd'T'HH:mm:ss.SSS") == dt.datetime(2014, 2, 3, 4, 5, 6, 250000)
    assert parse("3.2.2014", "d.M.y") == dt.datetime(2014, 2, 3)
    assert parse("3.2.2014 x", "d.M.y") is None and parse("3.2.2014 x", "d.M.y", "lenient") == dt.datetime(2014, 2, 3)
    assert parse("30.2.2014", "d.M.y") is None and parse("0.1.2014", "d.M.y", "lenient") == dt.datetime(2013, 12, 31)
    for bad in ("M/d", "yyyy MMM EEE", "yyyy M M"):
        with pytest.raises(ValueError):
            parse("1", bad)
