"""Log lines: faults dealt to two outputs in one pass, and UTC in any session."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from fleetwise.functions.times import from_utc_clock, utc_clock, utc_day
from fleetwise.plans import catalog
from fleetwise.sources import text
from fleetwise.sources.tables import TABLES

RIDE = "6,{kind},{a},{b},-73.99,40.7,{lon},40.8,2,2013000006,2013000006"
T1, T2 = "2013-01-01 00:00:00", "2013-01-01 00:06:00"


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def line(kind="START", a=T1, b=T2, lon="-73.9"):
    return RIDE.format(kind=kind, a=a, b=b, lon=lon)


GOOD = [line(), line("END", T2, T1), line(lon="")]
BAD = [line() + ",x", line("STOP"), line(a="soon"), line(a="2013-13-01 00:00:00"), line().replace(",2,", ",,"), line().rsplit(",", 1)[0] + ",", "x" + line(),
       "", ",,,", line(lon="x")]


def test_one_pass_deals_lines_to_two_outputs(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in GOOD + BAD] + [(None,)], "value string").repartition(3)
    good, rejects, counts = text.deal(text.parse_ride_lines(lines, mode="tag"), f"{tmp_path}/rides")
    assert counts == {"good": 3, "rejected": len(BAD) + 1}
    assert sorted((r.value for r in rejects.collect()), key=str) == sorted([*BAD, None], key=str)
    want, _ = text.parse_ride_lines(lines, mode="split")
    assert good.columns == want.columns
    assert sorted(map(tuple, good.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    nothing = text.deal(text.parse_ride_lines(lines.limit(0), mode="tag"), f"{tmp_path}/none")
    assert nothing[0].count() == nothing[1].count() == 0 and nothing[2] == {"good": 0, "rejected": 0}


def test_times_are_utc_in_any_session(spark, new_york):
    rides = text.parse_ride_lines(spark.createDataFrame([(GOOD[0],)], "value string"))
    assert rides.select(F.unix_millis("start_time")).first()[0] == 1356998400000
    assert text.format_ride_lines(rides).first().value.split(",")[2:4] == [T1, T2]
    fare = text.parse_fare_lines(spark.createDataFrame([(f"6,1,1,{T1},CSH,1.0,0.0,9.0",)], "value string"))
    assert fare.select(F.unix_millis("start_time")).first()[0] == 1356998400000
    # the hour that New York's clocks skip and the one they repeat
    for clock in ("2013-03-10 02:30:00", "2013-11-03 01:30:00", "1969-12-31 23:59:59"):
        ms = int(dt.datetime.fromisoformat(clock + "+00:00").timestamp() * 1000)
        row = spark.range(1).select(F.lit(clock).cast("timestamp_ntz").alias("ntz")).select(
            F.unix_millis(from_utc_clock(F.col("ntz"))).alias("ms"), utc_clock(from_utc_clock(F.col("ntz"))).alias("clock"),
            utc_day(from_utc_clock(F.col("ntz"))).alias("day")).first()
        assert tuple(row) == (ms, clock, ms // 86_400_000)


@pytest.mark.parametrize("name", ["q_ride_ingest", "q_fare_ingest", "q_car_ingest", "q_ride_export", "q_hourly_tips", "q_toggle_broadcast", "q_trade_enrich"])
def test_queries_in_another_zone(spark, new_york, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF_DIR)
    rel = con.sql(catalog.ORACLES[name])
    at = [rel.columns.index(c) for c in df.columns]
    norm = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted(map(norm, df.collect()), key=str) == sorted((norm([r[i] for i in at]) for r in rel.fetchall()), key=str)
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
