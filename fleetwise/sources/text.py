"""Text log codecs for rides, fares and car events, as DataFrame jobs.

Parsing takes a DataFrame with a string column ``value`` (what ``spark.read
.text`` and ``readStream.text`` produce; gzip files are decompressed by the
reader) and returns typed records.  Formatting does the reverse for export.
Everything is built-in string/cast functions, so parsing runs in codegen and
works unchanged on a streaming frame.

Validation follows the line formats: a wrong field count, an unknown event
kind, an unparsable time or number is an invalid record.  ``mode`` decides
what happens to invalid lines:

* ``"failfast"`` - the job fails on the first invalid line (``raise_error``);
* ``"drop"``     - invalid lines are skipped;
* ``"split"``    - returns ``(good, rejects)``; rejects keep the raw line;
* ``"tag"``      - one frame of all lines: ``is_good``, the raw line of invalid
  ones in ``rejected``, the record of valid ones (else nulls).  ``deal`` writes
  such a frame to two outputs in one pass and reports how many went to each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetwise.functions.times import utc_clock

# Fixed formats: ride and fare times "yyyy-MM-dd HH:mm:ss" (UTC); car event
# times "yyyy-MM-dd'T'HH:mm:ssZ"; ride lines have 11 comma fields, fare lines
# 8, car lines 23 fields separated by "," or ";" plus optional blanks.
RIDE_TIME_FMT = "yyyy-MM-dd HH:mm:ss"
CAR_TIME_FMT = "yyyy-MM-dd'T'HH:mm:ssZ"
RIDE_FIELDS = 11
FARE_FIELDS = 8
CAR_FIELDS = 23
CAR_SEPARATOR = "(,|;)\\s*"


def _tokens(value: Column, sep: str) -> Column:
    # A Java-style split drops trailing empty fields; do the same so the
    # field-count check behaves identically ("a,b,," has 2 fields).
    return F.split(F.regexp_replace(value, f"({sep})+$", ""), sep)


def _num(tok: Column, typ: str, empty_zero: bool) -> Column:
    """Numeric token; empty -> 0 when allowed; null when unparsable."""
    parsed = tok.try_cast(typ)
    if empty_zero:
        return F.when(F.length(tok) == 0, F.lit(0).cast(typ)).otherwise(parsed)
    return parsed


def _time(tok: Column, fmt: str) -> Column:
    """A time by its format; one without an offset is UTC, whatever the session's zone."""
    if fmt.endswith("Z"):
        return F.try_to_timestamp(tok, F.lit(fmt))
    return F.try_to_timestamp(F.concat(tok, F.lit(" +0000")), F.lit(fmt + " Z"))


def _finish(df: DataFrame, n_fields: int, required: list[str], out_cols: list[str], mode: str, what: str):
    """Validity from the parsed columns, then the mode's handling of invalid lines.

    Rows are selected by a generator over a one-element array (``inline`` of
    ``array(struct)`` when valid, nothing otherwise) rather than a filter: a
    filter on parsed columns would be pushed below the parsing projection and
    repeat every field's parse in the predicate.
    """
    valid = F.size("_tok") == n_fields
    for c in required:
        valid = valid & F.col(c).isNotNull()
    df = df.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    row = F.array(F.struct(*[F.col(c) for c in out_cols]))
    if mode == "failfast":
        bad = F.raise_error(F.concat(F.lit(f"Invalid {what} record: "), F.col("value")))
        return df.select(F.inline(F.when(F.col("_valid"), row).otherwise(bad)))
    good = df.select(F.inline(F.when(F.col("_valid"), row)))
    if mode == "drop":
        return good
    if mode == "tag":
        ok = F.col("_valid")
        return df.select(ok.alias("is_good"), F.when(~ok, F.col("value")).alias("rejected"), *[F.when(ok, F.col(c)).alias(c) for c in out_cols])
    if mode == "split":
        return good, df.select(F.inline(F.when(~F.col("_valid"), F.array(F.struct("value")))))
    raise ValueError(f"unknown mode {mode!r}")


def _with_tokens(lines: DataFrame, sep: str) -> DataFrame:
    # The token array is its own projection, so each field refers to one
    # computed array instead of repeating the split in every field expression
    # (which would also overflow the generated method size).
    return lines.select("value", _tokens(F.col("value"), sep).alias("_tok"))


RIDE_COLS = ["ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat", "end_lon", "end_lat",
             "passenger_cnt", "taxi_id", "driver_id", "event_time"]


def parse_ride_lines(lines: DataFrame, mode: str = "failfast"):
    b = _with_tokens(lines, ",")
    tok = [F.get(F.col("_tok"), i) for i in range(RIDE_FIELDS)]
    kind = tok[1]
    b = b.select(
        "value", "_tok",
        _num(tok[0], "bigint", False).alias("ride_id"),
        F.when(kind == "START", F.lit(True)).when(kind == "END", F.lit(False)).alias("is_start"),
        _time(tok[2], RIDE_TIME_FMT).alias("_t2"), _time(tok[3], RIDE_TIME_FMT).alias("_t3"),
        _num(tok[4], "float", True).alias("start_lon"), _num(tok[5], "float", True).alias("start_lat"),
        _num(tok[6], "float", True).alias("end_lon"), _num(tok[7], "float", True).alias("end_lat"),
        _num(tok[8], "smallint", False).alias("passenger_cnt"),
        _num(tok[9], "bigint", False).alias("taxi_id"), _num(tok[10], "bigint", False).alias("driver_id"))
    s = F.col("is_start")
    b = (b.withColumn("start_time", F.when(s, F.col("_t2")).otherwise(F.col("_t3")))
         .withColumn("end_time", F.when(s, F.col("_t3")).otherwise(F.col("_t2")))
         .withColumn("event_time", F.col("_t2")))
    req = ["ride_id", "is_start", "_t2", "_t3", "start_lon", "start_lat", "end_lon", "end_lat", "passenger_cnt",
           "taxi_id", "driver_id"]
    return _finish(b, RIDE_FIELDS, req, RIDE_COLS, mode, "ride")


def format_ride_lines(rides: DataFrame) -> DataFrame:
    """Ride record -> log line.  END lines carry (end, start) times, the order
    the log format expects, so an exported END line parses back to the same
    record."""
    s = F.col("is_start")
    st = utc_clock(F.col("start_time"))
    et = utc_clock(F.col("end_time"))
    line = F.concat_ws(",", F.col("ride_id").cast("string"), F.when(s, "START").otherwise("END"),
                       F.when(s, st).otherwise(et), F.when(s, et).otherwise(st),
                       *[F.col(c).cast("string") for c in ("start_lon", "start_lat", "end_lon", "end_lat",
                                                           "passenger_cnt", "taxi_id", "driver_id")])
    return rides.select("ride_id", line.alias("value"))


FARE_COLS = ["ride_id", "taxi_id", "driver_id", "start_time", "payment_type", "tip", "tolls", "total_fare",
             "event_time"]


def parse_fare_lines(lines: DataFrame, mode: str = "failfast"):
    b = _with_tokens(lines, ",")
    tok = [F.get(F.col("_tok"), i) for i in range(FARE_FIELDS)]
    b = b.select(
        "value", "_tok",
        _num(tok[0], "bigint", False).alias("ride_id"), _num(tok[1], "bigint", False).alias("taxi_id"),
        _num(tok[2], "bigint", False).alias("driver_id"), _time(tok[3], RIDE_TIME_FMT).alias("start_time"),
        tok[4].alias("payment_type"), _num(tok[5], "float", True).alias("tip"),
        _num(tok[6], "float", True).alias("tolls"), _num(tok[7], "float", True).alias("total_fare"),
    ).withColumn("event_time", F.col("start_time"))
    req = ["ride_id", "taxi_id", "driver_id", "start_time", "tip", "tolls", "total_fare"]
    return _finish(b, FARE_FIELDS, req, FARE_COLS, mode, "fare")


def format_fare_lines(fares: DataFrame) -> DataFrame:
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in ("ride_id", "taxi_id", "driver_id")],
                       utc_clock(F.col("start_time")), F.col("payment_type"),
                       *[F.col(c).cast("string") for c in ("tip", "tolls", "total_fare")])
    return fares.select("ride_id", line.alias("value"))


# Field positions used in a car line (the others are carried but unused):
# 0 car id, 1 event id, 7 consumption, 9 speed, 12 throttle, 19 engine load,
# 20 longitude, 21 latitude, 22 time.
CAR_POS = {"car_id": 0, "id": 1, "consumption": 7, "speed": 9, "throttle": 12, "engineload": 19,
           "longitude": 20, "latitude": 21, "time": 22}


CAR_COLS = ["id", "car_id", "event_time", "longitude", "latitude", "consumption", "speed", "throttle",
            "engineload"]
CAR_NUMS = ("longitude", "latitude", "consumption", "speed", "throttle", "engineload")


def parse_car_lines(lines: DataFrame, mode: str = "failfast"):
    b = _with_tokens(lines, CAR_SEPARATOR)
    tok = lambda name: F.get(F.col("_tok"), CAR_POS[name])
    b = b.select("value", "_tok", tok("id").alias("id"), tok("car_id").alias("car_id"),
                 _time(tok("time"), CAR_TIME_FMT).alias("event_time"),
                 *[_num(tok(n), "float", True).alias(n) for n in CAR_NUMS])
    return _finish(b, CAR_FIELDS, ["event_time", *CAR_NUMS], CAR_COLS, mode, "car event")


def format_car_lines(cars: DataFrame, filler: str = "") -> DataFrame:
    """Car record -> 23-field line; unused positions get ``filler``."""
    src = {CAR_POS["car_id"]: F.col("car_id"), CAR_POS["id"]: F.col("id"),
           CAR_POS["time"]: F.concat(F.replace(utc_clock(F.col("event_time")), F.lit(" "), F.lit("T")), F.lit("+0000"))}
    for n in ("consumption", "speed", "throttle", "engineload", "longitude", "latitude"):
        src[CAR_POS[n]] = F.col(n).cast("string")
    fields = [src.get(i, F.lit(filler)) for i in range(CAR_FIELDS)]
    return cars.select("id", F.concat_ws(",", *fields).alias("value"))


def _read_lines(spark, path: str, streaming: bool, max_files: int | None):
    if streaming:
        r = spark.readStream.format("text")
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return r.load(path)
    return spark.read.text(path)


def read_ride_log(spark, path: str, mode: str = "failfast", streaming: bool = False,
                  max_files_per_trigger: int | None = None):
    """Ride log files (plain or gzip text, one record per line) as ride records.

    A gzip file cannot be split, so each file is read by one task; at scale the
    log is many files, which the reader spreads over the cluster.  As a stream
    the file source's offset log makes the read restartable (the checkpoint
    location of the query records which files were processed).
    """
    return parse_ride_lines(_read_lines(spark, path, streaming, max_files_per_trigger), mode)


def read_fare_log(spark, path: str, mode: str = "failfast", streaming: bool = False,
                  max_files_per_trigger: int | None = None):
    """Fare log files as fare records (see :func:`read_ride_log`)."""
    return parse_fare_lines(_read_lines(spark, path, streaming, max_files_per_trigger), mode)


def read_car_log(spark, path: str, mode: str = "failfast", streaming: bool = False,
                 max_files_per_trigger: int | None = None):
    """Connected-car log files as car events (see :func:`read_ride_log`)."""
    return parse_car_lines(_read_lines(spark, path, streaming, max_files_per_trigger), mode)


def deal(tagged: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write a frame of mode "tag" below ``path``, valid records and invalid lines apart, in one pass over the input:
    (good records, rejected lines as ``value``, their counts).  The counts are observed while the rows are written."""
    spark = tagged.sparkSession
    seen = Observation()
    counted = tagged.observe(seen, F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("rejected"))
    counted.write.mode("overwrite").partitionBy("is_good").parquet(path)
    back = spark.read.schema(tagged.schema).parquet(path)
    good = back.where("is_good").drop("is_good", "rejected")
    rejects = back.where("NOT is_good").select(F.col("rejected").alias("value"))
    return good, rejects, {k: int(v) for k, v in seen.get.items()}


def write_log(lines, path: str, compression: str = "gzip") -> None:
    """Write a ``value`` column as text log files."""
    lines.select("value").write.mode("overwrite").option("compression", compression).text(path)
