"""Rules engine: ad-hoc predicates, supplied as data, evaluated over the latest
state of every taxi.

A rule is a Spark SQL boolean expression over the state's columns plus
``watermark`` (epoch ms).  The rules' text is read on the driver and checked
one by one:

* its words must be columns of the state, types, or the keywords and functions
  listed here.  The list holds what depends on the row alone and cannot fail at
  run time, so no rule reaches the JVM, the environment or other rows, and none
  can take the job down;
* it must analyse against the state as a boolean.

A rule that fails the check is reported in the rejects frame and does not
affect the others.  Accepted rules become projections of ``RULES_PER_PASS``
each, ``explode(array_compact(array(CASE WHEN rule_i THEN i END, ...)))``,
compiled by codegen.  They are analysed without ANSI errors: an operation that
fails on a row (a division by zero, a bad cast, an index outside an array) is
null there, so that row does not match that rule by it, and all other rows and
rules are as they would be without it.  Whole numbers that overflow wrap round.
"""

from __future__ import annotations

import logging
import re
from contextlib import contextmanager

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULES_PER_PASS = 200  # rules compiled into one projection

# The words a rule may hold besides the state's columns.
KEYWORDS = frozenset("and or not in between like is null true false case when then else end as div date timestamp".split())
TYPES = frozenset("boolean tinyint smallint int integer bigint long float real double decimal numeric string date timestamp".split())
FUNCTIONS = frozenset("""
    abs acos array array_contains asin atan atan2 bround cast cbrt ceil ceiling char_length coalesce concat concat_ws contains cos
    date_add date_sub datediff day dayofmonth dayofweek dayofyear degrees endswith exp floor get greatest hour hypot if ifnull
    instr isnan isnotnull isnull least left length ln locate log log10 log1p log2 lower ltrim minute mod month nanvl nullif nvl nvl2
    pmod pow power quarter radians replace reverse right round rtrim second sign signum sin size sqrt startswith substr substring
    tan translate trim try_add try_cast try_divide try_multiply try_subtract unix_micros unix_millis unix_seconds upper weekofyear year
""".split())
SIGNS = frozenset("(),+-*/%=<>!|&^~.[]")

_TOKEN = re.compile(r"""(?P<space>\s+) | (?P<comment>--|/\*) | (?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*") | (?P<column>`[^`]*`)
                        | (?P<number>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?:bd|[lsydf])?\b) | (?P<name>[A-Za-z_]\w*) | (?P<cast>::)
                        | (?P<sign>.)""", re.VERBOSE | re.DOTALL | re.IGNORECASE)


def refused_word(condition: str, columns: list[str]) -> str | None:
    """The first thing in a rule's text that is not on the lists, or None."""
    known = {c.lower() for c in columns}
    tokens, at = [], 0
    while at < len(condition):  # the last alternative takes any sign, so every text is covered
        m = _TOKEN.match(condition, at)
        at = m.end()
        if m.lastgroup != "space":
            tokens.append((m.lastgroup, m.group(), m.start()))
    tokens.append(("end", "", at))
    for i, (kind, text, start) in enumerate(tokens[:-1]):
        word = text.lower()
        after, next_text, next_start = tokens[i + 1]
        call = next_text == "("
        if kind == "comment" or kind == "sign" and text not in SIGNS:
            return text
        if kind == "column" and (call or text[1:-1].lower() not in known):
            return text
        if kind == "name":
            field = i > 0 and tokens[i - 1][1] == "."
            literal = word in ("date", "timestamp")
            if after == "text" and next_start == start + len(text) and not literal:
                return text  # a prefixed literal, whose quoting rules differ
            if call and not (word in FUNCTIONS or word in KEYWORDS or word in TYPES):
                return text
            if not call and not field and not (word in known or word in KEYWORDS or word in TYPES):
                return text
            if word == "like" and (after != "text" or "\\" in next_text):
                return text  # a pattern may be malformed
            if literal and after == "text" and not re.fullmatch(r"'\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d)?'", next_text):
                return next_text
    return None


@contextmanager
def _quiet_analysis_errors():
    """PySpark logs the query context of every analysis error it raises; a
    refused rule is an expected outcome (reported in the rejects frame), so
    those loggers are muted while a rule is probed."""
    loggers = [logging.getLogger(n) for n in ("SQLQueryContextLogger", "DataFrameQueryContextLogger")]
    saved = [lg.disabled for lg in loggers]
    for lg in loggers:
        lg.disabled = True
    try:
        yield
    finally:
        for lg, d in zip(loggers, saved):
            lg.disabled = d


@contextmanager
def _failing_is_null(spark: SparkSession):
    """Frames analysed inside take operations that fail as null; the session's own setting comes back after."""
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def check_rule(state: DataFrame, condition: str) -> str | None:
    """None if the rule is usable on ``state``, else the reason."""
    if condition is None or not condition.strip():
        return "empty rule"
    word = refused_word(condition, state.columns)
    if word is not None:
        return f"not allowed: {word}"
    try:
        with _quiet_analysis_errors(), _failing_is_null(state.sparkSession):
            dt = state.select(F.expr(condition).alias("r")).schema["r"].dataType
    except (AnalysisException, ParseException) as ex:
        return f"invalid: {type(ex).__name__}"
    except Exception as ex:  # noqa: BLE001 - any analysis failure rejects the rule
        return f"invalid: {type(ex).__name__}"
    if dt.simpleString() != "boolean":
        return f"not a predicate ({dt.simpleString()})"
    return None


def evaluate_rules(state: DataFrame, rules: DataFrame, watermark_ms: int,
                   id_col: str = "rule_id", cond_col: str = "condition") -> tuple[DataFrame, DataFrame]:
    """(matches, rejects): ``matches`` has ``rule_id`` + the state columns for
    every (rule, state row) where the rule holds; ``rejects`` lists refused
    rules with a reason."""
    spark = state.sparkSession
    s = state.withColumn("watermark", F.lit(watermark_ms).cast("bigint"))
    accepted, rejected = [], []
    for r in rules.select(id_col, cond_col).collect():
        reason = check_rule(s, r[cond_col])
        (rejected if reason else accepted).append((r[id_col], r[cond_col], reason))
    rejects = spark.createDataFrame([(a, b, c) for a, b, c in rejected],
                                    f"{id_col} bigint, {cond_col} string, reason string")
    if not accepted:
        return s.select(F.lit(None).cast("bigint").alias(id_col), *state.columns).where(F.lit(False)), rejects
    matches = None
    for at in range(0, len(accepted), RULES_PER_PASS):
        some = accepted[at:at + RULES_PER_PASS]
        with _failing_is_null(spark):
            hits = F.array_compact(F.array(*[F.when(F.coalesce(F.expr(c), F.lit(False)), F.lit(i).cast("bigint"))
                                             for i, c, _ in some]))
            m = s.select(F.explode(hits).alias(id_col), *state.columns)
        matches = m if matches is None else matches.unionByName(m)
    return matches, rejects
