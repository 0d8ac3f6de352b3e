"""A rule that fails on a row does no harm to other rows and rules; a rule that could do harm is refused."""

import pytest

from fleetwise.operators import rules


@pytest.fixture(scope="module")
def state(spark):
    return spark.createDataFrame([(1, 0, "x"), (2, 4, "7"), (3, 9, None), (4, None, "9")], "taxi_id long, n long, name string")


def test_failing_operations_match_nothing(spark, state):
    given = [(1, "n > 5"), (2, "10 / n > 2"), (3, "cast('x' as int) = n"), (4, "cast(name as int) = n OR n = 4"), (5, "get(array(1), 5) = n"),
             (6, "array(4, 9)[n] = 4"), (7, "n % 0 = 1 OR n div 0 = 1"), (8, "try_divide(10, n) > 2"), (9, "name::int > 6"), (10, "sqrt(n) = 3"),
             (11, "element_at(array(1), 5) = n"), (12, "name like '%7'"), (13, "date'2020-01-01' < timestamp '2021-01-01 00:00:00' AND n = 9"),
             (14, "substring(name, n, 1) = '7'"), (15, "case when n = 0 then 1 / n else 5 end > 4")]
    matches, rejects = rules.evaluate_rules(state, spark.createDataFrame(given, "rule_id long, condition string"), 0)
    found = {}
    for r in matches.collect():
        found.setdefault(r.rule_id, set()).add(r.taxi_id)
    assert found == {1: {3}, 2: {2}, 4: {2}, 6: {1}, 8: {2}, 9: {2, 4}, 10: {3}, 12: {2}, 13: {3}, 15: {2, 3, 4}}
    assert {r.rule_id: r.reason for r in rejects.collect()} == {11: "not allowed: element_at"}
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"  # the session's own setting is back


@pytest.mark.parametrize("bad", [
    "reflect('java.lang.System', 'nanoTime') = '1'", "`reflect`('a', 'b') = '1'", "reflect /**/ ('a', 'b') = 'c'", "n > (select 1)", "n in (table t)",
    "rand() > 0", "max(n) > 1", "sum(n) over () > 1", "exists(array(n), x -> x > 1)", "current_user = 'x'", "current_user() = 'x'", "raise_error('x') is null",
    "name rlike '('", "name like name", r"name like 'a\\'", r"r'\' = name OR reflect('a', 'b') = 'c' OR name = r'\'", "n > 1 -- all", "n > :x", "n > ?",
    "timestamp_millis(n) is null", "element_at(array(1), 0) = 1", "no_such > 1", "`no such` > 1", "n", "n +", "", "  ", "explode(array(true))",
    "date'99999-01-01' is null", "date'x' is null", "name = $$x$$", "n > 1; drop table x", "watermark(n)"])
def test_refused(spark, state, bad):
    given = spark.createDataFrame([(1, bad), (2, "n = 9")], "rule_id long, condition string")
    matches, rejects = rules.evaluate_rules(state, given, 0)
    assert [r.rule_id for r in rejects.collect()] == [1]
    assert [(r.rule_id, r.taxi_id) for r in matches.collect()] == [(2, 3)]


def test_every_listed_function_runs_on_nulls(spark, state):
    """None of the listed functions fails on extreme rows: one rule for each number function, on numbers of all kinds."""
    odd = spark.createDataFrame([(0, 0.0), (-1, -1.0), (2 ** 63 - 1, float("nan")), (-2 ** 63, float("inf")), (None, None)], "n long, x double")
    one = [f for f in rules.FUNCTIONS if f not in ("cast", "try_cast", "if")]
    calls = [f"{f}({a}) is null" for f in sorted(one) for a in ("n", "x", "n, n", "x, x", "n, n, n", "cast(n as string)", "cast(n as string), n",
                                                               "cast(n as string), n, n", "array(n), n", "cast(n as date)", "date'2020-01-01', n",
                                                               "cast(n as string), cast(n as string)", "cast(x as string), 'a', 'b'", "array(n)", "cast(n as timestamp)",
                                                               "date'2020-01-01', cast(n as int)")]
    given = spark.createDataFrame(list(enumerate(calls)), "rule_id long, condition string")
    matches, rejects = rules.evaluate_rules(odd, given, 0)
    refused = {r.rule_id for r in rejects.collect()}
    assert {c.split("(")[0] for i, c in enumerate(calls) if i not in refused} == set(one)
    assert matches.count() > len(calls) // 10
