import math

import pytest
from pyspark.sql import functions as F

from trailforge.functions import scalars as S, sql
from trailforge.sources import logs as L

LINES = {
    "w3c": ["2024-01-01 10:00:00 1.1.1.1 u 2.2.2.2 GET /a q=1 200 5 6 x HTTP/1.1 agent a=1;+sid=s=1;uid=u1;sid=last ref", "2024-01-01 10:00:00 1.1.1.1 u 2.2.2.2 GET /a q=1 200 5 6 7 HTTP/1.1 agent uid=u1 ref",
            "2024-01-01 25:00:00 1.1.1.1 u 2.2.2.2 GET /a q=1 200 5 6 7 HTTP/1.1 agent sid=u1 ref", "short line", "", None, "2024-01-01 10:00:00 1.1.1.1 u 2 GET /a q 200 5 6 7 H a sid=x"],
    "ncsa": ['1.1.1.1 - me [01/Jan/2024:10:00:00 +0100] "GET /a HTTP/1.1" 404 12 "http://x/" "Mozilla 5.0 (a b)" "a=1;sid=s1;uid=u"', '1.1.1.1 - me [no time] "GET" 404 - "r" "a" "sid=s1"',
             '1.1.1.1 - me [01/Jan/2024:10:00:00 +0000] "GET" 404 - "r" "a" "sid=s1"', '1.1.1.1 - me [01/Jan/2024:10:00:00 +0000] "GET /b" 200 1 - - sidx=1', "x", None],
}


@pytest.mark.parametrize("kind,parser", [("w3c", L.W3C), ("ncsa", L.NCSA)])
def test_table_functions_parse_like_the_column_functions(spark, kind, parser):
    sql.register(spark)
    lines = spark.createDataFrame([(x,) for x in LINES[kind]], "value string")
    got = spark.sql(f"SELECT w.* FROM {{lines}} AS l, LATERAL {kind}_log(l.value, 'sid', 'uid') AS w", lines=lines)
    want = L.parse_log(lines, parser, got.columns, "sid", "uid")
    assert dict(got.dtypes) == dict(want.dtypes) and "Python" not in got._jdf.queryExecution().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and 0 < got.count() < len(LINES[kind]) - 2


def test_scalars_of_sql(spark):
    names = sql.register(spark)
    assert {"cookie_value", "quoted_fields", "normal_cdf", "w3c_log", "ncsa_log"} <= set(names)
    for r in spark.sql("SELECT id / 97 AS z, normal_cdf(id / 97 * 2 + 1, 1, 2) AS p, normal_cdf(id, 0, 0) AS none FROM range(-1000, 1001, 13)").collect():
        assert abs(r["p"] - 0.5 * math.erfc(-float(r["z"]) / math.sqrt(2))) < 1e-14 and r["none"] is None
    text = spark.createDataFrame([('1.2 - me [a b] "GET /x" 200 "q r"',), ("",), (None,)], "t string")
    rows = text.select(S.quoted_fields(F.col("t"), 7).alias("a"), F.expr("quoted_fields(t)").alias("b"), F.expr("whole_group(t, '(1).*')").alias("g")).collect()
    assert rows[0]["a"] == rows[0]["b"] and rows[0]["g"] == "1" and rows[1]["b"] == [] and rows[1]["g"] is None and rows[2]["b"] is None
