import random

from trailforge.llm import common
from trailforge.llm.linededup import Forest


def test_components_against_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(60)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (7, 8), (7, 8)]
    forest = Forest(600)
    for u, v in pairs:
        forest.join(u, v)
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    nodes = {x for u, v in pairs if u != v for x in (u, v)}
    assert got == {n: forest.root(n) for n in nodes}
    assert common.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_hot_join_is_a_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 3)
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    left = spark.createDataFrame([(k % 7, k) for k in range(50)] + [(3, k) for k in range(90, 120)] + [(99, 1), (None, 2)], "k int, x int")
    right = spark.createDataFrame([(k, 10 * k, 7 if k != 3 else 37) for k in range(7)], "k int, y int, n int")
    weighed = common.weighed(right, "right", "n")
    assert weighed[1] == 26
    for how in ("inner", "left"):
        got = common.hot_join(left, weighed, ["k"], "n", how).select("k", "x", "y")
        assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", how).select("k", "x", "y").collect()))


def test_runs_cross_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame([(k // 10, k) for k in range(100)], "k int, x long")
        got = common.per_run(df, ["k"], lambda key, rows: [(key[0], sum(rows["x"]))] if key[0] else [])
        assert sorted(map(tuple, got.collect())) == [(k, sum(range(10 * k, 10 * k + 10))) for k in range(1, 10)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
