import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from trailforge.operators import engagement, events, patterns as P


@pytest.mark.parametrize("regex,run", [
    ("/product/(\\w+)/detail", "/product/"), ("error code 17$", "error code 17"), ("^abcd.efghij", "efghij"), ("ab|cdefgh", ""), ("(?i)abcdef", ""), ("(abc)?defg", "defg"), ("(?:abcd)+x", "abcd"),
    ("a{2,3}bcde", "bcde"), ("[ab]cdef\\.gh", "cdef.gh"), ("(unclosed", ""), ("x*", ""), ("(?<name>Java) group", ""), ("\\p{Alpha}name", ""), ("(ab)(cd)", "abcd"), ("(?!abcdef)gh", "gh"), ("(?:(?i)abcdef)", ""),
])
def test_required_runs(regex, run):
    assert P.required(regex) == run


def made(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    words = [word() for _ in range(4000)]
    regexes = [rng.choice(["{0} {1}", "{0}.*{1}", "^{0}", "({0})", "{0}|{1}", "{0}[0-9]+", "(?i){0}x{1}"]).format(rng.choice(words), rng.choice(words)) for _ in range(n)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "7"]) for _ in range(rng.randrange(12))) for _ in range(2000)]
    return regexes, [*texts, None, "", "abc"]


@pytest.mark.parametrize("whole", [False, True])
def test_filed_patterns_find_what_plain_ones_find(spark, whole):
    regexes, texts = made(120)
    regexes = [f".*{r}.*" for r in regexes] if whole else regexes
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    fields = [{"i": i, "regex": r, "name": f"n{i % 7}"} for i, r in enumerate(regexes)]
    got = P.matches(df, "text", fields, whole)
    plain = P.matches(df, "text", fields, whole, few=10**6)
    assert got.columns == plain.columns and dict(got.dtypes) == dict(plain.dtypes)
    rows = sorted(map(tuple, got.select("id", "i", "regex", "name").collect()))
    assert rows == sorted(map(tuple, plain.select("id", "i", "regex", "name").collect())) and len(rows) > 100


def test_two_thousand_patterns_take_a_tenth_of_the_time(spark):
    regexes, texts = made(4000, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4).cache()
    df.count()
    fields = [{"i": i, "regex": r} for i, r in enumerate(regexes) if len(P.required(r)) >= P.GRAM][:2000]
    took, found = {}, {}
    for name, few in (("filed", P.FEW), ("plain", 10**6)):
        began = time.perf_counter()
        found[name] = P.matches(df, "text", fields, few=few).agg(F.count("*"), F.sum(F.xxhash64("id", "i").cast("decimal(38,0)"))).first()
        took[name] = time.perf_counter() - began
    assert found["filed"] == found["plain"] and found["filed"][0] > 0 and len(fields) == 2000
    print(took)
    assert took["filed"] < took["plain"] / 10, took


def test_events_and_hits_with_many_patterns(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(f"s{rng.randrange(9)}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 7), i, f"u{i % 3}", f"/page{rng.randrange(40)}/x", None) for i in range(300)]
    df = spark.createDataFrame(rows, "session_id string, ts timestamp, event_id int, user_id string, url string, referrer string").withColumn("record", F.col("url"))
    found = [(f"e{i}", f"/page{i}/x") for i in range(30)]
    hit = [engagement.Pattern(f"/(page{i})/x", 1 + i % 3, i % 2) for i in range(20)] + [engagement.Pattern("/page21/x", 3, 9), engagement.Pattern("/page22/x", 2, 7)]
    numbered = events.dense_positions(df, "event_id")

    def all_():
        return [sorted(map(str, x.collect())) for x in (events.session_event_context(df, found, 2, 1), events.stream_event_context(numbered, found, 2, 1), engagement.engagement_events(df, hit))]

    many = all_()
    monkeypatch.setattr(events, "FEW", 100)
    monkeypatch.setattr(P.matches, "__defaults__", (False, 100))
    assert all_() == many and all(many)
