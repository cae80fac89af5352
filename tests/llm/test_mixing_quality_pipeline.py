"""Mixing, the classifier, encoding over a table, and the pipeline's stages on small tables."""

import hashlib
import math
import os
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trailforge.llm import bpe, mixing, neardup, quality

SF = "/root/testdata/sf0.001"


def h60(*parts):
    return int(hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:15], 16)


def brute_mix(rows, repeats=None, budget=None):
    """Visits of each row by the definition, over plain lists; rows of (doc_id, source, tokens)."""
    size = {}
    for _, s, t in rows:
        size[s or ""] = size.get(s or "", 0) + t
    full = {s: t for s, t in size.items() if t}
    total, most, least = sum(full.values()), max(full.values()), min(full.values())

    def most_passes(a):
        z = sum((t / total) ** a for t in full.values())
        goal = budget if budget is not None else most / ((most / total) ** a / z)
        return max((t / total) ** a / z * goal / t for t in full.values())

    low, high = 0.0, 1.0
    for _ in range(mixing.STEPS):
        mid = (low + high) / 2
        low, high = (low, mid) if most_passes(mid) <= repeats else (mid, high)
    z = sum((t / total) ** high for t in full.values())
    goal = budget if budget is not None else math.ceil(most / ((most / total) ** high / z))
    visits = {}
    for s in size:
        share = max(math.floor((size[s] / total) ** high / z * goal + 0.5), size[s] if budget is None else 0) if size[s] else 0
        passes, rest = divmod(share, size[s]) if size[s] else (1, 0)
        own = [(h60("mix", s, passes, (b := h60("mix", "block", "" if i is None else i) % mixing.BLOCKS)), b, h60("mix", "doc", passes, "" if i is None else i), i, t) for i, x, t in rows if (x or "") == s]
        used, taken = 0, set()
        for order, block in sorted({(o, b) for o, b, *_ in own}):
            docs = sorted((d, i, t) for o, b, d, i, t in own if b == block)
            inside = sum(t for *_, t in docs)
            if used + inside <= rest:
                taken |= {i for _, i, _ in docs}
                used += inside
                continue
            for d, i, t in docs:
                if used + t > rest:
                    break
                used += t
                taken.add(i)
            break
        for _, _, _, i, t in own:
            visits[i, s] = passes + (i in taken and t > 0 and rest > 0)
    return visits


@pytest.mark.parametrize("budget", [None, 3000, 40_000])
def test_visits_follow_the_definition(spark, budget):
    rng = random.Random(3)
    rows = [(i, rng.choice(["big"] * 6 + ["a", "b", None]), rng.randrange(0, 40)) for i in range(400)] + [(900, "empty", 0), (901, "empty", 0)]
    df = spark.createDataFrame([(i, s, " ".join(["w"] * t) if t else rng.choice([None, "", " \n"]), 1) for i, s, t in rows], "doc_id long, source string, text string, epoch int")
    made = mixing.mix(df, 3.0, budget=budget).collect()
    got = {}
    for r in made:
        got[r["doc_id"], r["source"] or ""] = got.get((r["doc_id"], r["source"] or ""), 0) + 1
    assert got == {k: v for k, v in brute_mix(rows, 3.0, budget).items() if v}
    if budget is None:
        assert {r["doc_id"] for r in made} == {i for i, *_ in rows}
    assert len({(r["doc_id"], r["epoch"]) for r in made}) == len(made)


def test_entropy_target_and_limits():
    class Fixed(mixing.Shares):
        def __init__(self, tokens):
            self.many, self.tokens = False, tokens
            self.total, self.most, self.least = sum(tokens), max(tokens), min(tokens)

    shares = Fixed([800, 100, 50, 50])
    flat, own = math.log(4), shares.entropy(1.0)
    want = (flat + own) / 2
    assert shares.entropy(mixing.exponent(shares, entropy=want)) == pytest.approx(want)
    alpha = mixing.exponent(shares, repeats=2.0)
    assert shares.repeats(alpha, None) == pytest.approx(2.0)
    assert mixing.exponent(Fixed([5, 5]), repeats=2.0) == pytest.approx(0, abs=1e-9)


def test_many_sources_and_repeated_rows(spark, monkeypatch):
    rows = [(i // 2, f"s{i % 7}", "a b c") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    few = sorted(map(str, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "SOURCES", 0)
    assert sorted(map(str, mixing.mix(df).collect())) == few
    assert mixing.mix(df.limit(0)).collect() == []


# --- classifier


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    x, at, y = rng.normal(size=(12, 5)), np.array([0, 3, 4, 9, 12]), np.array([1.0, 0, 1, 0])
    model = quality.fit(x.astype(np.float32), at, y, steps=1, hidden=4, gate=3)
    bag = np.repeat(np.arange(4), np.diff(at))
    x = (x - model.mean) / model.scale
    loss = lambda: -np.mean(y * np.log(p := model.forward(x, bag, 4)["p"]) + (1 - y) * np.log(1 - p))
    for name, g in model.step(x, bag, y, 0.0).items():
        flat = model.w[name].reshape(-1)
        for i in range(0, len(flat), 3):
            keep, eps = flat[i], 1e-6
            flat[i] = keep + eps
            up = loss()
            flat[i] = keep - eps
            down = loss()
            flat[i] = keep
            assert g.reshape(-1)[i] == pytest.approx((up - down) / (2 * eps), abs=1e-6)


def test_classifier_without_much_to_learn(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (3, "fine words here", 5.0), (None, "x", 5.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.classify(docs, none).collect()
    assert {r["score"] for r in got} == {0.5} and len(got) == 4 and {r["predicted"] for r in got} == {1}
    one = spark.createDataFrame([(3, 1), (3, None), (2, 7)], "doc_id long, quality int")
    assert {r["score"] for r in quality.classify(docs, one).collect()} <= {1.0, 0.5}
    assert quality.classify(docs.limit(0), none).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    clean = [r for r in got if r["quality"] == 1]
    assert np.mean([r["predicted"] for r in clean]) > 0.97


# --- encoding and the pipeline


def test_digests_are_the_librarys(spark):
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, "", "Hello wörld", "<|endoftext|> x", "a" * 1000, "Hello wörld"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    for r in bpe.digests(df).collect():
        ids = theirs.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        back = theirs.decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert bpe.digests(df.limit(0)).collect() == []
    apart = bpe.decode(bpe.encode(df)).collect()
    assert {r["doc_id"]: r["decoded"] for r in apart} == {r["doc_id"]: r["decoded"] for r in bpe.round_trip(df).collect()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, steps[-1], SF)
        assert out.schema.names == docs.schema.names
        steps.append(spark.createDataFrame(out.collect(), docs.schema))
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in steps]
    assert ids[1] <= ids[0] and ids[2] <= ids[1] and ids[3] <= ids[2] and ids[4] == ids[3]
    lines = [x for r in steps[2].collect() for x in r["text"].split("\n") if x.strip()]
    assert len({" ".join(x.lower().split()) for x in lines}) == len(lines)
    assert neardup.classes(steps[3]).where("not kept").count() == 0
    assert steps[2].where(F.char_length("text") != F.col("n_chars")).join(docs.where(F.char_length("text") == F.col("n_chars")), "doc_id", "left_semi").count() == 0
    final = corpus_pipeline.STAGES[-1][1](spark, steps[4], SF)
    assert final.count() == steps[4].count()
