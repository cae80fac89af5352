"""Cases that every stage of the pipeline defines, the classifier against a plain one, hot places, and recall of the fuzzy operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.test_catalog import SF, pytestmark  # noqa: F401
from trailforge.llm import kernel, linededup, meeting, neardup, quality
from trailforge.llm.linededup import Forest

#: Names that steps give to columns of theirs.
OWN = ["score", "tokens", "epoch", "block", "doc_order", "progress", "n_dropped", "high", "low", "key_id", "key_text", "__key_id", "__key_text", "ids", "decoded", "places", "__id", "__source", "__tokens", "lines_lost", "visit_epoch"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_stages_keep_columns_and_take_all_texts(spark):
    rng = random.Random(1)
    long_ = "\n".join(words(rng, 200) for _ in range(300))
    rows = [(None, "no id at all, but words"), (1, None), (2, ""), (3, " \n"), (4, long_), (5, words(rng, 80)), (5, words(rng, 80)), (6, "tie and tie"), (7, "tie and tie"), (8, long_ + " end")]
    rows += [(9, "repeated row of some words")] * 2
    docs = spark.createDataFrame([(i, t, "en", None if i == 5 else "web", len(t or ""), *range(len(OWN))) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` int" for c in OWN))
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, steps[-1], SF)
        assert out.schema.names == docs.schema.names, name
        found = out.collect()
        assert all(r[c] == k for r in found for k, c in enumerate(OWN)), name
        steps.append(spark.createDataFrame(found, docs.schema))
    made = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(made) == len(rows) and {r["n_tokens"] for r in made if r["doc_id"] in (1, 2, 3)} == {0}
    apart = corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()
    said = {(r["doc_id"], r["text"]) for r in apart}
    assert (1, None) in said and (2, "") in said and (None, "no id at all, but words") in said
    # Of a tie the least id stays, and a repeated row is a copy of itself in every line, as is a long text's.
    assert (6, "tie and tie") in said and not any(i == 7 for i, _ in said) and not any(i == 8 and "end" not in t for i, t in said)
    near = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    ids = [r["doc_id"] for r in near]
    assert 7 not in ids and 8 not in ids and {None, 1, 2, 3, 4, 6, 9} <= set(ids) and ids.count(9) == 1 and ids.count(5) == 2


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == [], name


def plain_passages(text):
    """The features of each passage of a text, by plain loops; hashed words come from the kernel."""
    found, data = [], text.encode()
    raw = [w for w in data.replace(b"\t", b" ").split() if w]
    hashes = [int(kernel.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in raw]
    covered = [False] * len(raw)
    for i in range(len(raw) - 2):
        if sum(raw[j : j + 3] == raw[i : i + 3] for j in range(len(raw) - 2)) > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = True
    begin, at = [], 0
    for w in raw:
        at = data.index(w, at)
        begin.append(at)
        at += len(w)
    for lo in range(0, len(raw), quality.PASSAGE):
        own = raw[lo : lo + quality.PASSAGE]
        end = begin[lo + len(own)] if lo + len(own) < len(raw) else len(data)
        stretch, n = data[begin[lo] : end], len(own)
        x = [sum(quality._CLASS[b] == k for b in stretch) / len(stretch) for k in range(quality._CLASSES)]
        mean = sum(map(len, own)) / n
        x += [math.log(mean), math.log1p(math.sqrt(max(sum(len(w) ** 2 for w in own) / n - mean**2, 0))), math.log(n), len(set(own)) / n, sum(covered[lo : lo + n]) / n]
        x.append(sum(65 <= w[0] <= 90 and not 97 <= w[-1] <= 122 for w in own) / n)
        slots = [0.0] * quality._HASHED
        for h in hashes[lo : lo + n]:
            slots[h & (quality._HASHED - 1)] += 1 if h >> 8 & 1 else -1
        found.append(x + [s / math.sqrt(n) for s in slots])
    return found or [[0.0] * quality.WIDTH]


def plain_score(model, text):
    """Gated attention over the passages of one text, a number at a time."""
    w, encoded, gates = model.w, [], []
    for x in plain_passages(text):
        x = [(a - m) / s for a, m, s in zip(x, model.mean, model.scale)]
        z = [math.tanh(sum(x[i] * w["enc"][i][j] for i in range(len(x))) + w["enc0"][j]) for j in range(len(w["enc0"]))]
        sig = lambda y: 1 / (1 + math.exp(-y))
        t = [math.tanh(sum(z[i] * w["v"][i][j] for i in range(len(z)))) for j in range(len(w["att"]))]
        s = [sig(sum(z[i] * w["u"][i][j] for i in range(len(z)))) for j in range(len(w["att"]))]
        encoded.append(z)
        gates.append(math.exp(sum(a * b * c for a, b, c in zip(t, s, w["att"]))))
    pooled = [sum(g * z[j] for g, z in zip(gates, encoded)) / sum(gates) for j in range(len(encoded[0]))]
    return 1 / (1 + math.exp(-sum(p * o for p, o in zip(pooled, w["out"])) - w["out0"][0]))


def test_scores_are_those_of_a_plain_forward_pass(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n"), (-4, "A\x0bb\x1cc é C3 C3 C3 C3")], "doc_id long, text string")
    # Tabs and the like count as white space in a stretch; the plain version splits where the operator does.
    some = docs.select("doc_id", "text").where(~F.col("text").rlike("[\\x0B\\x0C\\r]") & (F.char_length("text") < 6000)).union(odd.where("doc_id > -4"))
    got = quality.score(some, model).collect()
    assert len(got) > 100
    for r in got:
        assert r["score"] == pytest.approx(plain_score(model, r["text"] or ""), abs=2e-5), r["doc_id"]


def test_bags_of_training_are_bounded(spark):
    text = " ".join(f"w{i}" for i in range(quality.PASSAGE * 1000))
    data = np.frombuffer(text.encode(), np.uint8)
    x, _ = quality.passages(data, np.array([0, len(data)]))
    thin = quality._thinned(x)
    assert len(x) == 1000 and len(thin) == quality.BAG and (thin[0] == x[0]).all() and (thin[-1] == x[-1]).all()


def test_a_hot_place_is_connected_exactly(spark, monkeypatch):
    monkeypatch.setattr(meeting, "SLICE", 64)
    rng = random.Random(3)
    # One place with two clusters, single members, and chains that a pivot alone does not connect.
    values = [rng.randrange(40) for _ in range(1500)] + [10_000 + rng.randrange(30) for _ in range(400)] + [20_000 + 9 * k for k in range(60)] + [50_000 + 100 * k for k in range(80)]
    rows = [(7, k, 0) for k in range(len(values))] + [(8, 3, 0), (8, 1700, 0), (9, 2, 0)]
    met = meeting.pivoted(spark.createDataFrame(rows, "key long, id long, tag long"), ["key"])
    things = spark.createDataFrame(list(enumerate(values)), "id long, value long")
    same = lambda a, b: abs(a - b) <= 10
    forest = Forest(len(values))
    order = sorted(range(len(values)), key=values.__getitem__)
    for a, b in zip(order, order[1:]):
        if same(values[a], values[b]):
            forest.join(a, b)
    for metric in (None, meeting.Metric(lambda a, b: abs(a - b), lambda a, b: 10)):
        found = meeting.connect(met, ["key"], things, int, same, lambda key, tags, i: np.ones(i, bool), metric=metric)
        got = {r["node"]: r["root"] for r in found.collect()}
        assert {k: got.get(k, k) for k in range(len(values))} == {k: forest.root(k) for k in range(len(values))}


def edited(rng, line, how):
    if how == "word":
        line = line.split()
        line[rng.randrange(len(line))] = words(rng, 1)
        return " ".join(line)
    at = rng.randrange(len(line))
    return line[:at] + rng.choice("xyz") + line[at + 1 :]


def test_lines_with_one_edit_are_linked_whatever_their_length(spark):
    """Pairs by the edit similarity of all pairs, with no other condition."""
    rng = random.Random(11)
    rows, planted = [], {}
    for size in (3, 5, 8, 12, 20, 40, 80, 150):
        for k in range(25):
            line = words(rng, size)
            for how in ("word", "character"):
                rows += [line, edited(rng, line, how)] if how == "word" else [edited(rng, line, how)]
                planted.setdefault((size, how), []).append((line, rows[-1]))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    left = {r["text"] for r in linededup.deduplicate(df, radius=None).collect() if r["text"]}
    for (size, how), pairs in planted.items():
        alike = [(a, b) for a, b in pairs if linededup.similar(a, b)]
        # The first line of a group stays, so an edited one that stays was not linked.
        caught = sum(b not in left for _, b in alike)
        assert caught >= 0.9 * len(alike) - 1, (size, how, caught, len(alike))


def test_documents_with_few_edits_are_one_class(spark):
    """Pairs at a plain 5-word Jaccard similarity of 0.85 or more, one copy each, and a group that holds a third of all rows."""
    rng = random.Random(12)
    rows, pairs = [], []
    for k in range(120):
        text = words(rng, 200).split()
        copy = list(text)
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(200)] = words(rng, 1)
        pairs.append((len(rows), len(rows) + 1))
        rows += [" ".join(text), " ".join(copy)]
    hot = words(rng, 200).split()
    for _ in range(120):
        copy = list(hot)
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(200)] = words(rng, 1)
        pairs.append((240, len(rows)))
        rows.append(" ".join(copy))
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, rows)]
    near = [(a, b) for a, b in pairs if a != b and len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) >= 0.85]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert len(near) > 150 and sum(got[a] == got[b] for a, b in near) >= 0.95 * len(near)
    assert len({got[2 * k] for k in range(120)}) == 120
