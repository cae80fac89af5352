import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trailforge.llm import fuzzyhash as fh, registry
from tests.test_catalog import SF, pytestmark  # noqa: F401


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """doc_id: component, by comparing all fingerprints; rows have doc_id and fingerprint."""
    up = list(range(len(rows)))

    def root(i):
        return i if up[i] == i else root(up[i])

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [least.get(root(i)) for i in range(len(rows))]


def test_the_code_is_perfect():
    table = fh.decoder()
    assert np.bincount(table).tolist() == [2048] * 4096
    words = np.arange(1 << 23)
    zero = words[table == 0]
    assert sorted(set(np.bitwise_count(zero).tolist())) == [0, 1, 2, 3]


def test_segments_two_bits_apart_share_an_index():
    rng = np.random.default_rng(1)
    for width in (21, 22):
        v = rng.integers(0, 1 << width, 3000)
        w = v ^ (1 << rng.integers(0, width, 3000)) ^ (1 << rng.integers(0, width, 3000))
        a, b = fh.indices(v, width), fh.indices(w, width)
        assert all(set(x) & set(y) - {-1} for x, y in zip(a.tolist(), b.tolist()))


def test_linked_fingerprints_meet():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 64, 3000, np.uint64)
    other = one.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    (a, x), (b, y) = fh.places(one.view(np.int64)), fh.places(other.view(np.int64))
    met = set(zip(a.tolist(), x.tolist())) & set(zip(b.tolist(), y.tolist()))
    assert {r for _, r in met} == set(range(3000))


def test_fingerprints_against_plain_loops(monkeypatch):
    monkeypatch.setattr(fh, "PIECE", 50)
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "One TWO three", "É é ÀB\x0bc\x0cd\re f", "x" * 500, "a b c d " * 40]
    texts += ["".join(rng.choice(["ab", "C", "é", " ", "\n", "  "]) for _ in range(rng.randrange(200))) for _ in range(60)]
    for t in texts:
        assert fh.fingerprint((t or "").encode()) & (1 << 64) - 1 == plain(t)


@pytest.mark.parametrize("size", [256, 3])
def test_components_against_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(fh, "SLICE", size)
    rng = random.Random(size)
    words = ["w%d" % i for i in range(60)]
    base = [[rng.choice(words) for _ in range(n)] for n in (3, 8, 40, 400, 400, 900)]
    rows = [(None, None), (7000, ""), (7001, "\n"), (None, "alone with no id at all"), (7002, "One two"), (7003, "one  TWO")]
    for i in range(220):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += rows[10:14]
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, print int, n int, root int")
    got = [tuple(r) for r in fh.components(df).collect()]
    prints = [(d, plain(t)) for d, t in rows]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, brute(prints))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_places_with_many_components(spark, monkeypatch):
    """Fingerprints that all meet in one place, most of them not linked, in slices and in one array."""
    rng = np.random.default_rng(5)
    far = (rng.integers(0, 1 << 21, 400, np.uint64) << np.uint64(43)).view(np.int64)
    near = far[:60] ^ np.int64(1 << 60)
    prints = np.unique(np.concatenate([far, near]))
    df = spark.createDataFrame([(int(p),) for p in prints], "print long")
    want = brute([(int(p), int(p) & (1 << 64) - 1) for p in prints])
    for size in (256, 16):
        monkeypatch.setattr(fh, "SLICE", size)
        got = {r["node"]: r["root"] for r in fh.link(df).collect()}
        assert [got.get(int(p), int(p)) for p in prints] == want


def test_whole_table(spark):
    got = registry.QUERIES["op11_golay_simhash"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], plain(r["text"])) for r in docs]
    assert sorted(map(tuple, got)) == sorted((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute(prints)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string").where(F.lit(True))
    assert fh.components(empty).collect() == []
