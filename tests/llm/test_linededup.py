import os
import random

import numpy as np
import pyarrow as pa
import pytest

from trailforge.functions.scratch import shared_dir
from trailforge.llm import kernel, linededup as ld, meeting


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_is_levenshtein():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(rng.choice("abé ") for _ in range(rng.randrange(24))) for _ in range(2))
        assert ld.edit_distance(a, b) == levenshtein(a, b)


@pytest.mark.parametrize("n", [2, 10**4, 10**6, 10**8, 10**12])
def test_masks_leave_no_near_pair_apart(n):
    bits = ld.block_bits(n)
    assert sum(bits) == 64
    masks, rng = ld.tables(bits), random.Random(n)
    for _ in range(300):
        apart = sum(1 << i for i in rng.sample(range(64), ld.RADIUS))
        assert any(not apart & m for m in masks)


def sim_of(line):
    data = np.frombuffer(line.lower().encode(), np.uint8)
    _, _, high, low, sim = ld.signatures(data, np.array([0, len(data)]))
    return (int(high[0]), int(low[0]), int(sim[0])) if len(high) else None


def brute(rows):
    """Text of each row after the same by comparing all pairs; rows of (doc_id, text)."""
    places, info = [], []
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    for r in order:
        for k, line in enumerate((rows[r][1] or "").split("\n")):
            if (s := sim_of(line)) is not None:
                places.append((r, k))
                info.append((s, ld._normal(line)))
    forest = ld.Forest(len(places))
    for i in range(len(places)):
        for j in range(i):
            (a, x), (b, y) = info[i], info[j]
            if a[:2] == b[:2] or (bin(a[2] ^ b[2]).count("1") <= ld.RADIUS and ld.similar(x, y)):
                forest.join(i, j)
    gone = {p for i, p in enumerate(places) if forest.root(i) != i}
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (r, k) not in gone) for r, (_, t) in enumerate(rows)]


def test_whole_operator_against_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            line = rng.choice(base).split()
            if rng.random() < 0.6:
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append((" " * rng.randrange(3)).join(["", " ".join(line)]).upper() if rng.random() < 0.2 else " ".join(line))
        rows.append((i * 3, "\n".join([*lines, ""] if i % 7 == 0 else lines)))
    rows += [(1000, None), (1001, ""), (1002, " \n\n"), (1003, "x" * 20_000 + "\n" + "x" * 20_000)]
    df = spark.createDataFrame([(a, b, "s", 7) for a, b in rows], "doc_id long, text string, place string, n_dropped int")
    got = {r["doc_id"]: r for r in ld.deduplicate(df).collect()}
    want = dict(zip((r[0] for r in rows), brute(rows)))
    assert {k: r["text"] for k, r in got.items()} == want
    assert got[1003]["n_dropped"] == 1 and got[0]["place"] == "s"
    kept = {r["doc_id"] for r in ld.deduplicate(df, drop_emptied=True).collect()}
    assert {1000, 1001, 1002} <= kept
    lost = {k for (k, t), w in zip(rows, brute(rows)) if t and t.strip() and not w.strip()}
    assert kept == {r[0] for r in rows} - lost


def test_slices_of_large_places(spark, monkeypatch):
    monkeypatch.setattr(ld, "SLICE", 4)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:150], f"edit{i}"])) for i in range(40)] + [(None, "only here"), (None, "only here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in ld.deduplicate(df).collect()), key=str)
    assert got == sorted(zip([r[0] for r in rows], brute(rows[:40]) + ["only here"] * 2), key=str)


def test_empty_table(spark):
    assert ld.deduplicate(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_kernel_lines():
    data, offsets = np.frombuffer(b"a\n\nbc\n", np.uint8), np.array([0, 2, 2, 6])
    begin, end, at = kernel.lines(data, offsets)
    assert [bytes(data[b:e]) for b, e in zip(begin, end)] == [b"a", b"", b"", b"", b"bc", b""] and at.tolist() == [0, 2, 3, 6]


def edited(line, share, rng, words):
    line = line.split()
    for at in rng.sample(range(len(line)), max(1, round(share * len(line)))):
        line[at] = rng.choice(words)
    return " ".join(line)


def test_edited_copies_meet_by_edit_similarity_alone(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    rows = []
    for size in (10, 20, 30, 50, 80, 120):
        for _ in range(12):
            line = " ".join(rng.choice(words) for _ in range(size))
            rows += [line, edited(line, 0, rng, words), edited(line, 0.05, rng, words)]
    forest = ld.Forest(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if ld.similar(rows[i], rows[j]):
                forest.join(i, j)
    want = {i for i in range(len(rows)) if forest.root(i) == i}
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"] for r in ld.deduplicate(df, radius=None).collect() if r["text"]}
    narrow = {r["doc_id"] for r in ld.deduplicate(df).collect() if r["text"]}
    assert want <= got and len(got - want) <= 1 and len(narrow) > 1.5 * len(want)


def test_short_lines_and_slices_by_edit_similarity(spark, monkeypatch):
    monkeypatch.setattr(meeting, "SLICE", 4)
    monkeypatch.setattr(ld, "OFTEN", 7)
    monkeypatch.setattr(ld, "LISTED", 6)
    rows = ["abcdefghijklmnopqrst", "abcdefghijKlmnopqrsu", "something else here", "ab", "ac"]
    rows += [" ".join([*[f"w{i}" for i in range(50)], f"edit{k}"]) for k in range(20)] + ["ab", None, "  "]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in ld.deduplicate(df, radius=None).collect()}
    assert [k for k, t in sorted(got.items()) if t and t.strip()] == [0, 2, 3, 4, 5] and got[26] is None and got[27] == "  "


def test_edit_distance_stops_past_a_bound():
    rng = random.Random(3)
    for _ in range(1000):
        a, b = ("".join(rng.choice("ab ") for _ in range(rng.randrange(24))) for _ in range(2))
        most = rng.randrange(12)
        assert (ld.edit_distance(a, b, most) <= most) == (levenshtein(a, b) <= most)


def test_similar_is_the_edit_distance_under_its_bound():
    rng = random.Random(5)
    for _ in range(2000):
        a = [rng.choice(["la", "casa", "b", "perro"]) for _ in range(rng.randrange(1, 12))]
        b = [w for w in a if rng.random() < 0.9] + ["b"] * rng.randrange(2)
        a, b = " ".join(a), " ".join(b)
        assert ld.similar(a, b) == (levenshtein(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)


def test_a_pair_is_compared_where_its_gates_agree(spark):
    """Two equal texts and a stranger meet in a place of long n-grams, whose gates are alike, and in an earlier one of short n-grams, whose gates are not."""
    like, one, other = 5 << 56, 5 << 56 | 0x11111111111111, 5 << 56 | 0x22222222222222
    rows = [(2, 1, 1, like, [2, -1]), (2, 2, 2, like, [2, -1]), (2, 3, 3, like, [2, -1]), (-1, 1, 1, one, [2, -1]), (-1, 2, 2, other, [2, -1]), (-1, 3, 3, like, [2, -1])]
    things = spark.createDataFrame([(1, "same"), (2, "same"), (3, "stranger")], "id long, line string")
    df = spark.createDataFrame(rows, "key int, id long, root long, tag long, places array<int>")
    assert not ld._near_before((-1,), np.array([one, other]), 1).any() and ld._near_before((2,), np.array([like, like]), 1).all()
    got = meeting.tiles(df, ["key"], things, str, str.__eq__, ld._near_before, gate=ld._kind).collect()
    assert [sorted(r) for r in got] == [[1, 2]]


def test_letters_never_rule_out_a_similar_pair():
    rng = random.Random(8)
    lines = ["".join(rng.choice("abcdé đ漢") for _ in range(rng.randrange(40))) for _ in range(800)] + ["a" * 900, "ab" * 700]
    others = []
    for line in lines:
        new = list(line)
        for _ in range(rng.randrange(len(line) // 4 + 2)):
            at = rng.randrange(len(new) + 1)
            new[at : at + rng.randrange(2)] = rng.choice(["", "a", "é", "漢"])
        others.append("".join(new))
    fit = ld.letters_allow(ld.letters(pa.array(lines)), ld.letters(pa.array(others)))
    alike = np.array([ld.similar(a, b) for a, b in zip(lines, others)])
    assert alike.sum() > 400 and not (alike & ~fit).any()
    rng.shuffle(others)
    assert ld.letters_allow(ld.letters(pa.array(lines[:800])), ld.letters(pa.array(others[:800]))).sum() < 200


@pytest.mark.parametrize("slice_", [2048, 32])
def test_unlike_members_of_a_place_are_not_taken_to_its_texts(spark, monkeypatch, slice_):
    monkeypatch.setattr(ld, "THINNED", slice_)
    rng = random.Random(5)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50)) for _ in range(150)]
    lines += [lines[0][:i] + "-" + lines[0][i + 1 :] for i in range(45)] + [lines[i][:-2] for i in range(1, 6)]
    # One gate for all: nothing but letters tells them apart.
    near = spark.createDataFrame([(key, i, 7 << 56) for key in (2, 3) for i in range(len(lines))], "key int, id long, tag long")
    counted = spark.createDataFrame([(i, bytearray(row.tobytes())) for i, row in enumerate(ld.letters(pa.array(lines)))], "id long, letters binary")
    got = ld.thinned(near, counted).collect()
    linked = {(i, j) for j in range(len(lines)) for i in range(j) if ld.similar(lines[i], lines[j])}
    assert len(linked) == 46 * 45 // 2 + 5
    listed = {(r["u"], r["v"]) for r in got if r["key"] is None}
    for key in (2, 3):
        members = {r["u"] for r in got if r["key"] == key}
        assert all(p in listed or members.issuperset(p) for p in linked)
        assert len(members) <= 46
    assert len(listed) < 46 * 46 and {(i, i + 194) for i in range(1, 6)} <= listed


def test_tables_that_the_result_does_not_read_are_freed(spark):
    words = [f"w{i}" for i in range(90)]
    rng = random.Random(6)
    rows = [(i, " ".join(rng.sample(words, 20)) + "\none and the same line") for i in range(30)] + [(30 + i, " ".join(words[:40]) + f" {i}") for i in range(30)]
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    got = ld.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), radius=None)
    left = {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before}
    assert "dropped" in left and not left & {"occurrences", "classes", "lines", "joined", "keepers", "kept", "near", "thinned", "met", "pairs"}
    assert sum(r["n_dropped"] for r in got.collect()) == 29 + 29


def test_many_pairs_are_as_similar_as_one_by_one():
    rng = random.Random(11)
    lines = []
    for alphabet, longest, n in (("ab ", 12, 600), ("abcdefghij é", 70, 600), ("abcdefgh 漢", 200, 300), ("abcd", 700, 20), ("".join(map(chr, range(0x4E00, 0x5200))), 90, 200)):
        for _ in range(n):
            one = [rng.choice(alphabet) for _ in range(rng.randrange(longest))]
            other = list(one)
            for _ in range(int(rng.random() * 0.4 * (len(one) + 1))):
                at = rng.randrange(len(other) + 1)
                other[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(alphabet)])
            lines += ["".join(one), "".join(other)]
    i = np.arange(0, len(lines), 2)
    want = np.array([ld.similar(lines[k], lines[k + 1]) for k in i.tolist()])
    assert 0.2 < want.mean() < 0.95
    assert (ld.similar_pairs(lines, i, i + 1) == want).all() and (ld.similar_pairs(lines, i + 1, i) == want).all()


def test_short_listed_pairs_are_not_compared_one_by_one(monkeypatch):
    """Chance pairs of short lines grow faster than the input: each took 85 us."""
    rng = random.Random(12)
    base = "the quick brown fox jumps over the lazy dog again"
    ones = ["".join(rng.sample(base, len(base))) for _ in range(300)]
    others = ["".join(rng.sample(x, len(x))) for x in ones[:250]] + [x[:20] + "-" + x[21:] for x in ones[250:]]
    want = [i for i, pair in enumerate(zip(ones, others)) if ld.similar(*pair)]

    def one_by_one(*_):
        raise AssertionError

    monkeypatch.setattr(ld, "similar", one_by_one)
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(range(300)), pa.array(ones), pa.array(others)], names=["u", "v", "one", "other"])
    (got,) = ld._verify_pairs(iter([batch]))
    assert got.column(0).to_pylist() == want and set(range(250, 300)) <= set(want)


@pytest.mark.parametrize("gathered", [1 << 19, 40])
def test_places_meet_in_buckets(monkeypatch, gathered):
    """A line's 14 or 28 places are no rows of their own on the way, and each place meets whole."""
    monkeypatch.setattr(ld, "GATHERED", gathered)
    rng = random.Random(13)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 30))) for _ in range(60)]
    lines += [line[:-1] + "x" for line in lines]
    texts = pa.array(["\n".join(lines[k : k + 7]) for k in range(0, len(lines), 7)] + [None, "", " \n"])
    dealt = pa.Table.from_batches(ld._meet(5)(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]))).sort_by("bucket")
    assert dealt["bucket"].to_pylist() == sorted(dealt["bucket"].to_pylist()) and set(dealt["bucket"].to_pylist()) <= set(range(5))
    rows = np.frombuffer(b"".join(dealt["rows"].to_pylist()), np.int64).reshape(-1, 3)
    assert len(rows) == ld.BANDS * sum(2 if len(line) < ld.SHORT else 1 for line in lines)
    met = pa.Table.from_batches(ld._met(iter(dealt.to_batches(max_chunksize=3)))).to_pydict()
    ids = [int(x) for x in ld._classes([line.encode() for line in lines])[:, 0].view(np.int64)]
    found = {(u, v) for key, u, v in zip(met["key"], met["u"], met["v"]) if key is None}
    assert sum((min(p), max(p)) in found for p in zip(ids[:60], ids[60:])) >= 57
