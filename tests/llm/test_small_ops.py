"""Sharding, archives, top-k search, rules and chat formatting against brute force, with nulls, ties, empty and repeated rows."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from trailforge.llm import chat, rules, sharding, topk, warc


def jump(key, n):
    """The published algorithm."""
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


# --- sharding


def test_many_shards(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(2, 60)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert [r[0] for r in df.select(sharding.jump_hash(df.k, 300)).collect()] == [jump(k, 300) for k in keys]


def test_keys_that_need_more_jumps_walk_on(spark, monkeypatch):
    monkeypatch.setattr(sharding, "JUMPS", 2)
    df = spark.createDataFrame([(k,) for k in range(50)], "k long")
    assert [r[0] for r in df.select(sharding.jump_hash(df.k, 100)).collect()] == [jump(k, 100) for k in range(50)]


def test_jump_hash_is_the_published_one(spark):
    rng = random.Random(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(rng.randrange(-(2**63), 2**63) for _ in range(200))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100):
        assert [r[0] for r in df.select(sharding.jump_hash(df.k, n)).collect()] == [jump(k, n) for k in keys]


def test_shards_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(200), rng.choice(["a", "é" * 50, None, "", "x" * 1000]), i) for i in range(500)] + [(7, "hot", 0)] * 300 + [(None, "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot long")
    got = sharding.shards(df, 8).collect()
    want = sorted((k or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(k or 0, 8), jump(k or 0, 9)) for k, t, _ in rows)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got) and {r["law"] for r in got} == {"key"}
    assert sharding.shards(df.limit(0)).collect() == []


# --- archives


def page_rows():
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 20, "y" * 100
    return [
        (5, "http://a/\r\nX: 1", big), (3, "http://b", big), (9, None, big), (9, "u", big), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""),
        (7, "u", other), (8, "u", other), (None, "u", other), (10, "u", "z" * 99), (11, "u", "z" * 99), (3, "http://b", big),
    ]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_archives_round_trip(spark, tmp_path, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        round_trip(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def round_trip(spark, tmp_path):
    rows = page_rows()
    # Columns of the user's own that are called as the steps call theirs.
    df = spark.createDataFrame([(*r, "x", 1, "y", -5) for r in rows], "page_id long, url string, html string, digest string, bytes int, body string, original int")
    path = str(tmp_path / "arc")
    got = warc.deduplicate(df, path, archive_bytes=4000)
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, p), p)
    want = []
    for p, _, h in rows:
        raw = (h or "").encode()
        to = first.get(h) if len(raw) >= 100 and first.get(h) != p else None
        want.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if to is not None else "response", to))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    files = sorted((tmp_path / "arc").glob("part-*"))
    assert len(files) > 1
    seen = [h for f in files for h, _ in warc.parse(f.read_bytes())]
    assert len(seen) == len(rows) and all(h["WARC-Profile"] == warc.PROFILE for h in seen if h["WARC-Type"] == "revisit")
    full = next(f for f in files if gzip.decompress(f.read_bytes()))
    plain = gzip.decompress(full.read_bytes())
    assert list(warc.parse(plain)) == list(warc.parse(full.read_bytes())) and plain.endswith(b"\r\n\r\n")
    assert any(h.get("WARC-Target-URI") == "http://a/%0D%0AX: 1" for h in seen)


def test_long_pages_have_archives_of_their_own(spark, tmp_path):
    rows = [(i, "u", "x" * 50 + str(i)) for i in range(200)] + [(1000 + i, "u", chr(97 + i) * 30_000) for i in range(8)] + [(2000, None, "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: r["payload_bytes"] for r in warc.deduplicate(df, str(tmp_path / "arc"), archive_bytes=100_000).collect()}
    assert got == {i: len(h) for i, _, h in rows}
    sizes = [sum(len(b) for _, b in warc.parse(f.read_bytes())) for f in (tmp_path / "arc").glob("part-*")]
    assert max(sizes) == 3_000_000 and all(s <= 100_000 or s == 3_000_000 for s in sizes)


def test_a_revisit_without_its_response_stays(spark):
    records = [("response", 1, None, "d1", None, b"abc"), ("revisit", 2, None, hashlib.sha256(b"abc").hexdigest(), 1, b""), ("revisit", 3, None, "gone", 99, b"")]
    df = spark.createDataFrame(records, "record_type string, page_id long, url string, digest string, refers_to long, payload binary")
    got = {r["page_id"]: tuple(r)[1:] for r in warc.restore(df).collect()}
    assert got[3] == (None, None, "revisit", 99) and got[2] == (3, hashlib.sha256(b"abc").hexdigest(), "revisit", 1)


def test_no_pages(spark, tmp_path):
    assert warc.deduplicate(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "arc")).collect() == []


# --- top-k


def brute_top(rows, queries, k):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            known.setdefault((i, tuple(int(np.floor(1024 * x)) for x in v)), None)
    out = []
    for q, qv in known:
        if q in queries:
            found = sorted((-sum(a * b for a, b in zip(qv, cv)), c) for c, cv in known if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block", [8, 64, 4096])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATES", block)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=16) * rng.choice([1, 0.01, 3])).round(rng.integers(0, 4)).tolist()) for i in range(300)]
    rows += [(i + 300, rows[i][1]) for i in range(40)]
    rows += [(400, None), (410, [float("nan")] * 16), (420, [None] + [1.0] * 15), (430, [0.0] * 16), (440, [1.0] * 4), (None, [9.0] * 16), rows[10], rows[11]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df.where("vec_id % 10 = 0"), df, 5).collect())
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute_top(rounded, set(range(0, 1000, 10)), 5)
    assert topk.top_k(df.limit(0), df, 5).collect() == [] and topk.top_k(df, df.limit(0), 5).collect() == []


def test_index_stops_early_only_when_it_is_right():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(20, 64))
    x = np.floor(1024 * (centre[rng.integers(0, 20, 3000)] + 0.1 * rng.normal(size=(3000, 64))) / 8).astype(np.int64)
    index, ids = topk.Index(np.arange(3000), x), np.arange(0, 3000, 300)
    query, row, score = index.best(ids, x[ids], 10)
    for q in range(10):
        exact = x @ x[ids[q]]
        exact[ids[q]] = -(2**62)
        best = np.lexsort((np.arange(3000), -exact))[:10]
        mine = dict(zip(row[query == q].tolist(), score[query == q].tolist()))
        assert all(mine[b] == exact[b] for b in best.tolist())


# --- rules


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines))


def test_measures_against_brute_force(spark):
    rng = random.Random(7)
    texts = [None, "", " \n\t", "a", "a b", "a b a b a b", "x\n\nx\n x\nx", "   é\x1c#", "|" * 9, "w " * 5000, "line\n" * 400, "z" * 9000 + " " + "z" * 9000]
    texts += ["".join(rng.choice("ab é\n\t#|") for _ in range(rng.randrange(200))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: tuple(r[m] for m in rules.MEASURES) for r in rules.ledger(df).collect()}
    assert got == {i: brute_measures(t) for i, t in enumerate(texts)}
    assert rules.ledger(df.limit(0)).collect() == []


def test_ablations_count_what_a_policy_would_do(spark):
    rng = random.Random(8)
    bits = [rng.randrange(128) & rng.randrange(128) for _ in range(400)]
    entries = spark.createDataFrame([(b,) for b in bits], "fail_bits long")
    got = {(r["policy"], r["rule"]): tuple(r)[2:] for r in rules.ablations(entries).collect()}
    for p in (rules.BASE, rules.STANDARD, rules.STRICT):
        m = rules.mask(p)
        for rule in rules.RULES:
            if rule.name in p.rules:
                bit = 1 << rule.bit
                want = (400, sum(not b & m for b in bits), sum(not b & m & ~bit for b in bits), sum(b & m == bit for b in bits))
                assert got[p.version, rule.name] == want


# --- chat


def test_chat_round_trip(spark):
    rng = random.Random(9)
    bits = ["<|end|>", "<|turn|>", "&lt;|", "&amp;", "<", "|", "\n", "é", " ", "</s>[INST]", "<|say|>", "<|next|>", "&", ";"]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "<|say|>", None]), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(8)))]), "extra"))
    rows += [(None, 0, "user", "x", ""), (70, None, "assistant", "late", ""), (70, None, "assistant", "late", ""), (71, 1, "b", "2", ""), (71, 1, "a", "1", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    formatted = {r["conv_id"]: r["formatted"] for r in made.collect()}
    talks = {}
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(talks)
    for c, turns in talks.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        blocks = sum(i == 0 or turns[i - 1][0] != turns[i][0] for i in range(len(turns)))
        assert formatted[c].count(chat.TURN) == formatted[c].count(chat.END) == blocks
        assert tuple(got[c])[1:] == (
            len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted[c]),
        )
    assert chat.digests(chat.format_conversations(df.limit(0))).collect() == []
