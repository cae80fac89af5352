import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from trailforge.llm import phrases


def plain(rows, least, share, top):
    """lang, rank, phrase, a, l, r, n, score by plain loops."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def check(spark, rows, least=3, share=80, top=15, size=64):
    df = spark.createDataFrame([(l, t, 1, "x") for l, t in rows], "lang string, text string, n int, word string").repartition(3)
    got = phrases.collocations(df, least=least, share=share, top=top, size=size).collect()
    want = plain(rows, least, share, top)
    assert sorted(map(tuple, got)) == want
    return want


@pytest.mark.parametrize("size", [7, 500])
def test_phrases_against_plain_loops(spark, size):
    rng = random.Random(size)
    words = ["a", "B", "c", "d", "é", "(f)", "ß", "g\x00", "x-y", "tab"]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(30)):
            parts.append(rng.choice(["a b c d", "a B", "é ß (f)"]) if rng.random() < 0.4 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"]))
        rows.append((rng.choice(["en", "en", "de", None, ""]), "".join(parts)))
    assert len(check(spark, rows, size=size)) > 30
    assert len(check(spark, rows, least=2, share=40, top=1000, size=size)) > 100


def test_cases(spark):
    rows = [(None, None), ("en", ""), ("en", " .,\n"), ("en", "one two " * 3), ("en", "one two " * 3), ("tie", "a b. c d. e f. " * 5), ("long", "p q r s t " * 2000 + "."), ("apart", "u v\x1fw u v\x1fw u v\x1fw"), ("und", "null too null too"), (None, "null too")]
    found = check(spark, rows, top=2)
    assert [r[2] for r in found if r[0] == "tie"] == ["a b", "c d"] and ("und", 1, "null too", 3, 3, 3, 6, 1_000_000) in found


@pytest.mark.parametrize("run", [1, 7, 40])
def test_long_texts_in_parts(monkeypatch, run):
    rng = random.Random(run)
    texts = ["".join(rng.choice("aB é .,\n\t") for _ in range(rng.randrange(200))) for _ in range(20)] + ["", None, "x" * 300, "a b " * 50, "." * 90, "a b. " * 60]

    def told():
        return [(w, bool(b)) for words, begins in phrases.words_of(pa.array(texts)) for w, b in zip(words.to_pylist(), begins)]

    whole = told()
    monkeypatch.setattr(phrases, "RUN", run)
    assert told() == whole and len(whole) > 300


def test_empty_tables(spark):
    for rows in ([], [("en", None)], [("en", "nothing occurs twice here")]):
        assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_extensions_of_both_sides():
    """Intervals of both sides stay those of the same phrase, whatever the order of steps."""
    rng = np.random.default_rng(1)
    text = np.concatenate([[0], rng.integers(0, 5, 300), [0]])
    _, text = np.unique(text, return_inverse=True)
    index = phrases.Index(text, 4)
    seen = Counter(tuple(text[i : i + k].tolist()) for k in range(1, 5) for i in range(len(text) - k + 1) if 0 not in text[i : i + k])
    for steps in ((0, 0, 0), (1, 1, 1), (0, 1, 0), (1, 0, 1), (0, 1, 1)):
        begin, size = phrases.intervals(text)
        found = [(w,) for w in range(1, len(size) + 1)]
        for side in steps:
            parent, word, begin, size = index.extend(side, begin, size)
            found = [(w, *found[p]) if side == 0 else (*found[p], w) for p, w in zip(parent.tolist(), word.tolist())]
            assert dict(zip(found, size.tolist())) == {p: n for p, n in seen.items() if len(p) == len(found[0])}


def test_scores_past_64_bits(spark):
    got = spark.sql("SELECT cast(2000000 as decimal(7,0)) * cast(9000000000000000000 as decimal(20,0)) div (cast(9000000000000000000 as decimal(20,0)) + cast(9000000000000000000 as decimal(20,0))) AS s").collect()
    assert got[0]["s"] == 1_000_000
