import random
import zlib

import pytest

from trailforge.llm import spelling


def plain(rows):
    """word: (n, n_near, form, form_n, root) by plain loops."""
    found = {}
    for doc, text in rows:
        runs, run = [], ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] = found.get(run, 0) + 1
    found = {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, forms = {}, {}
    for w, n in found.items():
        others = [o for o in found if near(w, o)]
        best = min(others, key=lambda o: (-found[o], o), default=None)
        if best and found[best] >= 2 * n:
            forms[w] = best
        out[w] = (n, len(others), forms.get(w), found[best] if w in forms else None)

    def root(w):
        return root(forms[w]) if w in forms else w

    return {w: (*v, root(w)) for w, v in out.items()}


def check(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, word int, letters int")
    got = spelling.variants(df).collect()
    assert len({r["word"] for r in got}) == len(got)
    assert {r["word"]: tuple(r)[1:] for r in got} == plain(rows)
    return got


def edited(rng, word, alphabet):
    i, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:i] + (rng.choice(alphabet) if kind else "") + word[i + (kind < 2) :]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgéÿß"])
def test_variants_against_plain_loops(spark, alphabet):
    rng = random.Random(len(alphabet))
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 12))) for _ in range(20)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(30):
            w = base[min(int(rng.expovariate(0.2)), 19)]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                w = edited(rng, w, alphabet) or w
            words.append(rng.choice([w, w, w.upper() if w.isascii() else w]))
        rows.append((i, rng.choice([" ", "\n", "-1", "× "]).join(words)))
    assert len(check(spark, rows)) > 60


def test_cases(spark):
    long_ = "ab" * 60
    words = ["aaaaa"] * 3 + ["aaaaaa"] * 6 + ["aaaaaaa"] * 12 + ["baaaaaa"] * 30 + [long_] * 3 + [long_[:-1]] * 7 + [long_[1:]] * 7 + ["x" + long_[1:]] * 3 + ["y" * 90] * 3 + ["y" * 91] * 3
    rows = [(None, None), (1, ""), (2, " \n"), (None, "tiesy tiesz tiesx " * 3), (3, "tiesu " * 6), (4, "tiesv " * 6), (5, "repeated"), (5, "repeated"), (5, "repeated"), (6, " ".join(words)), (7, "w" * 100_000), (8, "a-b " * 9)]
    found = {r["word"]: r for r in check(spark, rows)}
    assert found["tiesx"]["form"] == "tiesu" and found["aaaaa"]["root"] == "baaaaaa"


def test_a_class_is_not_paired_word_by_word(spark):
    """Anagrams of one class and of another: what meets is a few times what is near."""
    rng = random.Random(4)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(300)} | {"".join(rng.sample("abcdefgi", 8)) for _ in range(300)}
    check(spark, [(i, " ".join([w] * 3)) for i, w in enumerate(sorted(words))])


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
