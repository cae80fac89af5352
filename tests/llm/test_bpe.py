import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trailforge.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
THEIRS = Tokenizer.from_file(PATH)
OURS = bpe.Bpe(PATH)


def same(text):
    ids = OURS.encode(text)
    want = THEIRS.encode(text, add_special_tokens=False).ids
    assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == want, repr(text)
    assert OURS.decode(ids) == THEIRS.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "Hello, world!! 123 don't I'LL 'stand", "ΑΣΣΟΣ ΟΔΟΣ", "İstanbul ǅ ß", "é ẛ̣ Å", "a\x1cb\x1d c\x85d e\xa0f　g​h",
        "<|startoftext|>a<|endoftext|> <|endof text|> <|ENDOFTEXT|>", "a" * 3000, "ab" * 700 + "'s", "日本語テキスト 12３ ①½", "😀👨‍👩‍👧 #### $$$&&& | | x", "﻿\x00\x7f",
    ],
)
def test_cases(text):
    same(text)


def test_random_texts():
    rng = random.Random(3)
    letters = "aAbBeEéÉ' \n\t.,#0159ßΣσ中́\x1c <|>stdmrvl"
    for _ in range(3000):
        same("".join(rng.choice(letters) for _ in range(rng.randrange(40))))


def test_queue_and_scan_agree():
    rng = random.Random(5)
    for _ in range(300):
        raw = [rng.choice(b"aeinorst") for _ in range(rng.randrange(2, 60))]
        parts = [OURS.inner[b] for b in raw[:-1]] + [OURS.last[raw[-1]]]
        assert OURS._scan(list(parts)) == OURS._queue(list(parts))
