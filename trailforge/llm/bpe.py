"""BPE encoding and decoding for a tokenizer file with word ends, lower case and a byte alphabet.

A word's parts and the ranks of their adjacent pairs stand in two contiguous arrays. The
lowest rank (the leftmost of equals) is found by a scan, its boundary is deleted, and the
two neighbouring ranks are refreshed. Words past SHORT parts go through a heap of the same
pairs with linked neighbours, in the same order, so that a text without white space costs
n log n. Encoded runs between white space are kept in a bounded cache in each worker.

The file must have a BPE model with word ends, the normaliser NFC, white space, lower case, no
decoder, and control tokens that hold `<|`; another is refused when it is loaded.

Defined cases: a null text is empty and gives no ids; control tokens of the file that stand
in a text become their ids; repeated rows are encoded again; `encode` keeps every column of
its input beside `ids`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest word, in parts, that the array is scanned for.
SHORT = 256
#: Entries after which the younger half of a worker's cache becomes the older one, and the longest run that it keeps.
CACHED, CACHED_CHARS = 150_000, 64
#: Text, in characters, of the rows that are handed back together.
PIECE = 4 << 20
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept in the machine's own 32-bit words, which must be little-endian")
_MINUS = "\x1c\x1d\x1e\x1f"
_NONE = 1 << 60


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next one from U+0100."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _expect(spec: dict) -> None:
    """Raises where a file asks for something that `Bpe` does not do."""
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]] if spec["normalizer"].get("normalizers") else [spec["normalizer"]["type"]]
    wanted = {"model": spec["model"]["type"] == "BPE" and bool(spec["model"].get("end_of_word_suffix")), "normalizer": steps == ["NFC", "Replace", "Lowercase"]}
    wanted["added_tokens"] = all("<|" in t["content"] and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) for t in spec["added_tokens"])
    wanted["decoder"] = not spec.get("decoder")
    if wrong := [name for name, right in wanted.items() if not right]:
        raise ValueError(f"this file's {', '.join(wrong)} is not of the kind that this encoder follows")


class Bpe:
    """One tokenizer file: ids of a text, and the text of ids."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _expect(spec)
        vocab = spec["model"]["vocab"]
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.control = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.control.items():
            self.tokens[i] = token
        self.pairs = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        letters = _byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + self.suffix] for x in letters]
        self.piece = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.at_control = regex.compile("(" + "|".join(regex.escape(c) for c in sorted(self.control, key=len, reverse=True)) + ")")
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def word(self, piece: str) -> list[int]:
        """The ids of one word."""
        raw = piece.encode("utf-8")
        parts = [self.inner[b] for b in raw[:-1]]
        parts.append(self.last[raw[-1]])
        return self._scan(parts) if len(parts) <= SHORT else self._queue(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        pairs = self.pairs
        ranks = [pairs.get(p, (_NONE,))[0] for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            at = ranks.index(least)
            parts[at] = pairs[parts[at], parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = pairs.get((parts[at - 1], parts[at]), (_NONE,))[0]
            if at < len(ranks):
                ranks[at] = pairs.get((parts[at], parts[at + 1]), (_NONE,))[0]
        return parts

    def _queue(self, parts: list[int]) -> list[int]:
        pairs, n = self.pairs, len(parts)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)
        heap = [(pairs[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i] = pairs[a, b][1]
            gone[j] = 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := (parts[left], parts[right])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], left, *p))
        return [parts[i] for i in range(n) if not gone[i]]

    def _run(self, run: str) -> bytes:
        """The ids of a run without white space: kept from before, or those of its pieces one after another."""
        ids = self.old.get(run)
        if ids is None:
            pieces = [run] if run.isalpha() else self.piece.findall(run)
            if len(pieces) == 1:
                ids = array("I", self.word(pieces[0])).tobytes()
            else:
                ids = b"".join([self.cache.get(p) or self._run(p) for p in pieces])
        if len(run) <= CACHED_CHARS:
            if len(self.cache) >= CACHED:
                # What has not been met since the last change goes.
                self.old = dict(self.cache)
                self.cache.clear()
            self.cache[run] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        """Ids of a text without control tokens, little-endian."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        runs = regex.split(r"\p{White_Space}+", text) if any(c in text for c in _MINUS) else text.split()
        get, run = self.cache.get, self._run
        return b"".join([get(r) or run(r) for r in runs])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        parts = self.at_control.split(text)
        return b"".join(np.array([self.control[p]], "<u4").tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with a space between; the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`df` with `ids` for its text: binary, little-endian unsigned 32-bit integers. `path` is read where the rows are."""
    path = path or default_path()
    return _mapped(df, text, {"ids": ("binary", pa.binary())}, lambda: lambda x: (load(path).encode(x),))


def decode(df: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """`df` with `decoded` for its ids: their text."""
    path = path or default_path()
    return _mapped(df, ids, {"decoded": ("string", pa.string())}, lambda: lambda x: (load(path).decode(x),))


def round_trip(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`df` with `ids` and `decoded` for its text: `encode`, then `decode` of what it gave, in one pass of one worker."""
    path = path or default_path()

    def both():
        bpe = load(path)
        return lambda x: ((ids := bpe.encode(x)), bpe.decode(ids))

    return _mapped(df, text, {"ids": ("binary", pa.binary()), "decoded": ("string", pa.string())}, both)


def _mapped(df: DataFrame, source: str, made: dict[str, tuple[str, pa.DataType]], of) -> DataFrame:
    """`df` without `source` and with the columns `made` from its values one by one (null as empty), a few MB at a time."""
    rest = [c for c in df.columns if c != source and c.lower() not in made]
    nothing = b"" if df.schema[source].dataType.typeName() == "binary" else ""
    kinds = [arrow for _, arrow in made.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = of()
        for batch in batches:
            at, held, out = 0, 0, [[] for _ in kinds]
            for i, value in enumerate(batch.column(0)):
                value = value.as_py() or nothing
                for column, x in zip(out, one(value)):
                    column.append(x)
                held += len(value)
                if held > PIECE or i + 1 == len(batch):
                    kept = [c.slice(at, i + 1 - at) for c in batch.columns[1:]]
                    yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, out, kinds)], names=[*rest, *made])
                    at, held, out = i + 1, 0, [[] for _ in kinds]

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest), *(f"{name} {kind}" for name, (kind, _) in made.items())])
    return df.select(source, *rest).mapInArrow(run, schema)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every row: the ids of `encode` and the text that `decode` gives for them.

    Texts alone go to the worker, and digests alone come back.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            n, ids_digest, text_digest = [], [], []
            for value in batch:
                ids = bpe.encode(value.as_py() or "")
                n.append(len(ids) // 4)
                ids_digest.append(hashlib.sha256(ids).hexdigest())
                text_digest.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())], names=["n_tokens", "ids_sha256", "decoded_sha256"])
            pa.default_memory_pool().release_unused()

    made = F.arrow_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string").asNondeterministic()
    return df.select(key, made(F.col(text).cast("string")).alias("made")).select(key, "made.*")
