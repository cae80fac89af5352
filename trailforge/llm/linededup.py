"""Fuzzy line deduplication over the whole corpus.

Lines are lower-cased and their white space collapsed; equal lines are one class, known by a
128-bit hash. Two classes are linked if their edit similarity is at least SIMILARITY. With
`radius=None`, as the registered queries have it, classes meet on bands of least hashes over
their character n-grams, a pair that meets is compared if enough nibbles of its other least
hashes agree (`alike`), each pair of a small place once, and nothing else keeps a pair apart; the README has the recall.

With `radius=RADIUS`, the narrow form, a pair also has to be near by SimHash: each class has a
64-bit SimHash of its pairs of neighbouring words, and pairs that differ in more than RADIUS
bits are not linked, which leaves out most edited copies.
By the pigeonhole principle, such SimHashes agree on all but RADIUS of the blocks that the 64
bits are cut into, so classes meet on the bits of every choice of the other blocks; the number
of blocks grows with the number of classes, so that chance meetings stay few. Linked classes
are joined to connected groups and the first line of each group, by doc_id and place, stays.

Only hashes are shuffled, those of places as bytes in buckets. Texts of classes are fetched for those alone that have a partner
by their hashes. In places with many members, pairs whose letters do not allow the similarity
are left out, which is a bound of the edit distance and so loses no link (`letters`); the pairs
of members with few partners are listed, and only the others of a place meet with their texts.
Within a meeting place, pairs already known to be connected are not
compared again; large places are cut into tiles of pairs of slices.

Defined cases: lines without a word are no lines to this operator and stay; a null text
stays null and an empty one empty; rows that repeat a doc_id and text keep the same lines;
ties between equal places cannot occur otherwise; null doc_ids sort first; a document that
loses its last line with a word has the text that remains, perhaps empty, and `deduplicate`
can drop it (`drop_emptied`); all columns pass through; an empty table stays empty.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm import common, kernel, meeting

RADIUS, SIMILARITY = 3, 0.8
#: Members of a meeting place that one task compares; a larger place is cut into slices of this size.
SLICE = 512
#: Least hashes: BANDS places of ROWS hashes each, and NIBBLES further hashes that say which pairs are compared.
BANDS, ROWS, NIBBLES = 14, 3, 14
#: Bytes of an n-gram; lines of up to SHORT bytes meet on n-grams of both lengths, since an edit spoils more of a short line.
GRAM, SHORT_GRAM, SHORT = 6, 3, 64
#: Nibbles that a pair has in common if it is compared, for n-grams of either length: short ones agree by chance more often.
AGREE, SHORT_AGREE = 6, 6
#: Members of a place whose pairs are listed one by one; more of them are connected by `meeting`.
LISTED = 16
#: A place of more members is not thinned out before it is compared.
DENSE = 16_384
#: Members of a slice of a place whose letters are compared, which takes no text.
THINNED = 2048
#: Partners by gates and letters of a member in a tile that are listed one by one, for n-grams of either length: with short ones chance gives more.
FEW, SHORT_FEW = 8, 32
#: Kinds of letters that are counted in a line, and what a count stops at.
LETTERS, MOST_LETTERS = 32, 255
#: Rows of one place in one task of the first pass after which the next part of the place begins.
OFTEN = 256
#: Rows of places that go through one bucket, about, and that a task gathers before it deals them out.
BUCKET, GATHERED = 1 << 18, 1 << 19
_MORE = -1
_FACTORS = (kernel.stream(np.arange(BANDS * ROWS + NIBBLES), 51) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_LENGTH_STEP, _LENGTH_APART = 1.08, 3
#: Characters of lines past which a bound of their distance is tried first, and of stretches that are aligned in it.
BLOCK = 4096
#: Lines of up to WIDE characters are compared many pairs at once: PAIRS, of MANY at least for each of up to COLUMNS words of 64 characters; KINDS of code points are told apart, in MATCHES numbers.
WIDE, COLUMNS, PAIRS, MANY, KINDS, MATCHES = 512, 4, 32_768, 24, 192, 1 << 20
_OCCURRENCE = "key_id long, key_text long, place int, high long, low long, sim long"


def block_bits(classes: int) -> list[int]:
    """Widths of the blocks: as many that a place of a table holds about 32 classes by chance at most."""
    for n in range(RADIUS + 1, 12):
        if n == RADIUS + 1 + 6 or (64 // n) * (n - RADIUS) >= np.log2(max(classes, 2)) - 5:
            return [64 // n + (i < 64 % n) for i in range(n)]
    raise AssertionError


def tables(bits: list[int]) -> list[int]:
    """For each choice of all but RADIUS blocks, the mask of their bits."""
    edges = np.cumsum([0, *bits])
    masks = [((1 << bits[i]) - 1) << int(edges[i]) for i in range(len(bits))]
    return [sum(masks[i] for i in some) for some in itertools.combinations(range(len(bits)), len(bits) - RADIUS)]


def signatures(data: np.ndarray, offsets: np.ndarray, simhashed: bool = True) -> tuple[np.ndarray, ...]:
    """Text, place, two class hashes and SimHash (0 if not asked for) of each line with a word; `data` is in lower case already."""
    begin, end, _ = kernel.words(data, offsets)
    line_begin, line_end, line_at = kernel.lines(data, offsets)
    first = np.searchsorted(begin, line_begin)
    full = np.flatnonzero(np.searchsorted(begin, line_end) > first)
    first = first[full]
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(line_at))[full]
    place = full - line_at[of]
    words = kernel.span_hashes(data, begin, end)
    sim = simhash(pairs(words, first), first) if simhashed else np.zeros(len(first), np.uint64)
    return of, place, kernel.sequence_hashes(words, first, 21), kernel.sequence_hashes(words, first, 22), sim


def pairs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each word and the next one of its run, the first one following the last.

    Single words will not do: a few common ones outvote the rest, and all long lines of a language look alike.
    """
    after = np.arange(1, len(words) + 1)
    if len(first):
        after[np.append(first[1:], len(words)) - 1] = first
    return kernel.mix(words + words[after] * np.uint64(0x9E3779B97F4A7C15))


def simhash(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bit by bit, what most hashes of each run have (a draw counts as 1)."""
    if not len(first):
        return np.zeros(0, np.uint64)
    size = np.diff(np.append(first, len(words)))
    out = np.zeros(len(first), np.uint64)
    # Runs of about 64k words at a time: their bits, one byte each, are 4 MB.
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(first, first[at] + 65_536)))
        some = words[first[at] : first[to] if to < len(first) else len(words)]
        bits = np.unpackbits(np.ascontiguousarray(some).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[at:to] - first[at], axis=0, dtype=np.int32)
        out[at:to] = np.packbits(2 * ones >= size[at:to, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
        at = to
    return out


_BLANK, _BLANKS = bytes.maketrans(b"\t\v\f\r", b"    "), re.compile(rb" {2,}")


def _lines(text: bytes) -> list[bytes]:
    """The lines of a text with one space between words and none around them; a line without a word is empty."""
    text = text.translate(_BLANK)
    if b"  " in text:
        text = _BLANKS.sub(b" ", text)
    return [line.strip(b" ") for line in text.split(b"\n")]


def _lowered(column: pa.Array) -> Iterator[bytes | None]:
    return (text.as_py() for text in pc.utf8_lower(column).cast(pa.large_string()).cast(pa.large_binary()))


def _classes(lines: list[bytes]) -> np.ndarray:
    """Both hashes of each line, a row each."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(line) for line in lines]), np.uint64).reshape(-1, 2)


def occurrences(documents: DataFrame, key: str, text: str, simhashed: bool = True) -> DataFrame:
    """One row for each line with a word: its document, place, class and SimHash (0 if not asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, _, data, offsets in kernel.texts(pc.utf8_lower(batch.column(2))):
                of, place, *hashes = signatures(data, offsets, simhashed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + of]), pa.array(keys[lo + of]), pa.array(place.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in hashes)],
                    names=["key_id", "key_text", "place", "high", "low", "sim"],
                )
            kernel.release()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            of, place, lines, size = [], [], [], 0
            for i, text in enumerate(_lowered(batch.column(2))):
                for k, line in enumerate(_lines(text)):
                    if line:
                        of.append(i)
                        place.append(k)
                        lines.append(line)
                size += len(text)
                if lines and (size >= 2 << 20 or i == len(batch) - 1):
                    high, low = np.ascontiguousarray(_classes(lines).T).view(np.int64)
                    columns = ids[of], keys[of], np.array(place, np.int32), high, low, np.zeros(len(of), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key_id", "key_text", "place", "high", "low", "sim"])
                    of, place, lines, size = [], [], [], 0
            kernel.release()

    return documents.select(*common.row_key(key, text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).mapInArrow(run if simhashed else hashed, _OCCURRENCE)


def _least(data: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """For each line the least of each hash over its n-grams, whose bytes past the end of the line are 0."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # Every place's next eight bytes as one number, of which n stay.
    gram = np.ndarray(len(data), "<u8", padded, strides=(1,)) & np.uint64((1 << 8 * n) - 1)
    end = np.append(first[1:], len(data))
    for k in range(1, n):
        last = end - k
        last = last[last >= first]
        gram[last] &= np.uint64((1 << 8 * k) - 1)
    gram *= np.uint64(0x9E3779B97F4A7C15)
    gram ^= gram >> np.uint64(32)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    gram = (gram >> np.uint64(32)).astype(np.uint32)
    out, scratch = np.empty((len(_FACTORS), len(first)), np.uint32), np.empty_like(gram)
    for i, factor in enumerate(_FACTORS):
        np.multiply(gram, factor, out=scratch)
        np.minimum.reduceat(scratch, first, out=out[i])
    return out


def _meetings(least: np.ndarray, chars: np.ndarray, short: int) -> tuple[np.ndarray, np.ndarray]:
    """The BANDS places of each line (the last bit tells n-grams of short lines) and its gate: length and nibbles. `least` has a row for each hash."""
    places = np.zeros((BANDS, least.shape[1]), np.uint64)
    for i in range(ROWS):
        places = kernel.mix(places * np.uint64(0xFF51AFD7ED558CCD) + least[i : BANDS * ROWS : ROWS] + np.arange(BANDS, dtype=np.uint64)[:, None])
    places = (places >> np.uint64(32)).astype(np.uint32) & np.uint32(0xFFFFFFFE) | np.uint32(short)
    gate = np.minimum(np.log(np.maximum(chars, 1)) / np.log(_LENGTH_STEP), 255).astype(np.uint64)
    for i in range(NIBBLES):
        gate = gate << np.uint64(4) | kernel.mix(least[BANDS * ROWS + i].astype(np.uint64)) & np.uint64(15)
    return np.ascontiguousarray(places.T).view(np.int32), gate.view(np.int64)


def alike(a: np.ndarray, b: np.ndarray, agree: np.ndarray | int = AGREE) -> np.ndarray:
    """Which pairs of gates have lengths that allow the similarity, and `agree` nibbles in common."""
    apart = a ^ b
    apart |= apart >> np.uint64(1)
    apart |= apart >> np.uint64(2)
    same = NIBBLES - np.bitwise_count(apart & np.uint64(0x0011111111111111)).astype(np.int64)
    length = (a >> np.uint64(56)).astype(np.int64) - (b >> np.uint64(56)).astype(np.int64)
    return (same >= agree) & (np.abs(length) <= _LENGTH_APART)


def meetings(lines: list[bytes], seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, id and gate for every place of every class; `lines` are of `_lines`, in lower case and none empty.

    `seen` remembers classes of earlier calls, as many as it is long, so that frequent lines are not repeated.
    """
    if not lines:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.ascontiguousarray(_classes(lines)[:, 0])
    new = np.zeros(len(ids), bool)
    new[np.unique(ids, return_index=True)[1]] = True
    if seen is not None:
        slot = (ids & np.uint64(len(seen) - 1)).astype(np.int64)
        new &= seen[slot] != ids
        seen[slot] = ids
    new = np.flatnonzero(new)
    ids = ids[new]
    found = []
    for n in (GRAM, SHORT_GRAM):
        some = [k for k, i in enumerate(new.tolist()) if n == GRAM or len(lines[i]) < SHORT]
        if some:
            # Each line ends in a space, its last word like the others.
            text = np.frombuffer(b" ".join([lines[i] for i in new[some].tolist()]) + b" ", np.uint8)
            size = np.fromiter((len(lines[i]) + 1 for i in new[some].tolist()), np.int64, len(some))
            at = np.cumsum(size) - size
            chars = np.add.reduceat((text & 0xC0) != 0x80, at, dtype=np.int64) - 1
            places, gate = _meetings(_least(text, at, n), chars, int(n == SHORT_GRAM))
            found.append((places.ravel(), np.repeat(ids[some].view(np.int64), BANDS), np.repeat(gate, BANDS)))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _held(texts: Iterator[bytes | None], most: int) -> Iterator[list[bytes]]:
    """The lines with a word of texts in turn, some `most` bytes of text at once."""
    held, size = [], 0
    for text in texts:
        if text:
            held += filter(None, _lines(text))
            size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def salted(key: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A part for each row: 0 for the first OFTEN rows of a key in a task, then 1, 2 ...; and which rows are the first past OFTEN.

    `met` counts the rows of earlier calls by the last bits of the key.
    """
    slot = key.view(np.uint32) & np.uint32(len(met) - 1)
    order = np.argsort(slot, kind="stable")
    sorted_ = slot[order]
    first = np.flatnonzero(np.diff(sorted_, prepend=-1))
    size = np.diff(np.append(first, len(sorted_)))
    at = np.empty(len(key), np.int64)
    at[order] = np.arange(len(key)) - np.repeat(first, size) + met[sorted_]
    met[sorted_[first]] += size
    return np.minimum(at // OFTEN, 0x7FFF).astype(np.int16), at == OFTEN


def _meet(buckets: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (place and part, id, gate) as bytes, all those of a place and part in one bucket."""
        seen, met = np.zeros(1 << 16, np.uint64), np.zeros(1 << 20, np.int64)
        held, n = [], 0
        for batch in itertools.chain(batches, [None]):
            for lines in _held(_lowered(batch.column(0)), 256 << 10) if batch is not None else ():
                key, ids, gate = meetings(lines, seen)
                part, full = salted(key, met)
                if full.any():
                    # The place's other part must not be taken for the whole.
                    key, ids, gate = np.append(key, key[full]), np.append(ids, ids[full]), np.append(gate, np.full(full.sum(), _MORE))
                    part = np.append(part, np.zeros(full.sum(), np.int16))
                held.append(np.stack([key.astype(np.int64) << 16 | part, ids, gate], axis=1))
                n += len(key)
                if n >= GATHERED:
                    yield _dealt(np.concatenate(held), buckets)
                    held, n = [], 0
            if batch is None and n:
                yield _dealt(np.concatenate(held), buckets)
            kernel.release()

    return meet


def _dealt(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = (kernel.mix(rows[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    edges = np.append(first, len(rows)) * (8 * rows.shape[1])
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(rows)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), packed.cast(pa.binary())], names=["bucket", "rows"])


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of `_meet`, sorted by place inside each bucket; a bucket's rows follow one another."""
    last, held = None, []
    for bucket, packed in itertools.chain(((b, p) for batch in batches for b, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), [(None, b"")]):
        if held and bucket != last:
            rows = np.frombuffer(b"".join(held), np.int64).reshape(-1, 3)
            rows = rows[np.argsort(rows[:, 0])]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=["place", "id", "gate"])
            held = []
        last = bucket
        held.append(packed)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _partners(_sorted_buckets(batches))


def _kind(key: int) -> int:
    """Of which n-grams a place is: a line has a gate for each kind."""
    return key & 1


def _agree(key: np.ndarray) -> np.ndarray:
    return np.where(key & 1, SHORT_AGREE, AGREE)


def _alike(a: Column, b: Column) -> Column:
    """`alike` in Spark, for gates of the place in column `key`."""
    apart = a.bitwiseXOR(b)
    apart = apart.bitwiseOR(F.shiftrightunsigned(apart, 1))
    apart = apart.bitwiseOR(F.shiftrightunsigned(apart, 2))
    same = NIBBLES - F.bit_count(apart.bitwiseAND(F.lit(0x0011111111111111)))
    length = F.shiftrightunsigned(a, 56) - F.shiftrightunsigned(b, 56)
    return (same >= F.when(F.col("key").bitwiseAND(1) == 1, SHORT_AGREE).otherwise(AGREE)) & (F.abs(length) <= _LENGTH_APART)


def _near_before(key: tuple, gates: np.ndarray, i: int) -> np.ndarray:
    gates = gates.view(np.uint64)
    return alike(gates[:i], gates[i], int(_agree(np.int64(key[0]))))


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and part (place: both in one), the pairs (null, u, v) of small places and rows (key, id, gate) of the members of others.

    A place in parts, or of more than DENSE rows, is not thinned out, and never held.
    """
    held: pa.Table | None = None
    passing = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None and not len(batch):
            continue
        rows = pa.Table.from_batches([batch]) if batch is not None else None
        if held is not None:
            rows = pa.concat_tables([held, rows]) if rows is not None else held
        if rows is None:
            return
        place, ids, gate = (rows.column(c).to_numpy() for c in ("place", "id", "gate"))
        key, part = (place >> 16).astype(np.int32), place & 0xFFFF
        edges = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(rows)]])
        size = np.diff(edges)
        whole = part[edges[:-1]] == 0
        if passing == (key[0], part[0]):
            whole[0] = False
        passing = (key[-1], part[-1]) if not whole[-1] or size[-1] > DENSE else None
        if batch is not None and passing is None:
            # The last place may go on.
            held, edges, size, whole = rows.slice(edges[-2]), edges[:-1], size[:-1], whole[:-1]
        else:
            held = None
        if not len(size):
            continue
        n = edges[-1]
        whole &= (size <= DENSE) & (np.add.reduceat(gate[:n] == _MORE, edges[:-1]) == 0)
        pairs, many = _pairs_alike(key[:n], ids[:n], gate[:n].view(np.uint64), edges, whole)
        many = many[gate[many] != _MORE]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int32()), pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["key", "u", "v"])
        yield pa.RecordBatch.from_arrays([pa.array(key[many]), pa.array(ids[many]), pa.array(gate[many])], names=["key", "u", "v"])


def _pairs_alike(key: np.ndarray, ids: np.ndarray, gate: np.ndarray, edges: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids with like gates between the same edges, and the rows of the places that have too many to be listed or are not `whole`."""
    size = np.diff(edges)
    pairs, many = [np.zeros((0, 2), np.int64)], [np.flatnonzero(np.repeat(~whole, size))]
    size = np.where(whole, size, 0)
    small = np.repeat((size <= 8) & whole, np.diff(edges))
    place = np.repeat(np.arange(len(size)), np.diff(edges))
    for gap in range(1, int(size[size <= 8].max(initial=1))):
        left = np.flatnonzero(small[:-gap] & (place[:-gap] == place[gap:]))
        left = left[alike(gate[left], gate[left + gap], _agree(key[left])) & (ids[left] != ids[left + gap])]
        pairs.append(np.stack([ids[left], ids[left + gap]], axis=1))
    for k in np.flatnonzero(size > 8):
        lo, hi = edges[k], edges[k + 1]
        near = np.zeros(hi - lo, bool)
        for at in range(lo, hi, 256):
            to = min(at + 256, hi)
            close = alike(gate[at:to, None], gate[None, lo:hi], int(_agree(key[lo])))
            near[at - lo : to - lo] = (close & (ids[at:to, None] != ids[None, lo:hi])).any(axis=1)
        near = lo + np.flatnonzero(near)
        if len(near) > LISTED:
            many.append(near)
        else:
            i, j = np.nonzero(np.triu(alike(gate[near, None], gate[None, near], int(_agree(key[lo]))) & (ids[near, None] != ids[None, near])))
            pairs.append(np.stack([ids[near[i]], ids[near[j]]], axis=1))
    return np.concatenate(pairs), np.concatenate(many)


def _near(whole: int):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of SimHashes sorted by meeting place (mask, bits), those within RADIUS of another there; shared ones at the first mask too."""
        held: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not len(batch):
                continue
            rows = pa.Table.from_batches([batch]) if batch is not None else None
            if held is not None:
                rows = pa.concat_tables([held, rows]) if rows is not None else held
            if rows is None:
                return
            mask, bits, sim, n = (rows.column(c).to_numpy() for c in ("mask", "bits", "sim", "n"))
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1
            cut = (int(new[-1]) if len(new) else 0) if batch is not None else len(rows)
            held = rows.slice(cut) if batch is not None else None
            if not cut:
                continue
            keep = _pairs_near(sim[:cut].view(np.uint64), np.concatenate([[0], new[new < cut], [cut]]))
            keep |= (n[:cut] > 1) & (mask[:cut] == whole)
            yield from rows.take(pa.array(np.flatnonzero(keep))).to_batches()

    return near


def _pairs_near(sim: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which of the SimHashes, all different in a place, are within RADIUS of another one between the same edges."""
    size = np.diff(edges)
    near = np.zeros(int(edges[-1]), bool)
    # Neighbours at every distance inside small places at once; larger places one by one.
    small = np.repeat(size <= 8, size)
    place = np.repeat(np.arange(len(size)), size)
    for gap in range(1, int(size[size <= 8].max(initial=1))):
        left = np.flatnonzero(small[:-gap] & (place[:-gap] == place[gap:]))
        hit = left[np.bitwise_count(sim[left] ^ sim[left + gap]) <= RADIUS]
        near[hit] = near[hit + gap] = True
    for k in np.flatnonzero(size > 8):
        some = sim[edges[k] : edges[k + 1]]
        for at in range(0, len(some), 1024):
            # Every SimHash is close to itself.
            close = np.bitwise_count(some[at : at + 1024, None] ^ some[None, :]) <= RADIUS
            near[edges[k] + at : edges[k] + at + len(close)] = close.sum(axis=1) > 1
    return near


def edit_distance(a: str, b: str, most: float = float("inf")) -> int:
    """Levenshtein distance by bit-parallel columns (Myers; Hyyro) on integers of any length; past `most`, any number past it."""
    at = 0
    while at < min(len(a), len(b)) and a[at] == b[at]:
        at += 1
    a, b = a[at:], b[at:]
    at = 0
    while at < min(len(a), len(b)) and a[-1 - at] == b[-1 - at]:
        at += 1
    a, b = a[: len(a) - at], b[: len(b) - at]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        match = where.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        rise = down | (full & ~(diagonal | up))
        fall = diagonal & up
        distance += bool(rise & last) - bool(fall & last)
        # Each column that is left takes off one at most.
        if distance - left > most:
            return distance - left
        rise = (rise << 1 | 1) & full
        fall = (fall << 1) & full
        up = fall | (full & ~(diagonal | rise))
        down = rise & diagonal
    return distance


def _bound(a: list[str], b: list[str], most: float) -> bool:
    """Whether an alignment of equal words, found in one walk, shows that at most `most` edits do; if not, more may or may not."""
    i = j = 0
    cost = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i, j = i + 1, j + 1
            continue
        # The nearest equal words ahead; without any, four words are exchanged.
        to = (min(i + 4, len(a)), min(j + 4, len(b)))
        for x, y in _AHEAD:
            if i + x < len(a) and j + y < len(b) and a[i + x] == b[j + y]:
                to = (i + x, j + y)
                break
        cost += max(sum(map(len, a[i : to[0]])) + to[0] - i, sum(map(len, b[j : to[1]])) + to[1] - j)
        if cost > most:
            return False
        i, j = to
    return cost + max(sum(map(len, a[i:])) + len(a) - i, sum(map(len, b[j:])) + len(b) - j) <= most


_AHEAD = sorted(((x, y) for x in range(6) for y in range(6) if x + y), key=lambda p: (p[0] + p[1], abs(p[0] - p[1])))


def _rising(values: list[int]) -> list[int]:
    """Places of a longest rising chain of different values."""
    ends, tops, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        at = bisect.bisect_left(tops, v)
        before[i] = ends[at - 1] if at else -1
        if at == len(tops):
            tops.append(v)
            ends.append(i)
        else:
            tops[at], ends[at] = v, i
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def _enough_edits(a: str, b: str) -> int:
    """Edits that do: words that either text has once, in one order, stay, and the stretches between them are aligned (exchanged past BLOCK)."""
    words = [text.split(" ") for text in (a, b)]
    once = []
    for some in words:
        count = Counter(some)
        once.append({w: i for i, w in enumerate(some) if count[w] == 1})
    met = [(i, once[1][w]) for w, i in once[0].items() if w in once[1]]
    cost, at, to = 0, 0, 0
    for i, j in [*(met[k] for k in _rising([j for _, j in met])), (len(words[0]), len(words[1]))]:
        one, other = " ".join(words[0][at:i]), " ".join(words[1][to:j])
        longer = max(len(one), len(other))
        # A stretch that only one text has brings its space along.
        cost += (edit_distance(one, other) if longer <= BLOCK else longer) + (bool(one) != bool(other))
        at, to = i + 1, j + 1
    return cost


def _limit(a: str, b: str, least: float = SIMILARITY) -> float:
    return (1 - least) * max(len(a), len(b)) + 1e-9


def _distance(a: str, b: str) -> float:
    """The edit distance, or no number for long lines, whose exact distance takes too long to be a mere help."""
    return edit_distance(a, b) if max(len(a), len(b)) <= BLOCK else float("nan")


_METRIC = meeting.Metric(_distance, _limit)


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    if not longest:
        return True
    most = _limit(a, b, least)
    if abs(len(a) - len(b)) > most:
        return False
    if _bound(a.split(" "), b.split(" "), most):
        return True
    # The exact distance of two long lines takes time by the square; most of those that are alike are told by a bound.
    if longest > BLOCK and _enough_edits(a, b) <= most:
        return True
    return edit_distance(a, b, most) <= most


def letters(lines: pa.Array) -> np.ndarray:
    """How often each line has each kind of letter, up to MOST_LETTERS; a kind is what the first byte of a code point leaves modulo LETTERS."""
    out = [np.zeros((0, LETTERS), np.uint8)]
    for lo, hi, data, offsets in kernel.texts(lines, 1 << 20):
        of = np.repeat(np.arange(hi - lo) * LETTERS, np.diff(offsets))
        first = (data & 0xC0) != 0x80
        counts = np.bincount(of[first] + data[first] % LETTERS, minlength=(hi - lo) * LETTERS)
        out.append(np.minimum(counts, MOST_LETTERS).astype(np.uint8).reshape(-1, LETTERS))
    return np.concatenate(out)


def letters_allow(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """False for pairs of `letters` that no lines with the similarity have: an edit adds one letter at most and takes one away at most."""
    size_a, size_b = a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64)
    apart = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)
    full = ((a == MOST_LETTERS) | (b == MOST_LETTERS)).any(axis=1)
    return full | ((apart + np.abs(size_a - size_b)) / 2 <= (1 - SIMILARITY) * np.maximum(size_a, size_b) + 1e-9)


def _partners_by_letters(key: tuple, held: dict[str, list]) -> list[tuple[int | None, int, int]]:
    """Of a tile's pairs that gates and letters allow, (None, u, v) of those of a member with few; (key, id, gate) of the other members of pairs."""
    ids, gates = np.array(held["id"], np.int64), np.array(held["tag"], np.int64)
    counts, parts = np.frombuffer(b"".join(held["letters"]), np.uint8).reshape(-1, LETTERS), np.array(held["part"])
    short, at_once, left, right = int(key[0]) & 1, 64, [], []
    for at in range(0, len(ids), at_once):
        rows = slice(at, at + at_once)
        close = np.triu(alike(gates[rows, None].view(np.uint64), gates[None, at:].view(np.uint64), SHORT_AGREE if short else AGREE), 1) & (ids[rows, None] != ids[None, at:])
        if key[1] != key[2]:
            close &= parts[rows, None] != parts[None, at:]
        i, j = (x + at for x in np.nonzero(close))
        fit = letters_allow(counts[i], counts[j])
        left.append(i[fit])
        right.append(j[fit])
    i, j = np.concatenate(left), np.concatenate(right)
    often = np.bincount(np.concatenate([i, j]), minlength=len(ids)) > (SHORT_FEW if short else FEW)
    many = often[i] & often[j]
    rest = np.unique(np.concatenate([i[many], j[many]]))
    u, v = ids[i[~many]], ids[j[~many]]
    return [*((None, *pair) for pair in zip(np.minimum(u, v).tolist(), np.maximum(u, v).tolist())), *((key[0], *row) for row in zip(ids[rest].tolist(), gates[rest].tolist()))]


def thinned(near: DataFrame, counted: DataFrame) -> DataFrame:
    """What `_partners` gives, for `near` (key, id, tag: a gate) and by letters as well; `counted` has id and letters."""
    sizes = common.weighed(near.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes", "size")
    parts = F.ceil(F.col("size") / THINNED).cast("int")
    placed = common.hot_join(near, sizes, ["key"], "size").withColumns({"part": F.pmod(F.xxhash64("id"), parts).cast("int"), "other": F.explode(F.sequence(F.lit(0), parts - 1))})
    tiled = placed.select("key", "id", "tag", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")).join(counted, "id")
    left = common.stored(common.per_run(tiled, ["key", "a", "b"], _partners_by_letters, ("key", "u", "v")), "thinned")
    common.forget(sizes[0])
    return left


def _packed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all lines in a row, and the place of each line in it with the end."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))])


def _grid(codes: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """A row for each stretch of `codes`, read on from `begin` by `step`; what lies past its size is of no meaning."""
    at = begin[:, None] + step * np.arange(width)
    at[np.arange(width) >= size[:, None]] = 0
    return codes[at]


def _equal_ends(codes: np.ndarray, a: np.ndarray, b: np.ndarray, least: np.ndarray, step: int) -> np.ndarray:
    """How many code points are equal from the places a and b on by `step`, `least` of them at most."""
    width = int(least.max(initial=0))
    if not width:
        return np.zeros(len(a), np.int64)
    apart = (_grid(codes, a, least, width, step) != _grid(codes, b, least, width, step)) & (np.arange(width) < least[:, None])
    return np.where(apart.any(axis=1), apart.argmax(axis=1), least)


def _bit_columns(codes: np.ndarray, kinds: int, a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """Edit distances of the stretches of sizes m and n at a and b, where they are `most` or less; else some number past it.

    Myers' columns of 64 rows for all pairs at once, those alone that lie within `most` of the diagonal.
    What is left out counts as a rise, which no path of at most `most` edits passes. n does not rise.
    """
    words, every = (int(m.max()) + 63) // 64, np.uint64(0xFFFFFFFFFFFFFFFF)
    one, top = np.uint64(1), np.uint64(63)
    rows = np.arange(len(a))
    match = np.zeros(len(a) * kinds * words, np.uint64)
    pattern, text = _grid(codes, a, m, words * 64).T, np.ascontiguousarray(_grid(codes, b, n, int(n[0])).T)
    for i in range(int(m.max())):
        live = rows if i < int(m.min()) else rows[m > i]
        match[(live * kinds + pattern[i, live]) * words + i // 64] |= one << np.uint64(i % 64)
    up, down = np.full((words, len(a)), every), np.zeros((words, len(a)), np.uint64)
    last = min(words - 1, most // 64)
    score, found = np.full(len(a), 64 * (last + 1), np.int64), np.zeros(len(a), np.int64)
    longer = np.searchsorted(-n, -np.arange(int(n[0]) + 1), "left").tolist()
    at = rows * (kinds * words)
    past = np.where(m - 64 * (words - 1) >= 64, np.uint64(0), every << (m - 64 * (words - 1)).clip(0, 63).astype(np.uint64))
    for j in range(int(n[0])):
        live = slice(0, longer[j])
        if last < min(words - 1, (j + 1 + most) // 64):
            last += 1
            score[live] += 64
        base = at[live] + text[j, live] * words
        rise, fall = np.full(live.stop, one), np.zeros(live.stop, np.uint64)
        for w in range(max(0, (j - most) // 64), last + 1):
            p, d, eq = up[w, live], down[w, live], match[base + w]
            still = eq | d
            eq |= fall
            x = eq & p
            x += p
            x ^= p
            x |= eq
            h = x | p
            np.invert(h, out=h)
            h |= d
            x &= p
            rise_out, fall_out = h >> top, x >> top
            h <<= one
            h |= rise
            x <<= one
            x |= fall
            np.bitwise_and(h, still, out=d)
            still |= h
            np.invert(still, out=still)
            np.bitwise_or(still, x, out=p)
            rise, fall = rise_out, fall_out
        score[live] += rise.astype(np.int64) - fall.astype(np.int64)
        done = slice(longer[j + 1], live.stop)
        if done.start < done.stop:
            below = past[done]
            found[done] = score[done] - np.bitwise_count(up[-1, done] & below).astype(np.int64) + np.bitwise_count(down[-1, done] & below) if last == words - 1 else most + 1
    return found


def similar_pairs(lines: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`similar` for the pairs lines[i], lines[j], many at once."""
    out = np.zeros(len(i), bool)
    for lo in range(0, len(i), PAIRS):
        some = slice(lo, lo + PAIRS)
        ids, where = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
        out[some] = _similar_pairs([lines[k] for k in ids.tolist()], *where.reshape(2, -1))
    return out


def _similar_pairs(lines: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    longer = size[j] > size[i]
    i, j = np.where(longer, j, i), np.where(longer, i, j)
    most = np.floor((1 - SIMILARITY) * size[i] + 1e-9).astype(np.int64)
    out = np.zeros(len(i), bool)
    open_ = size[i] - size[j] <= most
    for k in np.flatnonzero(open_ & (size[i] > WIDE)).tolist():
        out[k] = similar(lines[i[k]], lines[j[k]])
    open_ = np.flatnonzero(open_ & (size[i] <= WIDE))
    if not len(open_):
        return out
    codes, at = _packed([line if len(line) <= WIDE else "" for line in lines])
    # Kinds of code points in these lines; past KINDS some share a number, and what then seems alike is compared once more.
    present = np.zeros(0x110000, bool)
    present[codes] = True
    kinds = np.flatnonzero(present)
    number = np.zeros(0x110000, np.int32)
    number[kinds] = np.arange(len(kinds)) % KINDS
    codes, shared = number[codes], len(kinds) > KINDS
    kinds = min(len(kinds), KINDS)
    open_ = open_[np.argsort(size[i[open_]], kind="stable")]
    a, b, m, n, limit = at[i[open_]], at[j[open_]], size[i[open_]], size[j[open_]], most[open_]
    for lo in range(0, len(open_), 1024):
        lot = slice(lo, lo + 1024)
        head = _equal_ends(codes, a[lot], b[lot], n[lot], 1)
        tail = _equal_ends(codes, a[lot] + m[lot] - 1, b[lot] + n[lot] - 1, n[lot] - head, -1)
        a[lot], b[lot], m[lot], n[lot] = a[lot] + head, b[lot] + head, m[lot] - head - tail, n[lot] - head - tail
    near = m <= limit  # as many edits do
    left = np.flatnonzero(~near & (n > 0))
    words = (m[left] + 63) // 64
    for w in np.unique(words).tolist():
        of = left[words == w]
        for part in np.array_split(of, -(-len(of) * kinds * w // MATCHES)):
            if w > COLUMNS or len(part) < MANY * w:
                near[part] = [similar(lines[i[k]], lines[j[k]]) for k in open_[part].tolist()]
            else:
                part = part[np.argsort(-n[part], kind="stable")]
                near[part] = _bit_columns(codes, kinds, a[part], m[part], b[part], n[part], int(limit[part].max())) <= limit[part]
    out[open_] = near
    if shared:
        for k in open_[out[open_]].tolist():
            out[k] = similar(lines[i[k]], lines[j[k]])
    return out


def _letters_fit(things: list[tuple]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """For `meeting`: which pairs of things, lines alone, have letters that allow the similarity."""
    counts = letters(pa.array([line for line, in things], pa.string()))
    return lambda i, j: letters_allow(counts[i], counts[j])


def _same_pairs(things: list[tuple]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """For `meeting`: which pairs of things, lines alone, are `similar`, first by their letters."""
    lines, fits = [line for line, in things], _letters_fit(things)

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), bool)
        for lo in range(0, len(i), 65_536):
            out[lo : lo + 65_536] = fits(i[lo : lo + 65_536], j[lo : lo + 65_536])
        fit = np.flatnonzero(out)
        out[fit] = similar_pairs(lines, i[fit], j[fit])
        return out

    return same


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _verify(masks: list[int]):
    order = [_signed(m) for m in masks]

    def verify(key: tuple, rows: dict[str, list]) -> list[tuple[int, int]]:
        """Edges between the classes of a tile: enough of them to connect whatever its links connect.

        A pair is compared under the first mask on which it agrees, and nowhere else.
        """
        sims = np.array(rows["sim"], np.int64).view(np.uint64)
        texts, parts, ids, out = rows["line"], np.array(rows["part"]), rows["id"], []
        forest, earlier = Forest(len(ids)), [np.uint64(m) for m in masks[: order.index(key[0])]]
        for i in range(1, len(ids)):
            apart = sims[:i] ^ sims[i]
            close = np.bitwise_count(apart) <= RADIUS
            if key[2] != key[3]:
                close &= parts[:i] != parts[i]
            for m in earlier:
                close &= (apart & m) != 0
            for j in np.flatnonzero(close).tolist():
                if forest.root(i) != forest.root(j) and similar(texts[i], texts[j]):
                    forest.join(i, j)
                    out.append((ids[j], ids[i]))
        return out

    return verify


def _verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, other = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        at = np.arange(len(batch))
        keep = _same_pairs([(line,) for line in one + other])(at, at + len(batch))
        yield batch.select(["u", "v"]).filter(pa.array(keep))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _normal(line: str) -> str:
    return " ".join(_WORD.findall(line.lower()))


def links(classes: DataFrame, documents: DataFrame, key: str, text: str) -> DataFrame:
    """u, v: ids of linked classes, enough to connect each group. `classes` has id, sim, first (where a line of it stands)."""
    masks = tables(block_bits(classes.count()))
    sims = classes.groupBy("sim").agg(F.count(F.lit(1)).alias("n"))
    meet = (
        sims.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])))
        .select("sim", "n", "mask", F.col("sim").bitwiseAND(F.col("mask")).alias("bits"))
        .repartition("mask", "bits")
        .sortWithinPartitions("mask", "bits")
    )
    near = common.stored(meet.mapInArrow(_near(_signed(masks[0])), "sim long, n long, mask long, bits long"), "near")
    some = common.weighed(near.groupBy("sim").agg(F.first("n").alias("n")), "some", "n")
    members = common.stored(common.hot_join(classes.select("id", "low", "sim", "first"), some, ["sim"], "n"), "members")
    lines = common.stored(_lines_of(members.select("id", "low", "first.*"), documents, key, text), "lines").select("id", "line")
    sizes = common.weighed(near.groupBy("mask", "bits").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("sims")), "sizes", "sims")
    parts = F.ceil(F.col("size") / SLICE).cast("int")
    places = common.hot_join(near, sizes, ["mask", "bits"], "sims").select("sim", "mask", "bits", parts.alias("parts"))
    placed = places.join(members.select("id", "sim"), "sim").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # A slice of a place takes part in a tile with every slice of it, itself included.
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "id", "sim", "mask", "bits", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")
    )
    return common.stored(common.per_run(tiled.join(lines, "id"), ["mask", "bits", "a", "b"], _verify(masks)), "links")


def links_alike(classes: DataFrame, documents: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """node, root of the classes that are linked by edit similarity alone; and id, low of each of them.

    `classes` has id (the first hash of the class), low and first.
    """
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * n, classes.count() * 2 * BANDS // BUCKET)
    meet = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(_meet(buckets), "bucket int, rows binary")
    met = common.stored(meet.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_met, "key int, u long, v long"), "met")
    pairs, near = met.where("key is null").select("u", "v").distinct(), met.where("key is not null").select("key", F.col("u").alias("id"), F.col("v").alias("tag")).dropDuplicates(["key", "id"])
    pairs, near = common.stored(pairs, "pairs"), common.stored(near, "near")
    common.forget(met)
    asked = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).union(near.select("id")).distinct()
    members = classes.select("id", "low", "first").join(asked, "id").select("id", "low", "first.*")
    lines = common.stored(_lines_of(members, documents, key, text), "lines")
    met = thinned(near, lines.select("id", "letters"))
    every = common.stored(pairs.union(met.where("key is null").select("u", "v")).distinct(), "pairs")
    left = common.stored(met.where("key is not null").select(F.col("key").cast("int").alias("key"), F.col("u").alias("id"), F.col("v").alias("tag")).distinct(), "near")
    common.forget(pairs, near, met)
    texts = every.join(lines.select(F.col("id").alias("u"), F.col("line").alias("one")), "u").join(lines.select(F.col("id").alias("v"), F.col("line").alias("other")), "v")
    listed = common.stored(texts.select("u", "v", "one", "other").mapInArrow(_verify_pairs, "u long, v long"), "links")
    placed = meeting.pivoted(left, ["key"])
    # A line has 2 * BANDS places at most.
    places = left.groupBy("id").agg(F.collect_set("key").alias("places"))
    joined = common.stored(meeting.connect(placed, ["key"], lines.select("id", "line"), str, similar, _near_before, _alike(F.col("tag"), F.col("pivot.tag")), listed, places, _METRIC, _kind, _same_pairs, _letters_fit), "joined")
    common.forget(every, left, placed, listed)
    lows = joined.select(F.col("node").alias("id")).join(lines.select("id", "low"), "id")
    return joined, lows


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _lines_of(wanted: DataFrame, documents: DataFrame, key: str, text: str) -> DataFrame:
    """id, low, normalised text and letters of one line of each wanted id; of classes that share an id by chance, one stands for it."""
    asked = wanted.groupBy("key_id", "key_text").agg(F.collect_list(F.struct("place", "id", "low")).alias("asked"))
    held = documents.select(*common.row_key(key, text), F.col(text).cast("string").alias("text"))
    # By merge at any size: what is small in a test is not small on a cluster.
    met = held.join(asked.hint("merge"), ["key_id", "key_text"]).select("asked", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lows, lines = [], [], []
            for asked, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = text.split("\n")
                for one in asked:
                    ids.append(one["id"])
                    lows.append(one["low"])
                    lines.append(_normal(parts[one["place"]]))
            lines = pa.array(lines, pa.string())
            counted = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LETTERS), len(lines), [None, pa.py_buffer(letters(lines).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lows, pa.int64()), lines, counted], names=["id", "low", "line", "letters"])

    return met.mapInArrow(run, "id long, low long, line string, letters binary").dropDuplicates(["id"])


def groups(documents: DataFrame, key: str = "doc_id", text: str = "text", radius: int | None = RADIUS) -> tuple[DataFrame, tuple[DataFrame, int]]:
    """Every line with a word (key_id, key_text, place, high, low), and for each class that is not alone the place that stays.

    The second, for `common.hot_join`, has high, low, copies, and the keeper's kept_id, kept_text, kept_place.
    """
    if radius not in (None, RADIUS):
        raise ValueError(f"radius is {RADIUS} or None")
    seen = common.stored(occurrences(documents, key, text, radius is not None), "occurrences")
    where = F.struct("key_id", "key_text", "place")
    classes = common.stored(
        seen.groupBy("high", "low").agg(F.min(where).alias("first"), F.first("sim").alias("sim"), F.count(F.lit(1)).alias("copies")).withColumn("id", F.col("high") if radius is None else F.xxhash64("high", "low")),
        "classes",
    )
    if radius is None:
        joined, lows = links_alike(classes, documents, key, text)
        # By both hashes, so that classes that share the first by chance stay apart.
        joined = joined.join(lows, joined["node"] == lows["id"]).select("id", "low", "root")
        named = classes.join(joined, ["id", "low"], "left")
    else:
        joined = common.components(links(classes, documents, key, text))
        named = classes.join(joined.withColumnRenamed("node", "id"), "id", "left")
    named = common.stored(named.withColumn("group", F.coalesce("root", "id")), "named")
    common.forget(classes, joined)
    linked = named.where("root is not null")
    keepers = common.weighed(linked.groupBy("group").agg(F.min("first").alias("kept"), F.count(F.lit(1)).alias("n")), "keepers", "n")
    met = common.hot_join(linked, keepers, ["group"], "n").select("high", "low", "copies", "kept")
    alone = named.where("root is null and copies > 1").select("high", "low", "copies", F.col("first").alias("kept"))
    kept = met.unionByName(alone).select(
        "high", "low", "copies", F.col("kept.key_id").alias("kept_id"), F.col("kept.key_text").alias("kept_text"), F.col("kept.place").alias("kept_place")
    )
    kept = common.weighed(kept, "kept", "copies")
    common.forget(named, keepers[0])
    return seen, kept


def dropped(documents: DataFrame, key: str = "doc_id", text: str = "text", radius: int | None = RADIUS) -> DataFrame:
    """key_id, key_text, places: the places of the lines that each document loses."""
    seen, kept = groups(documents, key, text, radius)
    met = common.hot_join(seen, kept, ["high", "low"], "copies")
    gone = met.where("not (key_id = kept_id and key_text = kept_text and place = kept_place)")
    return gone.groupBy("key_id", "key_text").agg(F.collect_set("place").alias("places"))


def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, gone in batches:
        out = texts.to_pylist()
        for i, places in enumerate(gone.to_pylist()):
            if places and out[i] is not None:
                places = set(places)
                out[i] = "\n".join(line for k, line in enumerate(out[i].split("\n")) if k not in places)
        yield pa.array(out, pa.string())


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text", drop_emptied: bool = False, radius: int | None = RADIUS, count: str = "n_dropped") -> DataFrame:
    """`documents` without the lines that are copies, with their number as `count`; documents that lose all their lines go if `drop_emptied`.

    `radius=None` links lines on their edit similarity alone. A column of the name `count` gives way to it.
    """
    gone = dropped(documents, key, text, radius)
    places = common.stored(gone, "dropped")
    common.forget(gone)
    names = common.free(documents, "key_id", "key_text", "places", "left", "touched")
    key_id, key_text, gone, left, touched = names
    met = (
        documents.withColumns(dict(zip((key_id, key_text), common.row_key(key, text))))
        .join(places.toDF(key_id, key_text, gone).hint("merge"), [key_id, key_text], "left")
        .withColumn(touched, F.col(gone).isNotNull())
    )
    # Only texts that lose lines go to Python, and nothing else of their rows.
    cut = F.arrow_udf(_without, "string").asNondeterministic()
    made = met.withColumn(left, cut(F.when(F.col(touched), F.col(text).cast("string")), F.col(gone)))
    if drop_emptied:
        made = made.where(~F.col(touched) | F.coalesce(F.col(left), F.lit("")).rlike("[^\\x20\\x09-\\x0D]"))
    kept = [F.when(F.col(touched), F.col(left)).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in documents.columns if c.lower() != count.lower()]
    return made.select(*kept, F.coalesce(F.size(gone), F.lit(0)).alias(count))
