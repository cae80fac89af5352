"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A document's fingerprint has a bit set if more than half of the XXH64 hashes (seed 42) of its
SHINGLE-word shingles have it set. Fingerprints link at RADIUS or fewer differing bits.
Documents with one fingerprint are one member of what follows, whatever their number.

A fingerprint is cut into three segments of at most 23 bits. The Golay code of length 23 is
perfect: every word of 23 bits is within three bits of one codeword. So two segments that
differ by two bits or fewer have a word between them, one bit from each at most, and share the
codeword that it decodes to: a segment's keys are the indices of the codewords that it and its
one-bit neighbours decode to, one or six (Berkovich and Kowalski's fuzzy hashing). Of RADIUS
errors in three segments, either no segment has more than two, and the fingerprints share an
index in each of the three (a key of 36 bits), or two segments have one error in all, and the
fingerprints share one of these exactly and an index in the other (34 bits). So linked fingerprints
meet in a place, and hardly any others do.

Each member is compared with its place's least and greatest: one shuffle and a window, in which
a place is a run of sorted rows that Spark spills. A fingerprint is one row in each of about 180 places, so no
place has more than that part of all rows. What is then connected is contracted, and
members outside a place's largest component are compared with all others in slices of SLICE, as
arrays of bits. No link between components is lost. A place with very many members, none of
which is linked to another, would take time by the square of their number.

Defined cases: a text that is null or has no word has fingerprint zero, linked like any other;
fewer than SHINGLE words are one shingle; null doc_ids are passed over where a component is
named (null if all are); repeated rows stay rows; other columns are ignored; an empty table
gives an empty result. Texts are walked in pieces, however long they are.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm import common

#: Words of a shingle, most differing bits of a link, seed of the hash.
SHINGLE, RADIUS, SEED = 4, 4, 42
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: The Golay code's generator polynomial, bits of a codeword and of its index.
GENERATOR, LONG, INDEX = 0b101011100011, 23, 12
#: Bytes of a text that are walked at once, fingerprints that are keyed at once, members of a slice.
PIECE, BATCH, SLICE = 1 << 20, 4096, 256

_SPACE = re.compile(rb"[\x09-\x0d ]")


def _set_bits(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the runs of `size` words, and their number."""
    data, n = memoryview(b" ".join(words)), len(words) - size + 1
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    hashed = (xxhash.xxh64_intdigest(data[a:b], SEED) for a, b in zip(begins[:n].tolist(), ends[size - 1 :].tolist()))
    raw = np.fromiter(hashed, "<u8", n).view(np.uint8).reshape(n, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64), n


def fingerprint(data: bytes) -> int:
    """The fingerprint of a text in UTF-8, as a signed 64-bit number."""
    total, n, kept, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        words = kept + data[at:end].lower().split()
        if len(words) >= SHINGLE:
            more, count = _set_bits(words, SHINGLE)
            total, n, words = total + more, n + count, words[1 - SHINGLE :]
        kept, at = words, end
    if not n and kept:
        total, n = _set_bits(kept, len(kept))
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
        prints = [fingerprint(t.as_py() or b"") for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "print"])


@functools.cache
def decoder() -> np.ndarray:
    """The index of the codeword within three bits of each word of 23 bits."""
    index = np.arange(1 << INDEX)
    rest = index << (LONG - INDEX)
    for bit in range(LONG - 1, LONG - INDEX - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - LONG + INDEX)), rest)
    codeword = index << (LONG - INDEX) | rest
    one = 1 << np.arange(LONG)
    errors = np.unique(np.concatenate([[0], one])[:, None, None] ^ np.concatenate([[0], one])[:, None] ^ np.concatenate([[0], one]))
    table = np.zeros(1 << LONG, np.int16)
    table[codeword[:, None] ^ errors] = index[:, None]
    return table


def indices(segment: np.ndarray, width: int) -> np.ndarray:
    """For each segment the distinct indices of itself and of its neighbours, six columns filled up with -1."""
    near = np.concatenate([segment[:, None], segment[:, None] ^ (1 << np.arange(width))], axis=1)
    found = np.sort(decoder()[near], axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    out = np.full((len(segment), 6), -1, np.int64)
    row, column = np.nonzero(new)
    out[row, np.cumsum(new, axis=1)[row, column] - 1] = found[row, column]
    return out


def places(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the places of each fingerprint, and the row that each key is of."""
    prints = prints.view(np.uint64)
    exact = [(prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64) for first, width in SEGMENTS]
    near = [indices(segment, width) for segment, (_, width) in zip(exact, SEGMENTS)]
    rows = np.arange(len(prints))
    keys, of = [], []
    for kind, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        good = near[j] >= 0
        keys.append((((kind << 22 | exact[i]) << INDEX)[:, None] | near[j])[good])
        of.append(np.broadcast_to(rows[:, None], good.shape)[good])
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    good = (a >= 0) & (b >= 0) & (c >= 0)
    keys.append((7 << 36 | a << 24 | b << 12 | c)[good])
    of.append(np.broadcast_to(rows[:, None, None, None], good.shape)[good])
    return np.concatenate(keys), np.concatenate(of)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for at in range(0, len(prints), BATCH):
            here = prints[at : at + BATCH]
            keys, of = places(here)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(here[of])], names=["key", "print"])


def _near(u: str, v: str) -> Column:
    return F.bit_count(F.col(u).bitwiseXOR(F.col(v))) <= RADIUS


def _across(_: tuple, held: dict[str, list]) -> list[tuple[int, int]]:
    """A link for each two components of which a member of the one is near one of the other."""
    prints, root, part = np.array(held["print"]), np.array(held["root"]), np.array(held["part"])
    near = np.bitwise_count((prints[:, None] ^ prints[None, :]).view(np.uint64)) <= RADIUS
    u, v = np.nonzero(near & (root[:, None] < root[None, :]) & ((part[:, None] != part[None, :]) | (part.min() == part.max())))
    links = {(root[i], root[j]): (int(prints[i]), int(prints[j])) for i, j in zip(u.tolist(), v.tolist())}
    return list(links.values())


def links_across(rows: DataFrame) -> DataFrame:
    """u, v: links between the components that meet in places; `rows` has key, print, root."""
    counted = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = F.max(F.struct("n", "root"))
    open_ = common.weighed(counted.groupBy("key").agg(F.sum("n").alias("size"), most["n"].alias("large"), most["root"].alias("main")).where("size > large"), "open", "size")
    outside = F.col("root") != F.col("main")
    rest, whole = F.ceil((F.col("size") - F.col("large")) / SLICE).cast("int"), F.ceil(F.col("large") / SLICE).cast("int")
    small = F.col("size") <= SLICE
    part = F.when(small, 0).when(outside, F.pmod(F.xxhash64("print"), rest)).otherwise(rest + F.pmod(F.xxhash64("print"), whole)).cast("int")
    others = F.when(small, 1).when(outside, rest + whole).otherwise(rest)
    sliced = common.hot_join(rows, open_, ["key"], "size").withColumns({"part": part, "other": F.explode(F.sequence(F.lit(0), others - 1))})
    tiles = sliced.select("key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "print", "root", "part")
    return common.per_run(tiles, ["key", "a", "b"], _across)


def link(prints: DataFrame) -> DataFrame:
    """node, root of the distinct fingerprints (print) that are linked to another."""
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = prints.select("print").repartition(n).mapInArrow(_placed, "key long, print long")
    place = Window.partitionBy("key")
    sized = placed.select("key", "print", F.count(F.lit(1)).over(place).alias("n"), F.min("print").over(place).alias("low"), F.max("print").over(place).alias("high"))
    met = common.stored(sized.where("n > 1"), "places")
    pairs = met.select(F.col("print").alias("u"), F.col("low").alias("v")).union(met.select("print", "high"))
    named = common.stored(common.components(pairs.where((F.col("u") != F.col("v")) & _near("u", "v"))), "named")
    rows = met.where("n > 2").join(named.withColumnRenamed("node", "print"), "print", "left").select("key", "print", F.coalesce("root", "print").alias("root"))
    last, seen = common.measured(links_across(common.stored(rows, "rooted")), "links", n=F.count(F.lit(1)))
    if not seen["n"]:
        return named
    return common.components(last.union(named.select(F.col("node").alias("u"), F.col("root").alias("v"))))


def components(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id (the least doc_id reachable) of every document."""
    asked = documents.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = asked.schema["doc_id"].dataType.simpleString()
    marked = common.stored(asked.mapInArrow(_fingerprints, f"doc_id {kind}, print long"), "fingerprints")
    prints, limit = common.weighed(marked.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "prints", "n")
    rooted = prints.join(link(prints).withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = common.stored(rooted, "rooted")
    named = common.stored(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("print", "component_id", "n"), "named")
    told = common.hot_join(marked, (named, limit), ["print"], "n")
    return told.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
