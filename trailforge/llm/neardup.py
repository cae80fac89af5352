"""Near-duplicate documents by improved consistent weighted sampling (Ioffe, 2010) over TF-IDF shingles.

A document is the weighted set of its SHINGLE-word shingles in lower case (a shorter text is
one shingle of all its words). A shingle weighs its count in the document times its inverse
document frequency. Frequencies are counted over all documents in signed sketches, whose size
is fixed however large the corpus is and whose estimates are unbiased, so a frequent shingle
is told from a rare one at any size. Shingles in less than a RARE part of the documents weigh
the same, and the root is taken of the logarithm, because a shingle that a large group of
copies shares must not weigh so little that their few edits make them differ.

Each document gets BANDS * ROWS consistent samples; documents that agree on all samples of a
band meet there. A pair at weighted Jaccard similarity 0.8 meets with probability over
0.9998. Pairs that meet are verified by their exact weighted Jaccard similarity, unless they
are known to be connected (`meeting` says in what order). Connected documents are one class,
named by its least doc_id.

Documents with the same words are one member of all this, whatever their number. Only
hashes are shuffled for all documents, texts for those alone that have a partner.

Defined cases: a document without a word is a class of its own; null doc_ids sort first, and
such a class's name is null (the least long counts as null); rows that repeat a doc_id and text are one document to
`deduplicate` and a row each to `classes`; other columns pass through `deduplicate`; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.llm import common, kernel, meeting

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
#: Counters of the sketches of frequencies. An estimate is off by about the root of the sum of squared frequencies over WIDTH.
DEPTH, _BITS = 3, 16
WIDTH = 1 << _BITS
#: The part of all documents up to which a shingle is as rare as any.
RARE = 0.02
#: Bytes of text that are sketched at a time: arrays of their shingles stay in a core's cache.
_PIECE = 512 << 10
_STEPS = 1 << 16


def _gamma_two() -> np.ndarray:
    """The quantiles of the Gamma(2, 1) distribution at the middles of _STEPS equal parts."""
    at = (np.arange(_STEPS) + 0.5) / _STEPS
    low, high = np.zeros(_STEPS), np.full(_STEPS, 64.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < at
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return high


def _shuffled(values: np.ndarray, seed: int) -> np.ndarray:
    return values[np.argsort(kernel.stream(np.arange(_STEPS), seed))]


def _atoms() -> tuple[np.ndarray, ...]:
    """_STEPS draws of (r, beta, c), each a quantile of its law, and what the sampling formula makes of them.

    With level = floor(ln w / r + beta), the logarithm to be least is ln c - r * (level - beta) - r.
    """
    r, c = _shuffled(_gamma_two(), 41), _shuffled(_gamma_two(), 42)
    beta = _shuffled((np.arange(_STEPS) + 0.5) / _STEPS, 43)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, beta, np.log(c) + r * beta - r))


_R, _INVERSE_R, _BETA, _SHIFT = _atoms()
_MULTIPLIERS = kernel.stream(np.arange(1 << 16), 44) | np.uint64(1)


def occurrences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every shingle in the order of texts, the text of each, and which texts have words."""
    words, word_at = _words(data, offsets)
    return (*_grams(words, word_at), np.diff(word_at) > 0)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin, end, word_at = kernel.words(data, offsets)
    return kernel.span_hashes(data, begin, end), word_at


def _grams(words: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(word_at)
    grams, of, _ = kernel.windows(words, word_at, SHINGLE)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        own = np.repeat(word_at[:-1][short], n[short]) + np.arange(n[short].sum()) - np.repeat(np.cumsum(n[short]) - n[short], n[short])
        whole = kernel.sequence_hashes(words[own], np.cumsum(n[short]) - n[short], 33)
        grams, of = np.concatenate([grams, whole]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        grams, of = grams[order], of[order]
    return grams, of


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles in the order of texts with the text and count of each; and two hashes of each text's words (0 without words)."""
    words, word_at = _words(data, offsets)
    whole = np.flatnonzero(np.diff(word_at) > 0)
    high, low = np.zeros(len(offsets) - 1, np.uint64), np.zeros(len(offsets) - 1, np.uint64)
    high[whole] = kernel.sequence_hashes(words, word_at[:-1][whole], 31)
    low[whole] = kernel.sequence_hashes(words, word_at[:-1][whole], 32)
    grams, of = _grams(words, word_at)
    _, first, count = np.unique(kernel.mix(grams + kernel.stream(of, 3)), return_index=True, return_counts=True)
    order = np.argsort(first)
    first, count = first[order], count[order]
    return grams[first], of[first], count, high, low


@dataclass(frozen=True)
class Idf:
    """What the frequencies of all shingles come to: DEPTH signed sketches of WIDTH counters (Charikar, Chen and Farach-Colton, 2002)."""

    documents: int
    counters: np.ndarray

    def frequencies(self, grams: np.ndarray) -> np.ndarray:
        """About how many documents have each shingle: the median of what the sketches say."""
        said = [self.counters[d][_slot(grams, d)] * _sign(grams, d) for d in range(DEPTH)]
        return np.maximum(np.minimum(said[0], said[1]), np.minimum(np.maximum(said[0], said[1]), said[2]))

    def of(self, grams: np.ndarray) -> np.ndarray:
        """1 + ln(documents / frequency) under a root; shingles of less than a RARE part of the documents count as equally rare."""
        n, floor = 1 + self.documents, max(1.0, RARE * self.documents)
        out = np.full(len(grams), np.sqrt(1 + np.log(n / floor)), np.float32)
        often = self.frequencies(grams)
        some = np.flatnonzero(often > floor)
        out[some] = np.sqrt(1 + np.log(n / np.minimum(often[some], n)))
        return out


def _slot(grams: np.ndarray, d: int) -> np.ndarray:
    return ((grams >> np.uint64(d * _BITS)) & np.uint64(WIDTH - 1)).astype(np.int64)


def _sign(grams: np.ndarray, d: int) -> np.ndarray:
    return ((grams >> np.uint64(60 + d)) & np.uint64(1)).astype(np.int64) * 2 - 1


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, documents = np.zeros((DEPTH, WIDTH), np.int64), 0
    for batch in batches:
        for _, _, data, offsets in kernel.texts(pc.utf8_lower(batch.column(0)), _PIECE):
            grams, of, wordy = occurrences(data, offsets)
            # Each shingle once for each text.
            grams = grams[np.unique(kernel.mix(grams + kernel.stream(of, 3)), return_index=True)[1]]
            for d in range(DEPTH):
                total[d] += np.bincount(_slot(grams, d), weights=_sign(grams, d), minlength=WIDTH).astype(np.int64)
            documents += int(wordy.sum())
    total = total.ravel()
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], documents))], names=["counter", "n"])


def idf_table(documents: DataFrame, text: str = "text") -> Idf:
    """Counts over all documents. DEPTH * WIDTH rows reach the driver, whatever the corpus."""
    rows = documents.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).mapInArrow(_frequencies, "counter long, n long")
    counted = rows.groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    counters = np.zeros(DEPTH * WIDTH, np.int32 if counted["n"].abs().max() < 2**31 else np.int64)
    some = counted[counted["counter"] >= 0]
    counters[some["counter"].to_numpy()] = some["n"].to_numpy()
    return Idf(int(counted.loc[counted["counter"] < 0, "n"].sum()), counters.reshape(DEPTH, WIDTH))


def weights(grams: np.ndarray, count: np.ndarray, idf: Idf) -> np.ndarray:
    return count.astype(np.float32) * idf.of(grams)


def samples(grams: np.ndarray, of: np.ndarray, weight: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """For each text that has shingles, in order, the hashes of its `k` consistent samples (a shingle and its level)."""
    first = np.flatnonzero(np.diff(of, prepend=-1))
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(of))))
    log_weight = np.log(weight)
    out = np.empty((len(first), k), np.uint64)
    for i in range(k):
        # Shingle hashes are mixed already: a product's top bits are as good a draw as another mixing.
        atom = ((grams * _MULTIPLIERS[i]) >> np.uint64(48)).view(np.int64)
        level = _INVERSE_R.take(atom)
        level *= log_weight
        level += _BETA.take(atom)
        np.floor(level, out=level)
        value = _SHIFT.take(atom)
        value -= _R.take(atom) * level
        hit = np.flatnonzero(value == np.minimum.reduceat(value, first).take(bag))
        if len(hit) > len(first):
            # Of equal values the one of the least hash, whatever its place in the text.
            hit = hit[np.lexsort((grams[hit], bag[hit]))]
            hit = hit[np.flatnonzero(np.diff(bag[hit], prepend=-1))]
        out[:, i] = kernel.mix(grams[hit] + level[hit].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def band_keys(drawn: np.ndarray) -> np.ndarray:
    parts = drawn.reshape(len(drawn), -1, ROWS)
    key = np.zeros(parts.shape[:2], np.uint64)
    for j in range(ROWS):
        key = kernel.mix(key * np.uint64(0xFF51AFD7ED558CCD) + parts[:, :, j])
    return key.view(np.int64)


def _sketch(idf: Idf):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in kernel.texts(pc.utf8_lower(batch.column(2)), _PIECE):
                grams, of, count, high, low = shingles(data, offsets)
                keys = np.zeros((hi - lo, BANDS), np.int64)
                if len(grams):
                    keys[np.unique(of)] = band_keys(samples(grams, of, weights(grams, count, idf)))
                wordy = np.zeros(hi - lo, bool)
                wordy[of] = True
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                made = [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), lists, pa.array(wordy)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *made], names=["key_id", "key_text", "high", "low", "bands", "wordy"])

    return sketch


def weighted_sets(data: np.ndarray, offsets: np.ndarray, idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingles of each text with their weights, and where each text's begin (with the total at the end)."""
    grams, of, count, *_ = shingles(data, offsets)
    order = np.lexsort((grams, of))
    grams, of, count = grams[order], of[order], count[order]
    return grams, weights(grams, count, idf), np.searchsorted(of, np.arange(len(offsets)))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted sets: the sum of the lesser weights over the sum of the greater ones."""
    small, large = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    if not len(small[0]):
        return 0.0
    at = np.minimum(np.searchsorted(large[0], small[0]), len(large[0]) - 1)
    both = np.minimum(small[1], np.where(large[0][at] == small[0], large[1][at], 0)).sum()
    return both / (a[1].sum() + b[1].sum() - both)


def _sets(idf: Idf):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in kernel.texts(pc.utf8_lower(batch.column(1)), _PIECE):
                grams, weight, at = weighted_sets(data, offsets, idf)
                parts = [[x[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)] for x in (grams, weight)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(x, pa.binary()) for x in parts)], names=["id", "grams", "weights"])
            kernel.release()

    return sets


def _ready(grams: bytes, weight: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(grams, np.uint64), np.frombuffer(weight, np.float32).astype(np.float64)


def _same(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    return similarity(a, b) >= SIMILARITY


def _near_before(key: tuple, bands: np.ndarray, i: int) -> np.ndarray:
    """A pair is compared in the first band on which it agrees, and nowhere else."""
    return ~(bands[:i, : key[0]] == bands[i, : key[0]]).any(axis=1)


def _joined(members: DataFrame, documents: DataFrame, idf: Idf, key: str, text: str) -> DataFrame:
    """node, root of the members that are similar to another. `members` has id, bands, first (a document with its words)."""
    met = meeting.pivoted(members.select(F.posexplode("bands").alias("band", "key"), "id"), ["band", "key"])
    wanted = common.stored(met.select("id").distinct().join(members, "id").select("id", "bands", "first.*"), "wanted")
    held = documents.select(*common.row_key(key, text), F.col(text).cast("string").alias("text"))
    texts = wanted.drop("bands").join(held, ["key_id", "key_text"]).select("id", "text").dropDuplicates(["id"])
    sets = common.stored(texts.mapInArrow(_sets(idf), "id long, grams binary, weights binary"), "sets")
    joined = common.stored(meeting.connect(met, ["band", "key"], sets, _ready, _same, _near_before, tags=wanted.select("id", F.col("bands").alias("tag"))), "joined")
    common.forget(met, wanted, sets)
    return joined


def _classed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """key_id, key_text of every row with those of its class's first document (class_id, class_text) and the rows of its class."""
    idf = idf_table(documents, text)
    rows = documents.select(*common.row_key(key, text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    seen = common.stored(rows.mapInArrow(_sketch(idf), "key_id long, key_text long, high long, low long, bands array<long>, wordy boolean"), "sketch")
    wordy = seen.where("wordy")
    members = common.stored(
        wordy.groupBy("high", "low").agg(F.min(F.struct("key_id", "key_text")).alias("first"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"))
        # Written once, so the numbers stand, and no two members share one as they might share a hash.
        .withColumn("id", F.monotonically_increasing_id()),
        "members",
    )
    joined = _joined(members.select("id", "bands", "first"), documents, idf, key, text)
    named = common.stored(members.select("high", "low", "id", "first", "copies").join(joined.withColumnRenamed("node", "id"), "id", "left"), "named")
    linked = named.where("root is not null")
    classes = common.weighed(linked.groupBy("root").agg(F.min("first").alias("kept"), F.sum("copies").alias("size"), F.count(F.lit(1)).alias("n")), "classes", "n")
    met = common.hot_join(linked, classes, ["root"], "n").select("high", "low", "copies", "kept", "size")
    alone = named.where("root is null").select("high", "low", "copies", F.col("first").alias("kept"), F.col("copies").alias("size"))
    found = common.weighed(met.unionByName(alone), "found", "copies")
    common.forget(members, joined, named, classes[0])
    out = ["key_id", "key_text", "class_id", "class_text", "class_size"]
    classed = common.hot_join(wordy.select("key_id", "key_text", "high", "low"), found, ["high", "low"], "copies").select(
        "key_id", "key_text", F.col("kept.key_id").alias("class_id"), F.col("kept.key_text").alias("class_text"), F.col("size").alias("class_size")
    )
    own = seen.where("not wordy").select("key_id", "key_text", F.col("key_id").alias("class_id"), F.col("key_text").alias("class_text"), F.lit(1).cast("long").alias("class_size"))
    return classed.select(*out).unionByName(own)


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id (the least key of the class), class_size (its rows) and kept (whether this is the document that stays)."""
    found = _classed(documents, key, text)
    least = F.lit(-(2**63))
    return found.select(
        F.nullif("key_id", least).alias(key),
        F.nullif("class_id", least).alias("class_id"),
        "class_size",
        ((F.col("key_id") == F.col("class_id")) & (F.col("key_text") == F.col("class_text"))).alias("kept"),
    )


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`documents` with one row for each class: the one with the least key."""
    kept = common.stored(_classed(documents, key, text).where("key_id = class_id and key_text = class_text").select("key_id", "key_text").distinct(), "kept")
    names = common.free(documents, "key_id", "key_text")
    keyed = documents.withColumns(dict(zip(names, common.row_key(key, text))))
    return keyed.join(kept.toDF(*names), names).dropDuplicates(names).select(*[F.col(f"`{c}`") for c in documents.columns])
