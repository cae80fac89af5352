"""Collocations: phrases of two to four words, counted with an FM-index for each shard and scored by their weakest cut.

Words are counted per language. Documents are dealt into shards of about WORDS words of one
language; the words that occur LEAST times get a number, all others break a shard's sequence, as
do the ends of pieces, since no phrase that counts can have them. A shard's sequence of
numbers gets a bidirectional FM-index: the Burrows-Wheeler transforms of the sequence and
of its reverse, sorted by as many words as a phrase can have, which is all that intervals of
so many words need. One step extends all intervals at once: in the order of the transform's
symbols, the rows of an interval that have one symbol lie side by side, begin where that word's
interval begins, and their number is how often the extension occurs (`Index.extend`).

First every word's interval is extended to the left and the counts of word pairs are summed
over shards. Then each shard learns which of its pairs are frequent, extends those to the
right and the three words to the left, as long as every pair inside is frequent, and those
counts are summed. A phrase's extensions on either side are longer phrases in the same sums.

Counts of a shard are one row for each phrase, so a phrase has at most as many rows as there are
shards. Products are decimals, so that no score depends on 64 bits.

Defined cases: a null text has no words; a null language is `und`; repeated rows count as
often as they occur; texts are taken whole, in parts that end
where pieces do, so a shard can be as large as its longest piece; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm import common, kernel
from trailforge.operators.events import dense_positions

#: Least occurrences of a phrase, most words of it, per cent of its occurrences that a longer one may take, phrases of a language.
LEAST, LONGEST, SHARE, TOP = 30, 4, 80, 2000
#: Words of a shard, and buckets in which a language's phrases are ranked first.
WORDS, BUCKETS = 1 << 19, 64
#: Bytes of texts that are read at once.
RUN = 2 << 20

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True


def _cut(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts as they are, but one of more than RUN bytes in parts that end where a piece does."""
    at = 0
    while len(offsets) == 2 and len(data) - at > RUN:
        end = at + RUN
        while end < len(data) and not len(found := np.flatnonzero(_BREAK[data[end : end + RUN]])):
            end += RUN
        end = end + int(found[0]) + 1 if end < len(data) else len(data)
        yield data[at:end], np.array([0, end - at])
        at = end
    if at < len(data):
        yield data[at:], offsets if not at else np.array([0, len(data) - at])


def words_of(column: pa.Array) -> Iterator[tuple[pa.DictionaryArray, np.ndarray]]:
    """The words of texts, A-Z in lower case, and which of them begin a piece."""
    for data, offsets in (part for _, _, *run in kernel.texts(column, RUN) for part in _cut(*run)):
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        begin, end, first = kernel.words(data, offsets, _APART)
        if not len(begin):
            continue
        breaks = np.cumsum(_BREAK[data], dtype=np.int32)[begin]
        begins = np.append(True, breaks[1:] != breaks[:-1])
        begins[first[:-1][first[:-1] < len(begin)]] = True
        spans = np.append(0, np.cumsum(end - begin)).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(spans), pa.py_buffer(data[~_APART[data]])])
        yield found.dictionary_encode(), begins


class _Shard:
    """The words of one language that a task has read and not yet written."""

    def __init__(self) -> None:
        self.parts, self.begins, self.size = [], [], 0

    def add(self, words: pa.DictionaryArray, begins: np.ndarray) -> None:
        self.parts.append(words)
        self.begins.append(begins)
        self.size += len(begins)

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        words = pa.chunked_array(self.parts).unify_dictionaries()
        begins = np.concatenate(self.begins)
        tokens = np.full(self.size + int(begins.sum()), -1, np.int32)
        numbers = np.concatenate([c.indices.to_numpy() for c in words.chunks])
        tokens[np.arange(self.size) + np.cumsum(begins)] = numbers
        names = words.chunk(0).dictionary
        counts = np.bincount(numbers, minlength=len(names))
        columns = [[shard], [lang], [self.size], [tokens.tobytes()]]
        lists = [pa.array([names], pa.list_(pa.large_string())), pa.array([counts], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()), *lists], names=["shard", "lang", "size", "tokens", "words", "counts"])


def _shards(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Shard] = {}
        made = TaskContext.get().partitionId() << 33

        def write(lang: str) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return held.pop(lang).row(made, lang)

        for batch in batches:
            langs = pc.fill_null(batch.column(0).cast(pa.string()), "und")
            for lang in pc.unique(langs).to_pylist():
                for words, begins in words_of(batch.column(1).filter(pc.equal(langs, lang))):
                    held.setdefault(lang, _Shard()).add(words, begins)
                    if held[lang].size >= size:
                        yield write(lang)
            while sum(s.size for s in held.values()) > 2 * size:
                yield write(max(held, key=lambda lang: held[lang].size))
        for lang in list(held):
            yield write(lang)
        kernel.release()

    return run


def shards(documents: DataFrame, lang: str = "lang", text: str = "text", size: int = WORDS) -> DataFrame:
    """shard, lang, size, tokens (32-bit numbers into words, -1 before each piece), words, counts."""
    asked = documents.select(F.col(lang).cast("string"), F.col(text).cast("string"))
    return asked.mapInArrow(_shards(size), "shard long, lang string, size long, tokens binary, words array<string>, counts array<long>")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, tokens: with the numbers of the frequent words, and one 0 before and after each run of them."""
    for batch in batches:
        for i in range(len(batch)):
            tokens = np.frombuffer(batch.column(1)[i].as_py(), np.int32)
            place, number = (pc.list_flatten(batch.column(k).slice(i, 1)).to_numpy() for k in (2, 3))
            known = np.zeros(max(int(tokens.max(initial=0)) + 2, 1), np.int32)
            known[place] = number
            # -1 reads the last entry, which no word has.
            tokens = np.concatenate([[0], known[tokens], [0]]).astype(np.int32)
            kept = np.append(True, (tokens[1:] != 0) | (tokens[:-1] != 0))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([tokens[kept].tobytes()], pa.binary())], names=["shard", "tokens"])
        kernel.release()


class Index:
    """A bidirectional FM-index of a sequence that begins and ends with 0, for phrases of up to `depth` words.

    Side 0 is of the sequence, whose transform has the words to the left; side 1 is of its reverse, and has those to the right.
    """

    def __init__(self, tokens: np.ndarray, depth: int, sides: int = 2):
        self.sides = [self._transform(t, depth) for t in (tokens, tokens[::-1])[:sides]]

    @staticmethod
    def _transform(tokens: np.ndarray, depth: int) -> np.ndarray:
        """The transform's symbols in order, each with its row: symbol * 2^32 + row."""
        n, rank, width = len(tokens), tokens.astype(np.int64), 1
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: max(n - width, 0)] = rank[width:]
            key = rank << 32 | ahead
            order = np.argsort(key)
            width *= 2
            if width >= depth:
                break
            sorted_ = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, sorted_[1:] != sorted_[:-1]))
        return np.sort(tokens[order - 1].astype(np.int64) << 32 | np.arange(n))

    def extend(self, side: int, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """parent, word, begin, size of all extensions by one word of disjoint intervals, to the left on side 0 and to the right on side 1."""
        sorted_ = self.sides[side]
        row = np.repeat(begin[:, side] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        of = np.full(len(sorted_), -1, np.int64)
        of[row] = np.repeat(np.arange(len(size)), size)
        parent, word = of[sorted_ & 0xFFFFFFFF], sorted_ >> 32
        opens = np.flatnonzero(np.append(True, (parent[1:] != parent[:-1]) | (word[1:] != word[:-1]))) if len(sorted_) else np.zeros(0, np.int64)
        many = np.diff(np.append(opens, len(sorted_)))
        keep = parent[opens] >= 0
        opens, many = opens[keep], many[keep]
        parent, word = parent[opens], word[opens]
        # On the other side, an extension begins after those of its parent by lesser words.
        by_parent = np.argsort(parent, kind="stable")
        before = np.cumsum(many[by_parent]) - many[by_parent]
        start = np.searchsorted(parent[by_parent], parent[by_parent])
        other = np.empty(len(opens), np.int64)
        other[by_parent] = before - (before[start] if len(start) else 0) + begin[parent[by_parent], 1 - side]
        both = np.stack([opens, other] if side == 0 else [other, opens], 1)
        real = word > 0
        return parent[real], word[real], both[real], many[real]


def intervals(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins (a column a side) and sizes of the intervals of the words from 1, the same on both sides."""
    size = np.bincount(tokens)
    begin = np.cumsum(size) - size
    return np.stack([begin[1:], begin[1:]], 1), size[1:]


def _local(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sequence in numbers from 0 without gaps, and what each stands for; 0 stands for itself."""
    names, tokens = np.unique(np.frombuffer(raw, np.int32), return_inverse=True)
    return tokens, names.astype(np.int64)


def _pair_counts(shard: int, raw: bytes) -> pa.RecordBatch:
    tokens, names = _local(raw)
    second, first, _, size = Index(tokens, 2, sides=1).extend(0, *intervals(tokens))
    pair = names[first] << 32 | names[second + 1]
    return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.full(len(pair), shard)), pa.array(size)], names=["ab", "shard", "n"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield _pair_counts(shard, raw.as_py())
        kernel.release()


def _longer_counts(raw: bytes, frequent: np.ndarray) -> list[pa.RecordBatch]:
    tokens, names = _local(raw)
    frequent = np.sort(frequent)

    def known(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = names[a] << 32 | names[b]
        return frequent[np.minimum(np.searchsorted(frequent, pair), len(frequent) - 1)] == pair

    index = Index(tokens, LONGEST)
    b, a, begin, size = index.extend(0, *intervals(tokens))
    b += 1
    good = known(a, b)
    a, b, begin, size = a[good], b[good], begin[good], size[good]
    parent, c, begin, size = index.extend(1, begin, size)
    good = known(b[parent], c)
    parent, c, begin, size = parent[good], c[good], begin[good], size[good]
    a, b = a[parent], b[parent]
    three = [names[a] << 32 | names[b], names[c], size]
    parent, z, _, size = index.extend(0, begin, size)
    good = known(z, a[parent])
    parent, z, size = parent[good], z[good], size[good]
    four = [names[z] << 32 | names[a[parent]], names[b[parent]] << 32 | names[c[parent]], size]
    return [pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["ab", "cd", "n"]) for columns in (three, four)]


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            yield from _longer_counts(batch.column(1)[i].as_py(), pc.list_flatten(batch.column(2).slice(i, 1)).to_numpy())
        kernel.release()


def _pack(words: list[Column]) -> list[Column]:
    """The two numbers of a phrase of up to four words."""
    none = F.lit(0).cast("long")
    two = lambda w: none if not w else w[0] if len(w) == 1 else F.shiftleft(w[0], 32).bitwiseOR(w[1])
    return [two(words[:2]), two(words[2:])]


def _words(size: int) -> list[Column]:
    low = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    return [F.shiftright("ab", 32), low("ab"), F.shiftright("cd", 32) if size == 4 else F.col("cd"), low("cd")][:size]


def _by_size(make) -> Column:
    size = F.col("size")
    return F.when(size == 2, make(_words(2))).when(size == 3, make(_words(3))).otherwise(make(_words(4)))


def _struct(names: str, *columns: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in zip(names.split(), columns)])


def counted(documents: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, size: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words that occur `least` times (id, lang, word, f), all such phrases (ab, cd, size, a), and the words of each language (lang, n)."""
    made = common.stored(shards(documents, lang, text, size), "shards")
    seen = made.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select("shard", "lang", "place", "w.words", "w.counts")
    frequent = seen.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).where(F.col("f") >= least)
    frequent = common.stored(frequent.withColumn("order", F.monotonically_increasing_id()), "frequent")
    # Numbers are 32 bits, two of them one long: more frequent words than that are an error, not a wrong count.
    words = common.stored(dense_positions(frequent, "order", name="id").select(F.col("id").cast("int").cast("long").alias("id"), "lang", "word", "f"), "words")
    known = seen.join(words.withColumnRenamed("word", "words"), ["lang", "words"]).groupBy("shard").agg(F.collect_list(F.struct("place", "id")).alias("known"))
    joined = made.select("shard", "tokens").join(known, "shard").select("shard", "tokens", "known.place", "known.id")
    encoded = common.stored(joined.mapInArrow(_numbered, "shard long, tokens binary"), "encoded")
    totals = common.stored(made.groupBy("lang").agg(F.sum("size").alias("n")), "totals")
    common.forget(made, frequent)

    pairs = encoded.mapInArrow(_pairs, "ab long, shard long, n long")
    pairs = pairs.withColumn("a", F.sum("n").over(Window.partitionBy("ab"))).where(F.col("a") >= least)
    pairs = common.stored(pairs.select("ab", "shard", "a"), "pairs")
    found = encoded.join(pairs.groupBy("shard").agg(F.collect_list("ab").alias("pairs")), "shard").select("shard", "tokens", "pairs")
    longer = found.mapInArrow(_longer, "ab long, cd long, n long").groupBy("ab", "cd").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    two = pairs.select("ab", F.lit(0).cast("long").alias("cd"), F.lit(2).alias("size"), "a").distinct()
    more = longer.select("ab", "cd", F.when(F.shiftright("cd", 32) == 0, 3).otherwise(4).alias("size"), "a")
    phrases = common.stored(two.union(more), "phrases")
    common.forget(encoded, pairs)
    return words, phrases, totals


def collocations(documents: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, share: int = SHARE, top: int = TOP, size: int = WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language.

    a counts the phrase, l and r its parts at the lowest-scoring cut, n the language's words; the score is
    floor(2000000 * a / (l + r)). A phrase goes if a longer one that has it takes `share` per cent of its occurrences.
    """
    words, phrases, totals = counted(documents, lang, text, least, size)
    exact = lambda c: F.col(c).cast("decimal(20,0)")

    inside = phrases.where("size > 2").select(F.explode(_by_size(lambda w: F.array(_struct("ab cd", *_pack(w[:-1])), _struct("ab cd", *_pack(w[1:]))))).alias("s"), "a")
    taken = inside.groupBy("s.ab", "s.cd").agg(F.max("a").alias("most"))
    kept = phrases.join(taken, ["ab", "cd"], "left").where(F.col("most").isNull() | (exact("most") * 100 < exact("a") * share)).drop("most")

    parts = words.select(F.col("id").alias("ab"), F.lit(0).cast("long").alias("cd"), "f").union(phrases.select("ab", "cd", "a"))
    cuts = _by_size(lambda w: F.array(*[_struct("k lab lcd rab rcd", F.lit(k), *_pack(w[:k]), *_pack(w[k:])) for k in range(1, len(w))]))
    cut = kept.select("ab", "cd", "size", "a", F.explode(cuts).alias("c")).select("ab", "cd", "size", "a", "c.*")
    cut = cut.join(parts.toDF("lab", "lcd", "l"), ["lab", "lcd"]).join(parts.toDF("rab", "rcd", "r"), ["rab", "rcd"])
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cut.withColumn("score", score).groupBy("ab", "cd", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low")).select("ab", "cd", "size", "a", "low.*")

    ids = scored.withColumn("ids", _by_size(lambda w: F.array(*w))).withColumn("id", F.element_at("ids", 1))
    ranked = ids.join(words.select("id", "lang"), "id").withColumn("bucket", F.pmod(F.xxhash64("ab", "cd"), F.lit(BUCKETS)))
    best = [F.desc("score"), F.desc("a")]
    # Ties of the last place stay until phrases decide; a language is ranked in buckets before it is ranked whole.
    for by in (["lang", "bucket"], ["lang"]):
        ranked = ranked.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*best))).where(F.col("place") <= top)
    ranked = common.stored(ranked.drop("place", "id"), "ranked")
    spelled = ranked.select("ab", "cd", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("ab", "cd").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    told = ranked.join(spelled, ["ab", "cd"]).join(totals, "lang")
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase")).cast("long")).where(F.col("rank") <= top)
    return told.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long"))
