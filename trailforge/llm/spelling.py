"""Spelling variants: words one code point apart, found by partition-and-enumerate signatures of their letters.

A word's letters, with repetition, are a binary vector: dimension (c, k) is set if the word has
the letter c at least k times. One inserted or deleted code point changes one dimension and a
replaced one changes two, so near words lie within Hamming distance two and never at zero:
words with the same letters are one class, and only classes are compared (Arasu, Ganti and
Kaushik, VLDB 2006).

Dimensions are dealt into PARTS parts. Two classes of one length at distance two agree once
the right two parts are left out, two classes whose lengths differ by one once one part is. So
a class's signatures are its hashed letters without every two parts (for its own length), and
without every one part (as the longer or the shorter of two). Classes with a common signature
are candidates, and their letters are compared exactly. How many classes share a signature is
bounded by the letters that two parts can have, not by the corpus. The words of two classes
that differ by x and y then meet on what is left once an x is masked in the one and a y in the
other, and are verified by their edit distance, so that no class is paired with another word
by word.

Defined cases: a null text has no words; a null doc_id is the empty string where words are
drawn; repeated rows count as often as they occur; an empty table gives an empty result;
other columns are ignored. Forms lead to words at least twice as frequent, so a chain of them
ends after at most 63 steps.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm import common

#: Parts of the dimensions of a letter vector.
PARTS = 8
#: Least length and number of occurrences of a word, and one word in DRAWN loses a letter.
LENGTH, TIMES, DRAWN = 5, 3, 97
RUN = r"[A-Za-zÀ-ÿ]+"
#: Length up to which words meet on each masked letter; longer ones meet on a half.
MASKED = 64
_MASK = "\x01"


def occurrences(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word: a row for each run of letters, A-Z in lower case, one in DRAWN of them without one of its code points."""
    lower = F.translate(F.col(text).cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    # A line at a time, so that the runs of a very long text are not all held at once.
    lines = documents.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(F.split(lower, "\n")).alias("line"))
    runs = lines.select("key", F.explode(F.regexp_extract_all("line", F.lit(RUN), F.lit(0))).alias("run"))
    drawn = runs.withColumn("h", F.crc32(F.concat("key", F.lit(":"), F.col("run"))))
    at = F.pmod(F.col("h"), F.char_length("run").cast("long")).cast("int")
    return drawn.select(F.when(F.col("h") % DRAWN == 0, F.overlay("run", F.lit(""), at + 1, F.lit(1))).otherwise(F.col("run")).alias("word"))


def vocabulary(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    long_ = occurrences(documents, key, text).where(F.char_length("word") >= LENGTH)
    return long_.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= TIMES)


def letters(word: str = "word") -> Column:
    """The word's letters in order, as one string: the name of its class."""
    return F.array_join(F.array_sort(F.split(word, "")), "")


def dimensions(word: str = "letters") -> Column:
    """The dimensions that are set: a letter's code point times 2^40, plus k for its k-th occurrence."""
    times = lambda c: F.char_length(word) - F.char_length(F.replace(F.col(word), c))
    each = lambda c: F.transform(F.sequence(F.lit(1), times(c)), lambda k: F.ascii(c).cast("long") * F.lit(1 << 40) + k)
    return F.flatten(F.transform(F.array_distinct(F.split(word, "")), each))


def signatures(classes: DataFrame) -> DataFrame:
    """sig, role, class for each signature of `classes` (class, size, dims): role 0 meets its own kind, 1 the longer side meets 2 the shorter."""
    xor = lambda a, d: a.bitwiseXOR(F.xxhash64(d))
    part = lambda p: F.aggregate(F.filter("dims", lambda d: F.pmod(F.xxhash64(d), F.lit(PARTS)) == p), F.lit(0).cast("long"), xor)
    parted = classes.withColumn("parts", F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: part(p.cast("long"))))
    summed = parted.withColumn("all", F.aggregate("parts", F.lit(0).cast("long"), lambda a, s: a.bitwiseXOR(s)))
    left = F.transform("parts", lambda s: F.col("all").bitwiseXOR(s))
    two = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(PARTS - 1)), lambda i: F.transform(F.slice("left", 1, i), lambda s: s.bitwiseXOR(F.element_at("parts", i + 1)))))
    named = lambda role, size, sigs: F.transform(F.array_distinct(sigs), lambda s: F.struct(F.xxhash64(F.lit(role > 0), size, s).alias("sig"), F.lit(role).cast("byte").alias("role")))
    size = F.col("size")
    rows = summed.withColumn("left", left).select("class", F.explode(F.concat(named(0, size, two), named(1, size, F.col("left")), named(2, size + 1, F.col("left")))).alias("s"))
    return rows.select("s.sig", "s.role", "class")


def class_pairs(classes: DataFrame) -> DataFrame:
    """a, b, x, y, size: the classes of which one letter x of a is y in b, or (y null) is missing in b; `size` is a's length."""
    sigs = common.stored(signatures(classes), "signatures")
    one, other = sigs.toDF("sig", "role", "a"), sigs.toDF("sig", "other_role", "b")
    meet = "(role = 0 and other_role = 0 and a < b) or (role = 1 and other_role = 2)"
    pairs = one.join(other, "sig").where(meet).select("a", "b").distinct()
    dims = classes.select("class", "dims")
    held = pairs.join(dims.toDF("a", "one"), "a").join(dims.toDF("b", "other"), "b")
    gone, came = F.array_except("one", "other"), F.array_except("other", "one")
    letter = lambda d: F.char(F.shiftright(F.element_at(d, 1), 40))
    # A letter of the one length is replaced; of unlike lengths, a is the longer.
    near = held.select("a", "b", F.size("one").alias("size"), gone.alias("gone"), came.alias("came")).where("size(gone) = 1 and size(came) <= 1")
    kept = common.stored(near.select("a", "b", letter("gone").alias("x"), F.when(F.size("came") == 1, letter("came")).alias("y"), "size"), "class_pairs")
    common.forget(sigs)
    return kept


def _keys(word: str, letter: str, size: str, deleted: str) -> Column:
    """What is left of a word once its letter is masked (or deleted) at each place, or the word where no letter is; the halves of a long word."""
    at = F.filter(F.sequence(F.lit(1), F.char_length(word)), lambda p: F.substring(F.col(word), p, F.lit(1)) == F.col(letter))
    masked = F.transform(at, lambda p: F.overlay(F.col(word), F.when(F.col(deleted), F.lit("")).otherwise(F.lit(_MASK)), p, F.lit(1)))
    half = F.floor(F.col(size) / 2).cast("int")
    halves = F.array(F.concat(F.lit("<"), F.left(F.col(word), half)), F.concat(F.lit(">"), F.right(F.col(word), F.col(size) - half - 1)))
    return F.when(F.col(size) > MASKED, halves).when(F.col(letter).isNull(), F.array(F.col(word))).otherwise(F.array_distinct(masked))


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: both orders of each two of `words` (word, n) that are one code point apart."""
    classed = common.stored(words.withColumn("letters", letters()), "classed")
    classes = classed.groupBy("letters").agg(F.count(F.lit(1)).alias("members")).withColumn("class", F.monotonically_increasing_id())
    classes = common.stored(classes.select("class", "letters", F.char_length("letters").alias("size"), dimensions().alias("dims")), "classes")
    pairs = class_pairs(classes)
    members = common.stored(classed.join(classes.select("letters", "class"), "letters").select("class", "word", "n"), "members")
    shorter = F.col("y").isNull()
    sides = pairs.select(F.col("a").alias("class"), "a", "b", F.col("x").alias("letter"), "size", shorter.alias("deleted"), F.lit(True).alias("first"))
    sides = sides.union(pairs.select("b", "a", "b", "y", "size", shorter, F.lit(False)))
    keyed = sides.join(members, "class").select(F.col("first"), "word", "n", "a", "b", F.explode(_keys("word", "letter", "size", "deleted")).alias("left"))
    keyed = keyed.select("first", "word", "n", F.xxhash64("a", "b", "left").alias("key"))
    met = keyed.where("first").drop("first").join(keyed.where("not first").select("key", F.col("word").alias("other"), F.col("n").alias("other_n")), "key")
    close = met.where(F.levenshtein("word", "other", 1) == 1).drop("key")
    # Only the two halves of a long word can bring two words together twice.
    close = close.where(F.char_length("word") <= MASKED).union(close.where(F.char_length("word") > MASKED).distinct())
    close = common.stored(close.select("word", "n", "other", "other_n"), "close")
    common.forget(classed, classes, pairs, members)
    return close.union(close.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for each of `forms` (word, form): forms are followed to the last, twice as far in each step."""
    now, seen = common.measured(forms.select("word", F.col("form").alias("root")), "roots", n=F.count(F.lit(1)))
    open_ = seen["n"]
    while open_:
        further = now.toDF("root", "next")
        moved, seen = common.measured(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots", n=F.count_if("moved"))
        common.forget(now)
        now, open_ = moved.select("word", "root"), seen["n"]
    return now


def variants(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary.

    n_near counts the words near it; the form is the most frequent of them (ties: the first in
    code-point order) if it is at least twice as frequent, else null, as is form_n; the root is where forms lead.
    """
    words = common.stored(vocabulary(documents, key, text), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = words.join(near, "word", "left").withColumn("has", -F.col("best.order") >= 2 * F.col("n"))
    formed = formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("best.other")).alias("form"), F.when(F.col("has"), -F.col("best.order")).alias("form_n"))
    formed = common.stored(formed, "formed")
    common.forget(words)
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
