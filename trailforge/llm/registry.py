"""The queries of the corpus operators, by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from trailforge.functions.scratch import scratch_path
from trailforge.functions.ship import shipped
from trailforge.llm import bpe, chat, fuzzyhash, linededup, mixing, neardup, phrases, quality, rules, sharding, spelling, topk, warc

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for every page, written to archives in the shared folder, read back and resolved."""
    return warc.deduplicate(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


_OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM o
"""


def op2_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all embeddings for every hundredth vec_id."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)


_OP2_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by jump consistent hashing of doc_id."""
    return sharding.shards(_table(spark, sf_dir, "documents"), 8)


_JUMP_SQL = """{name}(doc_id, state, here, next) AS (
  SELECT DISTINCT doc_id, CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END, -1::BIGINT, 0::BIGINT FROM documents
  UNION ALL SELECT doc_id, s, next, floor((next + 1)::DOUBLE * (2147483648::DOUBLE / ((s // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT doc_id, next, (state * 2862933555777941757 + 1) % 18446744073709551616 AS s FROM {name} WHERE next < {n})),
{name}_last AS (SELECT doc_id, max(here)::INT AS shard FROM {name} GROUP BY doc_id)"""
_CRC_SQL = "crcs AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i))"
_OP3_SQL = f"""
WITH RECURSIVE {_JUMP_SQL.format(name="eight", n=8)},
{_JUMP_SQL.format(name="nine", n=9)},
{_CRC_SQL},
d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, strlen(text)::BIGINT + 1 AS size, list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT) AS bytes FROM d),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, crcs),
r AS (
  SELECT c.*, e.shard, n.shard AS grown_shard, ('0x' || substr(md5(coalesce(c.doc_id::VARCHAR, '') || '|' || size || '|' || text_crc32), 1, 3))::INT AS bucket
  FROM c JOIN eight_last e ON c.doc_id IS NOT DISTINCT FROM e.doc_id JOIN nine_last n ON c.doc_id IS NOT DISTINCT FROM n.doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM r
"""


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visit of every document in a mixture that repeats no source more than twice and leaves none out."""
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def _hash60(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT"


_OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS s, coalesce(doc_id::VARCHAR, '') AS i,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents),
b AS (SELECT *, ({_hash60("'mix'", "'block'", "i")} % {mixing.BLOCKS})::INT AS block FROM d),
n AS (SELECT s, sum(tokens)::BIGINT AS n FROM b GROUP BY s),
t AS (SELECT sum(n)::DOUBLE AS total, max(n)::DOUBLE AS most, min(n)::DOUBLE AS least FROM n WHERE n > 0),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL SELECT step + 1, CASE WHEN pow(least / most, (lo + hi) / 2 - 1) <= {mixing.REPEATS} THEN lo ELSE (lo + hi) / 2 END,
    CASE WHEN pow(least / most, (lo + hi) / 2 - 1) <= {mixing.REPEATS} THEN (lo + hi) / 2 ELSE hi END
  FROM bisect, t WHERE step < {mixing.STEPS}),
a AS (SELECT hi AS alpha FROM bisect WHERE step = {mixing.STEPS}),
z AS (SELECT sum(pow(n / total, alpha)) AS z FROM n, t, a WHERE n > 0),
g AS (SELECT ceil(most / (pow(most / total, alpha) / z)) AS goal FROM t, a, z),
w AS (SELECT s, n, CASE WHEN n > 0 THEN greatest(floor(pow(n / total, alpha) / z * goal + 0.5)::BIGINT, n) ELSE 0 END AS budget FROM n, t, a, z, g),
p AS (SELECT s, n, budget, CASE WHEN n > 0 THEN budget // n ELSE 1 END AS passes FROM w),
r AS (SELECT *, budget - passes * n AS rest FROM p),
o AS (
  SELECT s, block, sum(tokens) AS size, any_value(passes) AS passes, any_value(rest) AS rest, {_hash60("'mix'", "s", "any_value(passes)", "block")} AS edge
  FROM b JOIN r USING (s) WHERE rest > 0 GROUP BY s, block),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY s ORDER BY edge, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o),
e AS (SELECT s, block, passes, edge, rest - before AS free FROM c WHERE before <= rest AND rest < before + size),
u AS (
  SELECT s, ord, free, sum(tokens) OVER (PARTITION BY s ORDER BY ord RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM (SELECT b.s, tokens, free, {_hash60("'mix'", "'doc'", "passes", "i")} AS ord FROM b JOIN e USING (s, block))),
k AS (SELECT s, max(ord) AS cut FROM u WHERE used <= free GROUP BY s),
v AS (
  SELECT b.*, n, budget, r.passes, r.passes + CASE WHEN tokens > 0 AND edge IS NOT NULL AND ({_hash60("'mix'", "b.s", "r.passes", "b.block")} < edge
    OR ({_hash60("'mix'", "b.s", "r.passes", "b.block")} = edge AND {_hash60("'mix'", "'doc'", "r.passes", "i")} <= coalesce(cut, -1))) THEN 1 ELSE 0 END AS visits
  FROM b JOIN r USING (s) LEFT JOIN (SELECT s, edge FROM e) e USING (s) LEFT JOIN k USING (s)),
x AS (SELECT *, unnest(range(visits)) AS epoch FROM v)
SELECT doc_id, source, tokens, epoch, block, {_hash60("'mix'", "'doc'", "epoch", "i")} AS doc_order,
  (epoch + {_hash60("'mix'", "s", "epoch", "block")} / {mixing._HASH_RANGE:.1f}::DOUBLE) / CASE WHEN n > 0 THEN budget / n ELSE 1.0::DOUBLE END AS progress
FROM x
"""


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stay elsewhere, and how many it lost."""
    return linededup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"), radius=None)


def op6_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a classifier learned from the labels that are not held out."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document with the verdict of the standard policy."""
    entries = rules.ledger(_table(spark, sf_dir, "documents"))
    return rules.apply_policy(entries, rules.STANDARD).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~rules.kept(rules.BASE)).alias("base_failed"), "kept", "fail_bits", "policy"
    )


_OP7_BITS = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM grams),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
b AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 25 * n_words)::INT
    + 64 * (100 * n_symbols > n_words)::INT)::BIGINT AS fail_bits FROM m)
"""
_OP7_SQL = f"""{_OP7_BITS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 63) = 0 AS kept,
  fail_bits, 'standard-1' AS policy
FROM b
"""


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each policy and each of its rules: documents, kept, kept without the rule, and rejected by the rule alone."""
    return rules.ablations(rules.ledger(_table(spark, sf_dir, "documents")))


_CASES = ", ".join(f"('{p.version}', '{r.name}', {rules.mask(p)}, {1 << r.bit})" for p in (rules.BASE, rules.STANDARD, rules.STRICT) for r in rules.RULES if r.name in p.rules)
_ABLATIONS_SQL = f"""{_OP7_BITS}
SELECT policy, rule, count(*)::BIGINT AS documents, count(*) FILTER (fail_bits & mask = 0)::BIGINT AS kept,
  count(*) FILTER (fail_bits & mask & ~bit = 0)::BIGINT AS kept_without, count(*) FILTER (fail_bits & mask = bit)::BIGINT AS only_by_rule
FROM b, (VALUES {_CASES}) AS c(policy, rule, mask, bit) GROUP BY policy, rule
"""


def op8_weighted_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document, its size, and whether the document is the one that stays."""
    return neardup.classes(_table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts look like another template's control strings, formatted and read back."""
    talks = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        f"SELECT -7L AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{CONTROL_TEXT}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    return chat.digests(chat.format_conversations(talks.unionByName(probe)))


_OP9_SQL = f"""
WITH talks AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '{CONTROL_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
placed AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens,
    length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) AS escaped, length(replace(replace(role, '&', '&amp;'), '<|', '&lt;|')) AS named
  FROM talks)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + CASE WHEN opens THEN {len(chat.TURN) + len(chat.SAY) + len(chat.END)} + named ELSE {len(chat.NEXT)} END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.digests(_table(spark, sf_dir, "documents"))


def op11_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the least doc_id that its links lead to."""
    return fuzzyhash.components(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with the number of words near it, its form and its root."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_OP12_SQL = f"""
WITH RECURSIVE {_CRC_SQL},
o AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{spelling.RUN}')) AS run FROM documents),
p AS (SELECT run, count(*) AS c, hex(encode(d || ':' || run)) AS h FROM o GROUP BY d, run),
b AS (SELECT run, c, list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT) AS bytes FROM p),
h AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS h FROM b, crcs),
w AS (SELECT CASE WHEN h % {spelling.DRAWN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM w WHERE length(word) >= {spelling.LENGTH} GROUP BY word HAVING sum(c) >= {spelling.TIMES}),
m AS (SELECT word, i, substr(word, 1, i - 1) || chr(1) || substr(word, i + 1) AS masked, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (
  SELECT a.word, b.word AS other FROM m a JOIN m b ON a.masked = b.masked AND a.word <> b.word
  UNION SELECT m.word, cut FROM m JOIN v ON m.cut = v.word UNION SELECT cut, m.word FROM m JOIN v ON m.cut = v.word),
r AS (
  SELECT e.word, other, v.n AS other_n, count(*) OVER (PARTITION BY e.word) AS n_near, row_number() OVER (PARTITION BY e.word ORDER BY v.n DESC, other) AS place
  FROM e JOIN v ON v.word = other),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM v LEFT JOIN r ON r.word = v.word AND place = 1),
s AS (SELECT word, word AS here FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.here WHERE f.form IS NOT NULL),
k AS (SELECT s.word, here AS root FROM s JOIN f ON f.word = s.here WHERE f.form IS NULL)
SELECT f.*, root FROM f JOIN k USING (word)
"""


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


_OP13_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, doc, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k::INT AS k, ws[i:i + k - 1] AS p FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS v(k))),
f AS (SELECT lang, k, p, count(*) AS f FROM g GROUP BY lang, k, p HAVING count(*) >= {phrases.LEAST}),
n AS (SELECT lang, count(*)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, p, f AS a FROM f WHERE k > 1),
s AS (SELECT lang, p[1:k - 1] AS p, a FROM c WHERE k > 2 UNION ALL SELECT lang, p[2:k], a FROM c WHERE k > 2),
m AS (SELECT lang, p, max(a) AS most FROM s GROUP BY lang, p),
b AS (SELECT c.* FROM c LEFT JOIN m USING (lang, p) WHERE most IS NULL OR 100::HUGEINT * most < {phrases.SHARE}::HUGEINT * a),
t AS (SELECT lang, k, p, a, unnest(range(1, k)) AS cut FROM b),
u AS (
  SELECT t.lang, t.p, t.a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM t JOIN f x ON x.lang = t.lang AND x.p = t.p[1:cut] JOIN f y ON y.lang = t.lang AND y.p = t.p[cut + 1:t.k]),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS low FROM u),
o AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM z WHERE low = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= {phrases.TOP}
"""


QUERIES = {
    f.__name__: shipped(f)
    for f in (
        op1_warc_revisits,
        op2_impact_topk,
        op3_jump_sharding,
        op4_temperature_mix,
        op5_fuzzy_lines,
        op6_attention_quality,
        op7_rule_ledger,
        rule_ablations,
        op8_weighted_neardup,
        op9_chat_format,
        op10_bpe,
        op11_golay_simhash,
        op12_spelling_variants,
        op13_phrases,
    )
}
ORACLES = {"op1_warc_revisits": _OP1_SQL, "op2_impact_topk": _OP2_SQL, "op3_jump_sharding": _OP3_SQL, "op4_temperature_mix": _OP4_SQL, "op7_rule_ledger": _OP7_SQL, "rule_ablations": _ABLATIONS_SQL, "op9_chat_format": _OP9_SQL, "op12_spelling_variants": _OP12_SQL, "op13_phrases": _OP13_SQL}
