"""Every corpus query with SQL against DuckDB over the smallest tables, and encoding against the library over a whole table."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.test_catalog import SF, TABLES, db, pytestmark, rows  # noqa: F401
from trailforge.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, db, name):  # noqa: F811
    df = registry.QUERIES[name](spark, SF)
    result = db.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())


def test_every_document_is_encoded_as_the_library_does(spark):
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sf = SF.replace("0.001", "0.01")
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = registry.QUERIES["op10_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = theirs.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        back = theirs.decode(ids, skip_special_tokens=False)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
