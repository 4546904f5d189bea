import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from airdata.llm import queries as Q
from airdata.llm.tokens import vocabulary
from tests.compare import compare_query, duck


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, name):
    ok, msg = compare_query(spark, sf_dir, Q.queries()[name], Q.oracle_sql()[name], duck(sf_dir))
    assert ok, msg


def test_registered():
    assert set(Q.queries()) <= set(E.queries()) and set(Q.oracle_sql()) <= set(E.oracle_sql())
    assert {n.split("_")[0] for n in Q.queries()} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


def test_token_files_digests(spark, sf_dir):
    whole, start = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), 0
    got = Q.op2_token_files(spark, sf_dir).orderBy("doc_id").collect()
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{sf_dir}/documents.parquet') order by doc_id").fetchall()
    for g, (i, t) in zip(got, docs, strict=True):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_mixing_totals(spark, sf_dir):
    got = Q.op7_mixing(spark, sf_dir)
    assert got.filter("taken > 3 * size or taken % nullif(size, 0) <> 0").count() == 0
    for r in got.groupBy("source_size", "target").agg({"taken": "sum", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r.target) <= max(0.05 * r.target, r["max(size)"])
