import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from airdata.llm import token_files as F
from airdata.llm import tokens as T

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", "  a  b\n\n c ", "\n x", "a  b　c d", "'s I'll don't  \t x\r\ny", "tab\tx y\n", "ﬁ Ⅷ ½ 中文 字  x", "<|endoftext|> a<|startoftext|>b",
       "\x1c a\x1fb\x85c \x0bq", "é x ́y", "Σας ΑΣ", " lead", "trail ", "a  \n  b", "\n\n\n", " \n a"]


@pytest.mark.parametrize("name", NAMES)
def test_equals_whole_text_encoding(name, sf_dir):
    import duckdb

    texts = ODD + [r[0] or "" for r in duckdb.sql(f"select text from read_parquet('{sf_dir}/documents.parquet')").fetchall()]
    whole = Tokenizer.from_file(T.vocabulary(name))
    for t in texts:
        assert np.frombuffer(T.encoder(T.vocabulary(name)).encode(t.encode()), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t[:80]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\r\x0b\x0c  　\x85\x1cab'stE.é—1中"), max_size=30))
def test_equals_on_odd_texts(text):
    for name in NAMES:
        enc = T.encoder(T.vocabulary(name))
        assert np.frombuffer(enc.encode(text.encode()), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_files_round_trip(spark, odd_docs, no_docs):
    path = T.vocabulary("word_bpe_49k.json")
    shards = F.write_token_files(odd_docs, path, 2, length=64, shard_chars=20_000)
    assert shards.count() > 1
    got = F.read_token_files(spark, shards).orderBy("start").collect()
    rows = odd_docs.select("doc_id", "text").collect()
    whole, start = Tokenizer.from_file(path), 0
    want = {}
    for r in rows:
        want.setdefault(r.doc_id, []).append([*whole.encode(r.text or "", add_special_tokens=False).ids, 2])
    assert [g.doc_id for g in got] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    for g in got:
        assert g.start == start and list(g.ids) in want[g.doc_id] and g.n_tokens == len(g.ids)
        assert g.ids_crc32 == zlib.crc32(np.array(g.ids, "<u4").tobytes())
        want[g.doc_id].remove(list(g.ids))
        start += g.n_tokens
    assert F.read_token_files(spark, F.write_token_files(no_docs, path, 2)).count() == 0


def test_random_access_is_a_view(spark, words, tmp_dir):
    w = F.ShardWriter(f"file://{tmp_dir}", np.dtype("<u2"), length=16, sequences=4)
    ids = np.arange(1, 1001, dtype="<u4")
    w.add(7, ids[:333])
    w.add(8, ids[333:])
    made = w.close()
    shard = F.Shard(made["path"])
    before = pa.total_allocated_bytes()
    x, mask = shard.sequence(20)
    assert x.tolist() == ids[320:336].tolist() and mask.all()
    assert pa.total_allocated_bytes() - before < 4096
    x, mask = shard.sequence(62)
    assert mask.sum() == 1000 - 62 * 16 and x[mask].tolist() == ids[62 * 16:].tolist()
    assert shard.span(300, 400).tolist() == ids[300:700].tolist() and len(shard.span(5, 0)) == 0
