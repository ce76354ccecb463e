"""BPE against the tokenizers library: ids and decoded texts of whole texts."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stratalake.llm import bpe, common

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(PATH)


def own_ids(text):
    return list(memoryview(bpe.vocabulary(PATH).encode(text)).cast("i"))


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


TEXTS = [
    "", " ", "  ", "a", " a", "a  b", "a \n b", "a\n\n  b ", "it's John'll 'tis ' s", "x  y　 z", "don't   x",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|endoftext", "é è 漢字 😀 Ᲊ", "0123 4567 ٣",
    "a" * 3000, "ab" * 1500, "▁\x00\x1c \x1d", "aaa aaaa aaaaa aaaaaa", " " * 50 + "x", "\t\tx \ty", "tests/llm/test_bpe.py",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_decoded_equal_library(text):
    ids = library_ids(text)
    assert own_ids(text) == ids
    assert bpe.vocabulary(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abentirsh  \n'.,19éü漢"), max_size=60) | st.text(max_size=40))
def test_any_text(text):
    assert own_ids(text) == library_ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids_decode_alike(ids):
    assert bpe.vocabulary(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abentirsh  \n'.,19éü漢"), max_size=40) | st.text(max_size=30) | st.none(), max_size=8))
def test_many_texts_at_once(texts):
    got = bpe.vocabulary(PATH).encode_all(texts)
    assert [list(memoryview(g).cast("i")) for g in got] == [library_ids(t or "") for t in texts]


def test_pieces_side_by_side_equal_one_by_one(monkeypatch):
    monkeypatch.setattr(bpe, "BYTES_TOGETHER", 1024)
    known = bpe.vocabulary(PATH)
    pieces = [(" " + "thereonisterlaéü"[k % 11 : k % 11 + k % 7] * (k % 9 + 1)).encode() for k in range(300)]
    got = [list(memoryview(g).cast("i")) for g in known.tokens_of_pieces(pieces)]
    assert got == [known.piece_tokens(p) for p in pieces]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(common, "REMEMBERED", 10)
    known = common.Remembering(len)
    assert [known[str(k)] for k in range(100)] == [len(str(k)) for k in range(100)]
    assert len(known) <= 10 and len(known.older) <= 10
    assert known["x" * 100] == 100 and "x" * 100 not in known


def test_query_equals_library(spark):
    from stratalake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library_ids(d.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "a b", None)], "doc_id int, text string, ids string")
    got = bpe.with_decoded(bpe.with_tokens(docs, PATH), PATH).collect()
    assert [(list(r.ids), r.decoded) for r in got] == [([], ""), ([], ""), (library_ids("a b"), "a b")]
    assert bpe.with_tokens(docs.limit(0), PATH).count() == 0
    both = bpe.with_round_trip(docs.selectExpr("doc_id", "text", "ids", "'x' AS decoded"), PATH)
    assert [(list(r.ids), r.decoded) for r in both.collect()] == [(list(r.ids), r.decoded) for r in got]
    assert both.columns == ["doc_id", "text", "ids", "decoded"] and bpe.with_round_trip(docs.limit(0), PATH).count() == 0


def test_one_worker_encodes_and_decodes(spark):
    both = bpe.with_round_trip(spark.createDataFrame([(1, "a")], "doc_id int, text string"), PATH)
    plan = both.select("ids", "decoded")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
