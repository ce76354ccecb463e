"""Alignment against both libraries on whole texts, with ends from decoded bytes alone."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from stratalake.llm import token_alignment as ta

SF_DIR = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def whole(text):
    """(tokens of each, groups, links) of a whole text, None without tokens."""
    known = ta.aligner(*PATHS)
    raw = (" " + (text or "")).encode()
    a, b = known.first.encode(raw.decode(), add_special_tokens=False).ids, known.second.encode(text or "")
    a_bytes, b_bytes = [known.first_bytes[i] for i in a], [known.second_bytes[i] for i in b]
    if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return None
    a_ends, b_ends = np.cumsum(list(map(len, a_bytes))).tolist(), np.cumsum(list(map(len, b_bytes))).tolist()
    groups, links, low = [], [], 0
    for end in sorted(set(a_ends) & set(b_ends)):
        ga = [i for i, e in zip(a, a_ends) if low < e <= end]
        gb = [i for i, e in zip(b, b_ends) if low < e <= end]
        groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        links.append((ga[-1], gb[-1]))
        low = end
    return len(a), len(b), ";".join(groups), links


def by_parts(texts):
    out = []
    for parts in ta.Aligner(*PATHS).align_texts(texts):
        if parts is None:
            out.append(None)
            continue
        links = np.frombuffer(b"".join(p[3] for p in parts), np.int64)
        pairs = [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in links]
        out.append((sum(p[0] for p in parts), sum(p[1] for p in parts), ";".join(p[2] for p in parts), pairs))
    return out


def plain(rows):
    known = [whole(t) for _, t in rows]
    count = Counter(link for k in known if k for link in k[3])
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for (i, _), k in zip(rows, known):
        if k is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n = len(k[3])
        best = sum(count[link] == highest[link[1]] for link in k[3])
        out.append((i, k[0], k[1], n, n, best, sum(count[link] for link in k[3]), hashlib.sha256(k[2].encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  ", "a \n b", "a\tb  c\n\n d", "<|endoftext|> <s></s> <unk> <0x41>", "▁", "a ▁ b",
    "漢字 é ﬁ ½ 😀😀", "é x", "\x00 \x01", "　x  y​ z", "x" * 500, "ab" * 400, "hello world, it's 1234567",
]


@pytest.mark.parametrize("text", TEXTS)
def test_parts_equal_whole_text(text):
    assert by_parts([text]) == [whole(text)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abenth  \n'.,19éü漢\t　▁😀<|>\x00\x85"), max_size=30) | st.text(max_size=15) | st.none(), max_size=6))
def test_any_texts_together(texts):
    assert by_parts(texts) == [whole(t) for t in texts]


def test_tokenizers_that_cannot_be_cut_read_whole_texts():
    known = ta.Aligner(*PATHS)
    known.cuts = False
    texts = [*TEXTS, "one two  three\n four"]
    for text, parts in zip(texts, known.align_texts(texts)):
        want = whole(text)
        assert (parts and (parts[0][0], parts[0][1], parts[0][2])) == (want and want[:3])


def test_query_equals_plain_version(spark):
    from stratalake.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op13_token_alignment"](spark, SF_DIR).select(*COLUMNS, "groups_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    texts = [None, "", *TEXTS, "the cat", "the cat", "word " * 20_000, "é" * 20_000]
    rows = [(None if k % 5 == 0 else k % 4, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "b", 1, "x") for i, t in rows], "doc_id int, text string, block string, n_a int, links string")
    got = ta.token_alignment(df.repartition(3), *PATHS, digest=True)
    assert got.columns[:3] == ["doc_id", "block", "links"] and got.columns.count("n_a") == 1
    assert sorted((tuple(r) for r in got.select(*COLUMNS, "groups").collect()), key=str) == plain(rows)


def test_groups_as_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id int, text string")
    assert ta.token_alignment(df, *PATHS).first().groups == whole("hello world")[2]
    assert ta.token_alignment(df.limit(0), *PATHS).count() == 0
