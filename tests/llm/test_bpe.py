"""Merge replay against the tiktoken library, and exact round trips."""

import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = B.load_ranks(PATH)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MERGES = B.Merges(RANKS)
FIND = regex.compile(P.PATTERN).findall


def encode(texts, merges=MERGES):
    import numpy as np

    flat, sizes = B.encode_slice(texts, FIND, lambda ws: merges.encode_words([w.encode() for w in ws]))
    return [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]


TEXTS = ["", "a", " ", "\n", "aaaaaaaa" * 60, "it's we'll  two   three\n\n\tx", "  lead and trail  ", "é😀日本 ١٣ ²#&|\r\n\x0b", "word " * 4000, "x" * 20000,
         "one\ntwo three.\nfour", "tab\tand nbsp a", "don't’t", "a\x1cb \x85 c"]


def test_equals_the_library():
    rnd = random.Random(1)
    al = "aaab 'sllre  \n\n\t　\x85​日本éü😀0١３²#&|\r"
    texts = TEXTS + ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    assert encode(texts) == [ENC.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x2FF), max_size=40), max_size=6))
def test_equals_the_library_on_any_text(texts):
    if texts:
        assert encode(texts) == [ENC.encode_ordinary(t) for t in texts]


def test_ranks_whose_merges_go_backwards():
    """Vocabularies in which a merge makes a pair of lower rank: lowest rank first, leftmost first, word by word."""
    rnd = random.Random(5)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 300:
            a, b = rnd.choice([b"a", b"b", b"c", *[t for t in tokens if len(t) > 1]]), rnd.choice([b"a", b"b", b"c", *[t for t in tokens if len(t) > 1]])
            if len(a + b) < 9:
                tokens.add(a + b)
        order = sorted(tokens, key=lambda t: (len(t) > 1, rnd.random()))
        merges = B.Merges({t: i for i, t in enumerate(order)})
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))).encode() for _ in range(200)]
        flat, n = merges.replay(words)
        at = 0
        for w, k in zip(words, n.tolist()):
            assert flat[at:at + k].tolist() == merges.one_word(w)
            at += k


@pytest.mark.parametrize("extra", [False, True])
def test_query_operators(spark, tmp_path, extra):
    rows = [(i, t, "x", 1) for i, t in enumerate([*TEXTS, None, TEXTS[5], TEXTS[5]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int").repartition(3)
    if extra:
        out = B.decode(B.encode(df, PATH, P.PATTERN), PATH).collect()
        for r in out:
            assert list(r.ids) == ENC.encode_ordinary(rows[r.doc_id][1] or "")
            assert bytes(r.decoded).decode() == (rows[r.doc_id][1] or "")
        return
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in B.op2_byte_bpe(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        ids = ENC.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.decode(B.encode(df, PATH, P.PATTERN), PATH).count() == 0


def test_remembered_words_give_the_same(spark):
    """Words met in an earlier slice, too long to remember, or beyond the bound are encoded alike."""
    import random

    merges = MERGES
    plain = lambda ws: merges.encode_words([w.encode() for w in ws])
    asked = []
    known = B.Remembered(lambda ws: (asked.extend(ws), plain(ws))[1], most=50, longest=6)
    rnd = random.Random(2)
    for _ in range(30):
        words = list({"".join(rnd.choices("abcé ", k=rnd.randint(1, 9))) for _ in range(rnd.randint(0, 20))})
        flat, counts = known(words)
        want = plain(words)
        assert flat.tolist() == want[0].tolist() and counts.tolist() == want[1].tolist()
    assert len(known.index) == 50 and len(asked) > len(set(asked))


def test_decode_of_slices_nulls_and_wrong_ids(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame([(1, [72, 0]), (2, None), (3, []), (4, [5])], "k int, ids array<int>").coalesce(1)
    ranks = {r: t for t, r in B.load_ranks(path).items()}
    got = {r.k: bytes(r.decoded) for r in B.decode(df, path).where("k != 1").collect()}
    assert got == {2: b"", 3: b"", 4: ranks[5]}
    with pytest.raises(Exception, match="no token|out of bounds"):
        B.decode(spark.createDataFrame([([10**6],)], "ids array<int>"), path).collect()
