"""Range coder round trips and the token files against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskspark.llm import rangecoder as R
from riskspark.llm import tokenfiles as F
from riskspark.llm.bpe import encode_slice


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 255, 257, 2047, 2048, 2049, 9000])
@pytest.mark.parametrize("kinds", [1, 2, 300, 65535, 65536, 65537, 1 << 20])
def test_round_trip(n, kinds):
    rng = np.random.default_rng(n + kinds)
    for ids in (rng.integers(0, kinds, n), (rng.zipf(1.3, n) % kinds), np.resize(np.arange(min(kinds, 7)), n)):
        assert (R.read_segment(R.write_segment([5], np.array([n]), ids))[2] == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70000), max_size=200), max_size=12), st.integers(2, 90))
def test_documents_round_trip(docs, block):
    ids = np.array([x for d in docs for x in d], np.int64)
    names = [None if i % 3 == 2 else -i for i in range(len(docs))]
    got, lengths, out = R.read_segment(R.write_segment(names, np.array([len(d) for d in docs], np.int64), ids, block))
    assert got == names and lengths.tolist() == [len(d) for d in docs] and out.tolist() == ids.tolist()


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(1).zipf(1.2, 10000) % 5000
    data = R.write_segment([1], np.array([10000]), ids)
    assert (R.read_segment(data, [2])[2] == ids[2 * R.BLOCK:3 * R.BLOCK]).all()
    assert (R.read_segment(data, [1, 4])[2] == np.concatenate([ids[R.BLOCK:2 * R.BLOCK], ids[4 * R.BLOCK:]])).all()
    broken = bytearray(data)
    broken[-40] ^= 255
    with pytest.raises(ValueError):
        R.read_segment(bytes(broken))


def test_more_than_65536_kinds():
    ids = np.random.default_rng(5).permutation(200_000)
    assert (R.read_segment(R.write_segment([1], np.array([len(ids)]), ids))[2] == ids).all()


def test_settled_interval_of_exactly_a_word_goes_on():
    """An aligned interval of 2^32 has settled its upper half; shifted as it is, its width would be 0."""
    lo, w = np.array([5 << 32, 5 << 32, (6 << 32) - 9, 7 << 32], np.uint64), np.array([1 << 32, 1 << 33, 100, 9], np.uint64)
    k, width = R.settle(lo, w)
    assert k.tolist() == [0, 2, 3] and width.tolist() == [(1 << 32) - 1, 9, 9]
    assert (width << np.uint64(32) > 0).all()


def coder(total_of, freq_of, steps):
    """Drives the coder's own steps with chosen symbols of one lane; returns whether width ever was 0."""
    low, width = np.zeros(1, np.uint64), np.full(1, ~np.uint64(0))
    for i in range(steps):
        total, freq = total_of(i), freq_of(i)
        r = width // np.uint64(total)
        low, width = low + np.uint64(i % (total - freq + 1)) * r, np.uint64(freq) * r
        k, b = R.settle(low, width)
        if len(k):
            low, width = low << np.uint64(32), b << np.uint64(32)
        if not width[0]:
            return True
    return False


def test_width_never_vanishes():
    with np.errstate(over="ignore"):
        # after a narrow interval is cut at a border, the width is a small multiple of 2^32: shares of it are whole words
        for total in (*range(2, 70), 255, 256, 257, 4096, 65536):
            assert not coder(lambda i: total, lambda i: 1, 3000)
            assert not coder(lambda i: 2 + i % total, lambda i: 1, 3000)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 70000), st.integers(2, 70), st.integers(1, 400), st.integers(0, 2**31))
def test_small_blocks_round_trip(kinds, block, n, seed):
    rng = np.random.default_rng(seed)
    ids = np.where(rng.random(n) < 0.5, rng.integers(0, kinds, n), rng.integers(0, min(kinds, 3), n))
    assert (R.read_segment(R.write_segment([5], np.array([n]), ids, block))[2] == ids).all()


def test_repetition_is_predicted():
    ids = np.resize(np.random.default_rng(2).integers(0, 50000, 50), 40000)
    assert len(R.write_segment([1], np.array([40000]), ids)) < 0.3 * 2 * 40000


def test_files_equal_the_library(spark, tmp_path):
    texts = ["", None, "Hello world.\nHello  again \n", "a", " lead", "é😀日本 123 it's <|endoftext|> \t x", "word " * 3000, "one\ntwo three"] * 3
    ids = [*range(100, 100 + len(texts) - 2), 100, None]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in zip(ids, texts)], "doc_id long, text string, start int, part string").repartition(5)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for chars, block in ((F.SEGMENT_CHARS, R.BLOCK), (200, 16)):
        path = str(tmp_path / f"tokens{chars}")
        F.write_tokens(df, path, P.path("byte_bpe_50k.json"), chars=chars, block=block)
        rows = F.read_tokens(spark, path).collect()
        crcs = F.read_tokens(spark, path, digest=True).collect()
        order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
        at, want = 0, []
        for d, text in order:
            own = [*t.encode(text or "", add_special_tokens=False).ids, F.END_ID]
            want.append((d, at, len(own), own))
            at += len(own)
        assert sorted(((r.doc_id, r.start, r.n_tokens, list(r.ids)) for r in rows), key=lambda x: x[1]) == want
        assert sorted((r.start, r.ids_crc32) for r in crcs) == [(s, zlib.crc32(np.array(x, "<u4").tobytes())) for _, s, _, x in want]
    assert spark.read.parquet(path).count() > 5


def test_empty_table(spark, tmp_path):
    F.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), P.path("byte_bpe_50k.json"))
    assert F.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_special_strings_and_pieces_equal_the_plain_library_call(spark, tmp_path):
    special = list(Tokenizer.from_file(P.path("byte_bpe_50k.json")).get_added_tokens_decoder().values())
    marks = [s.content for s in special] or ["<|endoftext|>"]
    texts = [f"a {m} b" for m in marks] + [m for m in marks] + [f"x{m}{m} {m}y\n{m} \n z" for m in marks] + [f" {m} " for m in marks] + ["very " * 200_000 + marks[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    F.write_tokens(df, str(tmp_path / "t"), P.path("byte_bpe_50k.json"))
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: list(r.ids) for r in F.read_tokens(spark, str(tmp_path / "t")).collect()}
    assert got == {i: [*t.encode(x, add_special_tokens=False).ids, F.END_ID] for i, x in enumerate(texts)}


def test_many_rows_of_one_id_are_dealt(spark, tmp_path):
    df = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "concat('text ', id % 500) as text").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little would be put into one task
    try:
        F.write_tokens(df, str(tmp_path / "t"), P.path("byte_bpe_50k.json"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(str(tmp_path / "t")).groupBy("part").sum("n_ids").collect()
    sizes = [r[1] for r in parts]
    assert len(sizes) >= 4 and max(sizes) < 2.5 * sum(sizes) / len(sizes)
    out = F.read_tokens(spark, str(tmp_path / "t"))
    assert out.count() == 20_000 and out.agg({"start": "max"}).first()[0] + out.orderBy("start", ascending=False).first().n_tokens == sum(sizes)


def test_marks_at_the_end_of_a_word_are_encoded_apart():
    """A word is asked of the library once, whatever marks end it; ids are those of the plain call."""
    class Shared:
        with open(P.path("byte_bpe_50k.json"), "rb") as f:
            value = f.read()

    encode_words, parts = F._tools(Shared())
    asked, plain = [], encode_words.encode
    encode_words.encode = lambda ws: (asked.extend(ws), plain(ws))[1]
    words = ["word", "Été", "x9", "it's", "don't", "日本", "ﬀ", "a²", "'s", "'", "$", "x<|endoftext|>", "<|endoftext|>!", "a.b", "Ж"]
    marks = ["", ".", "!!", ",***", "'", "'.", "''s", "'s", '"', "|>", "…", "_", "-\u00a0-"]
    rnd = np.random.default_rng(3)
    texts = ["", *(w + m for w in words for m in marks), "\n", " a", "a ", "a\n\nb", "a\tb. c", "a \n b", "a\u2003b! c", "a\x1cb! c", "one.\ntwo, three\n!four"]
    texts += [rnd.choice([" ", "\n"]).join(rnd.choice(words) + rnd.choice(marks[:-1]) for _ in range(50)) for _ in range(40)]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    for _ in range(2):
        flat, sizes = encode_slice(texts, parts, encode_words)
        assert sizes.tolist() == list(map(len, want)) and flat.tolist() == [x for own in want for x in own]
    assert asked.count(" word") == asked.count("word") == 1 and not {"word.", " word!!", " Été,***"} & set(asked)


def test_bound_of_a_block():
    ids = np.arange(5)
    for block in (0, R.MOST_BLOCK + 1):
        with pytest.raises(ValueError):
            R.write_segment([1], np.array([5]), ids, block)
    ids = np.random.default_rng(8).zipf(1.1, 30_000) % 70_000  # in one lane: totals far beyond 2^24
    ids[10_000:20_000] = 7
    for block, n in ((R.MOST_BLOCK, 30_000), (1, 300)):
        assert (R.read_segment(R.write_segment([1], np.array([n]), ids[:n], block))[2] == ids[:n]).all()
