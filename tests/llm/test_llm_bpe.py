"""Operators 1 and 10 against the tokenizers library."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from llm_helpers import ODD_TEXTS, vocabulary  # noqa: F401
from tokenizers import Tokenizer

from marketlake.llm import bpe, byte_bpe, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


def _random_texts(n: int) -> list[str]:
    rng = random.Random(7)
    alphabet = "abe'stlrv \n\t\x1c\x85 ½Ⅷ٣é!_-中<|>endoftx"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(n)]


def test_encoding_and_counts_equal_the_library(vocabulary, library):
    texts = _random_texts(3000) + [t for t in ODD_TEXTS if t is not None]
    vocab, memory, counter = byte_bpe.load_vocabulary(vocabulary), bpe._memory(vocabulary), token_counts._counter(vocabulary)
    ids = bpe._ids(texts, memory, vocab)
    for text, found in zip(texts, ids, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert memoryview(found).cast("i").tolist() == want
        n = sum(len(p) if special else sum(map(counter.__getitem__, p)) for special, p in byte_bpe.pieces(text, vocab))
        assert n == len(want)


def test_pair_check_without_the_short_cut(vocabulary):
    """The border check by token edges agrees with merging both tokens' bytes."""
    encoder = bpe.Encoder(byte_bpe.load_vocabulary(vocabulary))
    assert encoder._regular
    rng, tokens = random.Random(1), sorted(encoder.vocab.ids)
    for _ in range(5000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert encoder._stands(a, b) == (encoder._merged(a + b) == [a, b])


def test_memory_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_REMEMBERED", 50)
    monkeypatch.setattr(bpe.Encoder, "MAX_PAIRS", 50)
    vocab = byte_bpe.load_vocabulary(vocabulary)
    memory, counter = bpe._Memory(vocab), token_counts._Counter(vocab)
    for text in _random_texts(300):
        want = library.encode(text, add_special_tokens=False).ids
        assert memoryview(bpe._ids([text], memory, vocab)[0]).cast("i").tolist() == want
        assert sum(len(p) if s else sum(map(counter.__getitem__, p)) for s, p in byte_bpe.pieces(text, vocab)) == len(want)
    assert len(counter) <= 50 and len(memory.encoder._pairs) <= 50


def test_dataframes_bear_odd_rows_and_clashing_columns(spark, vocabulary, library):
    rows = [(i, t, "own") for i, t in enumerate(ODD_TEXTS)] + [(None, "same text", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    out = bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")
    counted = token_counts.count_tokens(df, vocabulary, limit=1).collect()
    for r in counted:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 1)
    for empty in (bpe.decode(bpe.encode(df.limit(0), vocabulary), vocabulary), token_counts.count_tokens(df.limit(0), vocabulary)):
        assert empty.count() == 0


def test_decoding_what_is_no_text(spark, vocabulary, library):
    df = spark.createDataFrame([([0, 255, 50256, 10],), ([-1, 99_999_999],), ([],), (None,), ([162, 116],)], "ids array<int>")
    out = [r.decoded for r in bpe.decode(df, vocabulary).collect()]
    assert out == [library.decode([0, 255, 50256, 10], skip_special_tokens=False), "", "", "", library.decode([162, 116], skip_special_tokens=False)]


def test_documents_round_trip(spark, vocabulary, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for r in bpe.encode_and_decode(docs, vocabulary).collect():
        assert list(r.ids) == library.encode(r.text, add_special_tokens=False).ids and r.decoded == r.text


def test_memory_keeps_what_comes_again_and_words_are_encoded_once(vocabulary, library, monkeypatch):
    """Full memory keeps the chunks that came again; a known word is not walked again as part of another chunk."""
    monkeypatch.setattr(byte_bpe, "MAX_REMEMBERED", 400)
    vocab = byte_bpe.load_vocabulary(vocabulary)
    memory, walked = bpe._Memory(vocab), []
    inner = memory.encoder.encode_words
    memory.encoder.encode_words = lambda words: inner(walked.append(list(words)) or walked[-1])
    for k in range(40):
        text = "start common shingle, " + " ".join(f"w{k}x{i}" for i in range(20)) + " common, shingle"
        assert memoryview(bpe._ids([text], memory, vocab)[0]).cast("i").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(memory) <= 100 + 120
    every = [w for ws in walked for w in ws]
    assert sum(w == " common" or w == b" common" for w in every) == 1


def test_chunks_and_words_are_those_of_the_pattern():
    for text in [*_random_texts(2000), "a\0 b c", "\0", "12 3", " 12", "Ⅷ a", "é 7", *(t for t in ODD_TEXTS if t is not None)]:
        assert [w for c in byte_bpe.chunks(text) for w in byte_bpe.words(c)] == byte_bpe._ANY(text)


def test_batches_of_texts_are_bounded(spark, vocabulary):
    """Texts reach Python in batches of a few MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), vocabulary)
        assert int(spark.conf.get(name)) == 4 << 20
        spark.conf.set(name, "1048576")
        bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), vocabulary)
        assert int(spark.conf.get(name)) == 1 << 20
    finally:
        spark.conf.set(name, before)


def test_a_worker_holds_little(vocabulary):
    """100,000 chunks at most stay from batch to batch, and pairs share the vocabulary's tokens."""
    vocab = byte_bpe.load_vocabulary(vocabulary)
    memory = bpe._Memory(vocab)
    bpe._ids(_random_texts(300), memory, vocab)
    own = {token: token for token in vocab.ids}
    held = [left for known in memory.encoder._pairs.values() for left in known if left]
    assert held and all(left is own[left] for left in held)
    memory.update((f"chunk {i}", b"") for i in range(150_000))
    memory.trim({"chunk 7"})
    assert len(memory) <= 100_000
