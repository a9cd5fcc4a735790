import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from loomgraph.llm import tokens

TEXTS = [
    None, "", " ", "\n\n  \n", "<|endoftext|>", "it's they'll I'M '' 's", "naïve café é", "塔板效率与压降，传热系数取6.26×10^0 kPa。", "😀👩‍🔬 ​", "a" * 5000, "塔" * 3000, "x  y   z\t\r\n", "　全角　", "1234567890 12.5e-3", "aaaaaaaaab", "don't you're we've he'd she'm",
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(f"{tokens.VOCAB_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_every_token_is_sound():
    assert tokens.load().sound.all()


@given(texts=st.lists(st.text(max_size=60), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_random_texts(plain, texts):
    ids, sizes = tokens.load().encode(texts)
    want = [plain(x) for x in texts]
    assert [len(w) for w in want] == sizes.tolist()
    assert [i for w in want for i in w] == ids.tolist()


def test_corpus(spark, plain):
    df = spark.createDataFrame([(i, t, "z", 9) for i, t in enumerate(TEXTS)] + [(None, "x", "z", 9), (0, None, "z", 9)], "doc_id bigint, text string, ids string, n_tokens int")
    got = tokens.encode_corpus(df).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert list(r.ids) == (plain(TEXTS[r.doc_id]) if r.doc_id is not None else plain("x"))
    counts = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df.where("doc_id is not null")).distinct().collect()}
    assert counts == {i: len(plain(t)) for i, t in enumerate(TEXTS)}
    assert tokens.encode_corpus(df.where("false")).count() == 0


def test_memory_begins_anew_without_changing_results(plain):
    bpe = tokens.SpeculativeBpe(tokens.VOCAB_DIR, "byte_bpe_50k")
    old, tokens.REMEMBERED = tokens.REMEMBERED, 5
    try:
        for text in ("one two three four", "five six one two seven", "one eight nine ten"):
            ids, _ = bpe.encode([text, text])
            assert ids.tolist() == plain(text) * 2
    finally:
        tokens.REMEMBERED = old


def test_more_distinct_words_than_are_remembered(plain):
    bpe = tokens.SpeculativeBpe(tokens.VOCAB_DIR, "byte_bpe_50k")
    old, tokens.REMEMBERED = tokens.REMEMBERED, 5
    try:
        for text in ("one two three", "one four five six seven eight nine ten eleven one", "two three", "one two"):
            ids, sizes = bpe.encode([text])
            assert ids.tolist() == plain(text) and sizes.tolist() == [len(plain(text))] == bpe.count([text]).tolist()
    finally:
        tokens.REMEMBERED = old


def test_pairs_against_exact_merging():
    bpe = tokens.load()
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, bpe.n, (2, 4000))
    with open(f"{tokens.VOCAB_DIR}/byte_bpe_50k.tiktoken", "rb") as f:
        raw = {int(r): tokens.base64.b64decode(w) for w, r in map(bytes.split, f)}
    fits = bpe.compatible(a.astype(np.int64), b.astype(np.int64))
    assert fits.any() and not fits.all()
    for x, y, ok in zip(a.tolist(), b.tolist(), fits):
        assert ok == (bpe.exact(raw[x] + raw[y]) == [x, y])
