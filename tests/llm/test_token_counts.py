import random

import pytest

pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from brandtrack.llm import token_counts as tc  # noqa: E402

PATH = vocabularies.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "<|endoftext|>",
    "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "a" * 2001,
    "it's 'll 've \n\n x\t\ty  ",
    "x \x1c\x1dy \x85z\xa0",
    "日本語テキスト 🙂🙂👨‍👩‍👧 ſK",
    " \x0b\x0c ",
    "!!!!!!???..." * 40,
]


def expected(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library_on_odd_and_random_texts():
    rng = random.Random(5)
    letters = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), 32, 10, 0x1F600]))
    texts = ODD + ["".join(letters() for _ in range(rng.randrange(200))) for _ in range(500)]
    counter = tc.Counter(tc.read_merges(PATH))
    assert counter.count(texts) == expected(texts)


def test_small_memory_and_blocks_change_nothing(monkeypatch):
    monkeypatch.setattr(tc, "KNOWN", 10)
    texts = ["the cat sat on the mat " * k for k in range(30)] + ODD
    counter = tc.Counter(tc.read_merges(PATH))
    counted = [n for block in tc.blocks(texts, 100) for n in counter.count(block)]
    assert counted == expected(texts)


def test_rows_nulls_copies_and_other_columns(spark):
    rows = [(1, "Hello world", "x", 7), (1, "Hello world", "y", 7), (None, None, None, 0), (3, "", "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    got = {tuple(r) for r in tc.count_tokens(docs, PATH, limit=1).collect()}
    assert got == {(1, 11, 2, True), (None, 0, 0, False), (3, 0, 0, False)}
    assert tc.count_tokens(docs, PATH).count() == 4
    assert tc.count_tokens(docs.limit(0), PATH).collect() == []


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        tc.read_merges(vocabularies.path("word_bpe_49k.json"))
