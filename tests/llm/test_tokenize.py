from __future__ import annotations

import random

import pytest

from foliospark.llm import tokenize as K

TEXTS = [
    None, "", " ", "a", "<|endoftext|> x", "a" * 3000, "  \n\n  x", "x \n y", "\x1c a\x1fb  c ", "日本語テキスト" * 200, " é́", " '" + "s" * 7, "1234567890" * 50, " a", "a ", "it's  we'll\t'd x² ½3", "🙂 👩‍👩‍👧", "\r\n a b", "word " * 2000,
]


def test_same_ids_as_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(K.vocabulary_path())
    t.encode_special_tokens = True
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abcdefgh 'é日\n\t") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    ids, at = K.tokenizer(K.vocabulary_path()).encode(texts)
    want = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == want


def test_forgetting_changes_nothing(monkeypatch):
    bpe = K.ByteBpe(K.vocabulary_path())
    first = bpe.encode(TEXTS)[0].tolist()
    monkeypatch.setattr(K, "MEMO_CHUNKS", 0)
    assert bpe.encode(TEXTS)[0].tolist() == first


def test_corpus(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "hello world", "x"), (3, "hello world", "x")], "doc_id bigint, text string, ids string")
    rows = [(r.doc_id, r.ids) for r in K.encode_corpus(df).orderBy("doc_id").collect()]
    assert rows == [(1, []), (2, []), (3, [31373, 995]), (3, [31373, 995])]
    assert K.encode_corpus(df.limit(0)).count() == 0
    assert [r.n_tokens for r in K.token_counts(df).orderBy("doc_id").collect()] == [0, 0, 2, 2]
