"""Rows of a batch and what a tokenizing worker keeps: both bounded."""

import numpy as np

from orrery.llm import quality, tokens
from orrery.llm.common import BATCH_ROWS, LIST_ROWS

PARQUET = "spark.sql.parquet.columnarReaderBatchSize"
ORC = "spark.sql.orc.columnarReaderBatchSize"


def test_texts_and_id_lists_are_read_in_short_batches(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    before = {key: spark.conf.get(key) for key in (PARQUET, ORC)}
    try:
        for key in before:
            spark.conf.set(key, "4096")
        quality.judge(docs)
        assert int(spark.conf.get(PARQUET)) <= BATCH_ROWS
        for key in before:
            spark.conf.set(key, "4096")
        path = str(tmp_path / "ids")
        tokens.write_tokens(docs, path, tokens.vocabulary())
        assert int(spark.conf.get(PARQUET)) <= BATCH_ROWS
        spark.conf.set(ORC, "4096")
        assert tokens.read_tokens(spark, path).count() == 2
        assert int(spark.conf.get(ORC)) <= LIST_ROWS
        spark.conf.set(ORC, "16")  # a smaller size of the session stays
        tokens.read_tokens(spark, path)
        assert spark.conf.get(ORC) == "16"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_pieces_go_to_the_tokenizer_in_small_groups(monkeypatch):
    class Counting:
        def __init__(self, inner):
            self.inner, self.most = inner, 0

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **options):
            self.most = max(self.most, len(texts))
            return self.inner.encode_batch_fast(texts, **options)

    monkeypatch.setattr(tokens, "STEP_PIECES", 7, raising=False)
    known = tokens.Encoder(tokens.vocabulary())
    text = " ".join(f"word{i} part{i % 5}." for i in range(40))
    want = known.tokenizer.encode(text, add_special_tokens=False).ids
    known.tokenizer = Counting(known.tokenizer)
    ids, starts = known.encode([text, "", text], None)
    assert known.tokenizer.most <= 7
    assert ids.tolist() == want + want and starts.tolist() == [0, len(want), len(want), 2 * len(want)]


def test_long_words_are_not_all_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    known = tokens.Encoder(tokens.vocabulary())
    rng = np.random.default_rng(3)
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 26, 2000)) for _ in range(6)] + ["a b"]
    for _ in range(2):
        for text in texts:
            want = known.tokenizer.encode(text, add_special_tokens=False).ids
            assert known.encode([text], None)[0].tolist() == want
    assert len(known.ids) <= 50 * 8 and len(known.known)
