import base64
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import PATTERN, VOCABULARY, PairIndexEncoder, encode, token_counts

tiktoken = pytest.importorskip("tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no public vocabulary here")


@pytest.fixture(scope="module")
def both():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(VOCABULARY, "rb"))}
    return PairIndexEncoder(ranks), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_the_public_encoder(both):
    ours, theirs = both
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdeing aaaa<|endoftext|>é漢字🙂\n\t '") for _ in range(rng.randrange(80))) for _ in range(4000)]
    texts += ["a" * 20_000, "ab" * 3000, " " * 999, "<|endoftext|>", "it's we'll 123,456", "‍​", "नमस्ते दुनिया", "", "aaa" * 7]
    assert ours.encode(texts) == [theirs.encode_ordinary(t) for t in texts]


def test_forgetting_words_changes_nothing(both, monkeypatch):
    ours, theirs = both
    monkeypatch.setattr("ledgerloom.llm.bpe.WORDS_KEPT", 3)
    fresh = PairIndexEncoder(ours.ranks)
    texts = ["one two three four five six", "seven one eight two", "one"]
    assert fresh.encode(texts) == [theirs.encode_ordinary(t) for t in texts]


def test_spark(spark, both):
    _, theirs = both
    texts = [(1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (4, "<|endoftext|> again", "x"), (5, "long " * 60_000, "x"), (1, "Hello world", "x")]
    df = spark.createDataFrame(texts, "doc long, text string, ids string")
    got = sorted((r.doc, list(r.ids)) for r in encode(df, "doc", "text").collect())
    assert got == sorted((d, theirs.encode_ordinary(t) if t else []) for d, t, _ in texts)
    counts = {r.doc: r.n_tokens for r in token_counts(df, "doc", "text").collect()}
    assert counts[2] == counts[3] == 0 and counts[4] == len(theirs.encode_ordinary(texts[3][1]))
    assert encode(df.limit(0), "doc", "text").count() == 0 and encode(df, "doc", "text").schema["ids"].dataType.simpleString() == "array<int>"
    assert df.select(F.col("doc")).count() == 6
