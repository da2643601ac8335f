import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.packing import differencing, fill_containers, first_fit_decreasing, pack


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 80))
def test_no_container_overflows_and_every_item_has_one(sizes, capacity):
    sizes = np.array(sizes, dtype=np.int64)
    out = pack(sizes, capacity)
    assert len(out) == len(sizes)
    if len(sizes):
        assert np.bincount(out, weights=sizes).max() <= capacity
        # Differencing supplies every container, whatever another way would have needed: it may take one more.
        assert out.max() + 1 <= first_fit_decreasing(sizes, capacity).max() + 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=40), st.integers(1, 7))
def test_differencing_uses_k_containers(sizes, k):
    sizes = np.array(sizes, dtype=np.int64)
    out = differencing(sizes, k)
    assert out.min() >= 0 and out.max() < k and len(out) == len(sizes)
    if len(sizes) > 30 and k > 1:
        sums = np.bincount(out, weights=sizes, minlength=k)
        assert sums.max() - sums.min() <= sizes.max()


def test_differencing_beats_a_naive_split():
    sizes = np.random.default_rng(1).integers(1, 900, 2000)
    sums = np.bincount(differencing(sizes, 64), weights=sizes)
    assert sums.max() - sums.min() <= 5


def test_spark(spark):
    rows = [(k, (k * 37) % 900 + 1, "x") for k in range(3000)] + [(9001, 5000, "x"), (9002, 4096, "x"), (9003, 0, "x"), (9004, None, "x"), (9005, -3, "x"), (1, 38, "x"), (9006, 2048, "x")]
    df = spark.createDataFrame(rows, "doc long, size int, container string")
    out = fill_containers(df, "doc", "size").toPandas()
    filled = out.dropna(subset=["container"])
    assert filled.groupby("container").n_tokens.sum().max() <= 2048
    assert filled.n_tokens.sum() == sum(max(0, s or 0) for _, s, _ in rows)
    assert sorted(out[out.container.isna()].doc) == [9003, 9004, 9005]
    assert sorted(out[out.doc == 9001].n_tokens) == [904, 2048, 2048] and sorted(out[out.doc == 9001].first_token) == [0, 2048, 4096]
    assert len(out[out.doc == 1]) == 2 and len(out[out.doc == 9006]) == 1
    total = filled.n_tokens.sum()
    assert filled.container.nunique() <= -(-total // 2048) + 4


def test_empty(spark):
    assert fill_containers(spark.createDataFrame([], "doc string, size long"), "doc", "size").count() == 0


@pytest.mark.parametrize("sizes", [[2047] * 5, [1] * 10, [1024] * 7, [2047, 1, 2047, 1]])
def test_ties(sizes):
    out = pack(np.array(sizes), 2048)
    assert np.bincount(out, weights=sizes).max() <= 2048 and out.max() + 1 == -(-sum(sizes) // 2048)


def test_repeated_and_missing_ids_fill_containers_of_their_own(spark):
    rows = [("a", 2048), ("a", 4100), ("a", 4100), (None, 2048), (None, 2048), (None, 2100), ("a-0", 2048)]
    out = fill_containers(spark.createDataFrame(rows, "doc string, size long"), "doc", "size").toPandas()
    assert out.groupby("container").n_tokens.sum().max() <= 2048 and out.n_tokens.sum() == sum(s for _, s in rows)
    assert (out.n_tokens == 2048).sum() == out[out.n_tokens == 2048].container.nunique() == 9
