import numpy as np
import pytest

from ledgerline import queries
from ledgerline.operators import golden


@pytest.mark.parametrize("draws", [7, 50, 1000, 1 << 20])
def test_pieces_equal_the_whole_stream(monkeypatch, draws):
    monkeypatch.setattr(golden, "DRAWS", draws)
    for hits, n in ((31, 53), (0, 50), (50, 50)):
        sample = np.concatenate([np.ones(hits), np.zeros(n - hits)])
        rates = sample[np.random.default_rng(3).integers(0, n, size=(40, n))].mean(axis=1)
        assert golden.bootstrap_ci(hits, n, iters=40, seed=3) == tuple(np.percentile(rates, [2.5, 97.5]))


def test_query_counts_every_field(spark):
    sf = "/root/testdata/sf0.01"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    n, hits = orders.filter("o_orderkey % 13 <> 0").count(), orders.filter("o_orderkey % 13 <> 0 and o_orderkey % 11 <> 0 and o_orderkey % 7 <> 0").count()
    assert n > 2000
    low, high = queries.bootstrap_interval(spark, sf).first()
    assert low < hits / n < high and high - low < 0.02
