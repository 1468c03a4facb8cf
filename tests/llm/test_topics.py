"""Topics are learned from all texts."""

import numpy as np
import pytest

from flowtide.llm import topics


def test_all_whole_texts_are_learned_from(spark):
    """More texts than any sample, whose ends tell more than their heads: the same clusters as in memory, copies counted once."""
    rng = np.random.default_rng(5)
    words = [[f"{kind}{i}" for i in range(300)] for kind in "abc"]
    texts = ["head " * 1000 + " ".join(rng.choice(words[k % 3], 30)) + f" only{k}" for k in range(2400)]
    d = spark.createDataFrame([(t,) for t in [*texts, *texts[:300], None, " "]], "text string").repartition(7)
    got, want = topics.learn(d, topics=3), topics.fit(texts, 3)
    assert got.rarity == pytest.approx(want.rarity)
    assert sorted(map(tuple, got.centres.round(3))) == sorted(map(tuple, want.centres.round(3)))
    assert np.array_equal(topics.learn(d.repartition(3), topics=3).centres, got.centres)


def test_counts_beyond_the_table_of_logarithms():
    n = np.array([[0, 1, 255], [256, 300, 70_000]])
    assert topics.damped(n) == pytest.approx(np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0.0))
