"""op3's training sums the tasks' changes by pieces on the executors; texts are scored together."""

from __future__ import annotations

import numpy as np

from plumbline.llm import toxicity


def _ids(rng, n):
    return (rng.integers(0, toxicity.TABLE, n).astype(np.uint32) << 16) | rng.integers(0, toxicity.TABLE, n).astype(np.uint32)


def test_scored_together_as_one_by_one():
    rng = np.random.default_rng(5)
    net = toxicity.Network(3)
    net.bias = rng.normal(0, 0.3, net.bias.shape).astype(np.float32)
    tables = net.tables()
    texts = [_ids(rng, n) for n in (0, 1, 2, 3, 0, 9, toxicity.RUN - 4, 5, toxicity.RUN + 7, 2)]
    assert net.logits(texts, tables) == [net.logit(x, tables) for x in texts]


def test_pieces_sum_to_the_whole_change(spark):
    rng = np.random.default_rng(6)
    changes = []
    for _ in range(5):
        words = np.zeros((toxicity.TABLE, toxicity.DIM))
        words[rng.integers(0, toxicity.TABLE, 50)] = rng.normal(size=(50, toxicity.DIM))
        grow = np.zeros(toxicity.TABLE)
        grow[rng.integers(0, toxicity.TABLE, 30)] = rng.random(30)
        changes.append([words, grow, rng.normal(size=7)])
    keyed = spark.sparkContext.parallelize(changes, 5).flatMap(toxicity._pieces).reduceByKey(toxicity._add, 3).collect()
    assert len(keyed) <= 2 * (toxicity.TABLE // toxicity.PIECE) + 1
    whole = [np.zeros((toxicity.TABLE, toxicity.DIM)), np.zeros(toxicity.TABLE), np.zeros(7)]
    for (i, p), x in keyed:
        if i == 2:
            whole[i] = x
        else:
            whole[i][p * toxicity.PIECE : (p + 1) * toxicity.PIECE] = toxicity._whole(x, whole[i])
    for got, want in zip(whole, (sum(c[i] for c in changes) for i in range(3))):
        assert np.allclose(got, want, rtol=0, atol=1e-12)
