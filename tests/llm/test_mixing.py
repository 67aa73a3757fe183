import numpy as np
import pytest

from rinkframe.llm import mixing


def shared(sizes, weights, most):
    """Targets by rounds: what is above its cap is fixed there, and the rest shared anew."""
    named = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(named)}
    full: set = set()
    while True:
        open_ = sum(weight[k] for k in named if k not in full)
        level = (sum(sizes.values()) - most * sum(sizes[k] for k in full)) / open_ if open_ else float("inf")
        above = {k for k in named if k not in full and weight[k] * level > most * sizes[k]}
        if not above:
            return {k: min(weight[k] * level, most * sizes[k]) if k not in full else most * sizes[k] for k in named}
        full |= above


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_targets_against_rounds(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i:02d}": int(n) for i, n in enumerate((rng.pareto(0.6, 40) * 20).astype(int))} | {None: 7, "zero": 0, "équal": 7, "equal": 7}
    rows = [(k, n // 2) for k, n in sizes.items()] + [(k, n - n // 2) for k, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = shared(sizes, (5, 2, 1), 3.0)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-9 * max(1, want[k]) for k in want)


def test_all_sources_without_words_and_none_at_all(spark):
    zero = spark.createDataFrame([("a", 0), (None, 0)], "source string, size long")
    assert {(r.target, r.rate) for r in mixing.source_targets(zero).collect()} == {(0.0, 0.0)}
    assert mixing.source_targets(zero.limit(0)).count() == 0
