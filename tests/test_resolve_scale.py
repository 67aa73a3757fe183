"""Matches whose pairs are many: against brute force, and by what their plans join."""

import random

import pytest

from rinkframe.operators import resolve


@pytest.mark.parametrize("chunk", [3, 16384])
@pytest.mark.parametrize("members", [8, 300])
def test_best_overlap_against_brute_force(spark, chunk, members):
    draw = random.Random(members)
    rows = [[(draw.choice("AB"), f"s{k}", draw.choice([None, *range(members)])) for k in range(25) for _ in range(draw.randrange(1, 9))] for _ in range(2)]
    rows[1] += [("A", "t0", m) for b, s, m in rows[0] if (b, s) == ("A", "s3")] + [("C", "s1", 1), (None, "s1", 1)]
    sets = []
    for side in rows:
        sets.append({})
        for b, s, m in side:
            if b and m is not None:
                sets[-1].setdefault((b, s), set()).add(m)
    want = {}
    for (b, s), x in sets[0].items():
        near = sorted((-len(x & y) / len(x | y), t) for (c, t), y in sets[1].items() if c == b and x & y)
        if len(x) >= 3 and near and -near[0][0] >= 0.1:
            want[b, s] = near[0][1], -near[0][0]
    frames = [spark.createDataFrame(r, "block string, set_id string, member int") for r in rows]
    got = resolve.best_overlap(*frames, "block", "set_id", "member", least=0.1, chunk=chunk).collect()
    assert {(r.block, r.left_id): (r.right_id, r.overlap) for r in got} == want and len(got) == len(want)


def test_best_overlap_joins_no_members(spark):
    rows = spark.range(2000).selectExpr("'A' AS block", "id % 50 AS set_id", "id % 40 AS member")
    plan = resolve.best_overlap(rows, rows, "block", "set_id", "member")._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "member#" in x]


@pytest.mark.parametrize("keys", [0, 8, 60, 2000])
def test_similar_names_against_brute_force(spark, keys):
    from difflib import SequenceMatcher

    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abc" if draw.random() < 0.3 else "abcdefgh", k=draw.choice([0, 1, 2, 3, 5, 8, 12, 17, 24])))
    right = [word() for _ in range(80)]

    def typed(x):
        x = list(x)
        for _ in range(draw.randrange(5)):
            at = draw.randrange(len(x) + 1)
            x[at : at + draw.randrange(2)] = draw.choice(["", "z", "a"])
        return "".join(x)

    left = [typed(draw.choice(right)) for _ in range(80)] + [word() for _ in range(40)]
    for least in (0.6, 0.8):
        want = {}
        for x in set(left):
            near = sorted((-r, y) for y in set(right) if (r := SequenceMatcher(None, x, y).ratio()) >= least)
            if near:
                want[x] = near[0][1], -near[0][0]
        got = resolve.fuzzy_match(spark.createDataFrame([(x,) for x in left] + [(None,)], "name string"), spark.createDataFrame([(x,) for x in right], "other string"), least, keys).collect()
        assert {r.name: (r.other, r.similarity) for r in got} == want and len(got) == len(want)
