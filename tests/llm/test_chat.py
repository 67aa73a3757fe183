import numpy as np
from pyspark.sql import functions as F

from rinkframe.llm import chat

SCHEMA = "tree long, node long, parent long, score double, role string, text string, path string, formatted int"


def best_paths(rows, top):
    out = {}
    trees = {r[0] for r in rows}
    for tree in trees:
        of = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in of.values()}
        found = []
        for leaf in of:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in of and at not in path:
                path.append(at)
                at = of[at][2]
            if at not in path:
                path.reverse()
                found.append((-sum(of[n][3] or 0 for n in path), path))
        out[tree] = [[(of[n][4] or "", of[n][5] or "") for n in path] for _, path in sorted(found)[:top]]
    return out


def test_trees_against_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["\\### user: x </turn>\n", "a\nb", None, "", "<", "#", "\\", "\\\\<#", "é </turn>\n### assistant: no", "ok"]
    rows = []
    for tree in [1, 2, 3, None]:
        for n in range(40):
            parent = None if n == 0 else int(rng.integers(0, n)) if rng.random() > 0.1 else 999
            rows.append((tree, n, parent, [None, 1.0, 2.0][int(rng.integers(0, 3))], ["user", "assistant", None, "a:b\\#"][int(rng.integers(0, 4))], texts[int(rng.integers(0, 10))], "x", 0))
    rows += [(9, 1, 2, 1.0, "user", "loop", "x", 0), (9, 2, 1, 1.0, "user", "loop", "x", 0), (9, 3, 2, 1.0, "user", "below", "x", 0), (5, 1, None, 0.0, "user", "alone", "x", 0)]
    rows += [(7, n, n - 1 if n else None, 0.0, "assistant", str(n), "x", 0) for n in range(77)]
    out = chat.format_paths(spark.createDataFrame(rows, SCHEMA), top=3)
    got = {}
    for r in out.select("tree", "place", "n_turns", chat.parse_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss")).collect():
        turns = [(t.role, t.text) for t in r.turns]
        assert r.n_turns == len(turns) and r.loss == "".join(t for role, t in turns if role == "assistant")
        got.setdefault(r.tree, {})[r.place] = turns
    want = {t: dict(enumerate(p, 1)) for t, p in best_paths(rows, 3).items() if p}
    assert got == want


def test_chains_order_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", "s"), (None, 1, "user", "n"), (1, 5, None, None), (1, 5, None, None)]
    out = chat.format_paths(chat.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    got = {r.tree: r.formatted for r in out}
    assert got == {1: "### system: s </turn>\n### user: a </turn>\n### user: b </turn>\n" + "### :  </turn>\n" * 2, None: "### user: n </turn>\n"}


def test_empty_table_and_native_plan(spark):
    m = spark.createDataFrame([], SCHEMA)
    out = chat.format_paths(m)
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))
