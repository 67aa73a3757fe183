import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from rinkframe.llm import mixing, packing  # noqa: E402


def corpus():
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("etaoinshrdlu"), int(rng.integers(2, 9))))
    text = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n // 12 + 1))
    clean = [text(int(rng.integers(60, 500))) for _ in range(240)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(clean)]
    rows += [(1000 + i, text(20), "en", "s0", 1) for i in range(10)]
    rows += [(1100 + i, re.sub(r"(\w) ", r"\1%%% ", text(120)), "en", "s1", 1) for i in range(10)]
    rows += [(1200 + i, clean[i].replace(" ", "  ", 3) if i % 2 else clean[i], "en", "s2", 1) for i in range(10)]
    for i in range(10):
        words = clean[20 + i].split(" ")
        words[len(words) // 2] = "changed"
        rows.append((1300 + i, " ".join(words), "en", "s2", 1))
    return rows + [(None, None, None, None, None), (1400, "", "de", "s9", 0)]


def test_stages(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen, columns = {}, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    ids = lambda name: Counter(r.doc_id for r in seen[name])
    assert set(ids("quality_rules")) == {r[0] for r in rows if r[0] is not None and (r[0] < 1000 or 1200 <= r[0] < 1400)}
    # Equal texts: the one with more white space stays, else the smallest doc_id.
    gone = {i for i in range(1, 10, 2)} | {1200 + i for i in range(0, 10, 2)}
    assert set(ids("exact_dedup")) == set(ids("quality_rules")) - gone and max(ids("exact_dedup").values()) == 1
    near = {1300 + i for i in range(10)}
    assert set(ids("jaccard_join")) == set(ids("exact_dedup")) - near
    assert {r.text for r in seen["jaccard_join"]} <= {r[1] for r in rows}
    size = Counter()
    for r in seen["jaccard_join"]:
        size[r.source] += len(r.text.split())
    total, target = sum(size.values()), dict(zip(sorted(size), (5, 2, 1), strict=True))
    taken = Counter()
    for r in seen["mix_sources"]:
        taken[r.source] += len(r.text.split())
    for s, w in target.items():
        assert abs(taken[s] / min(3 * size[s], total * w / 8) - 1) < 0.15
    packed = seen["best_fit_packing"]
    assert sum(r.n_words for r in packed) == sum(taken.values()) and max(r.bin_words for r in packed) <= packing.CAPACITY
    of, source = {}, {r.doc_id: r.source for r in seen["mix_sources"]}
    for r in packed:
        of.setdefault(r.bin_id, []).append(source[r.doc_id])
    assert all(len(x) == len(set(x)) for x in of.values())


def test_run_and_reruns_agree(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    first = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert first == sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) and first


def test_mix_equals_assignment(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 50), None if i % 7 == 0 else f"s{i % 4}", "x") for i in range(300)] + [(None, None, "s1", "x"), (3, "w", "s1", "x")], "doc_id long, text string, source string, rate string")
    want = Counter()
    for r in mixing.assign(docs).collect():
        want[r.doc_id] += r.n_copies
        assert r.n_copies <= 3
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == +want
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.assign(docs.limit(0)).count() == 0
    plan = mixed._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_stages_with_clashing_names(spark):
    """Columns named like the operators' own neither fail nor change which rows stay."""
    rows = corpus()[:40] + corpus()[-40:]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = "gone_id gone_lang gone_source gone_hash gone_sha gone_chars gone_mark c0 c1 mark label n id_ sha_ len_ mark_ best rid fp of_ kept copies near_id".split()
    more = docs.selectExpr("*", *[f"concat('x', doc_id) AS {c}" for c in taken])
    for name, stage in corpus_pipeline.STAGES[:4]:
        plain, named = stage(spark, docs, "").collect(), stage(spark, more, "")
        assert named.columns == more.columns, name
        assert Counter(r.doc_id for r in named.collect()) == Counter(r.doc_id for r in plain), name
