import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rinkframe.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    again = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(again)


TEXTS = [None, "", " \n\t", "a b", "a b c", "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z", "# $ a|b <c> é é é é", "a b c d " * 700, "a b a b a c a b a", "\x1c odd \x85 sp　ace", "one\r\ntwo\r\none\r\n"]


def test_counts_against_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = TEXTS + [" ".join(rng.choice(list("abcde"), size=int(n))) for n in rng.integers(1, 60, 60)]
    got = quality.with_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string"), "text").collect()
    assert {r.id: tuple(r)[2:] for r in got} == {i: counts(t) for i, t in enumerate(texts)}


def test_slow_way_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(quality, "PLACE_BITS", 3)
    texts = ["a b c a b c d e", "a b c d e f g a b c d e f g x y z " * 3]
    got = quality.with_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string"), "text").collect()
    assert {r.id: tuple(r)[2:] for r in got} == {i: counts(t) for i, t in enumerate(texts)}


def starts(x):
    """Medians, and covariances by median deviations with three correlations."""
    lower = lambda v: np.sort(v, axis=0)[(len(v) - 1) // 2]
    m = lower(x)
    sd = lower(np.abs(x - m)) * 1.4826
    z = (x - m) / np.maximum(sd, quality.FLOORS)
    length = np.linalg.norm(z, axis=1, keepdims=True)
    for y in (None, np.tanh(z), z / np.where(length > 0, length, 1)):
        r = np.eye(4) if y is None else (y.T @ y) / np.sqrt(np.outer((y * y).sum(0), (y * y).sum(0)))
        yield m, r * np.outer(sd, sd)


def by_hand(x, share):
    """The least determinant of three chains of concentration steps in numpy, by the same buckets and floors."""
    floors = np.diag(np.square(quality.FLOORS))
    scale = share / quality.chi_square(quality.chi_square_quantile(share, 4), 6)
    distance = lambda m, s: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    half_log = lambda s: np.linalg.slogdet(s)[1] / 2
    chains = [(m, s + floors) for m, s in starts(x)]
    for _ in range(quality.STEPS):
        before = [half_log(s) for _, s in chains]
        for k, (m, s) in enumerate(chains):
            bucket = np.floor(np.log(distance(m, s) + 1e-3) * 64)
            near = np.zeros(len(x), bool)
            for b in np.unique(bucket):
                if near.sum() < np.ceil(share * len(x)):
                    near |= bucket == b
            chains[k] = x[near].mean(0), np.cov(x[near].T, bias=True) * scale + floors
        if all(abs(half_log(s) - old) <= quality.SETTLED for (_, s), old in zip(chains, before, strict=True)):
            break
    return distance(*min(chains, key=lambda c: round(half_log(c[1]), 6)))


def test_estimate_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.round((rng.normal(size=(400, 4)) @ np.diag([0.3, 0.2, 0.5, 0.1]) + [1.5, 0.3, 0.4, 0.5]) * quality.UNIT).astype(int)
    x[:40] += 9000
    points = spark.createDataFrame([("en", None, *map(int, r)) for r in x], "g_lang string, g_source string, x0 long, x1 long, x2 long, x3 long")
    params = quality.estimate(points).where("level = 0")
    got = quality._by_group(points.withColumn("level", F.lit(0)), params).select(*quality.X, quality._distance().alias("d")).collect()
    want = by_hand(x / quality.UNIT, quality.SHARE)
    cut = quality.chi_square_quantile(1 - quality.TAIL, 4)
    got = {tuple(r)[:4]: r.d for r in got}
    have = np.array([got[tuple(map(int, r))] for r in x])
    assert np.allclose(have, want, rtol=1e-6)
    assert (have[:40] > cut).all() and (have[40:] < cut).all()


def test_verdict_follows_the_estimate(spark):
    # Two statistics that go together: a row off their line is rejected, one as far along it stays.
    rng = np.random.default_rng(4)
    line = rng.normal(size=600)
    x = np.stack([0.5 + 2 * line, 0.4 + 2 * line + 0.05 * rng.normal(size=600), 0.3 + 0.05 * rng.normal(size=600), 0.3 + 0.05 * rng.normal(size=600)], 1)
    x[0], x[1] = [4.5, 4.4, 0.3, 0.3], [2.5, -1.6, 0.3, 0.3]
    points = spark.createDataFrame([("en", None, *map(int, np.round(r * quality.UNIT))) for r in x], "g_lang string, g_source string, x0 long, x1 long, x2 long, x3 long")
    params = quality.estimate(points).where("level = 0")
    got = quality._by_group(points.withColumn("level", F.lit(0)), params).where("x0 in (18432, 10240)").select("x0", quality._distance().alias("d")).collect()
    far = {r.x0: r.d for r in got}
    cut = quality.chi_square_quantile(1 - quality.TAIL, 4)
    assert far[18432] < cut < far[10240]


def clean(rng, n):
    lines = [" ".join("".join(rng.choice(list("etaoinshrdlu"), size=int(k))) for k in rng.integers(1, 9, 12)) for _ in range(n // 12 + 1)]
    return "\n".join(lines)


def test_verdicts_and_edge_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(i, clean(rng, int(rng.integers(60, 900))), "en", None, 1, "x") for i in range(300)]
    bad = [(1000 + i, re.sub(r"(\w) ", r"\1### ", clean(rng, 200)), "en", None, 1, "x") for i in range(20)]
    odd = [(None, None, None, None, None, None), (2000, "", "fr", "s", 1, "x"), (2001, clean(rng, 300), "fr", None, 1, "x"), (2001, clean(rng, 20), "fr", None, 1, "x")]
    docs = spark.createDataFrame(rows + bad + odd, "doc_id long, text string, lang string, source string, n_words int, kept string")
    out = {(r.doc_id, r.n_words): r for r in quality.verdicts(docs).collect()}
    assert len(out) == len(rows + bad + odd)
    for (i, n), r in out.items():
        assert r.base_failed == (n < 50) and r.kept == (n >= 50 and not 1000 <= (i or 0) < 1020), (i, r)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == 301
    assert quality.verdicts(docs.limit(0)).count() == 0 and quality.keep(docs.limit(0)).count() == 0


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = quality.verdicts(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


@pytest.mark.parametrize("x,k,want", [(9.487729, 4, 0.95), (12.591587, 6, 0.95)])
def test_chi_square(x, k, want):
    assert abs(quality.chi_square(x, k) - want) < 1e-6 and abs(quality.chi_square_quantile(want, k) - x) < 1e-4
