import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rinkframe.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, top):
    """Each pair of sources compared term by term."""
    n, df, groups = Counter(), Counter(), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall((text or "").translate(LOWER))
        for t in terms:
            n[lang, source, t] += 1
        df.update((lang, t) for t in set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), k in df.items() if g == lang and k >= least]
        rate = lambda count, total: 1 + 10**9 * (count + 5) // (total + 5 * len(kept))  # noqa: B023, E731
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        whole = {t: sum(n[lang, s, t] for s in sources) for t in kept}
        for s in sources:
            pairs = [(sum(abs(rate(n[lang, s, t], total[s]) - rate(n[lang, x, t], total[x])) for t in kept), x) for x in sources if x != s]
            above = [(rate(n[lang, s, t], total[s]) - rate(whole[t], sum(whole.values())), t) for t in kept if n[lang, s, t]]
            for part, found in (("pair", pairs), ("term", [x for x in above if x[0] > 0])):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def rows_of(rng, n):
    words = [f"{a}{b}" for a in "aBcdéZßя" for b in "xyzŧq"] + ["The", "the", "ÉTÉ", "Été"]
    share = rng.dirichlet(np.full(len(words), 0.3), 9)
    rows = []
    for _ in range(n):
        s = int(rng.choice(9, p=[0.4] + [0.075] * 8))
        text = "".join(w + str(rng.choice([" ", "-", "_", "3", "\n", "@"])) for w in rng.choice(words, int(rng.integers(0, 25)), p=share[s]))
        rows.append((str(rng.choice(["en", "de", ""])) or None, f"s{s}" if s < 8 else None, text))
    return rows + [("en", "empty", ""), ("en", "blank", None), ("fr", "one", "few words"), ("fr", "two", ""), ("xx", "alone", "word"), (None, "", "the the"), *[("en", "same", "the the aBx")] * 40]


@pytest.mark.parametrize("chunk,block,held,long_text", [(2048, 32, 1 << 19, 1 << 20), (3, 2, 20, 7)])
def test_against_every_term(spark, monkeypatch, chunk, block, held, long_text):
    for name, value in (("CHUNK", chunk), ("BLOCK", block), ("HELD", held), ("LONG", long_text)):
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of(np.random.default_rng(block), 400)
    docs = spark.createDataFrame([(*r, 1, "g") for r in rows], "lang string, source string, text string, n int, gid string")
    assert sorted(map(tuple, divergence.audit(docs, least=6, top=4).collect())) == by_hand(rows, 6, 4)


def test_rates_are_exact(spark):
    big = [(3 * 10**9 + 7, 10**18 - 1, 123456789), (0, 0, 1), (10**17, 10**18, 7), (0, 0, 0)]
    out = spark.createDataFrame(big, "n long, total long, v long").select(divergence.rate(*(divergence.F.col(c) for c in ("n", "total", "v")))).collect()
    assert [r[0] for r in out] == [1 + 10**9 * (n + 5) // (t + 5 * v) if t + v else None for n, t, v in big]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(docs).count() == 0
