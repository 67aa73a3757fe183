import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rinkframe.llm import lattice_lm
from rinkframe.llm.words import LOWER

FILE = public_tokenizers.path("piece_bpe_32k.model")


def splits(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in splits(word[k:]):
            yield [word[:k], *rest]


def tokens(text):
    return (text or "").encode().translate(LOWER).split()


def test_forward_sums_over_all_segmentations():
    pieces, log_p = lattice_lm.vocabulary(FILE)
    p = dict(zip(pieces, log_p, strict=True))
    lattice = lattice_lm.Lattice(pieces, log_p)
    for word in ("the", "station", "über", "a", "x9!"):
        terms = [sum(p[s] for s in way) for way in splits("▁" + word) if all(s in p for s in way)]
        assert math.isclose(lattice.forward(word), math.log(sum(map(math.exp, terms))), rel_tol=1e-12)
    assert math.isfinite(lattice.forward("\U0001f9ff" * 3)) and math.isfinite(lattice.forward("ab" * 20000))
    counts = {}
    lattice.expect("station", counts)
    assert math.isclose(sum(len(pieces[k]) * x for k, x in counts.items()), len("▁station"))


def test_bytes_weigh_as_the_last_piece():
    pieces, log_p = lattice_lm.vocabulary(FILE)
    p = dict(zip(pieces, log_p, strict=True))
    ranked = [x for piece, x in p.items() if not piece.startswith("<0x") and x > math.log(1e-8)]
    assert {p[f"<0x{b:02X}>"] for b in range(256)} == {min(ranked)}
    assert math.isclose(sum(map(math.exp, log_p)), 1)


def test_pieces_weigh_unseen_words(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "the cat sat") for i in range(10)] + [(10**6 + i, "quizzical the") for i in range(30)], "doc_id long, text string")
    held = [r.doc_id for r in lattice_lm.score(docs.where("doc_id >= 1000000"), FILE).collect() if r.held_out]
    docs = docs.where(f"doc_id < 1000000 or doc_id in ({','.join(map(str, held))})")
    one = {r.doc_id: r for r in lattice_lm.score(docs, FILE).collect()}
    pieces = lattice_lm.vocabulary(FILE)[0]
    monkeypatch.setattr(lattice_lm, "vocabulary", lambda _: (pieces, np.full(len(pieces), -math.log(len(pieces)))))
    two = {r.doc_id: r for r in lattice_lm.score(docs, FILE).collect()}
    assert held and all(abs(one[i].score - two[i].score) > 0.1 for i in held)
    assert all(abs(one[i].score - two[i].score) < 0.1 for i in one if i < 10)


@pytest.mark.parametrize("rounds", [0, 2])
def test_scores_against_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(lattice_lm, "BLOCK_TOKENS", 40)
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["the", "The", "cat", "sat", "oñ", "mat", "zebra", "\U0001f9ff"], int(n))) for n in rng.integers(0, 30, 60)]
    rows = list(enumerate(texts)) + [(100, None), (None, "lone words"), (101, ""), (7, texts[7]), (102, "unseen" * 3)]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    got = lattice_lm.score(docs, FILE, rounds=rounds).collect()
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not out(i) for w in [*tokens(t), None])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in rows:
        w = [*tokens(t), None]
        want[i, out(i), len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 8)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in got) == want
    pieces, log_p = lattice_lm.vocabulary(FILE)
    for _ in range(rounds):
        lattice, many = lattice_lm.Lattice(pieces, log_p), {}
        for x in c:
            if x is not None:
                lattice.expect(x.decode(), many)
        weight = np.full(len(pieces), lattice_lm.PRIOR)
        for k, x in many.items():
            weight[k] += x
        log_p = np.log(weight / weight.sum())
    lattice = lattice_lm.Lattice(pieces, log_p)
    p = lambda x: math.log10(c[x] / (n + v) + (v / (n + v) * math.exp(lattice.forward(x.decode())) if x is not None else 0))
    for r in got:
        text = dict(rows)[r.doc_id]
        assert math.isclose(r.score, sum(map(p, [*tokens(text), None])), rel_tol=1e-5)
        assert math.isclose(r.lattice_score, sum(lattice.forward(x.decode()) for x in tokens(text)) / math.log(10) + p(None), rel_tol=1e-5)


def test_empty_table(spark):
    assert lattice_lm.score(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0
