import re

import numpy as np
import pytest

from rinkframe.llm import jaccard
from rinkframe.llm.words import arrow_bytes, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def by_hand(rows, width, per_cent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= per_cent * len(x | y) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    low = {}
    for (i, _), v in zip(sets, label, strict=True):
        if i is not None:
            low[v] = min(low.get(v, i), i)
    return [(i, len(s), low.get(v)) for (i, s), v in zip(sets, label, strict=True)]


def corpus(rng):
    rows, words = [], [f"w{i}" for i in range(4000)]
    for k in range(14):
        n = int(rng.choice([3, 8, 20, 60, 150, 400]))
        hub = list(rng.choice(words, n))
        rows += [" ".join(hub)] * int(rng.integers(1, 3))
        for _ in range(14):
            copy = list(hub)
            for _ in range(int(rng.integers(0, max(2, n // 12)))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.choice(words))
            if rng.random() < 0.3:
                copy = copy[: int(len(copy) * rng.uniform(0.75, 1)) + 1]
            if rng.random() < 0.3:
                hub = list(copy)
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    passage = " ".join(rng.choice(words, 60))
    rows += [passage + " " + " ".join(rng.choice(words, 60)) for _ in range(30)]
    return rows


@pytest.mark.parametrize("width,per_cent,frequent", [(3, 90, 64), (5, 80, 3)])
def test_components_against_all_pairs(spark, monkeypatch, width, per_cent, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    texts = corpus(np.random.default_rng(width)) + [None, "", " \n", "one", "One", "one two", "Ünï", "ünï"]
    order = np.random.default_rng(9).permutation(len(texts))
    rows = [(int(i), texts[i]) for i in order] + [(None, "lone and null row"), (None, "one"), (3, texts[3])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, mark string, n int")
    got = jaccard.near_duplicates(docs, width=width, per_cent=per_cent).collect()
    want = by_hand(rows, width, per_cent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(want, key=str)
    kept = jaccard.keep_one(docs, width=width, per_cent=per_cent).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted({(i, t) for i, t in rows if not shingles(t, width) or by_id(want, i, rows, t) == i}, key=str)


def by_id(want, i, rows, t):
    return next(w[2] for w, r in zip(want, rows, strict=True) if r == (i, t))


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for per_cent in (80, 90):
        bands = jaccard.Bands(per_cent)
        for n in list(range(1, 40)) + [90, 200, 333, 1500]:
            for _ in range(8):
                x = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
                lose = int(rng.integers(0, n - -(-n * per_cent // 100) + 1))
                y = np.concatenate([x[lose:], rng.choice(1 << 40, max(0, (n - lose) * 100 // per_cent - n), replace=False).astype(np.uint64)])
                shared = len(np.intersect1d(x, y))
                assert 100 * shared >= per_cent * len(np.union1d(x, y))
                if len(y) == n == shared:
                    continue
                sig, owner, shift, rooms = jaccard.signatures(np.concatenate([np.sort(x), np.sort(y)]), np.array([0, n, n + len(y)]), bands)
                given = [{s: set(sig[(owner == k) & (shift == s)]) for s in (0, 1)} for k in (0, 1)]
                band = bands.of(np.array([n, len(y)]))
                for g in set(band) | set(band + 1):
                    at = g - band
                    if set(at) <= {0, 1}:
                        # More shared signatures than either set has room, which `_sharing` relies on.
                        both = given[0][at[0]] & given[1][at[1]]
                        assert len(both) > max(0, rooms[0, at[0]], rooms[1, at[1]]), (n, lose)


def test_word_hashes():
    import pyarrow as pa

    texts = ["a B", " A  b\tc", "", "é\x0bÉ", "ab ba", "\n", "x" * 3000]
    data, at = arrow_bytes(pa.array(texts))
    hashes, first = word_hashes(data, at)
    named = {}
    for k, t in enumerate(texts):
        w = WORD.findall(t.translate(LOWER))
        assert first[k + 1] - first[k] == len(w)
        for h, x in zip(hashes[first[k] : first[k + 1]].tolist(), w, strict=True):
            assert named.setdefault(x, h) == h
    assert len(set(named.values())) == len(named)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(docs).count() == 0 and jaccard.keep_one(docs).count() == 0


def test_word_hashes_in_pieces(monkeypatch):
    import pyarrow as pa

    from rinkframe.llm import words

    texts = ["alpha beta " * 9, "x" * 50, "", " gamma", "delta\n" * 20, "y"]
    data, at = arrow_bytes(pa.array(texts))
    whole = word_hashes(data, at)
    monkeypatch.setattr(words, "HASH_BYTES", 16)
    parts = word_hashes(data, at)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert words.slices(at, 60) == [(0, 1), (1, 4), (4, 5), (5, 6)]


@pytest.mark.parametrize("width,per_cent", [(3, 90), (5, 80)])
def test_copies_that_differ_alike(spark, width, per_cent):
    """Classes too far from the leader to link with it, some of which link with one another or with the leader's own."""
    rng = np.random.default_rng(per_cent)
    words = [f"w{i}" for i in range(3000)]

    def edited(text, n):
        out = list(text)
        for k in rng.integers(0, len(out), n):
            out[k] = str(rng.choice(words))
        return out

    hub = list(rng.choice(words, 150))
    copies = [edited(hub, int(rng.integers(0, 11))) for _ in range(110)]
    copies += [edited(copies[int(rng.integers(0, 110))], int(rng.integers(1, 3))) for _ in range(60)]
    far = edited(hub, 30)
    copies += [edited(far, int(rng.integers(0, 7))) for _ in range(40)]
    rows = [(i, " ".join(c)) for i, c in enumerate(copies)]
    want = by_hand(rows, width, per_cent)
    groups = {w[2] for w in want}
    assert 5 < len(groups) < len(rows) - 30
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width, per_cent=per_cent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)


def test_keep_one_of_each_group_without_ids_of_its_own(spark):
    text = lambda k, n: " ".join(f"{k}{i}" for i in range(60)) + f" end{n}"
    rows = [(None, text("a", 0)), (None, text("a", 1)), (None, text("b", 0)), (None, text("b", 1)), (7, text("c", 0)), (8, text("c", 1)), (7, text("d", 0)), (9, text("d", 1)), (None, text("e", 0)), (None, text("f", 0)), (None, text("f", 0))]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text[0]) for r in kept) == [("7", "c"), ("7", "d"), ("None", "a"), ("None", "b"), ("None", "e"), ("None", "f")]
