from collections import Counter

import numpy as np
import pytest

from rinkframe.llm import suffix_dedup as sd


def by_hand(texts):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + 400] for d in datas for p in range(len(d) - 399))
    out = []
    for d in datas:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - 399):
            if seen[d[p : p + 400]] > 1:
                gone[p : p + 400] = True
        out.append((len(d), sd.runs(gone), d if not gone.any() else bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def corpus(rng):
    word = lambda n: " ".join("".join(rng.choice(list("abcdeé"), 4)) for _ in range(n))
    a, b, c = word(150), word(90), word(400)
    texts = [a + word(20), word(30) + a + word(5), word(10) + a, a[:399], word(3) + a[:300], b + "x" + b, c, c, c[:900] + "!" + c[901:], word(50) + c[300:1400]]
    texts += [word(100) + b[k : k + 420] + word(60) for k in range(0, 12)] + ["z" * 3000, "zy" * 900, "y" + "z" * 401, None, "", "short", c[:400], c[1:401]]
    return texts + [word(int(rng.integers(80, 300))) for _ in range(20)]


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, b"") for i, t in enumerate(texts)], "doc_id long, text string, data binary")
    got = {r.doc_id: (r.n_bytes, [(x.start, x.end) for x in r.removed], bytes(r.kept)) for r in sd.remove_repeats(docs).collect()}
    want = by_hand(texts)
    for i, w in enumerate(want):
        assert got[i] == w, i


@pytest.mark.parametrize("bucket,group", [(256, 1 << 20), (3, 3000)])
def test_against_brute_force(spark, monkeypatch, bucket, group):
    monkeypatch.setattr(sd, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(sd, "GROUP_BYTES", group)
    check(spark, corpus(np.random.default_rng(bucket)))


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 700)
    check(spark, corpus(np.random.default_rng(5)))


@pytest.mark.parametrize("bucket", [256, 1])
def test_lone_passages_that_repeat_themselves(spark, monkeypatch, bucket):
    monkeypatch.setattr(sd, "BUCKET_ROWS", bucket)
    rng = np.random.default_rng(8)
    word = lambda n: " ".join("".join(rng.choice(list("abcde"), 4)) for _ in range(n))
    line = word(12) + "\n"
    check(spark, ["a" * 500, "b" * 401, "c" * 400, word(90) + "=" * 600 + word(90), word(40) + line * 8, (word(24) + "\n") * 7, word(30) + (word(39) + "\n") * 4, word(200)])


def test_hot_runs_of_several_lengths(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_ROWS", 1)
    rng = np.random.default_rng(11)
    word = lambda n: " ".join("".join(rng.choice(list("abcde"), 4)) for _ in range(n))
    check(spark, [word(90) + "=" * n + word(90) for n in (399, 400, 401, 450, 600, 601, 700, 700, 1500)] + ["-" * 400, "-" * 402, word(100)])


def test_merge_finds_repeated_windows():
    rng = np.random.default_rng(0)
    base = bytes(rng.choice(list(b"ab"), 3000))
    strings = [base[i : i + int(n)] for i, n in zip(rng.integers(0, 2000, 30), rng.integers(10, 900, 30), strict=True)] + [b"", b"a" * 500]
    weights = rng.integers(1, 3, len(strings))
    seen = Counter()
    for s, w in zip(strings, weights, strict=True):
        for p in range(len(s) - 399):
            seen[s[p : p + 400]] += int(w)
    for s, flags in zip(strings, sd.repeated_windows(strings, weights), strict=True):
        assert flags.tolist() == [seen[s[p : p + 400]] > 1 for p in range(len(s) - 399)]


@pytest.mark.parametrize("span", [400, 48])
def test_common_prefixes_against_brute_force(span):
    rng = np.random.default_rng(span)
    base = bytes(rng.choice(list(b"abc"), 2000))
    strings = [base[i : i + int(n)] for i, n in zip(rng.integers(0, 1500, 24), rng.integers(1, 600, 24), strict=True)] + [b"", b"q" * 200, bytes(rng.choice(list(b"xyz"), 500))]
    weights = rng.integers(1, 3, len(strings))
    seen = Counter()
    for s, w in zip(strings, weights, strict=True):
        for p in range(len(s)):
            for k in range(16, min(span, len(s) - p) + 1, 16):
                seen[s[p : p + k]] += int(w)
    for s, got in zip(strings, sd.common_prefixes(strings, weights, span), strict=True):
        assert got.tolist() == [max([k // 16 for k in range(16, min(span, len(s) - p) + 1, 16) if seen[s[p : p + k]] > 1], default=0) for p in range(len(s))]


def test_intervals_hold_equal_prefixes():
    rng = np.random.default_rng(2)
    base = bytes(rng.choice(list(b"ab"), 400))
    strings = [base[k : k + 200] for k in (0, 30, 60, 250)]
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    ranks, cut = sd._ranks(data, ends, sizes), int(ends[1])
    shards = sd.Shard(ranks[:cut], (ends - sizes)[:2], ends[:2], 3), sd.Shard(ranks[cut:], (ends - sizes)[2:] - cut, ends[2:] - cut, 3)
    common, rows, block = sd.merge(*shards, 3)
    by_string = {}
    for r, b in zip(rows.tolist(), block.tolist(), strict=True):
        by_string.setdefault(bytes(data[r : r + 48]), set()).add(b)
    assert sorted(rows.tolist()) == np.flatnonzero(common == 3).tolist()
    assert all(len(b) == 1 for b in by_string.values()) and len(set.union(*by_string.values())) == len(by_string)


@pytest.mark.parametrize("bound", [1, 7, 1 << 40, 1 << 62])
def test_order_is_stable_with_and_without_packing(bound):
    keys = np.random.default_rng(3).integers(0, bound, 1000) // 3 * 3 // max(bound // 50, 1)
    assert sd._order(keys, bound).tolist() == np.argsort(keys, kind="stable").tolist()
    assert sd._order(keys[:0], bound).tolist() == []


def test_groups_are_sorted_with_their_places(monkeypatch):
    rng = np.random.default_rng(4)
    base = bytes(rng.choice(list(b"abc"), 3000))
    strings = [base[i : i + 700] for i in range(0, 2000, 90)] + [b"short", bytes(rng.choice(list(b"xyz"), 900))]
    seen = Counter(s[p : p + 400] for s in strings for p in range(len(s) - 399))

    def slow(*_, **__):
        raise AssertionError("sorted by argsort")

    # Stable argsorts, one a pass, were more than half of the operator's CPU seconds.
    monkeypatch.setattr(np, "argsort", slow)
    found = sd.repeated_windows(strings, np.ones(len(strings), np.int64))
    for s, flags in zip(strings, found, strict=True):
        assert flags.tolist() == [seen[s[p : p + 400]] > 1 for p in range(len(s) - 399)]


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
