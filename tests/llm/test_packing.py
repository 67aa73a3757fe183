import numpy as np

from rinkframe.llm import packing


def plain(sizes, sources, clusters, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(left, k) for k, (left, ss, cc) in enumerate(bins) if left >= size and s not in ss and (c < 0 or c not in cc)]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append((capacity, set(), set()))
        left, ss, cc = bins[k]
        bins[k] = (left - size, ss | {s}, cc | {c})
        out.append(k)
    return out, len(bins)


def test_bins_against_brute_force():
    rng = np.random.default_rng(3)
    for n_sources, n_clusters in ((3, 2), (100, 200), (1, 1), (20, 70)):
        sizes = np.sort(rng.integers(0, 101, 600))[::-1]
        sources, clusters = rng.integers(0, n_sources, 600), rng.integers(-1, n_clusters, 600)
        got, n = packing.pack_group(sizes, sources, clusters, 100)
        assert (got.tolist(), n) == plain(sizes.tolist(), sources.tolist(), clusters.tolist(), 100)


def test_pieces_and_edge_cases(spark):
    texts = {1: "a " * 250, 2: "b " * 100, 3: None, 4: "", 5: "c " * 40, 6: "d " * 50, 7: " d" * 50, 8: "e " * 60}
    rows = [(i, t, "s" if i in (5, 8) else f"s{i}", 0) for i, t in texts.items()] + [(None, "x y", None, 0), (None, "x y", None, 0), (9, "q", "s9", 0), (9, "q", "s9", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = packing.pack(docs, capacity=100).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_words
        assert r.first_word == r.piece * 100 and r.bin_words == sum(x.n_words for x in got if x.bin_id == r.bin_id) <= 100
    assert total == {1: 250, 2: 100, 3: 0, 4: 0, 5: 40, 6: 50, 7: 50, 8: 60, None: 4, 9: 2}
    of = {(r.doc_id, r.piece): r.bin_id for r in got}
    assert of[5, 0] != of[8, 0], "one source"
    assert of[6, 0] != of[7, 0], "equal texts"
    assert len([r for r in got if r.doc_id == 1]) == 3 and of[2, 0] not in [b for k, b in of.items() if k != (2, 0) and k[0] not in (3, 4)]
    assert len({r.bin_id for r in got if r.doc_id == 9}) == 2
    assert packing.pack(docs.limit(0)).count() == 0
    assert sorted(map(str, packing.pack(docs, capacity=100).collect())) == sorted(map(str, got))
