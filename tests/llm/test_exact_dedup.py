import hashlib
import re

import numpy as np

from rinkframe.llm import exact_dedup


def test_filters_keep_all_prints_and_counts():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    counts = rng.integers(1, 4, len(prints))
    for block in range(16):
        mine = prints >> np.uint64(60) == block
        got = exact_dedup.unpack_filter(exact_dedup.pack_filter(prints[mine], counts[mine], 4), block, 4)
        assert (got[0] == prints[mine]).all() and (got[1] == counts[mine]).all()
    merged = exact_dedup.merge_counts([(prints[::2], counts[::2]), (prints, counts)])
    assert (merged[0] == prints).all() and merged[1].sum() == counts[::2].sum() + counts.sum()


def test_classes_against_brute_force(spark):
    rng = np.random.default_rng(2)
    texts = ["a b", "ab", "a  b\n", None, "", " \t", "x", "long " * 4000, "é　é", "é é", "\x1c"]
    rows = [(int(i), texts[int(k)], "z") for i, k in zip(rng.integers(0, 50, 80), rng.integers(0, len(texts), 80), strict=True)] + [(None, "ab", "z"), (None, "only", "z"), (None, "only", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = sorted(((i, min(groups[norm(t)], key=lambda g: g[:3])[3], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, _ in rows), key=str)
    got = exact_dedup.duplicate_classes(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    rest = exact_dedup.drop_duplicates(docs)
    assert rest.columns == docs.columns
    assert sorted(((r.doc_id, norm(r.text)) for r in rest.collect()), key=str) == sorted(((min(g, key=lambda x: x[:3])[3], t) for t, g in groups.items()), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.duplicate_classes(docs).count() == 0 and exact_dedup.drop_duplicates(docs).count() == 0
