import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rinkframe.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def grow(nodes):
    """Levels of a tree, by the definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + 3]) for i in range(0, len(now), 3)])
    return levels


def climb(levels, at, node):
    proof = ""
    for level in levels[:-1]:
        low = at - at % 3
        left, right = level[low:at], level[at + 1 : low + 3]
        proof += "".join(left + right)
        node = h(*left, node, *right)
        at //= 3
    return proof, node


def by_hand(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees.append(grow([x[2] for x in groups[s]]))
    top, out = grow([t[-1][0] for t in trees]), []
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(groups[s]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            proof, node = climb(trees[k], i, leaf(r, r[4].replace("\n", "")) if bad else own)
            more, node = climb(top, k, node)
            out.append((r[0], own, trees[k][-1][0], top[-1][0], h(proof + more), node, node == top[-1][0]))
    return sorted(out, key=str)


def rows_of(sizes, seed):
    rng = random.Random(seed)
    rows = []
    for s, n in sizes.items():
        for _ in range(n):
            i = rng.randrange(-50, 100000)
            rows.append((i, s, rng.choice(["en", "", None]), rng.choice([None, 7, -3]), rng.choice([None, "", f"a\nb {i}", "é\n\n", f"plain {i}"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3}, {"a": 4, None: 1}, {"a": 81, "b": 82, "": 80, None: 243}, {"hot": 700, "é": 28, "z": 1} | {f"s{i:03d}": i % 5 + 1 for i in range(100)}], ids=str)
def test_query_against_definition(spark, tmp_path, sizes):
    rows = rows_of(sizes, len(sizes))
    if len(rows) > 100:
        rows += [(5, "a", "en", 1, "same\n")] * 40 + [(None, "a", None, None, None), (None, None, None, None, "x\n"), (6, "a", "en", 1, "y" * 50000 + "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("leaf", F.lit("clash")).withColumn("row", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == by_hand(rows)


def test_untampered_is_verified_and_empty_table(spark):
    docs = spark.createDataFrame(rows_of({"a": 30, "b": 2}, 1), "doc_id long, source string, lang string, n_chars long, text string")
    out = merkle.manifest(docs).collect()
    assert len(out) == 32 and all(r.verified for r in out) and len({r.root for r in out}) == 1 and len({r.subroot for r in out}) == 2
    assert merkle.manifest(docs.limit(0)).count() == 0
