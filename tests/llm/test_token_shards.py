import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rinkframe.llm import token_shards

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["plain words here", "", None, " lead", "trail ", "two  spaces", "a\nb \n c", "<|endoftext|> x <|endoftext|>", "don't  'll 'll it's", "Ñandú  x y 　z", "\t\t", "émoji 🙂 🙂", "word " * 5000]


def direct(text):
    return np.array(Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_shards_against_direct_encoding(spark):
    rows = [(i * 7 % 1000 - 50, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no key", "x"), (None, "another", "x"), (3, "same", "x"), (3, "same", "x"), (3, "other", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = token_shards.read(token_shards.write(docs, FILE)).collect()
    want, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = direct(t)
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_shards_grow_with_the_texts_and_keyless_rows_spread(spark, monkeypatch):
    monkeypatch.setattr(token_shards, "SHARD_BYTES", 300)
    rows = [(None, f"{chr(97 + i % 26)} keyless {i}") for i in range(300)] + [(i // 3, f"keyed {i}") for i in range(300)]
    manifest = token_shards.write(spark.createDataFrame(rows, "doc_id long, text string"), FILE)
    shards = manifest.orderBy("shard").collect()
    assert len(shards) > 12 and sum(s.n_docs for s in shards) == 600 and max(s.n_docs for s in shards) < 150
    assert sum(s.last_key is None for s in shards) > 2, "shards of keyless rows alone"
    got = sorted(map(tuple, token_shards.read(manifest).collect()), key=lambda r: r[1])
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = direct(t)
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_index_knows_absent_keys():
    keys = np.arange(0, 40000, 4, dtype=np.int64) - 999
    index = token_shards.Index.from_bytes(token_shards.Index(keys, 0, np.arange(len(keys) + 1)).to_bytes())
    first, n = index.lookup(keys)
    assert (first == np.arange(len(keys))).all() and (n == 1).all()
    assert not index.lookup(keys + 1)[1].any()
    assert sum(x.sum() for x in index.hash.bits) == len(keys)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_shards.read(token_shards.write(docs, FILE)).count() == 0


def encoded(texts, file):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    ids, many = token_shards.Encoder(file, "<u4").encode(data, offsets, 0)
    return [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    file = public_tokenizers.path(name)
    whole = Tokenizer.from_file(file)
    rng = np.random.default_rng(5)
    atoms = [" ", " ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u1680", "a", "B", "é", "à", "’", "'s", "12", "<|endoftext|>", "漢", "🙂", "-", "word", "voilà"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(atoms, int(rng.integers(0, 40)))) for _ in range(3000)] + ["a-\x1c-b -\x1d-"]
    got = encoded(texts, file)
    want = [e.ids + [0] for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert encoded(["", ""], file) == [[0], [0]]


def test_cuts_only_where_the_file_allows():
    assert token_shards.cuts_at_spaces(FILE)
    assert len(token_shards.lone_spaces(np.frombuffer("a b  c\u00a0 d\ne f\u2003 g".encode(), np.uint8))) == 3


def test_get_by_key(spark):
    rows = [(i * 3, f"document number {i}") for i in range(400)] + [(9, "again"), (None, "no key")]
    manifest = token_shards.write(spark.createDataFrame(rows, "doc_id long, text string"), FILE)
    keys = spark.createDataFrame([(i,) for i in [*range(-5, 1300), None, 9, 10**12]], "k long")
    got = token_shards.get(manifest, keys, "k").collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((i, direct(t).tolist()) for i, t in rows if i is not None)
