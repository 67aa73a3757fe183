import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from rinkframe.llm import piece_codec, queries

FILE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  ", " ", "\n", "\t", "\r\n", "é", "梦", "🙂", "\x00", "aaa", "       ", "▁", "<s>", "<0x0A>", "\U0010ffff", "Ａ", "123", "=="]
TEXTS = ["plain words here", "", None, " lead", "trail ", "two  spaces", "a\nb \n c", "<s> x </s> <unk>", "don't", "Ñandú 　z", "\t\t", "🙂 🙂", "word " * 5000, "a" * 9000, " " * 9001 + "x", "ab" * 6000, "的我" * 4000]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=FILE)


@pytest.fixture(scope="module")
def codec():
    with open(FILE, "rb") as f:
        return piece_codec.Codec(f.read())


def mixtures(codec, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(codec.names) if rng.random() < 0.7 else rng.choice(ODD) for _ in range(rng.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize("long_text,window,together", [(1 << 22, 1 << 12, 1 << 18), (40, 8, 64)])
def test_ids_against_the_library(monkeypatch, codec, library, long_text, window, together):
    """With small limits, texts are cut into segments, and parts go through windows."""
    for name, value in (("LONG", long_text), ("WINDOW", window), ("TOGETHER", together)):
        monkeypatch.setattr(piece_codec, name, value)
    codec.forget()
    texts = [t or "" for t in TEXTS] + mixtures(codec, 3000, window)
    flat, ends = codec.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == library.encode(texts, num_threads=1)


def test_forgetting_changes_nothing(monkeypatch, codec, library):
    monkeypatch.setattr(piece_codec, "KEPT", 5)
    monkeypatch.setattr(piece_codec, "KEPT_PAIRS", 5)
    for text in mixtures(codec, 200, 3):
        assert codec.encode([text])[0].tolist() == library.encode(text)


def test_pieces_before_a_position_are_unique(codec):
    """Of all ways to cut short texts into pieces, one at most has compatible neighbours, the library's."""

    def ways(text, left):
        if not text:
            yield []
        for end in range(1, len(text) + 1):
            piece = text[:end]
            if (end == 1 or piece in codec.numbers) and codec.compatible(codec.number(left) << 21 | codec.number(piece) if left else codec.number(piece)):
                yield from ([piece, *rest] for rest in ways(text[end:], piece))

    for text in ("▁hello", "▁▁▁▁abcab", "▁internationally", "aaaaaaa", "▁xyzzyx"):
        assert list(ways(text, "")) == [codec.merged(text)]


def test_query_and_edge_cases(spark, tmp_path, library):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(None, "no key", "x", "y"), (3, "same", "x", "y"), (3, "same", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _, _ in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, queries.op11_piece_codec(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
    assert piece_codec.decode(piece_codec.encode(docs.limit(0), FILE), FILE).count() == 0
    keyed = spark.createDataFrame([("k", None)], "key string, said string")
    assert piece_codec.decode(piece_codec.encode(keyed, FILE, "key", "said"), FILE).collect()[0] == ("k", [], "")
