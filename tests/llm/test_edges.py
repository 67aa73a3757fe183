"""Every operator and stage on tables that hold nothing but nulls, blanks, short texts or one row again and again."""

import sys
from pathlib import Path

import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from rinkframe.llm import chat, divergence, exact_dedup, jaccard, lattice_lm, merkle, mixing, packing, piece_codec, quality, suffix_dedup, token_shards, warc  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(400))


def rows(*texts, source="s"):
    return [(i, t, "en", source, 1) for i, t in enumerate(texts)]


TABLES = {
    "nulls": [(None, None, None, None, None)] * 3 + [(1, None, "en", None, None)],
    "blanks": rows("", " ", "\n\t", "   \n"),
    "shorts": rows("a", "a", "a b", "b a", "one two three", "one two three"),
    "many of one row": [(7, LONG[:300], "en", "s", 1)] * 3000,
}


def frames(spark, few=False):
    """The tables by name; few: without the repeated row and the very long texts."""
    for name, data in TABLES.items():
        if not few or len(data) < 100:
            yield name, spark.createDataFrame(data, SCHEMA)
    # A partition of blank rows beside a full one, and a very long text.
    blank = spark.createDataFrame(rows("", None, " ", "x"), SCHEMA).coalesce(1)
    full = spark.createDataFrame([(100 + i, f"{LONG} {i // 2}", "de", "t", 1) for i in range(8)], SCHEMA).coalesce(1)
    yield "blank beside full", blank.unionByName(full)
    if few:
        return
    yield "long", spark.createDataFrame([(1, LONG * 300, "en", "s", 1), (2, "x" * 300_000, "en", "s", 1), (3, "ab\n" * 100_000, "en", None, 1)], SCHEMA)


BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: What gives one row a document.
PER_DOCUMENT = {
    "quality": quality.verdicts,
    "token_shards": lambda d: token_shards.read(token_shards.write(d, BPE)),
    "suffix_dedup": suffix_dedup.remove_repeats,
    "jaccard 90": lambda d: jaccard.near_duplicates(d, width=3, per_cent=90),
    "lattice_lm": lambda d: lattice_lm.score(d, PIECES),
    "exact_dedup": exact_dedup.duplicate_classes,
    "mixing": mixing.assign,
    "piece_codec": lambda d: piece_codec.decode(piece_codec.encode(d, PIECES), PIECES),
    "merkle": merkle.manifest,
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_a_document(spark, name):
    for label, docs in frames(spark, few=name in ("quality", "jaccard 90", "lattice_lm")):
        assert PER_DOCUMENT[name](docs).count() == docs.count(), label


def test_near_duplicates_among_short_texts(spark):
    by_id = lambda data, **k: {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(data, SCHEMA), **k).collect()}
    for k in ({"width": 3, "per_cent": 90}, {"width": 5, "per_cent": 80}):
        assert by_id(TABLES["shorts"], **k) == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4}
        assert by_id(TABLES["blanks"], **k) == {0: 0, 1: 1, 2: 2, 3: 3}
    kept = jaccard.keep_one(spark.createDataFrame(TABLES["shorts"], SCHEMA)).collect()
    assert sorted(r.text for r in kept) == ["a", "a b", "b a", "one two three"]
    assert jaccard.keep_one(spark.createDataFrame(TABLES["nulls"], SCHEMA)).count() == 4


def test_packing_and_divergence(spark):
    for label, docs in frames(spark, few=True):
        words = docs.selectExpr("coalesce(sum(size(array_remove(split(coalesce(text, ''), '[ \\\\t-\\\\r]+'), ''))), 0)").first()[0]
        assert packing.pack(docs).agg({"n_words": "sum"}).first()[0] in ((words,) if words else (None, 0)), label
        assert divergence.audit(docs, least=1).where("part = 'pair'").count() == docs.selectExpr("coalesce(lang, '') l", "coalesce(source, '') s").distinct().groupBy("l").count().selectExpr("coalesce(sum(count * (count - 1)), 0)").first()[0], label


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:4]])
def test_stages(spark, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    for label, docs in frames(spark, few=True):
        out = run(spark, docs, "")
        assert out.columns == docs.columns and out.count() <= 3 * docs.count(), label


def test_conversations(spark):
    turns = "conv_id long, turn long, role string, text string"
    for data in ([(None, None, None, None)] * 3, [(1, 0, "user", None)], [(1, k, "user" if k % 2 == 0 else "assistant", "") for k in range(5)], [(2, 0, "assistant", "y" * 200_000)], [(3, k, "user", f"t{k}") for k in range(600)]):
        out = chat.format_paths(chat.chains(spark.createDataFrame(data, turns))).collect()
        assert len(out) == len({d[0] for d in data})
        assert sum(len(r.formatted) for r in out) >= sum(len(d[3] or "") for d in data)


def test_pages(spark):
    schema = "page_id long, url string, html string"
    for data in ([(None, None, None)] * 2, [(k, "u", "") for k in range(3)], [(k, "u", "z" * 1500) for k in range(500)], [(1, None, "é" * 500_000)]):
        out = warc.read(warc.write(warc.chunks(warc.classify(spark.createDataFrame(data, schema)))), with_data=False)
        assert out.where("last").count() == len(data)
