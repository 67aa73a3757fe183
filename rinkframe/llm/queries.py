"""Queries of this subpackage's operators for the driver, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, divergence, exact_dedup, jaccard, lattice_lm, merkle, mixing, packing, piece_codec, quality, suffix_dedup, token_shards, warc
from . import storage

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    return token_shards.read(token_shards.write(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.verdicts(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    out = storage.table(chat.format_paths(chat.chains(turns)), "formatted")
    turn_text = F.array_join(F.transform(chat.parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss"))
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size(chat.parse_turns(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(turn_text, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.near_duplicates(read(spark, sf_dir, "documents"), width=3, per_cent=90)
    return out.select("doc_id", "n_shingles", "component_id")


def op7_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lattice_lm.score(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.classify(read(spark, sf_dir, "pages"))
    table = warc.read(warc.write(warc.chunks(records)), with_data=False)
    return table.where("last").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_classes(read(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.assign(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    out = piece_codec.decode(piece_codec.encode(read(spark, sf_dir, "documents"), path), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    shown = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(read(spark, sf_dir, "documents"), shown={"text": shown})


def _merkle_sql(levels: int = 18) -> str:
    """The manifest level by level, for up to 3 ** levels rows of a source, and sources."""
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"
    row = lambda text: "sha256(" + " || ".join(map(part, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    # CRC-32, a bit at a time, the lowest bit of a byte first.
    bits = "flatten(list_transform(range(length(k)), lambda i: list_transform(range(8), lambda b: (ascii(substr(k, i + 1, 1)) >> b) & 1)))"
    crc = f"list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b) & 1)), 4294967295::BIGINT)"
    out = f"""WITH d AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN 1 ELSE 1 - xor({crc.replace("(k", "(CAST(doc_id AS VARCHAR)")}, 4294967295::BIGINT) % 2 END AS even FROM documents
), h AS (
  SELECT doc_id, source, {row("text")} AS leaf, CASE WHEN doc_id IS NOT NULL AND even = 1 THEN {row("replace(text, chr(10), '')")} ELSE {row("text")} END AS shown FROM d
), s0 AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, leaf, shown AS cur, '' AS proof, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM h
), n0 AS MATERIALIZED (SELECT tree, idx, leaf AS h FROM s0)"""
    for k in range(2 * levels):
        if k == levels:
            # The subroots become the leaves of one tree.
            out += f""", sub AS MATERIALIZED (SELECT tree, h AS subroot FROM n{k})
, s{k}t AS MATERIALIZED (SELECT row, cur, proof, CAST(0 AS BIGINT) AS tree, tree AS idx FROM s{k}), n{k}t AS MATERIALIZED (SELECT CAST(0 AS BIGINT) AS tree, tree AS idx, h FROM n{k})"""
        top = "t" if k == levels else ""
        out += f"""
, r{k} AS MATERIALIZED (SELECT tree, idx // 3 AS up, list(h ORDER BY idx) AS hs, any_value(c) AS c FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM n{k}{top}) GROUP BY ALL)
, n{k + 1} AS MATERIALIZED (SELECT tree, up AS idx, CASE WHEN c = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM r{k})
, s{k + 1} AS MATERIALIZED (
  SELECT row, {"doc_id, leaf, " if k < levels else ""}tree, up AS idx, CASE WHEN c = 1 THEN proof ELSE proof || pre || post END AS proof, CASE WHEN c = 1 THEN cur ELSE sha256(pre || cur || post) END AS cur
  FROM (SELECT s.*, up, c, array_to_string(hs[:idx % 3], '') AS pre, array_to_string(hs[idx % 3 + 2:], '') AS post FROM s{k}{top} s JOIN r{k} r ON r.tree = s.tree AND r.up = s.idx // 3))"""
    return out + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = h AS verified
FROM s{levels} a JOIN sub ON sub.tree = a.tree JOIN s{2 * levels} f ON f.row = a.row CROSS JOIN n{2 * levels}
"""


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_shards": op3_token_shards,
    "op4_chat_format": op4_chat_format,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_lattice_score": op7_lattice_score,
    "op8_warc": op8_warc,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_piece_codec": op11_piece_codec,
    "op12_source_divergence": op12_source_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op4_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(15 + length(regexp_replace(role, '([\\#<:])', '..', 'g')) + length(regexp_replace(text, '([\\#<])', '..', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""",
    "op8_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    max(page_id) OVER (PARTITION BY html) AS response_id FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND response_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND response_id <> page_id THEN response_id END AS refers_to
FROM p
""",
    "op9_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm, length(raw) AS n,
    first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER w AS place
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(raw) DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
""",
    "op10_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CASE rank % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight FROM s
), o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    coalesce(sum(3e0 * source_size) OVER p, 0) AS full_before, coalesce(sum(weight) OVER p, 0) AS weight_before
  FROM w WINDOW p AS (ORDER BY 3e0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min((total - full_before) / (all_weight - weight_before), 3e0 * source_size / weight) AS level FROM o
  WHERE weight * (total - full_before) / (all_weight - weight_before) <= 3e0 * source_size
), t AS (
  SELECT source, source_size, least(weight * (SELECT level FROM l), 3e0 * source_size) AS target FROM w
), r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0e0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT r.*, seed, CAST((floor(rate) + CASE WHEN
    CAST(('0x' || substr(md5(seed || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12)) AS BIGINT) / 281474976710656e0 < rate - floor(rate)
    THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
  FROM r CROSS JOIN range(16) AS seeds(seed)
), b AS (
  SELECT source, seed, row_number() OVER (PARTITION BY source ORDER BY abs(CAST(sum(taken) AS DOUBLE) - target), seed) AS place FROM k GROUP BY source, seed, target
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken
FROM k JOIN b ON k.seed = b.seed AND k.source IS NOT DISTINCT FROM b.source AND b.place = 1
""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, row_number() OVER () AS row FROM documents
), o AS (
  SELECT lang, source, row, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS df FROM o GROUP BY ALL
), k AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(df) >= 30
), v AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang
), g AS (
  SELECT lang, source, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
), f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, g.v FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), t AS (
  SELECT lang, source, sum(n) AS total FROM f GROUP BY ALL
), p AS (
  SELECT f.*, 1 + (1000000000::HUGEINT * (n + 5)) // (t.total + 5 * f.v)::HUGEINT AS p FROM f JOIN t USING (lang, source)
), q AS (
  SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.v)::HUGEINT AS q FROM k JOIN v USING (lang)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(x.p - y.p)) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), term AS (
  SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), r AS (
  SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM pair
  UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM term
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
    "op13_merkle_manifest": _merkle_sql(),
}
