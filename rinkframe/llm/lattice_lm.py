"""Language-model scores: the marginal probability of a text over all its segmentations.

A word may be read as any sequence of pieces of an existing subword vocabulary, and
as a whole if it was seen in training. Pieces have the weights of the vocabulary's own
scores; a forward recursion in logarithms adds up the products of the pieces'
probabilities over all segmentations (lattice). P(word) = c / (N + V) + V / (N + V) *
lattice (c: count in training, N: all, V: distinct tokens). A text's probability is the
product over its words and one end: `score` by P, `lattice_score` by the lattice alone.
With rounds above 0 the pieces' weights are first fitted by as many rounds of expectation
and maximisation over the distinct training words.

Texts are encoded block by block with a dictionary of the block's words. Only
dictionaries are shuffled: by word, to count and score each word, and back by block,
so that no task holds more than one block's words.

Defined cases: a null text has the end as its only token; a null doc_id counts as the
empty text, which is in training; rows that repeat are counted and scored each; without
training texts N and V are 0; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import storage
from .words import LOWER

#: Tokens in a block, about; a longer text is a block of its own.
BLOCK_TOKENS = 1 << 22
#: Words of blocks in a shuffle partition, about.
PART_WORDS = 1 << 18
#: What each piece counts for before it is fitted.
PRIOR = 0.1
#: Units of an expected count, so that sums are of integers and runs agree.
UNIT = 1 << 20
START = "▁"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class Lattice:
    """Pieces with natural logarithms of their probabilities; prefixes of pieces have None."""

    def __init__(self, pieces: list[str], log_p: np.ndarray):
        """pieces: the 256 single bytes as <0x00> to <0xFF> among them."""
        self.table: dict[str, tuple[int, float] | None] = {}
        for k, (piece, p) in enumerate(zip(pieces, log_p.tolist(), strict=True)):
            for n in range(1, len(piece)):
                self.table.setdefault(piece[:n], None)
            self.table[piece] = (k, p)
        self.byte = [self.table[f"<0x{b:02X}>"] for b in range(256)]

    def arcs(self, word: str) -> list[list[tuple[int, int, float]]]:
        """For each place, the pieces that begin there: (end, piece, log probability)."""
        table, out = self.table, []
        missing = (0,)
        for i in range(len(word)):
            here = []
            for j in range(i + 1, len(word) + 1):
                entry = table.get(word[i:j], missing)
                if entry is missing:
                    break
                if entry is not None:
                    here.append((j, entry[0], entry[1]))
            if not here or here[0][0] != i + 1:
                # A character without a piece is spelled in bytes, which are one way on.
                here.append((i + 1, -1 - i, sum(self.byte[b][1] for b in word[i].encode("utf-8", "surrogatepass"))))
            out.append(here)
        return out

    def forward(self, word: str) -> float:
        """Logarithm of the sum over all segmentations of START + word."""
        word = START + word
        into: list[list[float]] = [[] for _ in range(len(word) + 1)]
        into[0].append(0.0)
        for i, here in enumerate(self.arcs(word)):
            a = _log_sum(into[i])
            for j, _, p in here:
                into[j].append(a + p)
        return _log_sum(into[-1])

    def expect(self, word: str, counts: dict[int, float]) -> None:
        """Add the expected number of each piece in START + word."""
        word = START + word
        arcs, n = self.arcs(word), len(word)
        a, into = [0.0] * (n + 1), [[] for _ in range(n + 1)]
        into[0].append(0.0)
        for i, here in enumerate(arcs):
            a[i] = _log_sum(into[i])
            for j, _, p in here:
                into[j].append(a[i] + p)
        whole = _log_sum(into[n])
        b = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            b[i] = _log_sum([p + b[j] for j, _, p in arcs[i]])
            for j, k, p in arcs[i]:
                share = math.exp(a[i] + p + b[j] - whole)
                if k >= 0:
                    counts[k] = counts.get(k, 0.0) + share
                else:
                    for x in word[i].encode("utf-8", "surrogatepass"):
                        counts[self.byte[x][0]] = counts.get(self.byte[x][0], 0.0) + share


def _log_sum(terms: list[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    if not terms:
        return -math.inf
    top = max(terms)
    return top + math.log(sum([math.exp(t - top) for t in terms])) if top > -math.inf else top


def vocabulary(model_file: str) -> tuple[list[str], np.ndarray]:
    """Pieces of a sentencepiece file and weights from their scores, which fall with the rank.

    Single bytes have no rank of their own (their score is 0, the first rank's) and weigh as the last piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    rank = -np.minimum([model.get_score(i) for i in ids], 0.0)
    byte = np.array([model.is_byte(i) for i in ids])
    # A rank is less than the number of pieces; what lies beyond is a mark of the file for pieces that merges do not reach.
    rank[byte] = rank[~byte & (rank < len(ids))].max(initial=0.0)
    weight = 1.0 / (2.0 + rank)
    return [model.id_to_piece(i) for i in ids], np.log(weight / weight.sum())


def _blocks(docs: DataFrame) -> DataFrame:
    """Encoded texts: block, n_words (distinct), ids, sizes, tokens (local numbers of words), words, counts (in training)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ids, sizes, chunks, index, train, n = [], [], [], {}, [], 0

        def emit() -> pa.RecordBatch:
            tokens = np.concatenate(chunks) if chunks else np.empty(0, "<u4")
            held = np.array([held_out(i) for i in ids])
            many = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(index)) if len(tokens) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + made], pa.int64()), pa.array([len(index)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([tokens.tobytes()], pa.binary()), pa.array([list(index)], pa.list_(pa.binary())), pa.array([many.tolist()], pa.list_(pa.int64()))],
                names=["block", "n_words", "ids", "sizes", "tokens", "words", "counts"],
            )

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_buffer().to_pybytes().translate(LOWER).split() if text.is_valid else []
                chunks.append(np.array([index.setdefault(w, len(index)) for w in words], "<u4"))
                ids.append(i)
                sizes.append(len(words))
                n += len(words) + 1
                if n >= BLOCK_TOKENS:
                    yield emit()
                    made += 1
                    ids, sizes, chunks, index, n = [], [], [], {}, 0
        if ids:
            yield emit()

    return docs.mapInArrow(encode, "block long, n_words long, ids array<long>, sizes array<long>, tokens binary, words array<binary>, counts array<long>")


def fit(words: DataFrame, pieces: list[str], log_p: np.ndarray, rounds: int) -> np.ndarray:
    """Fit the pieces to the distinct training words (a binary column word)."""
    for _ in range(rounds):
        start = log_p

        def expect(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            lattice, counts = Lattice(pieces, start), {}
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    lattice.expect(word.decode("utf-8", "surrogateescape"), counts)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array([round(x * UNIT) for x in counts.values()], pa.int64())], names=["piece", "many"])

        # At most one row for each piece of the vocabulary comes to the driver.
        found = words.mapInArrow(expect, "piece long, many long").groupBy("piece").agg(F.sum(F.col("many").cast("decimal(20,0)")).alias("many")).collect()
        many = np.full(len(pieces), PRIOR)
        for row in found:
            many[row["piece"]] += float(row["many"]) / UNIT
        log_p = np.log(many / many.sum())
    return log_p


def score(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", rounds: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score."""
    blocks = storage.table(_blocks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))), "blocks")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "e")).select("block", "at", F.col("e.words").alias("word"), F.col("e.counts").alias("many"))
    # A word has one row per block that holds it, so no key gathers more rows than there are blocks.
    # Partitions grow with the words, so that no task does.
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (blocks.agg(F.sum("n_words")).first()[0] or 0) // PART_WORDS)
    entries, of_word = entries.repartition(parts, "word"), W.partitionBy("word")
    counted = entries.select("block", "at", "word", F.sum("many").over(of_word).alias("c"), (F.row_number().over(of_word.orderBy("block")) == 1).alias("first"))
    counted = storage.table(counted, "counted")
    total = counted.where("first").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    trained = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    ends = blocks.select(F.explode("ids").alias("id")).where(trained).count()
    n, v = int(total["n"]) + ends, int(total["v"]) + (ends > 0)
    pieces, log_p = vocabulary(model_file)
    if rounds:
        log_p = fit(counted.where(F.col("first") & (F.col("c") > 0)).select("word"), pieces, log_p, rounds)

    def model(c: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Base-10 logarithm of c / (n + v) + v / (n + v) * lattice; without training the lattice alone."""
        if not n:
            return lattice / math.log(10)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(c / (n + v)), math.log(v / (n + v)) + lattice) / math.log(10)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, last, value = Lattice(pieces, log_p), None, 0.0
        for batch in batches:
            out = []
            for word in batch.column(2).to_pylist():
                if word != last:
                    last, value = word, lattice.forward(word.decode("utf-8", "surrogateescape"))
                out.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(out, pa.float64())], names=["block", "at", "c", "lattice"])

    # The end is a piece of its own: one in each training text, against all words.
    end_p = float(np.log10(max(ends, 1) / (n + v))) if n else 0.0
    weighed = counted.mapInArrow(weigh, "block long, at int, c long, lattice double").repartition(parts, "block")

    def finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row, size = left.iloc[0], len(right)
        c, lattice = np.zeros(size, np.int64), np.zeros(size)
        c[right["at"]], lattice[right["at"]] = right["c"], right["lattice"]
        tokens, sizes = np.frombuffer(row["tokens"], "<u4"), np.asarray(row["sizes"], np.int64)
        base = np.log10((c + 1) / (n + v + 1))
        full = sizes > 0
        first = (np.cumsum(sizes) - sizes)[full]

        def summed(x: np.ndarray, end) -> np.ndarray:
            out = np.full(len(sizes), end, dtype=np.result_type(x.dtype, type(end)))
            if full.any():
                out[full] += np.add.reduceat(x[tokens], first)
            return out

        ids = list(row["ids"])
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if i is None or i != i else int(i) for i in ids], dtype="Int64"),
                "held_out": [held_out(None if i is None or i != i else int(i)) for i in ids],
                "n_tokens": sizes + 1,
                "n_known": summed((c > 0).astype(np.int64), int(ends > 0)),
                "train_tokens": n,
                "base_score": summed(base, math.log10((ends + 1) / (n + v + 1))),
                "score": summed(model(c, lattice), end_p),
                "lattice_score": summed(lattice / math.log(10), end_p),
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, lattice_score double"
    return blocks.select("block", "ids", "sizes", "tokens").repartition(parts, "block").groupBy("block").cogroup(weighed.groupBy("block")).applyInPandas(finish, schema)
