"""SentencePiece BPE: encoded exactly by backtracking, and decoded with the library.

The library merges the neighbours whose joined piece scores best, the leftmost of equals,
until none is left. A row of pieces is its result if and only if every two neighbours,
merged alone, come out as these two: the first merge across a border would also be the
first across it in the pair alone. So pieces are chosen from left to right: the longest
that an Aho-Corasick automaton finds at the position and that is compatible with the piece
before it (the two are merged anew, and the answer is kept), else the next shorter. Where
none is, the last piece is taken back and a bit notes that its end is a dead position:
what precedes a position is decided by the text alone, so a position fails at most once,
and time is linear in the text.

Texts are cut first where no piece of the vocabulary spans the cut; a worker keeps the
ids of short parts that it has met. A document is one list of ids in memory; positions
are searched in windows, so that beside it only a bit a character is held.

Defined cases: a null text is an empty one, and an empty one has no ids; characters that
no piece has become the ids of their bytes; special strings in a text are plain text;
rows that repeat and null doc_ids are encoded like others; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from .words import arrow_bytes, slices

#: Fixed value: the character that stands for a space.
MARK = "▁"
#: Parts whose ids a worker keeps, ids that it keeps, and pairs of pieces whose answer it keeps.
KEPT, KEPT_IDS, KEPT_PAIRS = 1 << 18, 1 << 22, 1 << 19
#: Characters of new parts, and characters of a text, that are worked on together.
TOGETHER, LONG = 1 << 17, 1 << 21
#: Positions of a very long part whose matches are held together; bytes of texts that are worked on together.
WINDOW, SLICE_BYTES = 1 << 12, 1 << 22
#: Score of what is no piece; bits of a number of a piece, and of a piece's length.
_NONE, _BITS, _LENGTH = float("-inf"), 21, 10


class Windows:
    """Ends and numbers of the pieces that begin at a position of a very long text, found window by window."""

    def __init__(self, codec: Codec, text: str):
        self.codec, self.text, self.held = codec, text, {}

    def __getitem__(self, start: int) -> list[tuple[int, int]]:
        w = start // WINDOW
        if w not in self.held:
            if len(self.held) > 3:
                self.held.pop(max(self.held, key=lambda x: abs(x - w)))
            low = w * WINDOW
            high = min(low + WINDOW, len(self.text))
            # A character alone is always a choice, whether or not it is a piece.
            ends = [[(i + 1, self.codec.number(self.text[i]))] for i in range(low, high)]
            for last, value in self.codec.automaton.iter(self.text, low, min(high + self.codec.longest, len(self.text))):
                begin = last + 1 - (value & (1 << _LENGTH) - 1)
                if begin < high:
                    ends[begin - low].append((last + 1, value >> _LENGTH))
            self.held[w] = ends
        return self.held[w][start % WINDOW]


class Codec:
    """Encoder and decoder of one model file, given as bytes."""

    def __init__(self, model: bytes):
        self.library = SentencePieceProcessor(model_proto=model)
        sp, n = self.library, self.library.get_piece_size()
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(sp.is_byte(int(i)) for i in self.bytes):
            raise ValueError("the model has no pieces for bytes")
        plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
        # Pieces are numbered from one; a character that is no piece has the number after them that its code point gives.
        self.names = ["", *map(sp.id_to_piece, plain)]
        self.numbers = {p: i for i, p in enumerate(self.names) if i}
        self.ids_of = np.array([-1, *plain], np.int32)
        self.score = {p: sp.get_score(i) for p, i in zip(self.names[1:], plain, strict=True)}
        self.longest = max(map(len, self.names))
        self.automaton = ahocorasick.Automaton()
        for p, i in self.numbers.items():
            if len(p) > 1:
                self.automaton.add_word(p, i << _LENGTH | len(p))
        self.automaton.make_automaton()
        self.spanned = {p[i : i + 2] for p in self.names for i in range(len(p) - 1)}
        singles = sorted((ord(p), i) for p, i in self.numbers.items() if len(p) == 1)
        self.single_points, self.single_numbers = (np.array(x, np.int64) for x in zip(*singles, strict=True))
        # Characters that no longer piece has stand alone; a mark begins a part where no piece has one later.
        inside = {c for pair in self.spanned for c in pair}
        lone = "".join(c for c in map(chr, range(128)) if c not in inside)
        marks_first = not any(pair[1] == MARK != pair[0] for pair in self.spanned) and lone
        self.parts = re.compile(f"{MARK}*[^{MARK}{re.escape(lone)}]+|{MARK}+|[{re.escape(lone)}]" if marks_first else r"(?s:.+)")
        self.border = re.compile(f"[^{MARK}](?={MARK})") if marks_first else None
        self.between = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c not in inside)
        self.pairs: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def number(self, piece: str) -> int:
        return self.numbers.get(piece) or len(self.names) + ord(piece)

    def name(self, number: int) -> str:
        return self.names[number] if number < len(self.names) else chr(number - len(self.names))

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by the library's rule."""
        out = list(text)
        get = self.score.get
        scores = [get(a + b, _NONE) for a, b in zip(out, out[1:])]  # noqa: B905
        while scores and (best := max(scores)) != _NONE:
            i = scores.index(best)
            out[i : i + 2] = [out[i] + out[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(out[i - 1] + out[i], _NONE)
            if i < len(scores):
                scores[i] = get(out[i] + out[i + 1], _NONE)
        return out

    def compatible(self, pair: int) -> bool:
        """Whether two pieces stay as they are when they are merged anew; with no left one, whether the right one does."""
        found = self.pairs.get(pair)
        if found is None:
            left, right = self.name(pair >> _BITS), self.name(pair & (1 << _BITS) - 1)
            found = self.pairs[pair] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def numbers_of(self, text: str) -> list[int]:
        """Numbers of the pieces of a very long part, by backtracking."""
        ends, dead = Windows(self, text), bytearray(len(text) // 8 + 1)
        out: list[tuple[int, int]] = []
        at, below = 0, len(text) + 1
        while at < len(text):
            left = out[-1][1] if out else 0
            for end, number in reversed(ends[at]):
                if end < below and not dead[end >> 3] >> (end & 7) & 1 and self.compatible(left << _BITS | number):
                    out.append((at, number))
                    at, below = end, len(text) + 1
                    break
            else:
                dead[at >> 3] |= 1 << (at & 7)
                below, at = at, out.pop()[0]
        return [number for _, number in out]

    def numbers_of_many(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of many parts, one after another, and how many each has: the same backtracking, a step of all parts at once.

        The pieces before a position are decided by the text alone, so the piece that ends
        there and its begin are kept by position, which makes a stack needless.
        """
        text = self.between.join(parts) + self.between
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        length = hits[:, 1] & (1 << _LENGTH) - 1
        near = np.minimum(np.searchsorted(self.single_points, points), len(self.single_points) - 1)
        alone = np.where(self.single_points[near] == points, self.single_numbers[near], len(self.names) + points)
        start = np.concatenate([hits[:, 0] + 1 - length, np.arange(len(points))])
        end = start + np.concatenate([length, np.ones(len(points), np.int64)])
        number = np.concatenate([hits[:, 1] >> _LENGTH, alone])
        order = np.argsort(start << _LENGTH | (end - start))
        end, number = end[order], number[order]
        first = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(points)))])
        dead = np.zeros(len(points) + 1, bool)
        begin_of, choice_of, piece_of = (np.zeros(len(points) + 1, np.int64) for _ in range(3))
        stop = np.cumsum([len(p) + 1 for p in parts]) - 1
        at = np.concatenate([[0], stop[:-1] + 1])
        begin, choice = at.copy(), first[at + 1] - 1
        live = np.flatnonzero(at < stop)
        while len(live):
            a, c = at[live], choice[live]
            none = c < first[a]
            if none.any():
                back, where = live[none], a[none]
                dead[where] = True
                choice[back], at[back] = choice_of[where] - 1, begin_of[where]
                live_, a, c = live[~none], a[~none], c[~none]
            else:
                live_ = live
            pair = piece_of[a] << _BITS | number[c]
            fits = ~dead[end[c]]
            asked = pair[fits].tolist()
            answers = list(map(self.pairs.get, asked))
            fits[fits] = [self.compatible(x) if y is None else y for x, y in zip(asked, answers, strict=True)]
            choice[live_[~fits]] -= 1
            live_, a, c = live_[fits], a[fits], c[fits]
            to = end[c]
            begin_of[to], choice_of[to], piece_of[to] = a, c, number[c]
            at[live_], choice[live_] = to, first[to + 1] - 1
            live = live[at[live] < stop[live]]
        ends = np.zeros(len(points) + 1, bool)
        at = stop[stop > begin]
        begin = begin[stop > begin]
        while len(at):
            ends[at] = True
            at = begin_of[at]
            at, begin = at[at > begin], begin[at > begin]
        ends = np.flatnonzero(ends)
        return piece_of[ends], np.diff(np.concatenate([[0], np.searchsorted(ends, stop, "right")]))

    def learn(self, parts: list[str]) -> None:
        """Encode parts that are not known, and keep their ids."""
        found, many, short, size = [], [], [], 0
        for k, part in enumerate(parts):
            if len(part) > WINDOW:
                cuts = [0, *(i for i in range(1, len(part)) if part[i - 1 : i + 1] not in self.spanned), len(part)]
                numbers = [n for low, high in zip(cuts, cuts[1:]) for n in self.numbers_of(part[low:high])]  # noqa: B905
                found.append(np.array(numbers, np.int64))
                many.append([len(numbers)])
            else:
                short.append(part)
                size += len(part) + 1
            if short and (size > TOGETHER or k + 1 == len(parts) or len(parts[k + 1]) > WINDOW):
                numbers, count = self.numbers_of_many(short)
                found.append(numbers)
                many.append(count)
                short, size = [], 0
        numbers, many = np.concatenate(found), np.concatenate(many)
        # Ids of a piece, or of the bytes of a character that is none.
        other = np.unique(numbers[numbers >= len(self.names)])
        spelt = [self.bytes[list(self.name(int(x)).encode("utf-8", "surrogatepass"))] for x in other]
        table = np.concatenate([self.ids_of, *spelt])
        width = np.ones(len(self.names) + len(other), np.int64)
        width[len(self.names) :] = [len(x) for x in spelt]
        which = np.where(numbers < len(self.names), numbers, len(self.names) + np.searchsorted(other, numbers))
        before = np.concatenate([[0], np.cumsum(width)])
        n = width[which]
        ids = table[ragged(before[which], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(many)]
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.ends = np.concatenate([self.ends, len(self.held) + ends])
        self.held = np.concatenate([self.held, ids])
        if len(self.pairs) > KEPT_PAIRS:
            self.pairs.clear()

    def segments(self, text: str) -> Iterator[str]:
        """A normalised text in pieces of bounded length, where one can be cut between parts."""
        low = 0
        while self.border and len(text) - low > LONG and (m := self.border.search(text, low + LONG)):
            yield text[low : m.end()]
            low = m.end()
        yield text[low:]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and the offsets of the texts."""
        ids, many, parts, owners = [], np.zeros(len(texts), np.int64), [], []

        def give() -> None:
            codes = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
            new = np.flatnonzero(codes < 0)
            if len(new):
                missing = [parts[i] for i in new.tolist()]
                self.learn(list(dict.fromkeys(missing)))
                codes[new] = [self.known[p] for p in missing]
            n = self.ends[codes + 1] - self.ends[codes]
            ids.append(self.held[ragged(self.ends[codes], n)])
            np.add.at(many, [k for k, _ in owners], np.diff(np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *(k for _, k in owners)])]))
            parts.clear()
            owners.clear()
            if len(self.known) > KEPT or len(self.held) > KEPT_IDS:
                self.forget()

        for k, text in enumerate(texts):
            for segment in self.segments(self.library.normalize(text)):
                had = len(parts)
                parts += self.parts.findall(segment)
                owners.append((k, len(parts) - had))
                if len(parts) > LONG // 8:
                    give()
        give()
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(many)])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of runs of the given starts and lengths, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


@lru_cache(maxsize=2)
def _codec(model: bytes) -> Codec:
    return Codec(model)


@lru_cache(maxsize=2)
def _library(model: bytes) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_proto=model)


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each text: doc_id, ids. path: the model file, on the driver; tasks get its bytes."""
    model = _model(path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for b in batches:
            data, offsets = arrow_bytes(b.column(1))
            for low, high in slices(offsets, SLICE_BYTES):
                texts = [data[x:y].tobytes().decode() for x, y in zip(offsets[low:high].tolist(), offsets[low + 1 : high + 1].tolist(), strict=True)]
                flat, ends = codec.encode(texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(low, high - low), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], names=["doc_id", "ids"])

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ids: doc_id, ids, text. encoded: columns doc_id and ids (null: none)."""
    model = _model(path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(model)
        for b in batches:
            for low in range(0, len(b), 1 << 10):
                part = b.slice(low, 1 << 10)
                texts = [library.decode(x.values.to_numpy().tolist()) if x.is_valid else "" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(scan, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
