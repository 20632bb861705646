"""SentencePiece encoding by sampled segmentation, and lossless decoding.

A text is a lattice of vocabulary pieces.  Forward filtering sums the weights of all
segmentations up to every place; backward sampling then draws the pieces from the
end, each with its share of the sum.  The lattice falls apart where no piece can
cross: before a run of blanks, and in a long run without blanks between two
characters that no piece holds side by side.  The filter runs once for each different
chunk between such places and the draws of all chunks of a batch run together; a run
that nothing divides is one chunk, however long it is.

A draw is a hash of (seed, row key, place of the draw in the row), so a row's pieces
depend on nothing but its key and text.  The vocabulary's ranks give the weights: the
r-th piece weighs ``(r + 1) ** -alpha``; a large alpha prefers frequent pieces, and
fewer, longer ones are preferred throughout because weights multiply.

Blanks are written as U+2581 as the vocabulary has it.  A character no piece has, and
U+2581 itself, is spelled by byte pieces, so every text comes back unchanged.

Defined cases: a null text has null pieces, an empty text has none; rows of equal key
and text get equal pieces; a null key draws like key 0; an unknown column is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import small_batches

BLANK, MARK = "\u2581", "\ue000"  # MARK stands for a blank sign that is part of the text
PRIVATE = 0x110000  # a number that is no code point
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SEED, ALPHA = 20240607, 1.0
CHUNK_CHARS = 64  # in a longer chunk places are sought that no piece can cross
BATCH_CHARS = 400_000
SPELLED_PIECES = 100_000
CACHE_CHUNKS, CACHE_STATES = 300_000, 4_000_000  # what is forgotten is filtered anew
RUN = re.compile(" *[^ ]+| +")


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Vocabulary:
    """Pieces by length with their hashes, the byte pieces, and what every id stands for."""

    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by length: sorted hashes, ids, code points
    log_weight: np.ndarray
    log_byte: float
    byte_ids: list[int]
    of_id: list[bytes]
    longest: int
    joins: set[str]  # every two characters that stand side by side in a piece, blanks as spaces
    blank_inside: bool  # a piece holds a blank after another character

    @classmethod
    def load(cls, path: str, alpha: float = ALPHA) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids, of_id = [0] * 256, [b""] * size
        by_length: dict[int, list[tuple[int, str]]] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value], of_id[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                of_id[i] = piece.replace(BLANK, " ").encode()
                if MARK not in piece:
                    by_length.setdefault(len(piece), []).append((i, piece))
        tables = {}
        for length, pieces in by_length.items():
            letters = np.array([[ord(c) for c in p] for _, p in pieces], np.int64)
            hashes = np.zeros(len(pieces), np.uint64)
            for j in range(length):
                hashes = hashes * FACTOR + letters[:, j].astype(np.uint64)
            order = np.argsort(hashes)
            tables[length] = hashes[order], np.array([i for i, _ in pieces], np.int64)[order], letters[order]
        log_weight = -alpha * np.log(np.arange(size) + 1.0)
        joins = {p[j : j + 2].replace(BLANK, " ") for pieces in by_length.values() for _, p in pieces for j in range(len(p) - 1)}
        blank_inside = any(j[1] == " " != j[0] for j in joins)
        return cls(tables, log_weight, -alpha * float(np.log(size + 1.0)), byte_ids, of_id, max(tables), joins, blank_inside)

    def chunks_of(self, text: str) -> list[str]:
        """The text in parts that no piece crosses; their sum is the text."""
        words = [text] if text and self.blank_inside else RUN.findall(text)
        if max(map(len, words), default=0) <= CHUNK_CHARS:
            return words
        out = []
        for w in words:
            cuts = [i for i in range(1, len(w)) if w[i - 1 : i + 1] not in self.joins] if len(w) > CHUNK_CHARS else []
            out += [w[a:b] for a, b in zip([0, *cuts], [*cuts, len(w)], strict=True)]
        return out


class Grown:
    """An array that is appended to in blocks, with room to spare."""

    def __init__(self, kind: type):
        self.room, self.size = np.zeros(1024, kind), 0

    def append(self, block: np.ndarray) -> None:
        if self.size + len(block) > len(self.room):
            larger = np.zeros(2 * (self.size + len(block)), self.room.dtype)
            larger[: self.size] = self.room[: self.size]
            self.room = larger
        self.room[self.size : self.size + len(block)] = block
        self.size += len(block)

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Sampler:
    """Filters every different chunk once and draws segmentations of whole texts.

    A state is a place in a chunk; the arcs into state k are ``first[k] : first[k + 1]``,
    with cumulated shares raised by k so that one sorted array serves all states.  An
    arc's unit is a piece id, or the vocabulary's size and a code point to be spelled.
    """

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        self.vocabulary, self.seed = vocabulary, seed
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.first, self.share, self.step, self.unit, self.begin = (Grown(t) for t in (np.int64, np.float64, np.int8, np.int32, np.int64))
        self.n_states = 0

    def _arcs(self, code: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, unit) of every piece that stands in the laid-out chunks; left: characters to the chunk's end."""
        places, lengths, units = [], [], []
        rolled = np.zeros(len(code), np.uint64)
        single = np.zeros(len(code), bool)
        for length in range(1, self.vocabulary.longest + 1):
            inside = np.flatnonzero(left >= length)
            if not len(inside):
                break
            rolled[inside] = rolled[inside] * FACTOR + code[inside + length - 1].astype(np.uint64)
            table = self.vocabulary.tables.get(length)
            if table is None:
                continue
            hashes, ids, letters = table
            at = np.minimum(np.searchsorted(hashes, rolled[inside]), len(hashes) - 1)
            hit = hashes[at] == rolled[inside]
            place, at = inside[hit], at[hit]
            same = (code[place[:, None] + np.arange(length)] == letters[at]).all(1)
            place, at = place[same], at[same]
            if length == 1:
                single[place] = True
            places.append(place)
            lengths.append(np.full(len(place), length, np.int64))
            units.append(ids[at])
        spelled = np.flatnonzero(~single)
        original = np.where(code[spelled] == ord(MARK), ord(BLANK), code[spelled])
        places.append(spelled)
        lengths.append(np.ones(len(spelled), np.int64))
        units.append(len(self.vocabulary.of_id) + original)
        return np.concatenate(places), np.concatenate(lengths), np.concatenate(units)

    def _learn(self, chunks: list[str]) -> None:
        """Forward filter over new chunks, all at once, end by end."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        laid = "".join(chunks)
        # The text's own private character becomes a code point that no piece and no text has.
        code = np.frombuffer(laid.encode("utf-32-le"), np.uint32).astype(np.int64)
        private, sign, blank = code == ord(MARK), code == ord(BLANK), code == ord(" ")
        code = np.where(private, PRIVATE, np.where(sign, ord(MARK), np.where(blank, ord(BLANK), code)))
        starts = np.cumsum(sizes) - sizes
        number = np.repeat(np.arange(len(chunks)), sizes)
        local = np.arange(len(code)) - starts[number]
        place, length, unit = self._arcs(code, sizes[number] - local)
        unit = np.where(unit == len(self.vocabulary.of_id) + PRIVATE, len(self.vocabulary.of_id) + ord(MARK), unit)
        end = place + number[place] + length  # state numbers: one more state than characters in each chunk
        order = np.argsort(end, kind="stable")  # merges runs: for each length the ends are in order
        place, length, unit, end = place[order], length[order], unit[order], end[order]
        n_states = len(code) + len(chunks)
        counts = np.bincount(end, minlength=n_states)
        first = np.cumsum(counts) - counts
        log_weight = np.where(unit < len(self.vocabulary.of_id), self.vocabulary.log_weight[np.minimum(unit, len(self.vocabulary.of_id) - 1)], self.vocabulary.log_byte * _utf8_length(unit - len(self.vocabulary.of_id)))
        total = np.zeros(n_states)
        part = np.zeros(len(end))
        at_end = (local[place] + length).astype(np.min_scalar_type(int(sizes.max())))  # a narrow type sorts faster
        by_end = np.argsort(at_end, kind="stable")
        bounds = np.searchsorted(at_end[by_end], np.arange(1, int(sizes.max()) + 2))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = by_end[a:b]  # arcs of one distance from the chunk's begin, still in order of their states
            if not len(own):
                continue
            value = total[end[own] - length[own]] + log_weight[own]
            ends = end[own]
            begin = np.flatnonzero(np.diff(ends, prepend=-1))
            states = ends[begin]
            high = np.maximum.reduceat(value, begin)
            reach = np.diff(np.append(begin, len(own)))
            raw = np.exp(value - np.repeat(high, reach))
            whole = np.add.reduceat(raw, begin)
            total[states] = high + np.log(whole)
            part[own] = raw / np.repeat(whole, reach)
        upto = np.cumsum(part)
        before = np.where(counts > 0, np.append(0, upto)[first], 0)
        share = upto - before[end]
        last = first[counts > 0] + counts[counts > 0] - 1
        share[last] = 1.0
        self.begin.append(starts + np.arange(len(chunks)) + self.n_states)
        self.first.append(first + self.share.size)
        self.share.append(np.clip(share, 0.0, 1.0) + end + self.n_states)
        self.step.append(length)
        self.unit.append(unit)
        self.n_states += n_states

    def encode(self, keys: list[int], texts: list[str]) -> list[np.ndarray]:
        """Piece ids of every text."""
        if len(self.index) >= CACHE_CHUNKS or self.n_states >= CACHE_STATES:
            self._forget()
        index, known = self.index, len(self.index)
        which, counts = [], []
        for text in texts:
            own = self.vocabulary.chunks_of(text)
            counts.append(len(own))
            which += [index.setdefault(c, len(index)) for c in own]
        if not which:
            return [np.zeros(0, np.int32) for _ in texts]
        if len(index) > known:
            self._learn(list(islice(index, known, None)))
        first, share, step, unit = (x.values for x in (self.first, self.share, self.step, self.unit))
        ends = np.append(self.begin.values[1:], self.n_states) - 1
        which, owner = np.array(which, np.int64), np.repeat(np.arange(len(texts)), counts)
        begin, state = self.begin.values[which], ends[which]
        size = state - begin
        place = np.cumsum(size) - size
        place -= place[np.minimum(np.cumsum(counts) - counts, len(place) - 1)][owner]  # from the text's begin
        key = np.array(keys, np.int64).astype(np.uint64)[owner]
        alive, bounds = np.arange(len(which)), np.append(first, len(share))
        drawn, arcs, ends_at = [], [], []
        while len(alive):
            now = state[alive]
            end = place[alive] + now - begin[alive]
            arc, last, drawn_share = bounds[now], bounds[now + 1] - 1, now + uniform(self.seed, key[alive], end)
            on = np.arange(len(arc))  # a state has few arcs, side by side: step on until the share is reached
            while len(on := on[(share[arc[on]] <= drawn_share[on]) & (arc[on] < last[on])]):
                arc[on] += 1
            drawn.append(alive)
            arcs.append(arc)
            ends_at.append(end)
            state[alive] = now - step[arc]
            alive = alive[state[alive] > begin[alive]]
        row, arc, end = owner[np.concatenate(drawn)], np.concatenate(arcs), np.concatenate(ends_at)
        order = np.argsort((row << 40) + end)
        return self._spell(unit[arc[order]], row[order], len(texts))

    def _spell(self, unit: np.ndarray, row: np.ndarray, n_rows: int) -> list[np.ndarray]:
        """Ids of the drawn units, row by row; units beyond the vocabulary become the bytes of their character."""
        size = len(self.vocabulary.of_id)
        wide = unit >= size
        length = np.where(wide, _utf8_length(unit - size), 1)
        ids = np.repeat(unit, length)
        if wide.any():
            spelled = "".join(map(chr, (unit[wide] - size).tolist())).encode()
            ids[np.repeat(wide, length)] = np.array(self.vocabulary.byte_ids, np.int32)[np.frombuffer(spelled, np.uint8)]
        rows = np.bincount(row, weights=length, minlength=n_rows).astype(np.int64)
        return np.split(ids.astype(np.int32), np.cumsum(rows)[:-1])


def _utf8_length(code: np.ndarray) -> np.ndarray:
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


def uniform(seed: int, key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number in [0, 1) that is a hash of seed, key and place."""
    with np.errstate(over="ignore"):
        x = key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
        for more in (place.astype(np.uint64), np.uint64(0)):
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = (x ^ (x >> np.uint64(31))) + more * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def decode(ids, vocabulary: Vocabulary) -> str:
    of_id = vocabulary.of_id
    return b"".join([of_id[i] for i in ids]).decode()


def _slices(texts: list[str | None]) -> Iterator[slice]:
    """Runs of rows of about ``BATCH_CHARS`` characters."""
    begin = size = 0
    for row, text in enumerate(texts):
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield slice(begin, row + 1)
            begin, size = row + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode_column(docs: DataFrame, key: str = "doc_id", text: str = "text", column: str = "piece_ids", model: str | None = None, seed: int = SEED, alpha: float = ALPHA) -> DataFrame:
    """``docs`` with the ids of a sampled segmentation of each text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sampler = Sampler(Vocabulary.load(model or model_file(), alpha), seed)
        for keys, bodies in batches:
            texts, out = bodies.tolist(), []
            keys = keys.fillna(0).astype("int64").tolist()
            for part in _slices(texts):
                ids = sampler.encode(keys[part], [t or "" for t in texts[part]])
                out += [None if t is None else i for t, i in zip(texts[part], ids, strict=True)]
            yield pd.Series(out, dtype=object)

    return docs.withColumn(column, encoded(docs[key].cast("long"), docs[text]))


class Speller:
    """Turns lists of ids into texts by one lookup of bytes for a run of pieces, whatever rows they are of."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = np.fromiter(map(len, vocabulary.of_id), np.int64, len(vocabulary.of_id))
        self.begin = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(vocabulary.of_id), np.uint8)

    def texts(self, ids: pa.ListArray) -> pa.Array:
        """The text of every row; null where the row is."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        data = []
        for at in range(0, len(flat), SPELLED_PIECES):
            part = flat[at : at + SPELLED_PIECES]
            size = self.size[part]
            shift = self.begin[part] - (np.cumsum(size) - size)
            data.append(self.letters[np.repeat(shift, size) + np.arange(size.sum())].tobytes())
        ends = np.append(0, np.cumsum(self.size[flat]))
        rows = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)))
        offsets = pa.py_buffer(ends[rows].astype(np.int64))
        spelled = pa.LargeStringArray.from_buffers(len(ids), offsets, pa.py_buffer(b"".join(data)))
        spelled.validate(full=True)
        return pc.if_else(ids.is_valid(), spelled, pa.scalar(None, pa.large_string())).cast(pa.string())


def decode_column(pieces: DataFrame, ids: str = "piece_ids", column: str = "decoded", model: str | None = None) -> DataFrame:
    """``pieces`` with the text that the ids stand for."""
    small_batches(pieces.sparkSession)

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        speller = Speller(Vocabulary.load(model or model_file()))
        for batch in batches:
            yield speller.texts(batch)

    return pieces.withColumn(column, decoded(F.col(ids)))
