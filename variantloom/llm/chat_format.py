"""Chat formatting: whole conversations rendered, encoded once, with offset-aligned loss masks.

A turn is written ``[INST]role[/INST]text</s>``.  The three control strings are
single tokens of the encoder, so no token reaches over a turn's edge; inside
roles and texts one backslash is put after the first character of every control
string (and of its already escaped forms), which is taken out again on reading.
The loss mask marks the tokens whose span meets the text of an assistant turn;
turn spans and token spans are both sorted, so a binary search finds them.

A conversation is one record: its rows are those of its id in the order (turn, role,
text).  A null role or text is empty, a null id is a conversation of its own,
repeated rows are repeated turns, other columns are ignored.

Rows are sorted by Spark and read as a stream, and each turn is encoded by itself: a
task holds one turn, one row of the result and a batch of bounded size, however many
conversations there are.  A row of ``format_conversations`` is as long as its
conversation; those of ``format_pieces`` are bounded by a size and one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import small_batches

OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
_RAW = re.compile(r"([\[<])(\\*)(/?INST\]|/s>)")
_ESCAPED = re.compile(r"([\[<])\\(\\*)(/?INST\]|/s>)")

SCHEMA = "conv_id bigint, formatted string, token_ids array<int>, token_start array<int>, token_end array<int>, loss_mask array<boolean>"
PIECES = SCHEMA.replace("conv_id bigint,", "conv_id bigint, piece int,")
PIECE_CHARS = 1 << 20
BATCH_ROWS, BATCH_CHARS = 1000, 1 << 20


def escape(text: str) -> str:
    return _RAW.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted conversation and the sorted spans of its assistant texts."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{CLOSE}", escape(text)
        if role == "assistant" and body:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), starts, ends


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns, taken back from the formatted text."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part[len(OPEN) :].partition(CLOSE)
        turns.append((unescape(role), unescape(text)))
    return turns


def masked_texts(formatted: str, starts, ends, mask) -> list[str]:
    """Text under the loss mask, one entry for each unbroken run of masked tokens."""
    on = np.asarray(mask, bool)
    starts, ends = np.asarray(starts)[on], np.maximum.accumulate(np.asarray(ends)[on])
    if not len(starts):
        return []
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
    return [unescape(formatted[a:b]) for a, b in zip(starts[first], ends[last], strict=True)]


def loss_mask(token_start: np.ndarray, token_end: np.ndarray, starts: list[int], ends: list[int]) -> np.ndarray:
    """True for tokens that share a character with one of the sorted spans."""
    if not starts:
        return np.zeros(len(token_start), bool)
    at = np.searchsorted(np.asarray(ends), token_start, side="right")
    inside = np.minimum(at, len(starts) - 1)
    return (at < len(starts)) & (np.asarray(starts)[inside] < token_end)


def load_encoder(path: str):
    """The tokenizer file with the control strings as single tokens and untrimmed offsets."""
    from tokenizers import AddedToken, Tokenizer, processors

    encoder = Tokenizer.from_file(path)
    encoder.post_processor = processors.ByteLevel(trim_offsets=False)
    encoder.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (OPEN, CLOSE, END)])
    return encoder


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Rows:
    """Rows of one Arrow batch, made of encoded turns: (formatted, ids, start, end, mask) each."""

    def __init__(self):
        self.convs, self.pieces, self.texts, self.tokens, self.chars = [], [], [], [], 0

    def add(self, conv: int | None, piece: int, turns: list[tuple]) -> None:
        texts, ids, starts, ends, masks = zip(*turns, strict=True)
        at = np.cumsum([0, *map(len, texts[:-1])])
        self.convs.append(conv)
        self.pieces.append(piece)
        self.texts.append("".join(texts))
        self.tokens.append((np.concatenate(ids), *(np.concatenate([x + a for x, a in zip(side, at, strict=True)]) for side in (starts, ends)), np.concatenate(masks)))
        self.chars += len(self.texts[-1])

    def batch(self) -> pa.RecordBatch:
        edges = pa.array(np.cumsum([0, *(len(t[0]) for t in self.tokens)]), pa.int32())
        lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate(side), kind)) for side, kind in zip(zip(*self.tokens, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.bool_()), strict=True)]
        columns = [pa.array(self.convs, pa.int64()), pa.array(self.pieces, pa.int32()), pa.array(self.texts, pa.string()), *lists]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "piece", "formatted", "token_ids", "token_start", "token_end", "loss_mask"])


def encode_turns(batches: Iterator[pa.RecordBatch], encoder, piece_chars: int | None) -> Iterator[pa.RecordBatch]:
    """Rows of turns in order (conv_id, role, text) as encoded rows; a batch is given away at BATCH_ROWS rows or BATCH_CHARS characters."""
    out, held, conv, piece, chars = _Rows(), [], None, 0, 0
    for batch in batches:
        for own, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text")), strict=True):
            if held and (own != conv or (piece_chars is not None and chars >= piece_chars)):
                out.add(conv, piece, held)
                piece, held, chars = piece + 1 if own == conv else 0, [], 0
                if len(out.convs) >= BATCH_ROWS or out.chars >= BATCH_CHARS:
                    yield out.batch()
                    out = _Rows()
            conv = own
            formatted, starts, ends = render([(role, text)])
            encoded = encoder.encode(formatted, add_special_tokens=False)
            spans = np.array(encoded.offsets, np.int32).reshape(-1, 2)
            held.append((formatted, np.array(encoded.ids, np.int32), spans[:, 0], spans[:, 1], loss_mask(spans[:, 0], spans[:, 1], starts, ends)))
            chars += len(formatted)
    if held:
        out.add(conv, piece, held)
        yield out.batch()


def _formatted(rows: DataFrame, tokenizer: str | None, piece_chars: int | None) -> DataFrame:
    small_batches(rows.sparkSession)
    turns = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    # Turns are read as a stream in their order: no row of Spark and no batch gathers a conversation's input.
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode_turns(batches, load_encoder(tokenizer or tokenizer_file()), piece_chars)

    return ordered.mapInArrow(encode, PIECES)


def format_conversations(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row for each conversation, with the text, the tokens and the mask (``SCHEMA``).

    ``tokenizer`` is the file's path on every machine; by default the installed public one.
    """
    return _formatted(rows, tokenizer, None).drop("piece")


def format_pieces(rows: DataFrame, tokenizer: str | None = None, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The same in rows of bounded size (``PIECES``): runs of whole turns, cut behind the turn that reaches ``piece_chars``.

    Pieces of a conversation follow each other in one partition, numbered from 0; offsets
    count from the beginning of their piece.
    """
    return _formatted(rows, tokenizer, piece_chars)


class _Told:
    """What is told of one conversation, from its pieces in order."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars, self.tokens, self.loss_tokens = conv, 0, 0, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> None:
        for role, text in read_turns(formatted):
            self.said.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        for text in masked_texts(formatted, starts, ends, mask):
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)
        self.tokens += len(mask)
        self.loss_tokens += int(np.sum(mask))

    def row(self) -> tuple:
        return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.tokens, self.loss_tokens)


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``format_conversations`` or ``format_pieces``: turns, loss text, lengths."""
    in_pieces = "piece" in formatted.columns

    def told_batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [column.split()[0] for column in DIGESTS.split(", ")]
        kinds = [pa.string() if "sha256" in name else pa.int64() for name in names]
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = None
        for batch in batches:
            out = []
            edges = batch.column("token_start").offsets.to_numpy()
            lists = [batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("token_start", "token_end", "loss_mask")]
            first = batch.column("piece").to_numpy() == 0 if in_pieces else np.ones(len(batch), bool)
            convs, texts = batch.column("conv_id"), batch.column("formatted")
            for k in range(len(batch)):
                if first[k]:
                    out += [told.row()] if told is not None else []
                    told = _Told(convs[k].as_py())
                told.add(texts[k].as_py(), *(x[edges[k] : edges[k + 1]] for x in lists))
            yield told_batch(out)
        if told is not None:
            yield told_batch([told.row()])

    return formatted.select("conv_id", *(["piece"] if in_pieces else []), "formatted", "token_start", "token_end", "loss_mask").mapInArrow(read, DIGESTS)
