"""Sequence packing as vector bin packing by the dot-product heuristic.

Every piece is a vector (tokens, segments = 1, loss-bearing tokens); a sequence
has a limit in each dimension. The open sequence takes, of the pending pieces
that fit, the one whose vector has the largest dot product with what the
sequence has left (both in units of the limits). When none fits and cutting is
allowed, a piece is cut so that its head fills the rest exactly.

Packing runs inside the map tasks: a task holds a bounded pool of pending
pieces, so nothing is shuffled, no task needs more than its own input split,
and a lost task is simply run again. Sequence ids are (partition number, count
in the partition). A sequence that cannot be filled (the last of a task, or one
at the limit of segments) is cut into sequences whose lengths are powers of
two, which need no padding.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .base import only

CAPACITY = 2048
MAX_SEGMENTS = 256
END_ID = 1
POOL = 1024
CACHE_ENTRIES = 200_000  # of each generation of the table of chunks
PIECE_ENTRIES = 30_000   # the same of what other chunks are cut into
OUT_SCHEMA = ("id long, start long, ids binary, doc_tokens long, loss_tokens long, "
              "sequence_id long, offset long")


def word_tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class Recent(dict):
    """A bounded table of what ``make`` gives: two generations of at most
    ``limit`` entries, so entries in use survive when the table is full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


# printable Latin-1 without blanks and soft hyphens; and whole texts of it
_LATIN = re.compile("[!-~¡-¬®-ÿ]*")
_LATIN_TEXT = re.compile("[\n -~¡-¬®-ÿ]*")


_PACKED = [struct.Struct(f"<{n}I").pack for n in range(16)]


class WordEncoder:
    """Texts to ids (little-endian uint32 bytes), equal to the tokenizer's own
    ``encode(text, add_special_tokens=False)``.

    No token of this tokenizer spans white space, so a text is the sequence of
    its chunks between blanks and line feeds, and chunks recur: their ids are
    kept in a bounded table. A chunk of printable Latin-1 characters without
    ``<|`` needs neither normalisation beyond lower-casing nor special tokens:
    it is split by the tokenizer's own pattern and its words go straight to the
    tokenizer's model. Every other chunk goes through the whole tokenizer, and
    so does every whole text if the file describes another kind of tokenizer.
    A text of such characters only is lower-cased before it is cut, so that its
    chunks recur more often.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        names = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.by_words = (names == ["NFC", "Replace", "Lowercase"]
                         and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                         and steps[0]["invert"] and steps[0]["behavior"] == "Removed")
        if self.by_words:
            self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        # the byte alphabet of byte-level models: printable bytes stand for
        # themselves, the others for the characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.chunks = Recent(self._chunk, CACHE_ENTRIES)
        self.pieces = Recent(self._word, PIECE_ENTRIES)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        symbols = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        return self._bytes([t.id for t in self.tokenizer.model.tokenize(symbols)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and (chunk.isascii() or _LATIN.fullmatch(chunk)):  # one word for the pattern, too
            low = chunk.lower()
            return self._word(chunk) if low == chunk else self.chunks[low]
        if not _LATIN.fullmatch(chunk) or "<|" in chunk:
            return self._bytes(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if chunk[:-1].isalpha() and chunk[-1] in ",.":
            return self.chunks[chunk[:-1].lower()] + self.pieces[chunk[-1]]
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk.lower())))

    def __call__(self, text: str) -> bytes:
        if not self.by_words:
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _LATIN_TEXT.fullmatch(text) and "<|" not in text:
            text = text.lower()
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


@dataclass(slots=True)
class Piece:
    id: int | None
    start: int
    ids: bytes  # little-endian uint32
    mask: np.ndarray | None  # which of them bear loss; None: all but the document's first
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def loss(self) -> int:
        if self.mask is not None:
            return int(np.count_nonzero(self.mask))
        return len(self) - (self.start == 0 and len(self) > 0)

    def head(self, most: int, loss: float) -> int:
        """How many of the first ``most`` tokens bear at most ``loss`` losses."""
        if self.mask is not None:
            return min(most, int(np.searchsorted(np.cumsum(self.mask[:most]), loss, side="right")))
        return int(min(most, loss + (self.start == 0)))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head, tail = (None, None) if self.mask is None else (self.mask[:at], self.mask[at:])
        return (Piece(self.id, self.start, self.ids[:4 * at], head, self.doc_tokens),
                Piece(self.id, self.start + at, self.ids[4 * at:], tail, self.doc_tokens))


class VectorPacker:
    """Packs a stream of pieces under simultaneous limits on tokens, segments
    and loss-bearing tokens; yields finished sequences (lists of pieces)."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int, cut: bool = True, pool: int = POOL):
        if min(capacity, max_segments, max_loss) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits = np.array([capacity, max_segments, max_loss], np.float64)
        self.may_cut, self.pool = cut, pool
        self.pending: list[Piece] = []
        self.sizes = np.zeros((2 * pool + 4, 3))

    def _add(self, piece: Piece) -> None:
        if len(self.pending) == len(self.sizes):
            self.sizes = np.vstack([self.sizes, np.zeros_like(self.sizes)])
        self.sizes[len(self.pending)] = len(piece), 1, piece.loss()
        self.pending.append(piece)

    def _take(self, k: int) -> Piece:
        last = len(self.pending) - 1
        piece = self.pending[k]
        self.pending[k], self.sizes[k] = self.pending[last], self.sizes[last]
        self.pending.pop()
        return piece

    def _head(self, piece: Piece, left: np.ndarray) -> int:
        """How many of the piece's first tokens fit into ``left``."""
        return piece.head(int(min(len(piece), left[0])), left[2])

    def _fill(self) -> list[Piece]:
        """One sequence from the pending pieces."""
        left, out = self.limits.copy(), []
        while self.pending and left[0] >= 1 and left[1] >= 1:
            sizes = self.sizes[:len(self.pending)]
            fits = (sizes <= left).all(axis=1)
            if fits.any():
                score = (sizes / self.limits) @ (left / self.limits)
                piece = self._take(int(np.argmax(np.where(fits, score, -1))))
            elif self.may_cut or not out:  # a piece beyond the limits is cut in any case
                k = int(np.argmax(sizes[:, 0]))
                at = self._head(self.pending[k], left)
                if at == 0:
                    break
                piece, rest = self._take(k).cut(at)
                self._add(rest)
            else:
                break
            left -= (len(piece), 1, piece.loss())
            out.append(piece)
        return out

    def feed(self, piece: Piece) -> Iterator[list[Piece]]:
        whole = int(self.limits[0])
        while len(piece) > whole and piece.head(whole, self.limits[2]) == whole:
            head, piece = piece.cut(whole)  # full sequences need no search
            yield [head]
        if len(piece):
            self._add(piece)
        while len(self.pending) > self.pool:
            yield from self._next()

    def finish(self) -> Iterator[list[Piece]]:
        while self.pending:
            yield from self._next()

    def _next(self) -> Iterator[list[Piece]]:
        """The next sequence, or what it has in powers of two when it isn't full."""
        out = self._fill()
        size = sum(map(len, out))
        if not self.may_cut or size == self.limits[0]:
            yield out
        else:
            yield from powers_of_two(out, size)


def powers_of_two(pieces: list[Piece], size: int) -> Iterator[list[Piece]]:
    """Cut a partly filled sequence into sequences whose lengths are powers of two."""
    pieces = pieces[::-1]
    while size:
        room = 1 << (size.bit_length() - 1)
        size -= room
        out = []
        while room:
            piece = pieces.pop()
            if len(piece) > room:
                piece, rest = piece.cut(room)
                pieces.append(rest)
            out.append(piece)
            room -= len(piece)
        yield out


def _rows(sequences: Iterable[list[Piece]], counter: list[int]) -> Iterator[tuple]:
    for sequence in sequences:
        offset = 0
        for p in sequence:
            yield (p.id, p.start, p.ids, p.doc_tokens, p.loss(), counter[0], offset)
            offset += len(p)
        counter[0] += 1


def _packed(pieces_of, capacity: int, max_segments: int, max_loss: int, cut: bool):
    """mapInArrow function; ``pieces_of`` makes pieces of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = VectorPacker(capacity, max_segments, max_loss, cut)
        counter = [TaskContext.get().partitionId() << 40]
        rows: list[tuple] = []
        fields = ["id", "start", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
        kinds = [pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 4

        def flush() -> pa.RecordBatch:
            got = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)
            rows.clear()
            return got

        for batch in batches:
            for piece in pieces_of(batch):
                rows.extend(_rows(packer.feed(piece), counter))
                if len(rows) >= 4000:
                    yield flush()
        rows.extend(_rows(packer.finish(), counter))
        if rows:
            yield flush()
    return run


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder a worker process: its table outlives the task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
                   max_segments: int = MAX_SEGMENTS, max_loss: int | None = None) -> DataFrame:
    """Whole texts, encoded and closed by ``end_id``, as pieces of packed sequences.

    One row per piece: ``id``, ``start`` (the document's ids before it),
    ``ids`` (binary, little-endian uint32), ``doc_tokens``, ``loss_tokens``
    (all but a document's first id, which nothing predicts), ``sequence_id``
    and ``offset``. A null or empty text is the end id alone. Repeated ids are
    packed as rows of their own; a null id is kept as null. Extra columns are
    ignored; an empty table gives no rows.
    """
    path = tokenizer or word_tokenizer_path()

    def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
        encode, end = _encoder(path), end_id.to_bytes(4, "little")
        for key, text in zip(batch.column(0), batch.column(1)):
            ids = encode(text.as_py() or "") + end
            yield Piece(key.as_py(), 0, ids, None, len(ids) // 4)

    return only(docs, id=id_col, body=text_col).mapInArrow(
        _packed(pieces, capacity, max_segments, max_loss or capacity, cut=True), OUT_SCHEMA)


def pack_examples(examples: DataFrame, id_col: str, ids_col: str, loss_col: str, capacity: int = CAPACITY,
                  max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, cut: bool = False) -> DataFrame:
    """The same for tokenised examples: ``ids_col`` an array of ids, ``loss_col``
    an array of booleans of the same length (instruction data: the answer's
    tokens). Without ``cut`` only examples beyond a limit are cut. Rows with
    null or empty ids give nothing; a null loss array bears no loss.
    """
    def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
        for key, ids, loss in zip(*(batch.column(i) for i in range(3))):
            ids, loss = np.array(ids.as_py() or [], "<u4"), np.array(loss.as_py() or [], bool)
            if len(ids):
                mask = loss if len(loss) == len(ids) else np.zeros(len(ids), bool)
                yield Piece(key.as_py(), 0, ids.tobytes(), mask, len(ids))

    return only(examples, id=id_col, ids=ids_col, loss=loss_col).mapInArrow(
        _packed(pieces, capacity, max_segments, max_loss or capacity, cut), OUT_SCHEMA)
