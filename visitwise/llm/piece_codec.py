"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut where no piece of the vocabulary can cross (before
a blank that follows something else, if no piece holds such a place), and each
different part is encoded once. The parts are concatenated and indexed by a
suffix array; every piece is binary-searched in it for its range of
occurrences; the occurrences are edges (start, end, piece), sorted by the
position of their end; then the edges are relaxed from left to right.

The model is a BPE model, where the best path is not the one of the largest
sum of scores. What decides is that an encoding's prefixes are encodings too,
and that a sequence is the encoding of its text if every two neighbours are
the encoding of theirs: a merge across a border would have to win against the
merges of its two neighbours, which their own encoding settles. So an edge
extends the path at its start exactly if (last piece there, its piece) is such
a pair, and just one edge into each position passes. Pairs are settled once, by
merging their characters, and remembered in a bounded table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import only

BLANK = "▁"
CACHE_ENTRIES = 200_000  # of each generation
PAIR_ENTRIES = 400_000
INDEX_CHARS = 400_000  # characters of one suffix array


def piece_model_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCodec:
    """Ids of a SentencePiece BPE model without text normalisation, and back."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " a  ｆ "
        if model.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("the model normalises its texts: not supported")
        self.size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
                 for i in range(self.size)]
        self.names = names
        self.score = {n: model.get_score(i) for i, (n, p) in enumerate(zip(names, plain)) if p}
        self.id = {n: i for i, (n, p) in enumerate(zip(names, plain)) if p}
        self.byte_id = {int(names[i][3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        # what an id stands for: bytes of text, or nothing for control pieces
        self.bytes = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace(BLANK, " ").encode() if p
                      else " ⁇ ".encode() if i == self.unknown else b""
                      for i, (n, p) in enumerate(zip(names, plain))]
        self.parts = re.compile(f"(?<=[^{BLANK}])(?={BLANK})") if not any(
            re.search(f"[^{BLANK}]{BLANK}", n) for n in self.id) else None
        # the pieces as a matrix of characters, filled with zeros behind
        ids = np.array(list(self.id.values()), np.int32)
        lengths = np.array([len(n) for n in self.id], np.int32)
        chars = np.zeros((len(ids), lengths.max()), np.uint32)
        for row, n in zip(chars, self.id):
            row[:len(n)] = np.frombuffer(n.encode("utf-32-le"), np.uint32)
        self.piece_ids, self.piece_lengths, self.piece_chars = ids, lengths, chars
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    # -- encoding ---------------------------------------------------------

    def _text(self, token: int) -> str:
        """The characters of a piece; beyond the vocabulary a token is one unknown character."""
        return self.names[token] if token < self.size else chr(token - self.size)

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text, merging the best neighbours first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _passes(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """For each (token before, or -1; token) whether the two are neighbours in an encoding."""
        keys = (before.astype(np.int64) + 1) << 32 | token
        values, back = np.unique(keys, return_inverse=True)
        if len(self.pairs) > PAIR_ENTRIES:
            self.pairs.clear()
        pairs, out = self.pairs, np.empty(len(values), bool)
        for i, key in enumerate(values.tolist()):
            got = pairs.get(key)
            if got is None:
                first, second = (key >> 32) - 1, key & 0xFFFFFFFF
                own = [self._text(t) for t in (first, second) if t >= 0]
                got = pairs[key] = self._merged("".join(own)) == own
            out[i] = got
        return out[back]

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence of every piece in ``text``
        (code points), piece by piece."""
        depth = self.piece_chars.shape[1]
        alphabet, rank = np.unique(text, return_inverse=True)
        # suffixes in the order of their first `depth` characters: the ranks of
        # several characters make one sort key; 0 stands behind the end
        bits = int(len(alphabet)).bit_length()
        each = 62 // bits
        padded = np.concatenate([rank.astype(np.int64) + 1, np.zeros(depth + each, np.int64)])
        keys = []
        for at in range(0, depth, each):
            key = np.zeros(len(text), np.int64)
            for i in range(at, at + each):
                key = key << bits | padded[i:i + len(text)]
            keys.append(key)
        order = np.lexsort(keys[::-1]).astype(np.int32)
        del keys
        # only pieces of characters that occur, in the same ranks
        place = np.minimum(np.searchsorted(alphabet, self.piece_chars), len(alphabet) - 1)
        behind = np.arange(depth)[None, :] >= self.piece_lengths[:, None]
        able = np.nonzero(((alphabet[place] == self.piece_chars) | behind).all(axis=1))[0]
        wanted, inside = place[able] + 1, ~behind[able]

        def search(after: bool) -> np.ndarray:
            """For each piece the first suffix not below it (or not beginning with it, behind)."""
            lo = np.zeros(len(able), np.int64)
            hi = np.full(len(able), len(text), np.int64)
            while (open_ := np.nonzero(lo < hi)[0]).size:
                mid = (lo[open_] + hi[open_]) // 2
                have = padded[order[mid][:, None] + np.arange(depth)[None, :]]
                want = wanted[open_]
                differs = (have != want) & inside[open_]
                row, at = np.arange(len(open_)), differs.argmax(axis=1)
                below = np.where(differs[row, at], have[row, at] < want[row, at], after)
                lo[open_] = np.where(below, mid + 1, lo[open_])
                hi[open_] = np.where(below, hi[open_], mid)
            return lo

        first, last = search(False), search(True)
        count = last - first
        piece = np.repeat(able, count)
        start = order[np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
        return start, start + self.piece_lengths[piece], self.piece_ids[piece]  # all of 32 bits

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids (little-endian uint32) of each part: one index over all of them."""
        gap = "\U0010FFFF"  # in no piece, so no occurrence spans two parts
        text = np.frombuffer(gap.join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(p) for p in parts])
        offset = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        owner = np.repeat(np.arange(len(parts)), lengths + 1)[:len(text)]
        local = np.arange(len(text)) - offset[owner]
        start, end, token = self.edges(text)
        # characters of no piece are edges of their own
        single = np.isin(text, self.piece_chars[self.piece_lengths == 1, 0], invert=True)
        odd = np.nonzero(single & (local < lengths[owner]))[0].astype(np.int32)
        start, end = np.concatenate([start, odd]), np.concatenate([end, odd + 1])
        token = np.concatenate([token, text[odd].astype(np.int32) + np.int32(self.size)])
        # edges by position: the end's place within its part; all parts are relaxed at once
        place = (end - offset[owner[start]]).astype(np.uint16 if lengths.max() < 1 << 16 else np.uint32)
        step = np.argsort(place, kind="stable")
        start, end, token = start[step], end[step], token[step]
        bounds = np.searchsorted(place[step], np.arange(1, lengths.max() + 2))
        last = np.full(len(text) + 1, -1, np.int32)  # the piece that ends here, by text position of its end
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s = start[a:b]
            head = local[s] == 0
            before = np.where(head, -1, last[s])
            live = np.nonzero(head | (before >= 0))[0]
            live = live[self._passes(before[live], token[a:b][live])]
            last[end[a:b][live]] = token[a:b][live]
        # back from every part's end, one piece a round
        widths = np.ones(self.size + 1, np.int64)
        widths[self.piece_ids] = self.piece_lengths
        pos, active, rounds = offset + lengths, np.arange(len(parts)), []
        while active.size:
            got = last[pos[active]]
            rounds.append((active, got))
            pos[active] -= widths[np.minimum(got, self.size)]
            active = active[pos[active] > offset[active]]
        part = np.concatenate([a for a, _ in rounds][::-1])
        found = np.concatenate([t for _, t in rounds][::-1])
        found = found[np.argsort(part, kind="stable")]
        ends = np.cumsum(np.bincount(part, minlength=len(parts))).tolist()
        flat, out, at = found.astype("<u4").tobytes(), [], 0
        strange = set(part[np.concatenate([t for _, t in rounds][::-1]) >= self.size].tolist())
        for i, to in enumerate(ends):
            out.append(self._spelled(found[at:to].tolist()) if i in strange else flat[4 * at:4 * to])
            at = to
        return out

    def _spelled(self, tokens: list[int]) -> bytes:
        """Ids with unknown characters as their bytes' pieces."""
        ids = []
        for t in tokens:
            if t < self.size:
                ids.append(t)
            else:
                raw = chr(t - self.size).encode("utf-8", "surrogatepass")
                ids += [self.byte_id[b] for b in raw] if self.byte_id else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text (little-endian uint32), equal to the model's own."""
        marked = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        cut = [(self.parts.split(t) if self.parts else [t]) if t else [] for t in marked]
        # two generations of known parts: what is in use survives when the table is full
        if len(self.known) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        known, older, new = self.known, self.older, []
        for part in set().union(*cut):
            if part not in known:
                ids = older.get(part)
                if ids is None:
                    new.append(part)
                else:
                    known[part] = ids
        at = 0
        while at < len(new):  # indexes of bounded size; a longer part has its own
            to, held = at, 0
            while to < len(new) and (to == at or held + len(new[to]) < INDEX_CHARS):
                held += len(new[to]) + 1
                to += 1
            known.update(zip(new[at:to], self._encode_parts(new[at:to])))
            at = to
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes of the pieces, without the blank put in front."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


_codecs: dict[str, PieceCodec] = {}


def _codec(path: str) -> PieceCodec:
    """One codec a worker process: its tables outlive the task."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """One row per input row: ``id`` and ``ids`` (binary, little-endian uint32).

    Null and empty texts have no ids. Repeated rows are encoded alike; a null
    id stays null. Extra columns are ignored; an empty table gives an empty
    result.
    """
    path = model or piece_model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = codec.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary())],
                                      names=["id", "ids"])

    return only(docs, id=id_col, body=text_col).mapInArrow(run, "id long, ids binary")


def decode_ids(rows: DataFrame, ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``rows`` with ``ids_col`` replaced by ``text``; null ids give null."""
    path = model or piece_model_path()
    others = [c for c in rows.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            texts = [codec.decode(np.frombuffer(v.as_buffer(), "<u4")) if v.is_valid else None
                     for v in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())],
                                  names=batch.schema.names[:-1] + ["text"])

    own = [f"c{i}" for i in range(len(others))]
    named = rows.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(others, own)], F.col(f"`{ids_col}`").alias("ids"))
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in named.schema.fields[:-1])
    out = named.mapInArrow(run, f"{schema}text string")
    return out.select(*[F.col(o).alias(c) for c, o in zip(others, own)], "text")
