"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once.

A text is cut where the tokenizer's own splitting pattern always cuts, by whole-array operations on
its bytes. Every distinct piece then goes through the library's model once, and its ids are
laid out for all texts. Texts that hold characters whose class is not plain from their bytes (beyond
ASCII and the Latin-1 letters), or a special token's string, go through the library whole.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa

from ticketlens.llm.arrowtext import LOWER, coded, cuts_between, flat, gather, runs
from ticketlens.llm.shipping import ship

_SPACE, _LETTER, _DIGIT, _MARK, _WIDE = 1, 2, 3, 4, 5

#: Encoded pieces that a Python worker remembers.
REMEMBERED = 200_000


def _kinds() -> np.ndarray:
    kinds = np.full(256, _MARK, np.uint8)
    kinds[[32, 9, 10, 11, 12, 13]] = _SPACE
    for low, high, kind in ((65, 91, _LETTER), (97, 123, _LETTER), (48, 58, _DIGIT)):
        kinds[low:high] = kind
    kinds[128:] = _WIDE
    return kinds


KINDS = _kinds()


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in the vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {byte: chr(byte) for byte in shown}
    hidden = [byte for byte in range(256) if byte not in letters]
    return letters | {byte: chr(256 + n) for n, byte in enumerate(hidden)}


LETTERS = byte_letters()


def kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; the two bytes of a Latin-1 letter count as letters."""
    kinds = KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    if len(lead):
        letter = (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)
        kinds[lead[letter]] = _LETTER
        kinds[lead[letter] + 1] = _LETTER
    return kinds


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital Latin-1 letters in lower case."""
    low = LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    if len(lead):
        capital = (data[lead + 1] >= 0x80) & (data[lead + 1] <= 0x9E) & (data[lead + 1] != 0x97)
        low[lead[capital] + 1] += 0x20
    return low


class PieceEncoder:
    """Encodes columns of texts as the tokenizer of one file does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        #: White space is dropped and case folded, or else a space belongs to the next piece.
        self.folds = described["normalizer"] is not None
        self.special = [t["content"].encode() for t in described["added_tokens"]]
        self.known: dict[bytes, bytes] = {}

    def _pieces(self, data: np.ndarray, starts: np.ndarray):
        kinds = kinds_of(data)
        cut = cuts_between(kinds, starts)
        # a contraction begins with an apostrophe: it stays with the letters behind it
        quote = np.flatnonzero(data[:-1] == 39) if len(data) else np.zeros(0, np.int64)
        glued = quote[kinds[quote + 1] == _LETTER] + 1
        if self.folds:
            cut[kinds == _DIGIT] = True
            cut[glued] = False
            cut[starts[:-1][starts[:-1] < len(data)]] = True
            begin = np.flatnonzero(cut)
            end = np.append(begin[1:], len(data))
            inside = kinds[begin] != _SPACE
            return begin[inside], end[inside], kinds != _SPACE
        cut[glued] = False
        # of the white space before a word, the last space goes with the word
        first = np.zeros(len(data) + 1, bool)
        first[starts] = True
        turn = np.flatnonzero((kinds[:-1] == _SPACE) & (kinds[1:] != _SPACE)) + 1
        turn = turn[~first[turn]]
        cut[turn - 1] = True
        cut[turn[data[turn - 1] == 32]] = False
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        begin = np.flatnonzero(cut)
        return begin, np.append(begin[1:], len(data)), None

    def _encode_piece(self, piece: bytes) -> bytes:
        spot = piece.find(b"'")
        if spot >= 0 and not piece.isascii() or spot >= 0 and any(97 <= b | 32 <= 122 for b in piece):
            ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        else:
            text = "".join([LETTERS[b] for b in piece])
            ids = [token.id for token in self.model.tokenize(text)]
        return array("I", ids).tobytes()

    def _odd(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Texts that must go through the library whole."""
        odd = np.zeros(len(starts) - 1, bool)
        wide = np.flatnonzero(kinds_of(data) == _WIDE)
        odd[np.searchsorted(starts, wide, side="right") - 1] = True
        raw = data.tobytes()
        for string in self.special:
            at = raw.find(string)
            while at >= 0:
                odd[np.searchsorted(starts, at, side="right") - 1] = True
                at = raw.find(string, at + 1)
        return odd

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of each text's ids."""
        data, starts = flat(column)
        odd = self._odd(data, starts)
        whole = {}
        if odd.any():
            rows = np.flatnonzero(odd)
            texts = [column[int(i)].as_py() for i in rows]
            done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            whole = {int(i): np.array(e.ids, np.uint32) for i, e in zip(rows, done, strict=True)}
            plain = np.repeat(~odd, starts[1:] - starts[:-1])
            size = np.where(odd, 0, starts[1:] - starts[:-1])
            data, starts = data[plain], np.concatenate([[0], np.cumsum(size)])
        if self.folds:
            data = lowered(data)
        begin, end, keep = self._pieces(data, starts)
        codes, distinct = coded(data, begin, end, keep)
        known, encoded = self.known, []
        for piece in distinct.to_pylist():
            ids = known.get(piece)
            if ids is None:
                ids = self._encode_piece(piece)
                if len(known) < REMEMBERED and len(piece) < 64:
                    known[piece] = ids
            encoded.append(ids)
        at = np.zeros(len(encoded) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4, out=at[1:])
        ids, length = gather(codes, np.frombuffer(b"".join(encoded), np.uint32), at)
        ends = np.concatenate([[0], np.cumsum(length)])
        bounds = ends[np.searchsorted(begin, starts)]
        counts = bounds[1:] - bounds[:-1]
        if not whole:
            return ids, counts
        parts, last = [], 0
        for row in sorted(whole):
            parts += [ids[last : bounds[row]], whole[row]]
            last = bounds[row]
            counts[row] = len(whole[row])
        return np.concatenate([*parts, ids[last:]]), counts


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of a file, loaded once per Python worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_rows(docs, path: str, end_id: int | None = None, narrow: bool = True):
    """doc_id and ``ids``, the ids of the whole text as little-endian integers (16 or 32 bits).

    NULL text counts as empty. ``end_id`` is put behind each document's ids. ``narrow`` takes 16 bits
    per id and needs a vocabulary below 65,536.
    """
    ship(docs.sparkSession)
    kind = np.dtype("<u2" if narrow else "<u4")

    def encode(batches):
        tokens = encoder(path)
        for batch in runs(batches):
            ids, counts = tokens.encode(batch.column("text"))
            ids = ids.astype(kind)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), kind.type(end_id))
                counts = counts + 1
            size = np.concatenate([[0], np.cumsum(counts * kind.itemsize)])
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(size), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), packed.cast(pa.binary())], names=["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary")
