"""Byte-pair encoding by speculation, and decoding.

Each distinct piece of a batch is first cut greedily into the longest tokens. A cut is the true one
if and only if every adjacent pair of its tokens is compatible: merging the pair's text gives the
pair. All different pairs are tested at once, by walking back through the merges that made the two
tokens and looking for a merge across the border that would have come first. Only pieces with an
incompatible pair are merged step by step, those of one length together.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ticketlens.llm.arrowtext import coded, flat, gather, runs
from ticketlens.llm.shipping import ship
from ticketlens.llm.token_ids import LETTERS, PieceEncoder, lowered

_NONE = np.int64(-1)
_NEVER = np.int64(1 << 40)
#: Longer pieces are merged with a heap, one by one.
SIDE_BY_SIDE = 48


class Lookup:
    """Whole numbers to whole numbers, for arrays of keys at once (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _NONE)
        self.values = np.full(1 << bits, _NONE)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == _NONE
            chosen = left[free]
            _, once = np.unique(slot[chosen], return_index=True)
            chosen = chosen[once]
            self.keys[slot[chosen]] = keys[chosen]
            self.values[slot[chosen]] = values[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)
            taken = self.keys[slot[left]] != keys[left]
            slot[left[taken]] = (slot[left[taken]] + 1) & self.mask
            left = left[taken | (self.keys[slot[left]] == _NONE)]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for unknown keys."""
        slot = self._slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], _NONE)
        left = np.flatnonzero((at != keys) & (at != _NONE))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            at = self.keys[slot[left]]
            hit = at == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (at != _NONE)]
        return out


class SpeculativeBpe:
    """The merges of one tokenizer file. Tokens are numbered by the order of their merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {left + right.removesuffix(suffix) + (suffix if suffix and right.endswith(suffix) else "")
                for left, right in pairs}
        alphabet = set(LETTERS.values())
        base = [t for t in vocab if t not in made and (t.removesuffix(suffix) if suffix else t) in alphabet]
        number = {token: n for n, token in enumerate(sorted(base, key=vocab.__getitem__))}
        self.n_base = len(number)
        left, right = list(range(self.n_base)), list(range(self.n_base))
        names = sorted(number, key=number.__getitem__)
        for one, two in pairs:
            token = one + two
            if token in number or one not in number or two not in number:
                raise ValueError(f"a merge makes {token!r} twice or from unknown parts")
            number[token] = len(names)
            names.append(token)
            left.append(number[one])
            right.append(number[two])
        self.left, self.right = np.array(left), np.array(right)
        self.size = len(names)
        self.real = np.array([vocab[token] for token in names], np.uint32)
        merged = np.arange(self.n_base, self.size)
        self.merges = Lookup(self.left[merged] * self.size + self.right[merged], merged)
        self._heap_merges = None

        byte = {letter: value for value, letter in LETTERS.items()}
        self.plain_byte, self.final_byte = np.full(256, _NONE), np.full(256, _NONE)
        raw, closes = [], []
        for n, token in enumerate(names):
            final = bool(suffix) and token.endswith(suffix)
            body = bytes(byte[c] for c in (token.removesuffix(suffix) if final else token))
            raw.append(body)
            closes.append(final)
            if n < self.n_base:
                if final or not suffix:
                    self.final_byte[body[0]] = n
                if not final:
                    self.plain_byte[body[0]] = n
        steps: dict[int, int] = {}
        plain, final_at = [-1], [-1]
        for n in np.flatnonzero(self._reachable(raw, closes, bool(suffix))):
            node = 0
            for value in raw[n]:
                key = node << 8 | value
                if key not in steps:
                    steps[key] = len(plain)
                    plain.append(-1)
                    final_at.append(-1)
                node = steps[key]
            if closes[n] or not suffix:
                final_at[node] = n
            if not closes[n]:
                plain[node] = n
        self.steps = Lookup(
            np.fromiter(steps, np.int64, len(steps)), np.fromiter(steps.values(), np.int64, len(steps))
        )
        self.plain, self.final = np.array(plain), np.array(final_at)

    def _reachable(self, raw: list[bytes], closes: list[bool], ends: bool) -> np.ndarray:
        """Tokens that their own text is encoded to; greedy matching must not use any other."""
        found = np.ones(self.size, bool)
        by_size: dict[tuple[int, bool], list[int]] = {}
        for n in range(self.n_base, self.size):
            by_size.setdefault((len(raw[n]), closes[n] or not ends), []).append(n)
        for (length, final), group in by_size.items():
            data = np.frombuffer(b"".join(raw[n] for n in group), np.uint8)
            symbols = self._symbols(data.reshape(-1, length), final)
            for n, tokens in zip(group, self._merge(symbols), strict=True):
                found[n] = tokens == [n]
        return found

    def _symbols(self, data: np.ndarray, final: bool = True) -> np.ndarray:
        symbols = self.plain_byte[data]
        if final:
            symbols[:, -1] = self.final_byte[data[:, -1]]
        return symbols

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.merges((left * self.size + right).ravel()).reshape(left.shape)
        return np.where(found < 0, _NEVER, found)

    def _merge(self, symbols: np.ndarray) -> list[list[int]]:
        """True merging of rows of equal length: each step merges a row's first best pair."""
        out: list = [None] * len(symbols)
        rows = np.arange(len(symbols))
        ranks = self._rank(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if not ranks.shape[1]:
                for row, tokens in zip(rows.tolist(), symbols.tolist(), strict=True):
                    out[row] = tokens
                break
            best = ranks.argmin(axis=1)
            value = ranks[np.arange(len(rows)), best]
            done = value == _NEVER
            for row, tokens in zip(rows[done].tolist(), symbols[done].tolist(), strict=True):
                out[row] = tokens
            go = ~done
            rows, best, value = rows[go], best[go], value[go]
            if not len(rows):
                break
            symbols, ranks = symbols[go], ranks[go]
            each = np.arange(len(rows))
            symbols[each, best] = value
            places = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, places + (places > best[:, None]), 1)
            places = places[:-1]
            ranks = np.take_along_axis(ranks, places + (places >= best[:, None]), 1)
            before = np.flatnonzero(best > 0)
            at = best[before]
            ranks[before, at - 1] = self._rank(symbols[before, at - 1], symbols[before, at])
            behind = np.flatnonzero(best < ranks.shape[1])
            at = best[behind]
            ranks[behind, at] = self._rank(symbols[behind, at], symbols[behind, at + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """True merging of one long piece, with a heap of the pairs."""
        if self._heap_merges is None:
            merged = np.arange(self.n_base, self.size)
            keys = (self.left[merged] * self.size + self.right[merged]).tolist()
            self._heap_merges = dict(zip(keys, merged.tolist(), strict=True))
        merges, size = self._heap_merges, self.size
        tokens = self._symbols(np.frombuffer(piece, np.uint8)[None, :])[0].tolist()
        behind = list(range(1, len(tokens))) + [-1]
        before = list(range(-1, len(tokens) - 1))
        heap = []
        for at in range(len(tokens) - 1):
            made = merges.get(tokens[at] * size + tokens[at + 1])
            if made is not None:
                heap.append((made, at, tokens[at], tokens[at + 1]))
        heapq.heapify(heap)
        while heap:
            made, at, one, two = heapq.heappop(heap)
            after = behind[at]
            if tokens[at] != one or after < 0 or tokens[after] != two:
                continue
            tokens[at], tokens[after] = made, -1
            behind[at] = behind[after]
            if behind[after] >= 0:
                before[behind[after]] = at
            for start, end in ((before[at], at), (at, behind[at])):
                if start >= 0 and end >= 0:
                    new = merges.get(tokens[start] * size + tokens[end])
                    if new is not None:
                        heapq.heappush(heap, (new, start, tokens[start], tokens[end]))
        return [token for token in tokens if token >= 0]

    def propose(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Greedy longest match of all pieces at once: the piece of each token, and the tokens."""
        pieces, tokens = [], []
        at, left = begin.copy(), np.flatnonzero(end > begin)
        while len(left):
            start, stop = at[left], end[left]
            node = np.zeros(len(left), np.int64)
            best, length = np.full(len(left), _NONE), np.zeros(len(left), np.int64)
            alive, step = np.arange(len(left)), 0
            while len(alive):
                to = self.steps(node[alive] << 8 | data[start[alive] + step])
                step += 1
                alive, to = alive[to >= 0], to[to >= 0]
                node[alive] = to
                last = start[alive] + step == stop[alive]
                token = np.where(last, self.final[to], self.plain[to])
                hit = token >= 0
                best[alive[hit]] = token[hit]
                length[alive[hit]] = step
                alive = alive[~last]
            pieces.append(left)
            tokens.append(best)
            at[left] += length
            left = left[at[left] < end[left]]
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        piece = np.concatenate(pieces)
        order = np.argsort(piece, kind="stable")
        return piece[order], np.concatenate(tokens)[order]

    def compatible(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether their joined text is encoded to just this pair."""
        good = np.ones(len(one), bool)
        left = np.arange(len(one))
        a, b = one.copy(), two.copy()
        # when the token at the border, on either side, is taken up by a merge away from the border
        until_a, until_b = np.full(len(one), _NEVER), np.full(len(one), _NEVER)
        while len(left):
            across = self.merges(a * self.size + b)
            bad = (across >= 0) & (across < until_a) & (across <= until_b)
            good[left[bad]] = False
            go = ~bad & ((a >= self.n_base) | (b >= self.n_base))
            left, a, b, until_a, until_b = left[go], a[go], b[go], until_a[go], until_b[go]
            # back in time: undo the later of the two merges; of equal ones the right, made last
            undo_a = a > b
            until_a, until_b = np.where(undo_a, a, until_a), np.where(undo_a, until_b, b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return good

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces ``data[at[i]:at[i + 1]]`` in a row, and where each piece's ids start."""
        begin, end = at[:-1], at[1:]
        piece, token = self.propose(data, begin, end)
        inner = np.flatnonzero(piece[1:] == piece[:-1]) if len(piece) else np.zeros(0, np.int64)
        pairs, back = np.unique(token[inner] * self.size + token[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.unique(piece[inner[~good[back]]])
        if len(failing):
            mended = self._merge_all(data, begin[failing], end[failing])
            keep = ~np.isin(piece, failing)
            more = np.repeat(failing, [len(tokens) for tokens in mended])
            piece = np.concatenate([piece[keep], more])
            token = np.concatenate([token[keep], np.fromiter((t for m in mended for t in m), np.int64)])
            order = np.argsort(piece, kind="stable")
            piece, token = piece[order], token[order]
        return self.real[token], np.searchsorted(piece, np.arange(len(at)))

    def _merge_all(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[list[int]]:
        out: list = [None] * len(begin)
        length = end - begin
        for size in np.unique(length):
            group = np.flatnonzero(length == size)
            if size > SIDE_BY_SIDE:
                for row in group:
                    out[row] = self._merge_long(data[begin[row] : end[row]].tobytes())
            else:
                symbols = self._symbols(data[begin[group][:, None] + np.arange(size)])
                for row, tokens in zip(group, self._merge(symbols), strict=True):
                    out[row] = tokens
        return out


class Codec:
    """Texts to ids and back, as the tokenizer of one file; its splitting rules are its own pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        if described["normalizer"] is None:
            raise ValueError("this codec is for tokenizers that fold case and drop white space")
        self.bpe = SpeculativeBpe(path)
        self.pieces = PieceEncoder(path)
        splits = described["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        names = {n: token for token, n in described["model"]["vocab"].items()}
        names |= {n: token for token, n in self.special.items()}
        self.names = [names[n].encode() for n in range(max(names) + 1)]

    def _fold(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # letter by letter: a sigma at the end of a word stays what it is
        return "".join([c.lower() for c in text]) if "Σ" in text else text.lower()

    def _words(self, text: str) -> list[bytes]:
        return [word.encode() for word in self.pattern.findall(text)]

    def _encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        at = np.cumsum([0, *map(len, words)])
        ids, bounds = self.bpe.encode(np.frombuffer(b"".join(words), np.uint8), at)
        return [ids[bounds[i] : bounds[i + 1]] for i in range(len(words))]

    def _whole(self, text: str) -> np.ndarray:
        """A text with special tokens or characters of any kind."""
        words, spots = [], []
        for part in self.specials.split(text):
            if part in self.special:
                spots.append((len(words), self.special[part]))
                words.append(b"")
            else:
                words += self._words(self._fold(part))
        ids = self._encode_words(words)
        for spot, token in spots:
            ids[spot] = np.array([token], np.uint32)
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of each text's ids."""
        data, starts = flat(column)
        odd = self.pieces._odd(data, starts)
        whole = {int(row): self._whole(column[int(row)].as_py()) for row in np.flatnonzero(odd)}
        if whole:
            size = starts[1:] - starts[:-1]
            data = data[np.repeat(~odd, size)]
            starts = np.concatenate([[0], np.cumsum(np.where(odd, 0, size))])
        data = lowered(data)
        begin, end, keep = self.pieces._pieces(data, starts)
        codes, distinct = coded(data, begin, end, keep)
        distinct = distinct.cast(pa.large_binary())
        raw, at = flat(distinct)
        ids, bounds = self.bpe.encode(raw, at)
        # pieces with a contraction are several words to the tokenizer
        quoted = np.flatnonzero(raw == 39)
        split = {}
        for n in np.unique(np.searchsorted(at, quoted, side="right") - 1):
            words = self._words(distinct[int(n)].as_py().decode())
            if len(words) > 1:
                split[int(n)] = np.concatenate(self._encode_words(words))
        if split:
            parts = [split.get(n, ids[bounds[n] : bounds[n + 1]]) for n in range(len(distinct))]
            bounds = np.cumsum([0, *map(len, parts)])
            ids = np.concatenate(parts)
        ids, length = gather(codes, ids, bounds)
        ends = np.concatenate([[0], np.cumsum(length)])
        text_ends = ends[np.searchsorted(begin, starts)]
        counts = text_ends[1:] - text_ends[:-1]
        parts, last = [], 0
        for row in sorted(whole):
            parts += [ids[last : text_ends[row]], whole[row]]
            last = text_ends[row]
            counts[row] = len(whole[row])
        return (np.concatenate([*parts, ids[last:]]) if parts else ids), counts

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings with a space between, as the tokenizer without a decoder gives them."""
        return b" ".join([self.names[n] for n in ids.tolist()])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, built once per Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (little-endian, 32 bits each), decoded.

    NULL counts as the empty text, which has no ids and decodes to the empty string. Repeated rows give
    repeated results; an empty table gives none; other columns are ignored. Strings of special
    tokens inside a text become those tokens, as the library does it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in runs(batches):
            ids, counts = own.encode(batch.column("text"))
            ends = np.concatenate([[0], np.cumsum(counts)])
            spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
            packed = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([packed[4 * a : 4 * b] for a, b in spans], pa.binary()),
                    pa.array([own.decode(ids[a:b]) for a, b in spans], pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")
