"""Ranked pair merging of many short sequences at once, and tables of distinct pieces.

`PairTable` holds which adjacent symbols merge, how early and into what. It
merges ragged numpy arrays of symbols: a round looks up every new adjacent
pair, takes each sequence's lowest rank and merges its places from left to
right. `DistinctTable` keeps what each distinct piece of text became, so a
piece is merged once and its ids are joined back by position.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import regex

LONG = 2048              # symbols; a longer sequence is merged by a heap, in n log n steps
TABLE_PIECES = 300_000   # distinct pieces that a worker remembers before it starts afresh
TABLE_IDS = 4_000_000    # and their ids
_NO_RANK = np.int64(1 << 40)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i]+1, ... of every run, one run after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class PairTable:
    """Pairs (left, right) -> merged at `rank`; symbols are integers below `size`."""

    def __init__(self, left, right, merged, rank, size: int) -> None:
        left, right, merged, rank = (np.asarray(x, dtype=np.int64) for x in (left, right, merged, rank))
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.size, self.keys, self.rank, self.merged = size, key[order], rank[order], merged[order]
        earliest = np.full(size, _NO_RANK)  # of the pairs that a symbol is part of
        np.minimum.at(earliest, left, rank)
        np.minimum.at(earliest, right, rank)
        # What such a pair makes may merge on before the other places of its own rank do.
        self.alone = (earliest[merged] <= rank)[order]
        self.by_key: dict[int, int] | None = None

    def _look_up(self, at: np.ndarray, symbols: np.ndarray, sequence: np.ndarray, found: np.ndarray, rank: np.ndarray) -> None:
        """Set the table places and the ranks of the pairs that begin at `at`."""
        rank[at] = _NO_RANK
        at = at[at + 1 < len(symbols)]
        at = at[sequence[at] == sequence[at + 1]]
        key = symbols[at] * self.size + symbols[at + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[place] == key
        at, place = at[hit], place[hit]
        found[at], rank[at] = place, self.rank[place]

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """One sequence: lowest rank first, leftmost of equals; entries of changed pairs are skipped."""
        if self.by_key is None:
            self.by_key = dict(zip(self.keys.tolist(), range(len(self.keys))))
        pair, rank, merged, size, n = self.by_key.get, self.rank, self.merged, self.size, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(rank[p]), i, p) for i in range(n - 1) if (p := pair(symbols[i] * size + symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n or symbols[i] * size + symbols[j] != self.keys[p]:
                continue
            symbols[i], symbols[j], after[i] = int(merged[p]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := pair(symbols[a] * size + symbols[b])) is not None:
                    heapq.heappush(heap, (int(rank[p]), a, p))
        return [s for s in symbols if s >= 0]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left of each sequence: flat symbols and the new lengths."""
        symbols, lengths = symbols.astype(np.int64), lengths.astype(np.int64)
        counts, starts = lengths.copy(), np.cumsum(lengths) - lengths
        made = np.empty(len(symbols), dtype=np.int64)  # each sequence's result, from its own start on
        for i in np.flatnonzero(lengths > LONG).tolist():
            merged = self._merge_long(symbols[starts[i]:starts[i] + lengths[i]].tolist())
            made[starts[i]:starts[i] + len(merged)], counts[i] = merged, len(merged)
        owner = np.flatnonzero((lengths > 0) & (lengths <= LONG))
        symbols, lengths = symbols[ragged(starts[owner], lengths[owner])], lengths[owner]
        sequence = np.repeat(np.arange(len(owner)), lengths)
        found, rank = np.zeros(len(symbols), dtype=np.int64), np.full(len(symbols), _NO_RANK)
        self._look_up(np.arange(len(symbols)), symbols, sequence, found, rank)
        while len(owner):
            lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
            done = lowest == _NO_RANK
            if done.any():
                out = done[sequence]
                made[ragged(starts[owner[done]], lengths[done])] = symbols[out]
                counts[owner[done]] = lengths[done]
                owner, lengths, lowest, keep = owner[~done], lengths[~done], lowest[~done], ~out
                symbols, found, rank = symbols[keep], found[keep], rank[keep]
                sequence = np.repeat(np.arange(len(owner)), lengths)
                if not len(owner):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # Of overlapping pairs (aaa) every second one merges, from the left end of their run.
            head = np.ones(len(at), dtype=bool)
            head[1:] = at[1:] != at[:-1] + 1
            run = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            # Up to a sequence's first pair that must merge alone, and that one.
            owners, single = sequence[at], self.alone[found[at]]
            if single.any():
                first = np.ones(len(at), dtype=bool)
                first[1:] = owners[1:] != owners[:-1]
                before = np.cumsum(single) - single
                at = at[before == np.maximum.accumulate(np.where(first, before, 0))]
                owners = sequence[at]
            symbols[at] = self.merged[found[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            lengths = lengths - np.bincount(owners, minlength=len(owner))
            symbols, sequence, found, rank = symbols[keep], sequence[keep], found[keep], rank[keep]
            at = at - np.arange(len(at))  # where the merged symbols stand now
            self._look_up(np.concatenate([at, at[at > 0] - 1]), symbols, sequence, found, rank)
        return made[ragged(starts, counts)], counts


class DistinctTable:
    """Ids of each distinct piece; `make` turns a list of unseen pieces into flat ids and their counts."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], size: int = TABLE_PIECES) -> None:
        self.make, self.size = make, size
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int64)
        self.counts = self.starts = np.zeros(0, dtype=np.int64)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the pieces in order, and how many each has."""
        if len(self.place) > self.size or len(self.ids) > TABLE_IDS:
            self.clear()
        unseen = list(set(pieces).difference(self.place))
        if unseen:
            ids, counts = self.make(unseen)
            self.place.update(zip(unseen, range(len(self.place), len(self.place) + len(unseen))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])
        at = np.fromiter(map(self.place.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        counts = self.counts[at]
        return self.ids[ragged(self.starts[at], counts)], counts


def encode_split(table: DistinctTable, split: Callable[[str], list[str]], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the texts and each one's number of ids: the pieces' ids joined by position."""
    pieces = [split(t) for t in texts]
    ids, counts = table.encode([p for found in pieces for p in found])
    ends = np.concatenate([[0], np.cumsum(counts)])
    return ids, np.diff(ends[np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])])


# --- byte-level vocabularies (tokenizers' JSON) ---------------------------------------------------

def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class ByteVocabulary:
    """A byte-level BPE file without normaliser and prefix; special strings in a text are plain text."""

    def __init__(self, data: bytes, pattern: str, table_pieces: int = TABLE_PIECES) -> None:
        spec = json.loads(data)
        vocab, symbols = spec["model"]["vocab"], byte_characters()
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level vocabulary")
        # In this pattern language `\s` also takes U+001C-U+001F, which are not white space.
        pattern = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        size = max(vocab.values()) + 1
        self.pairs = PairTable([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], [vocab[a + b] for a, b in pairs], np.arange(len(pairs)), size)
        self.first = np.array([vocab[s] for s in symbols], dtype=np.int64)
        byte = {s: b for b, s in enumerate(symbols)}
        self.token = [b""] * size
        for text, i in vocab.items():
            self.token[i] = bytes(byte[c] for c in text)
        self.n_bytes = np.array([len(t) for t in self.token], dtype=np.int64)
        self.table = DistinctTable(self._make, table_pieces)

    def _make(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        return self.pairs.merge(self.first[np.frombuffer(b"".join(data), dtype=np.uint8)], lengths)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return encode_split(self.table, self.split, texts)

    def encode_joined(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for segments that begin with one space before a character and end with one that isn't
        white space: no pre-token reaches from one to the next, so all are split in one go."""
        pieces = self.split("".join(segments))
        ids, counts = self.table.encode(pieces)
        ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
        own = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))), side="right")
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[own], prepend=0)


# --- piece vocabularies (SentencePiece's model files) ----------------------------------------------

MARK = "▁"
codecs.register_error("bytewise", lambda e: ("\ufffd", e.start + 1))
# Field numbers and kinds of the model file.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_TEXT, _SCORE, _KIND = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MODEL_TYPE, _BYTE_FALLBACK, _BPE = 3, 35, 2
_CHARSMAP, _DUMMY_PREFIX, _REMOVE_SPACES, _ESCAPE = 2, 3, 4, 5


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields."""
    at = 0
    while at < len(data):
        head, at = _varint(data, at)
        kind = head & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield head >> 3, value


class PieceVocabulary:
    """A BPE piece model with byte fallback and no normalisation but the space marker and its prefix.

    Other kinds of models, user-defined pieces and pieces with a marker after
    another character are refused: then chunks could not stand alone.
    """

    def __init__(self, data: bytes) -> None:
        messages = list(_fields(data))
        trainer = dict(next((_fields(v) for n, v in messages if n == _TRAINER), ()))
        rules = dict(next((_fields(v) for n, v in messages if n == _NORMALIZER), ()))
        found = [dict(_fields(v)) for n, v in messages if n == _PIECE]
        self.piece = [p[_TEXT].decode() for p in found]
        kinds = np.array([p.get(_KIND, _NORMAL) for p in found])
        score = np.array([np.frombuffer(p.get(_SCORE, b"\0" * 4), dtype="<f4")[0] for p in found])
        if (trainer.get(_MODEL_TYPE) != _BPE or not trainer.get(_BYTE_FALLBACK) or rules.get(_CHARSMAP) or not rules.get(_DUMMY_PREFIX, 1)
                or rules.get(_REMOVE_SPACES, 1) or not rules.get(_ESCAPE, 1) or not set(kinds.tolist()) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}):
            raise ValueError("not a plain BPE piece model with byte fallback")
        normal = {p: i for i, p in enumerate(self.piece) if kinds[i] == _NORMAL}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("pieces cross the space marker")
        self.end, self.unknown = self.piece.index("</s>"), int(np.flatnonzero(kinds == _UNKNOWN)[0])
        self.controls = set(np.flatnonzero(kinds == _CONTROL).tolist())
        self.control, self.byte = (kinds == _CONTROL).tolist(), np.full(len(found), -1, dtype=np.int64)
        self.of_byte = np.zeros(256, dtype=np.int64)
        for i in np.flatnonzero(kinds == _BYTE).tolist():
            self.byte[i] = b = int(self.piece[i][3:5], 16)
            self.of_byte[b] = i
        # A character that is no piece of its own counts as the symbol n_pieces + its code point.
        self.n_pieces, self.of_char = len(found), np.arange(len(found), len(found) + 0x110000, dtype=np.int64)
        for p, i in normal.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        order = np.unique(-score, return_inverse=True)[1]  # highest score first, equal ones alike
        symbol = lambda s: int(self.of_char[ord(s)]) if len(s) == 1 else normal.get(s)
        splits = [(symbol(p[:k]), symbol(p[k:]), i) for p, i in normal.items() for k in range(1, len(p))]
        left, right, merged = np.array([x for x in splits if x[0] is not None and x[1] is not None], dtype=np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left, right, merged, order[merged], self.n_pieces + 0x110000)
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.n_bytes = np.array([1 if k == _BYTE else 0 if k == _CONTROL else len(p.replace(MARK, " ").encode()) for p, k in zip(self.piece, kinds)], dtype=np.int64)
        self.surface = [bytes([self.byte[i]]) if self.byte[i] >= 0 else b"" if self.control[i] else " ⁇ ".encode() if i == self.unknown
                        else p.replace(MARK, " ").encode() for i, p in enumerate(self.piece)]
        self.table = DistinctTable(self._make)

    def _make(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbols, counts = self.pairs.merge(self.of_char[codes], lengths)
        strange = symbols >= self.n_pieces
        if not strange.any():
            return symbols, counts
        # A character that merged into no piece: its UTF-8 bytes.
        data = [chr(c - self.n_pieces).encode("utf-8", "replace") for c in symbols[strange].tolist()]
        width = np.ones(len(symbols), dtype=np.int64)
        width[strange] = [len(d) for d in data]
        made = np.repeat(symbols, width)
        made[np.repeat(strange, width)] = self.of_byte[np.frombuffer(b"".join(data), dtype=np.uint8)]
        ends = np.concatenate([[0], np.cumsum(width)])
        return made, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def chunks(self, text: str) -> list[str]:
        """Runs of markers with what follows up to the next marker; the text has a marker put before it."""
        return self.split(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return encode_split(self.table, self.chunks, texts)

    def encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for short distinct texts: each is merged as it stands, as no pair crosses a marker."""
        return self._make([MARK + t.replace(" ", MARK) if t else t for t in texts])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces with spaces for markers, without the prefix; runs of byte pieces as
        UTF-8, where each byte that is none becomes U+FFFD; control pieces give nothing."""
        while ids and self.control[ids[-1]]:
            ids = ids[:-1]
        body = next((k for k, i in enumerate(ids) if not self.control[i]), len(ids))
        data = b"".join(map(self.surface.__getitem__, ids))
        if body < len(ids) and self.piece[ids[body]].startswith(MARK):
            data = data[1:]
        try:
            if self.controls.isdisjoint(ids[body:]):  # control pieces end a run of bytes
                return data.decode()
        except UnicodeDecodeError:
            pass
        parts, run = [], bytearray()
        for k, i in enumerate([*ids, None]):
            if i is not None and self.byte[i] >= 0:
                run.append(self.byte[i])
                continue
            if run:
                parts.append(run.decode("utf-8", "bytewise"))
                run = bytearray()
            if i is not None:
                text = self.surface[i].decode()
                parts.append(text[1:] if k == body and self.piece[i].startswith(MARK) else text)
        return "".join(parts)
