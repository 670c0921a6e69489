"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

A pre-token is a linked list of parts. Each adjacent pair whose bytes are a
token waits in the bucket of that token's rank; a bitmap hierarchy over the
ranks (64 buckets per word, words of words above) gives the lowest waiting
rank by find-first-set at each level. Entries whose pair has changed since
they were queued are stale and skipped. A pre-token of n bytes costs O(n)
queue operations, so very long pre-tokens need no quadratic rescans. The
distinct pre-tokens of a slice of texts that aren't remembered share one queue:
their lists stand one after another, with a part that pairs with nothing between.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import slices

MEMO_ENTRIES = 600_000   # encoded pre-tokens that a worker remembers at least, and twice as many at most
PAIR_ENTRIES = 1_000_000  # pairs of ids whose rank a worker remembers
MEMO_CHARS = 64          # longer pre-tokens are encoded each time
QUEUE_BYTES = 1 << 19    # bytes of pre-tokens that share a queue (a longer pre-token has its own)
VOCABULARY_BYTES = 64 << 20  # largest vocabulary file that is sent to every executor


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of `base64(token) rank`."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


# Character classes that the standard library's expressions don't know, and their names in `regex`.
CLASSES = {r"\p{L}": r"\p{L}", r"\p{N}": r"\p{N}", r"\s": r"\p{White_Space}", r"\S": r"\P{White_Space}"}


def _ranges(name: str) -> str:
    """The characters up to U+FFFF of a class, as the inside of a bracket expression."""
    runs = regex.findall(f"{name}+", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x10000)))))
    return "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in runs)


def short_pattern(pattern: str) -> re.Pattern | None:
    """`pattern` for texts without characters beyond U+FFFF, its classes written out for the standard library's
    expressions, which split such texts in half the time; None if it holds more than these classes and plain groups."""
    bare = re.sub(r"\\p\{[LN]\}|\\[sS]|\(\?[:!=]", "", pattern)
    if "\\" in bare or "(?" in bare or re.search(r"\[\^?\]|\[[^]]*(\[|\\S|--|&&|\|\||~~)", pattern):
        return None
    ranges = {short: _ranges(name) for short, name in CLASSES.items() if short in pattern}
    return re.compile("".join(
        re.sub(r"\\p\{[LN]\}|\\[sS]", lambda m: ranges[m[0]] if part[0] == "[" else f"[{ranges[m[0]]}]", part)
        for part in re.findall(r"\[[^]]*\]|[^[]+", pattern)))


class Encoder:
    """Encodes texts by token ranks; pre-tokens are the matches of `pattern`."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.short = short_pattern(pattern)
        # In this pattern language `\s` also takes the separators U+001C-U+001F, which are not white space.
        pattern = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
        self.findall = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.ranks = ranks
        # Two levels of bitmaps over the ranks, of about as many bits each.
        self.shift = (max(ranks.values(), default=1).bit_length() + 1) // 2
        self.words = [0] * (1 << self.shift)
        self.bits = [1 << i for i in range(1 << self.shift)]
        self.memo: dict[str, bytes] = {}   # ids of pre-tokens, as little-endian unsigned 32-bit integers
        self.older: dict[str, bytes] = {}  # what was remembered before; forgotten when the memo is full again
        self.token = {rank: token for token, rank in ranks.items()}
        self.tokens = np.empty(max(ranks.values(), default=-1) + 1, dtype=object)
        for rank, token in self.token.items():
            self.tokens[rank] = token
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        self.byte_pairs = np.array([ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)], dtype=np.int64)
        self.pairs: dict[int, int] = {}

    def _pair(self, key: int) -> int:
        """The rank of a pair of ids (left << 32 | right), -1 if its bytes are no token; remembered."""
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs.clear()
        found = self.pairs[key] = self.ranks.get(self.token[key >> 32] + self.token[key & 0xFFFFFFFF], -1)
        return found

    def pieces(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of pre-tokens (packed): always merge the lowest-ranked pair, leftmost first."""
        known, pair, words, bits, shift = self.pairs.get, self._pair, self.words, self.bits, self.shift
        mask = (1 << shift) - 1
        data = b"\0".join((b"", *pieces, b""))  # a place before, between and after the pre-tokens
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])  # these places
        inside = np.ones(len(data), dtype=bool)
        inside[bounds] = False
        letters = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
        ids = list(map(self.single.__getitem__, data))  # of the part that begins at each byte, -1: none
        for i in bounds.tolist():
            ids[i] = -1
        after = list(range(1, len(data) + 1))  # where the next part begins
        before = list(range(-1, len(data)))    # where the previous part begins
        # Rank of the pair that begins at part i, -1: no token.
        first = np.where(inside[:-1] & inside[1:], self.byte_pairs[letters[:-1] << 8 | letters[1:]], -1)
        waiting = [*first.tolist(), -1]
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0):]
        ranks, starts = np.unique(first[order], return_index=True)
        buckets, top, places = {}, 0, order.tolist()
        for rank, start, stop in zip(ranks.tolist(), starts.tolist(), [*starts[1:].tolist(), len(places)]):
            buckets[rank] = places[start:stop]
            words[rank >> shift] |= bits[rank & mask]
            top |= bits[rank >> shift]
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            rank = w << shift | (word & -word).bit_length() - 1
            words[w] = word & word - 1
            if not words[w]:
                top &= top - 1
            places = buckets.pop(rank)
            if len(places) > 1:
                places.sort()
            held, later = -1, []
            for i in places:
                if waiting[i] != rank:
                    continue  # stale
                if i < held:
                    later.append(i)
                    continue
                middle = after[i]
                stop = after[i] = after[middle]
                before[stop] = i
                ids[i] = least = rank
                ids[middle] = waiting[middle] = waiting[i] = -1
                right = ids[stop]
                if right >= 0:
                    new = known(key := rank << 32 | right)
                    if new is None:
                        new = pair(key)
                    if new >= 0:
                        waiting[i] = new
                        if new < least:
                            least = new
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> shift] |= bits[new & mask]
                            top |= bits[new >> shift]
                left = before[i]
                other = ids[left]
                if other >= 0:
                    new = known(key := other << 32 | rank)
                    if new is None:
                        new = pair(key)
                    waiting[left] = new
                    if new >= 0:
                        if new < least:
                            least = new
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            words[new >> shift] |= bits[new & mask]
                            top |= bits[new >> shift]
                if least < rank:  # a lower rank came up: it goes first in its pre-token
                    held = int(bounds[bisect_right(bounds, i)])
            if later:
                buckets[rank] = later
                words[rank >> shift] |= bits[rank & mask]
                top |= bits[rank >> shift]
        made = np.array(ids, dtype=np.int64)
        left = made >= 0
        packed = made[left].astype("<u4").tobytes()
        ends = (4 * np.cumsum(left)[bounds]).tolist()
        return [packed[a:b] for a, b in zip(ends, ends[1:])]

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, each a pre-token."""
        if self.short is not None and (text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)):
            return self.short.findall(text)
        return self.findall(text)

    def encode_all(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text; the texts are held in memory as pre-tokens meanwhile."""
        split = list(map(self.split, texts))
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo, self.older = {}, self.memo
        memo, ranks = self.memo, self.ranks
        wanted = set(chain.from_iterable(split)).difference(memo)
        fresh = []
        for piece in wanted:
            found = self.older.get(piece)
            if found is not None:
                memo[piece] = found
            elif (data := piece.encode()) in ranks:
                memo[piece] = ranks[data].to_bytes(4, "little")
            else:
                fresh.append((piece, data))
        own, size = [], 0
        for i, (_, data) in enumerate(fresh, 1):
            own.append(data)
            size += len(data)
            if size >= QUEUE_BYTES or i == len(fresh):
                memo.update(zip([piece for piece, _ in fresh[i - len(own):i]], self.pieces(own)))
                own, size = [], 0
        made = [np.frombuffer(b"".join(map(memo.__getitem__, pieces)), dtype="<u4") for pieces in split]
        for piece, _ in fresh:
            if len(piece) > MEMO_CHARS:
                del memo[piece]
        return made

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[ids].tolist())


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def shared_vocabulary(spark, path: str):
    """The vocabulary file as a broadcast, if it is of a vocabulary's size."""
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id",
                     text_col: str = "text", out: str = "ids") -> DataFrame:
    """Encode every text, then decode the ids.

    Returns per row: the id column, `ids` (array<long>) if out="ids", else
    digests: `n_tokens`, `ids_sha256` (ids as little-endian unsigned 32-bit
    integers) and `decoded_sha256`. Null and empty texts have no ids. Rows are
    independent: repeated ids and texts give repeated rows; other columns are
    not carried.
    """
    spark, digests = docs.sparkSession, out != "ids"
    shared = shared_vocabulary(spark, vocabulary)
    key = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {key}, " + ("n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = (hash(shared.value), pattern)
        if where not in _ENCODERS:
            _ENCODERS[where] = Encoder(parse_ranks(shared.value), pattern)
        encoder = _ENCODERS[where]
        for whole in batches:
            for batch in slices(whole, "__text"):
                made: list[list] = [[], [], []]
                for ids in encoder.encode_all([text or "" for text in batch.column("__text").to_pylist()]):
                    if digests:
                        made[0].append(len(ids))
                        made[1].append(hashlib.sha256(ids.tobytes()).hexdigest())
                        made[2].append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                    else:
                        made[0].append(ids.astype(np.int64))
                kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.list_(pa.int64()),)
                names = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ("ids",)
                yield pa.RecordBatch.from_arrays([batch.column("__id"), *(pa.array(x, y) for x, y in zip(made, kinds))], [id_col, *names])

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id") -> DataFrame:
    """Rows of (id, `ids`) back to (id, `text`): the exact inverse of `encode_documents`."""
    shared = shared_vocabulary(rows.sparkSession, vocabulary)
    key = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: data for data, rank in parse_ranks(shared.value).items()}
        for batch in batches:
            texts = [b"".join(token[i] for i in ids or ()).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(texts, pa.string())], [id_col, "text"])

    return rows.select(F.col(id_col).alias("__id"), "ids").mapInArrow(run, f"`{id_col}` {key}, text string")
