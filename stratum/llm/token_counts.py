"""Token counts by rank-synchronous array merging.

Pre-tokens not counted before are held together as ragged numpy arrays: one
flat array of symbols and the place where each sequence begins. A round looks
up the rank of every adjacent pair, takes each sequence's lowest rank and
merges that pair everywhere in the sequence at once; sequences without a
mergeable pair leave the arrays. What survives of a sequence is its count.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.bpe import shared_vocabulary
from stratum.llm.common import slices

MEMO_ENTRIES = 400_000   # counted pre-tokens a worker remembers before it starts afresh
MEMO_CHARS = 64          # longer pre-tokens are counted each time
# No word-final sigma rule, and two letters newer than Python's tables.
_LOWER = {0x03A3: 0x03C3, 0xA7CB: 0x0264, 0xA7DC: 0x019B}
_NO_RANK = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Counter:
    """Counts by a tokenizer file: NFC, white space runs to a space, lower case; the file's
    pre-token pattern; byte symbols, the last with the word-end suffix; ranked merges.
    Special tokens found in a text count as one each, as the library does by default."""

    def __init__(self, data: bytes) -> None:
        spec = json.loads(data)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.findall = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")).findall
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.split_special = regex.compile("|".join(sorted(special, key=len, reverse=True))).split if special else None
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int64)
        self.size = len(vocab)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.memo: dict[str, int] = {}

    def look_up(self, at: np.ndarray, symbols: np.ndarray, sequence: np.ndarray, rank: np.ndarray) -> None:
        """Set the ranks of the pairs that begin at `at`."""
        rank[at] = _NO_RANK
        at = at[at + 1 < len(symbols)]
        at = at[sequence[at] == sequence[at + 1]]
        key = symbols[at] * self.size + symbols[at + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[found] == key
        rank[at[hit]] = self.ranks[found[hit]]

    def merge_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) byte sequence."""
        counts = np.ones(len(pieces), dtype=np.int64)
        if not pieces:
            return counts
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[flat]
        symbols[ends - 1] = self.last[flat[ends - 1]]
        owner = np.arange(len(pieces))
        sequence = np.repeat(owner, lengths)
        rank = np.full(len(symbols), _NO_RANK)  # of the pair that begins at each symbol
        self.look_up(np.arange(len(symbols)), symbols, sequence, rank)
        while len(owner):
            lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
            at = np.flatnonzero((rank == np.repeat(lowest, lengths)) & (rank < _NO_RANK))
            # A run of overlapping equal pairs (aaa) merges every second one from its left end.
            head = np.ones(len(at), dtype=bool)
            head[1:] = at[1:] != at[:-1] + 1
            run_start = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            lengths = lengths - np.bincount(sequence[at], minlength=len(owner))
            counts[owner] = lengths
            symbols, sequence, rank = symbols[keep], sequence[keep], rank[keep]
            at = at - np.arange(len(at))  # where the merged symbols stand now
            self.look_up(np.concatenate([at, at[at > 0] - 1]), symbols, sequence, rank)
            going = (lowest < _NO_RANK) & (lengths > 1)
            if not going.all():
                keep = going[sequence]
                owner, lengths = owner[going], lengths[going]
                symbols, rank, sequence = symbols[keep], rank[keep], np.repeat(np.arange(len(owner)), lengths)
        return counts

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special tokens stand between them."""
        parts = self.split_special(text) if self.split_special else [text]
        found: list[str] = []
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).translate(_LOWER)
            found += self.findall(part.lower())
        return found, len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pretokens(t) for t in texts]
        memo, fresh = self.memo, {}
        if len(memo) >= MEMO_ENTRIES:
            memo.clear()
        unseen = list({p for found, _ in split for p in found}.difference(memo))
        for piece, n in zip(unseen, self.merge_counts([p.encode() for p in unseen]).tolist()):
            (memo if len(piece) <= MEMO_CHARS else fresh)[piece] = n
        look = memo.__getitem__ if not fresh else lambda p: fresh[p] if p in fresh else memo[p]
        return [sum(map(look, found)) + specials for found, specials in split]


_COUNTERS: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Tokens of every text.

    Returns per row: the id column, n_bytes (UTF-8), n_tokens and over_limit
    (n_tokens > limit). Null and empty texts count 0. Rows are independent:
    repeated rows give repeated results; other columns are not carried.
    """
    shared = shared_vocabulary(docs.sparkSession, vocabulary)
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        counter = _COUNTERS.get(hash(data)) or _COUNTERS.setdefault(hash(data), Counter(data))
        for whole in batches:
            for batch in slices(whole, "__text"):
                column = batch.column("__text")
                counts = counter.count([t or "" for t in column.to_pylist()])
                n_bytes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("__id"), n_bytes, pa.array(counts, pa.int64())], [id_col, "n_bytes", "n_tokens"])

    return (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
            .mapInArrow(run, f"`{id_col}` {key}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
