"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes; where both end a token, a group ends, and
all A-B token pairs of a group are links. Documents are dealt into blocks of
up to 65,536 (an Arrow batch of bounded text), each made whole by one task:

1. A text falls into segments that both tokenizers cut on their own (a space
   between two characters that aren't white space begins one). Each distinct
   segment is tokenized and grouped once; a document is its segments' sum.
2. A block's postings: per pair the bitmap of its documents, which is the OR of the
   bitmaps of the segments that hold it, and multiplicity planes for documents
   with more links than one (plane p: bit p of links - 1). A bitmap is stored
   as a list of 16-bit places or as bits, whichever is smaller.
3. Blocks are disjoint, so a pair's document count is the sum of its bitmaps'
   popcounts: one row per pair and block is shuffled, however frequent a pair.
4. The counts are joined to the postings, which go back to their blocks; there each
   plane gives its weight times the pair's count to the documents it names.

No document's pairs are shuffled one by one and no bitmap grows beyond its block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.bpe import shared_vocabulary
from stratum.llm.common import slices, stored
from stratum.llm.merging import ByteVocabulary, PieceVocabulary, ragged

BLOCK_DOCS = 1 << 16     # places in a block
BLOCK_BYTES = 4 << 20    # text in a block (a longer text is a block of its own)
SEGMENTS = 500_000       # distinct segments a worker remembers before it starts afresh
LINKS = 6_000_000        # and their links
PIECES = 120_000         # distinct pre-tokens that it remembers besides
AT_ONCE = 30_000         # segments that are tokenized together
_ID_BITS = 20            # a pair is A's id << 20 | B's id

# A segment ends before a single space between two characters that aren't white space.
_parts = re.compile(r"\s*\S+(?:(?:\s{2,}|[^\S ])\S+)*(?:\s+\Z)?|\s+").findall
_uneven = re.compile(r"(?:^|\s) | (?=\s|\Z)").search  # a space that ends no segment


def _segments(text: str) -> list[str]:
    """Segments of space + text, each without the space it begins with."""
    if not text:
        return []
    return [s[1:] for s in _parts(" " + text)] if _uneven(text) else text.split(" ")


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    head = np.ones(len(sorted_keys), dtype=bool)
    head[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(head)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = _runs(keys)
    return keys[starts], np.add.reduceat(weights[order], starts)


class Aligner:
    """Segments of texts and what both tokenizers make of them."""

    def __init__(self, byte_vocabulary: bytes, pattern: str, piece_model: bytes) -> None:
        self.a, self.b = ByteVocabulary(byte_vocabulary, pattern, PIECES), PieceVocabulary(piece_model)
        most = max(len(self.a.token), self.b.n_pieces)
        if most > 1 << _ID_BITS:
            raise ValueError("vocabulary too large")
        self.written = [f"{i}{mark}" for i in range(most) for mark in ",|;"]
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[str] = []  # the groups written out, each with its `;`
        self.pairs, self.times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)  # links, one segment after another
        # Per segment: tokens of A and of B, groups, links; -1 tokens if the bytes differ. Where its distinct links begin, how many.
        self.sums = np.zeros((0, 4), dtype=np.int64)
        self.starts = self.counts = np.zeros(0, dtype=np.int64)

    def places(self, segments: list[str]) -> np.ndarray:
        if len(self.place) > SEGMENTS or len(self.pairs) > LINKS:
            self.clear()
        unseen = list(set(segments).difference(self.place))
        for first in range(0, len(unseen), AT_ONCE):
            self._add(unseen[first:first + AT_ONCE])
        return np.fromiter(map(self.place.__getitem__, segments), dtype=np.int64, count=len(segments))

    def _add(self, segments: list[str]) -> None:
        plain = [s for s in segments if s and not s[0].isspace() and not s[-1].isspace()]
        segments = plain + list(set(segments).difference(plain))  # the rest is at the edges of a text
        spaced = [" " + s for s in segments]
        (a, n_a), (rest, n_rest) = self.a.encode_joined(spaced[:len(plain)]), self.a.encode(spaced[len(plain):])
        a, n_a = np.concatenate([a, rest]), np.concatenate([n_a, n_rest])
        b, n_b = self.b.encode_whole(segments)
        joined, n = b"".join(map(self.b.surface.__getitem__, b.tolist())), len(segments)
        own = [s.encode() for s in spaced]
        size = np.fromiter(map(len, own), dtype=np.int64, count=n)
        of_a, of_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        size_b = np.bincount(of_b, weights=self.b.n_bytes[b], minlength=n).astype(np.int64)
        same = np.ones(n, dtype=bool)
        if joined != b"".join(own):
            ends = np.cumsum(size_b).tolist()
            same = np.array([joined[e - s:e] == o for e, s, o in zip(ends, size_b.tolist(), own)])
            a, of_a, b, of_b, size = a[same[of_a]], of_a[same[of_a]], b[same[of_b]], of_b[same[of_b]], size[same]
        ends_a, ends_b = np.cumsum(self.a.n_bytes[a]), np.cumsum(self.b.n_bytes[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        owner = np.empty(len(cuts), dtype=np.int64)  # the segment of each group
        owner[group_a] = of_a
        # Distinct ids of each group with their counts; every A meets every B of its group.
        one = np.ones(1, dtype=np.int64)
        key_a, times_a = _summed(group_a << _ID_BITS | a, np.broadcast_to(one, len(a)))
        key_b, times_b = _summed(group_b << _ID_BITS | b, np.broadcast_to(one, len(b)))
        width = np.bincount(key_b >> _ID_BITS, minlength=len(cuts))
        group = key_a >> _ID_BITS
        other = ragged((np.cumsum(width) - width)[group], width[group])
        key_a, times = np.repeat(key_a, width[group]), np.repeat(times_a, width[group]) * times_b[other]
        low = (1 << _ID_BITS) - 1
        pairs, of_link = (key_a & low) << _ID_BITS | key_b[other] & low, owner[key_a >> _ID_BITS]
        counts = np.bincount(of_link, minlength=n)
        sums = np.stack([np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n), np.bincount(owner, minlength=n),
                         np.bincount(of_link, weights=times, minlength=n).astype(np.int64)], axis=1)
        sums[~same] = -1
        # Groups written out: A's ids, then B's, in the order of the groups; `|` after the last A, `;` after the last B.
        last = np.concatenate([np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True) * 2]) if len(a) else np.zeros(0, dtype=np.int64)
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        words = list(map(self.written.__getitem__, (np.concatenate([a, b]) * 3 + last)[order].tolist()))
        ends = np.concatenate([[0], np.cumsum(np.where(same, n_a + n_b, 0))]).tolist()
        self.text += ["".join(words[s:e]) for s, e in zip(ends, ends[1:])]
        self.place.update(zip(segments, range(len(self.place), len(self.place) + n)))
        self.starts = np.concatenate([self.starts, len(self.pairs) + np.cumsum(counts) - counts])
        self.counts, self.sums = np.concatenate([self.counts, counts]), np.concatenate([self.sums, sums])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times.astype(np.int32)])

    def block(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text the tokens of A and B, groups and links, and the groups' digest; then the distinct
        (pair, text, links), in order."""
        split = [_segments(t) for t in texts]
        n_segments = np.array([len(s) for s in split], dtype=np.int64)
        at = self.places([s for found in split for s in found])
        slot = np.repeat(np.arange(len(texts)), n_segments)
        sums = np.zeros((len(texts), 4), dtype=np.int64)
        np.add.at(sums, slot, self.sums[at])
        bad = np.zeros(len(texts), dtype=bool)
        bad[slot[self.sums[at, 0] < 0]] = True
        sums[bad] = 0
        ends, at_list, digests = np.cumsum(n_segments).tolist(), at.tolist(), []
        for i, (e, n) in enumerate(zip(ends, n_segments.tolist())):
            written = "" if bad[i] else "".join(map(self.text.__getitem__, at_list[e - n:e]))
            digests.append(hashlib.sha256(written[:-1].encode()).hexdigest() if written else "")
        kept = ~bad[slot]
        key, times = _summed(at[kept] * BLOCK_DOCS + slot[kept], np.ones(kept.sum(), dtype=np.int64))
        at, slot = key // BLOCK_DOCS, key % BLOCK_DOCS
        width = self.counts[at]
        link = ragged(self.starts[at], width)
        key, links = _summed(self.pairs[link] * BLOCK_DOCS + np.repeat(slot, width), self.times[link].astype(np.int64) * np.repeat(times, width))
        return sums, digests, key // BLOCK_DOCS, key % BLOCK_DOCS, links


def bitmaps(pair: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Per pair (in order): how many places, and the places as a list of 16-bit numbers or as bits."""
    starts = _runs(pair)
    n = np.diff(np.append(starts, len(pair)))
    dense = n * 16 > size
    sparse = ~np.repeat(dense, n)
    listed = slot[sparse].astype("<u2").tobytes()
    offsets = np.concatenate([[0], np.cumsum(np.where(dense, 0, 2 * n))]).astype(np.int32)
    lists = pa.Array.from_buffers(pa.binary(), len(n), [pa.array(~dense).buffers()[1], pa.py_buffer(offsets), pa.py_buffer(listed)])
    bits: list[bytes | None] = [None] * len(n)
    for i in np.flatnonzero(dense).tolist():
        row = np.zeros(size, dtype=bool)
        row[slot[starts[i]:starts[i] + n[i]]] = True
        bits[i] = np.packbits(row).tobytes()
    return pair[starts], n, lists, pa.array(bits, pa.binary())


_ALIGNERS: dict[tuple, Aligner] = {}
_POSTING = "block bigint, pair bigint, plane int, n bigint, places binary, bits binary"
_RESULT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def link_index(docs: DataFrame, byte_vocabulary: str, pattern: str, piece_model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: rows of documents (`pair` is null) and postings, by block.

    Plane -1 of a pair is its document bitmap, plane p >= 0 has the documents in
    whose number of links less one bit p is set.
    """
    spark = docs.sparkSession
    shared_a, shared_b = shared_vocabulary(spark, byte_vocabulary), shared_vocabulary(spark, piece_model)
    key = docs.schema[id_col].dataType.simpleString()
    schema = f"{_POSTING}, slot int, `{id_col}` {key}, {_RESULT}, groups_sha256 string"
    names = [f.split()[0].strip("`") for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = (hash(shared_a.value), hash(shared_b.value), pattern)
        aligner = _ALIGNERS.get(where) or _ALIGNERS.setdefault(where, Aligner(shared_a.value, pattern, shared_b.value))
        block = (TaskContext.get().partitionId() << 32) - 1
        for whole in batches:
            for part in slices(whole, "__text", BLOCK_BYTES):
                for first in range(0, part.num_rows, BLOCK_DOCS):
                    batch = part.slice(first, BLOCK_DOCS)
                    block, size = block + 1, batch.num_rows
                    sums, digests, pair, slot, links = aligner.block([t or "" for t in batch.column("__text").to_pylist()])
                    none, here = pa.nulls(size, pa.int64()), pa.array(np.full(size, block))
                    yield pa.RecordBatch.from_arrays(
                        [here, none, none.cast(pa.int32()), none, pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), pa.array(np.arange(size, dtype=np.int32)),
                         batch.column("__id"), *(pa.array(sums[:, k]) for k in range(4)), pa.array(digests, pa.string())], names)
                    more = links - 1
                    for plane in range(-1, int(more.max(initial=0)).bit_length()):
                        held = slice(None) if plane < 0 else (more >> plane & 1).astype(bool)
                        if not len(pair[held]):
                            continue
                        pairs, n, lists, bits = bitmaps(pair[held], slot[held], size)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(n), block)), pa.array(pairs), pa.array(np.full(len(n), plane, dtype=np.int32)), pa.array(n.astype(np.int64)), lists, bits,
                             pa.nulls(len(n), pa.int32()), pa.nulls(len(n), batch.schema.field("__id").type), *[pa.nulls(len(n), pa.int64())] * 4, pa.nulls(len(n), pa.string())], names)

    return stored(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema), "links")


def pair_counts(index: DataFrame) -> DataFrame:
    """Of every pair: a_id, b_id, n_docs (documents that link it) and n_links (links in all)."""
    weight = F.expr("CASE WHEN plane < 0 THEN n ELSE n * shiftleft(1L, plane) END")
    return (index.filter("pair IS NOT NULL").groupBy("pair")
            .agg(F.sum(F.when(F.col("plane") < 0, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(weight).alias("n_links"))
            .select(F.shiftright("pair", _ID_BITS).alias("a_id"), F.expr(f"pair & {(1 << _ID_BITS) - 1}L").alias("b_id"), "n_docs", "n_links"))


def align_tokenizers(docs: DataFrame, byte_vocabulary: str, pattern: str, piece_model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The links of space + text under the byte-level vocabulary (A) and text under the piece model (B).

    Returns per row: the id column, n_a, n_b, n_groups, n_links, groups_sha256
    (digest of `a1,a2|b1;...`, '' without tokens), n_best (links whose pair's
    document count is the highest of its A id, ties included) and count_sum
    (document counts summed over links). Null and empty texts, and texts whose
    token bytes differ from space + text under either tokenizer (such as those
    with U+2581), have zeros. Rows count as documents of their own, so
    repeated rows count repeatedly; an empty table gives none; other columns
    are not carried.
    """
    index = link_index(docs, byte_vocabulary, pattern, piece_model, id_col=id_col, text_col=text_col)
    names = ["n_a", "n_b", "n_groups", "n_links"]
    counts = stored(pair_counts(index).select("a_id", "b_id", "n_docs"), "pairs")
    # One row for each id of A's vocabulary at most (a vocabulary file is bounded), so it is broadcast.
    most = F.broadcast(counts.groupBy("a_id").agg(F.max("n_docs").alias("most")))
    scored = counts.join(most, "a_id").select(F.expr(f"shiftleft(a_id, {_ID_BITS}) | b_id").alias("pair"), "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    posts = (index.filter("pair IS NOT NULL").select("block", "pair", "plane", "places", "bits").join(scored, "pair")
             .select("block", "plane", "places", "bits", "n_docs", "best"))
    rows = index.filter("pair IS NULL").select(F.col("block").alias("own"), "slot", F.col(id_col).alias("__id"), *names, "groups_sha256")
    key = docs.schema[id_col].dataType.simpleString()

    def returned(rows: pa.Table, posts: pa.Table) -> pa.Table:
        """Scores of one block's documents from its postings."""
        size = rows.num_rows
        best, total = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        plane, docs_, is_best = (posts.column(c).to_numpy() for c in ("plane", "n_docs", "best"))
        weight = np.int64(1) << np.maximum(plane, 0).astype(np.int64)
        lists = posts.column("places")
        n = pc.binary_length(lists).fill_null(0).to_numpy() // 2
        places = np.frombuffer(b"".join(x for x in lists.to_pylist() if x), dtype="<u2")
        np.add.at(total, places, np.repeat(docs_ * weight, n))
        np.add.at(best, places, np.repeat(is_best * weight, n))
        for i, bits in enumerate(posts.column("bits").to_pylist()):
            if bits:
                held = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=size).astype(bool)
                total[held] += docs_[i] * weight[i]
                best[held] += is_best[i] * weight[i]
        slot = rows.column("slot").to_numpy()
        return pa.Table.from_arrays([rows.column("__id"), *(rows.column(c) for c in names), pa.array(best[slot]), pa.array(total[slot]), rows.column("groups_sha256")],
                                    [id_col, *names, "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("own").cogroup(posts.groupBy("block")).applyInArrow(
        returned, f"`{id_col}` {key}, {_RESULT}, n_best bigint, count_sum bigint, groups_sha256 string")
