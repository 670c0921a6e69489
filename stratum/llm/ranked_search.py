"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its terms and of their tiers: a
term that occurs tf times is entered once for each tier (counts that grow by
about a quarter) that begins at tf or before. Documents of like size share a block, whose signatures stand transposed: slice r holds bit r of every
document of the block. The AND of a term's slices is a bitmap that names every
document with the term (and a few without it), so the highest tier named
bounds tf from above, and with the document's length, known exactly, the
term's part of the score. The weighted bitmaps summed give each document's
upper bound for each query, from a fraction of the text's bytes.

A search reads the slices twice. First, each query's documents with the highest
bounds are scored exactly; the kth exact score is a floor. Then every document whose
bound isn't below its query's floor is scored exactly: all others are provably
excluded. Texts are read again only for documents that are scored.

Queries are taken in chunks of a bounded number of terms, which tasks get as
a broadcast; all rows are searched for each chunk. A task keeps per query only
what can still be ranked: rows with one text tie, so no more than k of their
ids are kept. Tables are written between the steps.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import mix, slices, stored
from stratum.llm.merging import ragged

BITS_PER_KEY, HASHES = 16, 8   # of documents without a term, at most about 1 in 1,700 is named as well
BLOCK_CELLS = 1 << 23          # bits of a block at most, unless one document has more
BLOCK_DOCS = 4096
BLOCK_ROWS = 16                # blocks that Python gets at once
TASK_TERMS = 400_000           # distinct terms a task counts before it passes their counts on
CHUNK_TERMS = 500_000          # terms of the queries that are searched at once (bounds the broadcast)
CANDIDATES_MB = 16             # ids and digests that are broadcast at most
_BOUND_CELLS = 1 << 22         # numbers held at once while bounds are summed

# Bytes that are no part of a term become spaces, A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
# A tier begins at each of these counts, about a quarter above the last.
TIERS = [1]
while TIERS[-1] < 1 << 40:
    TIERS.append(max(TIERS[-1] + 1, TIERS[-1] * 5 // 4))
TIERS = np.array(TIERS, dtype=np.int64)

# Fixed values of the score.
_SCALE, _TF, _M = 1_000_000_000, 1000, 8


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII, with A-Z lowered."""
    return text.encode().translate(_FOLD).split() if text else []


def digest(text: str | None) -> bytes:
    return hashlib.md5((text or "").encode(), usedforsecurity=False).digest()


def length_norm(n, total_docs: int, total_terms: int):
    """m of a document with n terms."""
    return 10 + (90 * n * total_docs) // max(total_terms, 1)


def part(weight, tf, m):
    """A term's part of a score; grows with tf."""
    return weight * ((_SCALE * tf) // (_TF * tf + _M * m))


def _rows_of(hashes: np.ndarray, tier: np.ndarray | int, size: int) -> np.ndarray:
    """The slices (HASHES columns) of terms at tiers in a block of `size` slices."""
    a = mix(hashes + np.uint64(0x9E3779B97F4A7C15) * np.asarray(tier, dtype=np.uint64), 1)
    b = mix(a, 2) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


class _Open:
    """Documents of one size class that wait for their block to fill."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []     # id, digest, number of terms
        self.hashes: list[np.ndarray] = []
        self.tiers: list[np.ndarray] = []

    def close(self, size: int) -> tuple[list, np.ndarray]:
        """The rows and the block's slices, packed."""
        cells = np.zeros((size, -(-len(self.rows) // 8)), dtype=np.uint8)
        slot = np.repeat(np.arange(len(self.rows)), [len(h) for h in self.hashes])[:, None]
        at = _rows_of(np.concatenate(self.hashes), np.concatenate(self.tiers), size)
        np.bitwise_or.at(cells, (at, slot >> 3), (128 >> (slot & 7)).astype(np.uint8))
        return self.rows, cells


def signature_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: rows of blocks (ids, digests, lengths, slices) and of terms (`term`, `df`: how many
    documents of a task hold it). Documents without a term take no part."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"size int, ids array<{kind}>, digests array<binary>, lengths array<bigint>, slices binary, term binary, df bigint"
    names = ["size", "ids", "digests", "lengths", "slices", "term", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, _Open] = defaultdict(_Open)
        counted: Counter = Counter()
        types: list = [pa.int32(), None, pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]

        def block(class_: int) -> pa.RecordBatch:
            size = BITS_PER_KEY << class_
            rows, packed = open_.pop(class_).close(size)
            ids, digests, lengths = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([size, list(ids), list(digests), list(lengths), packed.tobytes(), None, None], types)], names)

        def terms() -> pa.RecordBatch:
            n = len(counted)
            made = pa.RecordBatch.from_arrays([*(pa.nulls(n, t) for t in types[:5]), pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())], names)
            counted.clear()
            return made

        for whole in batches:
            types[1] = pa.list_(whole.schema.field("__id").type)
            for batch in slices(whole, "__text"):
                for id_, text in zip(batch.column("__id").to_pylist(), batch.column("__text").to_pylist()):
                    words = terms_of(text)
                    if not words:
                        continue
                    found = Counter(words)
                    counted.update(found.keys())
                    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found))
                    tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                    tiers = np.searchsorted(TIERS, tf, side="right")
                    keys = np.repeat(hashes, tiers)
                    class_ = len(keys).bit_length()
                    held = open_[class_]
                    held.rows.append((id_, digest(text), len(words)))
                    held.hashes.append(keys)
                    held.tiers.append(ragged(np.zeros(len(tiers), dtype=np.int64), tiers).astype(np.int8))
                    if len(held.rows) >= min(BLOCK_DOCS, BLOCK_CELLS // (BITS_PER_KEY << class_)):
                        yield block(class_)
                if len(counted) > TASK_TERMS:
                    yield terms()
        for class_ in list(open_):
            yield block(class_)
        if counted:
            yield terms()

    return stored(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema), "signatures")


class Queries:
    """Queries as tasks need them: distinct terms with hashes and weights, and each query's terms."""

    def __init__(self, queries: list[int], terms: list[bytes], weights: list[int], total_docs: int, total_terms: int) -> None:
        self.total = total_docs, total_terms
        self.terms = sorted(set(terms))
        place = {t: i for i, t in enumerate(self.terms)}
        self.weight = np.zeros(len(place), dtype=np.int64)
        self.of: dict[int, list[int]] = defaultdict(list)
        for q, t, w in zip(queries, terms, weights):
            self.weight[place[t]] = w
            self.of[q].append(place[t])
        self.names = list(self.of)
        self.flat = np.array([i for q in self.names for i in self.of[q]], dtype=np.int64)
        counts = np.array([len(self.of[q]) for q in self.names], dtype=np.int64)
        self.starts = np.cumsum(counts) - counts
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.terms), dtype=np.uint64, count=len(place))

    def bounds(self, size: int, lengths: np.ndarray, packed: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, bound of each query and document) over runs of a block's documents."""
        m = length_norm(lengths, *self.total)
        step = max(8, _BOUND_CELLS // max(len(self.flat), len(self.terms), 1) // 8 * 8)
        for first in range(0, len(lengths), step):
            part_ = packed[:, first // 8:(first + step) // 8]
            n = min(step, len(lengths) - first)
            sums = np.zeros((len(self.terms), n), dtype=np.int64)
            tier, alive = 0, np.arange(len(self.terms))
            most = np.zeros((len(self.terms), n), dtype=np.int8)  # the highest tier named, from 1
            while len(alive) and tier < len(TIERS) - 1:
                rows = _rows_of(self.hashes[alive], tier, size)
                named = part_[rows[:, 0]]
                for k in range(1, HASHES):
                    named = named & part_[rows[:, k]]
                bits = np.unpackbits(named, axis=1, count=n).astype(bool)
                if tier:
                    bits &= most[alive] == tier
                most[alive] += bits
                tier, alive = tier + 1, alive[bits.any(axis=1)]
            term, slot = np.nonzero(most)
            tf = np.minimum(TIERS[most[term, slot]] - 1, lengths[first + slot])
            sums[term, slot] = part(self.weight[term], tf, m[first + slot])
            yield first, np.add.reduceat(sums[self.flat], self.starts, axis=0)

    def score(self, query: int, found: Counter, n: int) -> int:
        m = length_norm(n, *self.total)
        return sum(part(int(self.weight[i]), found[self.terms[i]], m) for i in self.of[query] if self.terms[i] in found)


def _order(id_) -> tuple:
    """Ids ascending; none last."""
    return (id_ is None, 0 if id_ is None else id_)


def _top(rows: DataFrame, k: int, by: list[str], score: str) -> DataFrame:
    """The k first rows of each group; Spark limits each task's rows before the shuffle."""
    order = [F.col(score).desc(), F.col("id").asc_nulls_last()]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def _bounded_rows(index: DataFrame, shared, k: int, kind: str, floors=None) -> DataFrame:
    """(q, id, digest, bound): without `floors` the k best bounds of each query, else all rows whose
    bound, and id among equals, isn't beyond the query's floor. Of rows with one text, k ids at most per task."""
    blocks = index.filter("size IS NOT NULL").select("size", "ids", "digests", "lengths", "slices")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, at_least = shared.value, floors.value if floors is not None else None
        kept: dict[tuple[int, bytes], list] = defaultdict(list)   # ids of one text for one query
        heaps: dict[int, list] = defaultdict(list)                # the k best (bound, digest) of a query, distinct texts
        bound_of: dict[tuple[int, bytes], int] = {}
        id_type = pa.int64()

        def rows() -> pa.RecordBatch:
            made = [(q, id_, d, bound_of[q, d]) for (q, d), ids in kept.items() for id_ in ids]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate((pa.int64(), id_type, pa.binary(), pa.int64()))], ["q", "id", "digest", "bound"])

        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for size, ids, digests, lengths, packed in zip(*(batch.column(c).to_pylist() for c in ("size", "ids", "digests", "lengths", "slices"))):
                lengths = np.array(lengths, dtype=np.int64)
                cells = np.frombuffer(packed, dtype=np.uint8).reshape(size, -1)
                for first, bounds in queries.bounds(size, lengths, cells):
                    for row, q in enumerate(queries.names):
                        own = bounds[row]
                        if at_least is None:
                            heap = heaps[q]
                            least = heap[0][0] if len(heap) >= k else 0
                            hits = np.flatnonzero((own > 0) & (own >= least))
                            if len(hits) > 4 * k:  # of many, those that can be among the k best texts or tie with them
                                hits = hits[np.argsort(-own[hits], kind="stable")][:4 * k]
                        else:
                            hits = np.flatnonzero(own >= max(at_least.get(q, 1), 1))
                        for j in hits.tolist():
                            d, id_ = digests[first + j], ids[first + j]
                            if (q, d) not in bound_of:
                                if at_least is None:
                                    entry = (int(own[j]), d)
                                    if len(heaps[q]) < k:
                                        heapq.heappush(heaps[q], entry)
                                    elif entry > heaps[q][0]:
                                        gone = heapq.heapreplace(heaps[q], entry)
                                        kept.pop((q, gone[1]))
                                        bound_of.pop((q, gone[1]))
                                    else:
                                        continue
                                bound_of[q, d] = int(own[j])
                            same = kept[q, d]
                            same.append(id_)
                            if len(same) > k:
                                same.sort(key=_order)
                                same.pop()
                if at_least is not None and len(kept) > TASK_TERMS:
                    yield rows()
                    kept.clear()
                    bound_of.clear()
        if kept:
            yield rows()

    return blocks.mapInArrow(run, f"q bigint, id {kind}, digest binary, bound bigint")


def _exact(docs: DataFrame, wanted: DataFrame, shared, kind: str, k: int) -> DataFrame:
    """(q, digest, score) of the wanted (q, digest, id), each text scored once per query from its whole text.

    One id per text, its smallest, is looked up; the digest tells the right row of a repeated id. A task hands on
    the k first texts of each query by score and that id: any other has k rows before all of its own."""
    one = wanted.groupBy("q", "digest").agg(F.min_by("id", F.struct(F.col("id").isNull(), "id")).alias("id"))
    texts = one.groupBy("digest", "id").agg(F.collect_list("q").alias("qs"))
    texts = stored(texts, "wanted")
    size = texts.agg(F.sum(F.size("qs") * 8 + 32 + F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0)))).first()[0] or 0
    side = F.broadcast(texts) if size <= CANDIDATES_MB << 20 else texts
    rows = docs.join(side.select(F.col("id").alias("__wanted"), "digest", "qs"),
                     F.col("__id").eqNullSafe(F.col("__wanted")) & (F.unhex(F.md5(F.col("__text").cast("binary"))) == F.col("digest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best: dict[int, dict[bytes, tuple]] = defaultdict(dict)  # of a query: digest -> place in the ranking

        def cut(q: int) -> None:
            best[q] = dict(sorted(best[q].items(), key=lambda x: x[1])[:k])

        for whole in batches:
            for batch in slices(whole, "__text"):
                for text, id_, d, qs in zip(*(batch.column(c).to_pylist() for c in ("__text", "__id", "digest", "qs"))):
                    words = terms_of(text)
                    found = Counter(words)
                    for q in qs:
                        best[q][d] = (-queries.score(q, found, len(words)), _order(id_))
                        if len(best[q]) > 8 * k:
                            cut(q)
        for q in best:
            cut(q)
        made = [(q, d, -place[0]) for q, own in best.items() for d, place in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.int64()))], ["q", "digest", "score"])

    return rows.select("__text", "__id", "digest", "qs").mapInArrow(run, "q bigint, digest binary, score bigint").distinct()


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The k documents of highest score above 0 for each item.

    Returns item_id, rank, doc_id, score. Terms are runs of ASCII letters and
    digits and of characters beyond ASCII, A-Z lowered; null and empty texts
    have none, and count neither as documents nor as queries. Rows are ranked
    on their own: a repeated row takes as many ranks, a repeated item is
    answered as often, equal scores go by ascending id (rows without an id
    last). Empty tables give no rows; other columns are not carried.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, "__id"), (items, item_col)))
    index = signature_index(docs, id_col="__id", text_col="__text")
    total = index.filter("size IS NOT NULL").agg(F.sum(F.size("lengths")), F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)"))).first()
    total_docs, total_terms = total[0] or 0, total[1] or 0

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("q"), pa.array(terms, pa.list_(pa.binary()))], ["q", "terms"])

    # Items numbered as rows, so that repeated ones stay apart; written, so that the numbers stay.
    named = stored(items.select(F.monotonically_increasing_id().alias("q"), F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")), "items")
    terms = named.select("q", "text").mapInArrow(split, "q bigint, terms array<binary>").select("q", F.explode("terms").alias("term"))
    terms = stored(terms, "terms")
    held = index.filter("term IS NOT NULL").select("term", "df").join(terms.select("term").distinct(), "term", "left_semi")
    weight: Column = F.floor(1000 * F.log((2 * F.lit(total_docs).cast("bigint") + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("bigint")
    weights = held.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("w"))
    n_chunks = -(-terms.count() // CHUNK_TERMS)
    weighted = stored(terms.join(weights, "term").withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(max(n_chunks, 1)))), "weighted")

    found = []
    for chunk in range(n_chunks):
        rows = weighted.filter(F.col("chunk") == chunk).select("q", "term", "w").toArrow()
        if not rows.num_rows:
            continue
        shared = spark.sparkContext.broadcast(Queries(*(rows.column(c).to_pylist() for c in ("q", "term", "w")), total_docs, total_terms))
        first = stored(_top(_bounded_rows(index, shared, k, kind), k, ["q"], "bound"), "first", BLOCK_ROWS)
        scored = stored(first.join(_exact(docs, first, shared, kind, k), ["q", "digest"]), "scored")
        # One row of fixed width for each query of the chunk.
        floors = {r.q: r.score for r in _top(scored, k, ["q"], "score").filter(F.col("rank") == k).select("q", "score").collect()}
        left = _bounded_rows(index, shared, k, kind, spark.sparkContext.broadcast(floors))
        left = stored(_top(left, k, ["q", "digest"], "bound").drop("rank"), "left", BLOCK_ROWS)
        fresh = left.join(scored.select("q", "digest").distinct(), ["q", "digest"], "left_anti")
        known = scored.select("q", "digest", "score").distinct().unionByName(_exact(docs, fresh, shared, kind, k))
        best = left.join(known, ["q", "digest"]).filter("score > 0")
        found.append(stored(_top(best, k, ["q"], "score").select("q", "rank", F.col("id").alias("doc_id"), "score"), "found"))
    if not found:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.join(named.select("q", "item_id"), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
