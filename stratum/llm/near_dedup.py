"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct word shingles. A hash deals every shingle
to one of REGISTERS buckets; a bucket keeps the least second hash as a
register of its leading-zero count (6 bits) and the next MANTISSA bits. An
empty bucket borrows from the first filled one of a fixed random order.

1. Documents with equal sets are one class; its smallest id stands for it.
2. BANDS keys of ROWS registers each; a class meets others under equal keys.
3. Under each key one pivot is chosen, the member that meets most others; whoever meets a
   pivot belongs to its group. Members are compared on full sets with the pivot and the
   COMPANIONS members of the group that meet most others.
4. Let P be the union of those sets, and X a member that is not yet in the pivot's
   component. Linked sets X and Y share r (|X| + |Y|) shingles or more, r = 3/7 for a similarity
   of 3/4, so if |X & P| is less, they share some outside P: X is paired with those who
   hold one of its outside shingles, the rarest first, and as at least 2 r |X| s - |X & P| must
   be shared (s: the least size ratio), all but that many less one are tried. If |X & P| and |Y & P| are enough
   to link them, they are paired by size alone; few members are so and yet not linked with any of P's.
   Pairs that the collision-corrected estimate can't rule out are verified on full sets.

Thus every pair under an equal key is linked, in one component or ruled out, without
making all pairs of a bucket, and there is no cap. At a similarity of 0.75 two sets
share no key with probability (1 - 0.75**5)**48 = 2e-6, and less above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import WIDE_ROWS, bounded, byte_texts, mix, slices, span_hashes, stored, words_joined
from stratum.llm.components import components

ROWS, BANDS, MANTISSA = 5, 48, 10
REGISTERS = ROWS * BANDS
COMPANIONS = 4
SLACK = 0.2             # an estimate this far below the threshold rules a pair out (7 deviations)

_ORDERS = np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64), 5).reshape(REGISTERS, REGISTERS), axis=1)


def shingles(text: bytes, size: int) -> np.ndarray:
    """Hashes of the distinct runs of `size` words, sorted; fewer words are one run."""
    data, starts, ends = words_joined(text)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(starts))
    return np.unique(span_hashes(data, starts[:len(starts) - size + 1], ends[size - 1:]))


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (leading zeros and mantissa) of a non-empty set of hashes."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    np.minimum.at(least, bucket, mix(hashes, 11))
    filled = np.zeros(REGISTERS, dtype=bool)
    filled[bucket] = True
    fraction, exponent = np.frexp(least.astype(np.float64))
    found = (np.minimum(64 - exponent, 63) << MANTISSA | ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)).astype("<u2")
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDERS[empty]
        found[empty] = found[order[np.arange(len(empty)), np.argmax(filled[order], axis=1)]]
    return found


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less the collisions expected
    of sets of n and m elements that have nothing in common."""
    chance = 0.16992 / (1 << MANTISSA) * 4 * n * m / (n + m) ** 2.0 * 4
    return (equal - chance) / (1 - chance)


def sketch(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """Per row: __id, n_shingles, __digest (of the set) and __registers; both null for an empty set."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text"):
                counts, digests, kept = [], [], []
                for text in byte_texts(batch.column("__text")):
                    found = shingles(text, size)
                    counts.append(len(found))
                    digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                    kept.append(registers(found).tobytes() if len(found) else None)
                yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())],
                                                 ["__id", "n_shingles", "__digest", "__registers"])

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(
        run, f"__id {key}, n_shingles bigint, __digest binary, __registers binary")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose registers don't rule them out."""
    kind = pairs.schema["a"].dataType.simpleString()
    least = percent / 100 - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
            keep = (estimate((ra == rb).mean(axis=1), na, nb) >= least) & (np.minimum(na, nb) * 100 >= percent * np.maximum(na, nb))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    for end in ("b", "a"):
        pairs = pairs.join(classes.select(F.col("__id").alias(end), F.col("n_shingles").alias(f"n{end}"), F.col("__registers").alias(f"r{end}")), end)
    return pairs.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _with_texts(pairs: DataFrame, texts: DataFrame, ends: str) -> DataFrame:
    """Pairs with the text of each named end `x` in `tx`."""
    for end in ends:
        pairs = pairs.join(texts.select(F.col("__id").alias(end), F.col("__text").alias(f"t{end}")), end)
    return pairs


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (u, v): pairs whose full sets are similar enough."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            keep = []
            for a, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "ta", "tb"))):
                if last is None or last != (a, ta):
                    last, left = (a, ta), shingles((ta or "").encode(), size)
                right = shingles((tb or "").encode(), size)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).rename_columns(["u", "v"])

    return _with_texts(pairs, texts, "ba").select("a", "b", "ta", "tb").mapInArrow(run, f"u {kind}, v {kind}")


def _profiles(chosen: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, ids, sizes, hashes, masks) of pivots a: whose sets make up the union, their sizes, the union's
    hashes in order and for each, as bits, whose it is. `chosen`: (a, b), b one of a's few."""
    kind = chosen.schema["a"].dataType.simpleString()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            ids, sizes, hashes, masks = [], [], [], []
            for members in batch.column("members").to_pylist():
                members = list({m["b"]: m for m in members}.values())
                own = [shingles((m["tb"] or "").encode(), size) for m in members]
                every, at = np.unique(np.concatenate(own), return_inverse=True)
                mask = np.zeros(len(every), dtype=np.uint8)
                np.bitwise_or.at(mask, at, np.repeat(np.uint8(1) << np.arange(len(own), dtype=np.uint8), [len(o) for o in own]))
                ids.append([m["b"] for m in members])
                sizes.append([len(o) for o in own])
                hashes.append(every.tobytes())
                masks.append(mask.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("a"), pa.array(ids, pa.list_(batch.schema.field("a").type)), pa.array(sizes, pa.list_(pa.int64())), pa.array(hashes, pa.binary()), pa.array(masks, pa.binary())],
                                             ["a", "ids", "sizes", "hashes", "masks"])

    return (_with_texts(chosen, texts, "b").groupBy("a").agg(F.collect_list(F.struct("b", "tb")).alias("members"))
            .mapInArrow(joined, f"a {kind}, ids array<{kind}>, sizes array<bigint>, hashes binary, masks binary"))


def _held_against(pairs: DataFrame, profiles: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """For members b of pivots a: `links` (of the profile's ids, those it is linked with), `n` (set size),
    `inside` (shingles in the profile) and `outside` (the hashes of the others)."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "hashes"):
                links, counts, inside, outside = [], [], [], []
                for tb, ids, sizes, hashes, masks in zip(*(batch.column(c).to_pylist() for c in ("tb", "ids", "sizes", "hashes", "masks"))):
                    own = shingles((tb or "").encode(), size)
                    every, mask = np.frombuffer(hashes, dtype=np.uint64), np.frombuffer(masks, dtype=np.uint8)
                    at = np.minimum(np.searchsorted(every, own), len(every) - 1)
                    hit = every[at] == own
                    both = np.unpackbits(mask[at[hit]][:, None], axis=1, bitorder="little").sum(axis=0)
                    links.append([i for i, n, k in zip(ids, sizes, both.tolist()) if k and 100 * k >= percent * (n + len(own) - k)])
                    counts.append(len(own))
                    inside.append(int(hit.sum()))
                    outside.append(own[~hit].view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(links, batch.schema.field("ids").type), pa.array(counts, pa.int64()), pa.array(inside, pa.int64()), pa.array(outside, pa.list_(pa.int64()))],
                                                 ["a", "b", "links", "n", "inside", "outside"])

    return (_with_texts(pairs, texts, "b").join(profiles, "a").select("a", "b", "tb", "ids", "sizes", "hashes", "masks")
            .mapInArrow(run, f"a {kind}, b {kind}, links array<{kind}>, n bigint, inside bigint, outside array<bigint>"))


def _remaining(held: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of a pivot that may be linked and aren't in one component yet."""
    labels = labels.select(F.col("node").alias("x"), "component")
    rows = (held.select(F.col("a").alias("p"), F.col("b").alias("x"), "n", "inside", "outside").join(labels, "x", "left").withColumn("c", F.coalesce("component", "x")).drop("component")
            .join(labels.withColumnRenamed("x", "p"), "p", "left").withColumn("open", F.col("c") != F.coalesce("component", "p")).drop("component"))
    # What linked sets of n and m share at least, times (100 + percent): percent * (n + m); m is percent % of n or more.
    need = F.ceil((percent * F.col("n") + percent * F.ceil(percent * F.col("n") / 100)) / (100 + percent)) - F.col("inside")
    rows = rows.withColumn("tries", F.size("outside") - F.greatest(need, F.lit(1)) + 1)
    busy = rows.groupBy("p").agg(F.max("open").alias("any")).filter("any").select("p")
    rows = stored(rows.join(busy, "p", "left_semi"), "open")
    cold = rows.select("p", "x", "c", "open", "tries", F.explode("outside").alias("h"))
    often = cold.groupBy("p", "h").agg(F.count(F.lit(1)).alias("k"))
    rarest = F.row_number().over(Window.partitionBy("p", "x").orderBy("k", "h"))
    # A shingle of one member counts in the order of the tried ones, but finds nobody.
    tried = cold.filter("open and tries > 0").join(often, ["p", "h"]).withColumn("__n", rarest).filter("__n <= tries and k > 1").select("p", "h", F.col("x").alias("a"), F.col("c").alias("ca"))
    by_outside = tried.join(cold.select("p", "h", F.col("x").alias("b"), F.col("c").alias("cb")), ["p", "h"]).filter("ca <> cb").select("a", "b")
    core = rows.filter(f"inside * 100 >= {percent} * n")  # else no partner is small enough
    by_size = (core.filter("open").select("p", F.col("x").alias("a"), F.col("c").alias("ca"), "n", "inside")
               .join(core.select("p", F.col("x").alias("b"), F.col("c").alias("cb"), F.col("n").alias("m"), F.col("inside").alias("within")), "p")
               .filter("ca <> cb").filter(f"100 * least(n, m) >= {percent} * greatest(n, m)")
               .filter(f"least(inside, within) * (100 + {percent}) >= {percent} * (n + m)").select("a", "b"))
    return by_outside.unionByName(by_size).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """Link documents whose sets' intersection is at least `percent` % of their union.

    Returns per input row: the id column, n_shingles (set size), component_id
    (smallest id reachable by links, itself included) and kept (id = component_id).
    Documents without words are linked with nothing and kept. Rows that share an
    id are one document. Rows with a null id are linked with nothing: their
    component_id is null and they are kept. Other columns are not carried.
    """
    rows = stored(sketch(docs, id_col=id_col, text_col=text_col, size=size), "sketch")
    sets = rows.filter("__id is not null and __digest is not null")
    repeated = stored(sets.groupBy("__digest").agg(F.min("__id").alias("u"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("__digest", "u"), "repeated")
    repeated = bounded(repeated)
    classes = sets.join(repeated, "__digest", "left").filter("u is null or u = __id").drop("u")
    copies = sets.select("__id", "__digest").join(repeated, "__digest").select("u", F.col("__id").alias("v"))

    keys = classes.select("__id", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("__band"), "__registers").select(
        "__id", F.xxhash64("__band", F.expr(f"substring(__registers, __band * {2 * ROWS} + 1, {2 * ROWS})")).alias("__key"))
    shared = stored(keys.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-keys")
    members = stored(keys.join(bounded(shared), "__key"), "members")
    # How many a member meets, in one number with a fixed order of those who meet as many.
    met = stored(members.groupBy("__id").agg((F.shiftleft(F.sum("n"), 20) + F.first(F.xxhash64("__id").bitwiseAND(F.lit((1 << 20) - 1)))).alias("met")), "met")
    pivots = members.join(met, "__id").groupBy("__key").agg(F.max_by("__id", "met").alias("a"))
    pairs = stored(members.select("__key", F.col("__id").alias("b")).join(pivots, "__key").filter("a <> b").select("a", "b").distinct(), "pivots")
    ids = bounded(stored(pairs.select(F.explode(F.array("a", "b")).alias("__id")).distinct(), "ids"))
    texts = stored(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(ids, "__id", "left_semi"), "texts")
    classes = stored(classes.join(ids, "__id", "left_semi"), "candidates")
    most = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("met"), "b"))
    companions = pairs.join(met.withColumnRenamed("__id", "b"), "b").withColumn("__n", most).filter(F.col("__n") <= COMPANIONS).select("a", "b")
    profiles = stored(_profiles(companions.unionByName(pairs.select("a", F.col("a").alias("b")).distinct()), texts, size), "profiles", WIDE_ROWS)
    held = stored(_held_against(pairs, profiles, texts, size, percent), "held", WIDE_ROWS)
    links = stored(held.select(F.explode("links").alias("u"), F.col("b").alias("v")), "links")
    rest = stored(_likely(_remaining(held, components(links), percent), classes, percent), "pairs")
    links = links.unionByName(stored(_verified(rest, texts, size, percent), "verified", WIDE_ROWS))
    labels = components(links.select("u", "v").unionByName(copies))
    return (rows.join(labels.withColumnRenamed("node", "__id"), "__id", "left")
            .select(F.col("__id").alias(id_col), "n_shingles", F.coalesce("component", "__id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
