"""Exact top-k search by a vector-approximation file.

The approximation file holds each vector's grid cells, one byte a component, on
a grid over the vector's own range. A scan of it, block of vectors by block of
queries, bounds every score: with c the cells' centres and h half a cell, q.v
lies in q.c -/+ h * sum|q|. A query's (k+1)-th highest lower bound rules out
all cells whose upper bound is less; the first block gives every query such a
floor, so the others hand on what may still beat it. Exact vectors are then read
in bound order: the first k+1 of each query, and of the rest only those that may
still reach its kth exact score.

Equal vectors are one class that keeps its k+1 smallest ids, which is all a
ranking of k without the query's own row can need. Where bounds are exact
and tie (a zero vector asks), the smaller ids are kept, k+1 a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

BLOCK, QUERY_BLOCK = 4096, 1024  # vectors and queries that one task holds against each other
CELLS = 256                      # cells of the grid over a vector's range
NARROW = 1 << 28                 # |scaled component| below which sums of products fit a long
_LONG = (1 << 63) - 1
_CLIP = 10 ** 33                 # beyond any score that counts; sums of 99,999 such products fit 38 digits


def _scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = lambda v: F.when(F.abs(v * scale) < float(1 << 62), F.floor(v * scale).cast("bigint")).otherwise(
        F.when(v > 0, F.lit(_LONG)).otherwise(F.lit(-_LONG)))
    return (vectors.select(F.col(id_col).alias("id"), x.alias("x"), finite.alias("ok"))
            .filter("id is not null and x is not null and ok and size(x) > 0")
            .select("id", F.transform("x", whole).alias("vec"))
            .groupBy("id").agg(F.min("vec").alias("vec")))


def _matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _product(wide: bool) -> Column:
    """Inner product of qvec and vec as a long; `wide`: by decimals, a score beyond a long counts as its end."""
    if not wide:
        return F.aggregate(F.zip_with("qvec", "vec", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x)
    clip = F.lit(str(_CLIP)).cast("decimal(38,0)")
    end = F.lit(_LONG).cast("decimal(38,0)")
    times = lambda a, b: F.greatest(-clip, F.least(clip, (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast("decimal(38,0)")))
    total = F.aggregate(F.zip_with("qvec", "vec", times), F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    return F.greatest(-end, F.least(end, total)).cast("bigint")


def exact_top_k(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                query_every: int = 50, scale: int = 256) -> DataFrame:
    """The k highest integer inner products of each query with every other row.

    Components become floor(scale * x). Queries: rows whose id is divisible by
    `query_every`; candidates: all other rows with as many components. Returns
    query_id, rank (from 1), vec_id, score; ties go to the smaller id, fewer
    candidates give fewer rows. Rows without an id, and vectors that are null,
    empty, or hold null or non-finite components, take no part. Finite components
    may have any size; a scaled component of 2**62 or more counts as the end of the
    64-bit range, and so does a score beyond it. Rows repeating an id count once
    (with the smallest vector). Other columns are not carried.
    """
    rows = stored(_scaled(vectors, id_col, vector_col, scale), "vectors")
    key = rows.schema["id"].dataType.simpleString()
    low, high, n = rows.agg(F.min(F.array_min("vec")), F.max(F.array_max("vec")), F.count(F.lit(1))).first()
    empty = rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    queries = rows.filter(F.pmod("id", F.lit(query_every)) == 0).select(F.col("id").alias("q"), F.col("vec").alias("qvec"))
    n_queries = queries.count()
    if not n_queries:
        return empty
    wide = max(abs(low), abs(high)) >= NARROW

    same = Window.partitionBy(F.xxhash64("vec"), "vec").orderBy("id")
    classes = (rows.withColumn("__n", F.row_number().over(same)).filter(F.col("__n") <= k + 1)
               .groupBy(F.xxhash64("vec").alias("__h"), "vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
               .select(F.col("ids")[0].alias("c"), "vec", "ids"))
    classes = stored(classes, "classes")

    blocks, query_blocks = max(1, n // BLOCK), max(1, n_queries // QUERY_BLOCK)
    base, width = F.array_min("vec").cast("double"), (F.array_max("vec").cast("double") - F.array_min("vec").cast("double") + 1) / CELLS
    cells = (classes.select("c", F.size("vec").alias("dim"), "vec", base.alias("base"), width.alias("width"), F.pmod(F.xxhash64("c"), F.lit(blocks)).alias("vb"))
             .withColumn("cells", F.transform("vec", lambda v: F.least(F.lit(CELLS - 1), F.floor((v.cast("double") - F.col("base")) / F.col("width"))).cast("smallint"))).drop("vec")
             .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))))
    every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("vb")
    asked = queries.select("q", F.size("qvec").alias("dim"), "qvec", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).alias("qb"))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list = []
        if left.num_rows and right.num_rows:
            c, q = left["c"].to_numpy(), right["q"].to_numpy()
            width, base = left["width"].to_numpy(), left["base"].to_numpy()
            centres = (_matrix(left["cells"], np.float64) + 0.5) * width[:, None] + base[:, None]
            largest = np.abs(base) + CELLS * width
            asked = _matrix(right["qvec"], np.float64)
            floor = right["floor"].to_numpy(zero_copy_only=False).astype(np.float64)  # null: none yet
            weight = np.abs(asked).sum(axis=1)
            slack = weight[:, None] * (width / 2 + largest * 2.0 ** -40)[None, :]
            middle = asked @ centres.T
            low, high = (np.clip(x, -float(_LONG), float(_LONG)) for x in (middle - slack, middle + slack))
            if len(c) > k + 1:
                floor = np.fmax(floor, np.partition(low, len(c) - k - 1, axis=1)[:, len(c) - k - 1])
            kept = ~(high < floor[:, None])
            for row in np.flatnonzero((weight == 0) & (kept.sum(axis=1) > k + 1)).tolist():  # all bounds are exact and tie
                kept[row, np.argsort(c, kind="stable")[k + 1:]] = False
            i, j = np.nonzero(kept)
            found = [q[i], c[j], low[i, j], high[i, j]]
        return pa.table(found or [[], [], [], []], schema=pa.schema([("q", left.schema.field("c").type), ("c", left.schema.field("c").type), ("lo", pa.float64()), ("hi", pa.float64())]))

    def bounded_by(cells: DataFrame, asked: DataFrame, name: str) -> DataFrame:
        return stored(cells.groupBy("vb", "qb", "dim").cogroup(asked.groupBy("vb", "qb", "dim")).applyInArrow(scan, f"q {key}, c {key}, lo double, hi double"), name)

    by_low = Window.partitionBy("q").orderBy(F.desc("lo"), "c")

    def floors(bounds: DataFrame) -> DataFrame:
        return bounds.withColumn("__n", F.row_number().over(by_low)).filter(F.col("__n") == k + 1).select("q", F.col("lo").alias("floor"))

    bounds = bounded_by(cells.filter("vb = 0"), asked.select("*", F.lit(0).cast("bigint").alias("vb"), F.lit(None).cast("double").alias("floor")), "bounds")
    if blocks > 1:
        held = asked.join(floors(bounds), "q", "left").select("*", every_block).filter("vb > 0")
        bounds = bounds.unionByName(bounded_by(cells.filter("vb > 0"), held, "more-bounds"))
    by_bound = Window.partitionBy("q").orderBy(F.desc("hi"), "c")
    open_ = stored(bounds.join(floors(bounds), "q", "left").filter("floor is null or hi >= floor").withColumn("order", F.row_number().over(by_bound)).select("q", "c", "hi", "order"), "open")

    def exact(pairs: DataFrame) -> DataFrame:
        return (pairs.select("q", "c").join(queries, "q").join(classes, "c").select("q", _product(wide).alias("score"), F.explode("ids").alias("id")).filter("id <> q"))

    ranking = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    first = stored(exact(open_.filter(F.col("order") <= k + 1)), "first")
    certain = first.withColumn("__n", F.row_number().over(ranking)).filter(F.col("__n") == k).select("q", F.col("score").alias("kth"))
    rest = exact(open_.filter(F.col("order") > k + 1).join(certain, "q", "left").filter("kth is null or hi >= kth"))
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
