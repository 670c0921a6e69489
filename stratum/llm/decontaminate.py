"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, runs of K words are hashed from them, and every window of
W such runs keeps its least hash: with K + W - 1 = SPAN words, any shared span
of SPAN words has the same fingerprint on both sides, so none is missed.
Distinct fingerprints of a text are joined with those of the benchmark; in the
texts with a hit, the windows of the fingerprints that met are extended to
all SPAN words and compared by two independent 64-bit hashes of those words. Items of fewer than SPAN
words are one window of their own length, handled alike per length present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import row_key, stored

SPAN, K = 10, 8
BROADCAST_ROWS = 200_000  # benchmark windows (of fixed width) up to which they are broadcast; beyond, joins shuffle

# A text's bytes as one character each: lower() then changes A-Z, and maps other texts one to one.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ["__id", "__th", "__tl"]


def words(text: Column) -> Column:
    """The words of a text (A-Z lower-cased), one character a byte; null has none."""
    plain = F.lower(F.decode(text.cast("binary"), "ISO-8859-1"))
    # Splitting is linear; extracting all matches copies the text for each of them.
    return F.coalesce(F.array_remove(F.split(plain, _BETWEEN), ""), F.array().cast("array<string>"))


def _pairwise(left: Column, right: Column, by: int, f) -> Column:
    """f(left[i], right[i + by]) for all i where both are there."""
    n = F.greatest(F.least(F.size(left), F.size(right) - by), F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(by + 1), n), f)


def _runs(df: DataFrame, hashes: str, n: int, out: str) -> DataFrame:
    """Column `out`: hashes of all runs of n words; runs of a power of two come from halves."""
    made = {1: hashes}
    size = 1
    while size * 2 <= n:
        name = f"{out}_{size * 2}"
        df = df.withColumn(name, _pairwise(F.col(made[size]), F.col(made[size]), size, lambda a, b: F.xxhash64(a, b)))
        size *= 2
        made[size] = name
    now, have = made[size], size
    while have < n:
        step = max(s for s in made if have + s <= n)
        df = df.withColumn(f"{out}_{have + step}", _pairwise(F.col(now), F.col(made[step]), have, lambda a, b: F.xxhash64(a, b)))
        have += step
        now = f"{out}_{have}"
    return df.withColumn(out, F.col(now)).drop(*[f"{out}_{i}" for i in range(2, n + 1)])


def _fingerprints(df: DataFrame, n: int) -> DataFrame:
    """Column fp<n>: the fingerprint of the window of n words that begins at each word."""
    k, out = min(K, n), f"fp{n}"
    df = _runs(df, "__h", k, out)
    width, left = 1, n - k + 1
    while left > width:
        by = min(width, left - width)
        df = df.withColumn(out, _pairwise(F.col(out), F.col(out), by, lambda a, b: F.least(a, b)))
        width += by
    return df if n == SPAN else df.withColumn(out, F.transform(out, lambda x: F.xxhash64(x, F.lit(n))))


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))


def _windows(df: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """A row per window of n words: where it begins, its fingerprint, two hashes of all its words."""
    df = _runs(_fingerprints(_hashed(df), n), "__h", n, "__a")
    df = df.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w, F.lit(1))))
    df = _runs(df, "__h", n, "__b")
    return (df.select(*keep, F.posexplode(F.arrays_zip(F.col(f"fp{n}").alias("fp"), F.col("__a").alias("wa"), F.col("__b").alias("wb"))))
            .select(*keep, F.lit(n).alias("n"), F.col("pos").alias("start"), "col.fp", "col.wa", "col.wb"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Words of documents that stand in a window of a benchmark item.

    Returns per document row: the id column, n_words, n_hit (words inside any
    occurrence of an item's window), n_items, items_sha256 (their ids, sorted as
    strings, comma-joined) and contaminated (n_hit > 0). Null texts have no words;
    null ids are kept as null; repeated rows give repeated results; items without
    words or id match nothing; an empty benchmark hits nothing. Other columns are not carried.
    """
    items = (benchmark.filter(F.col(item_col).isNotNull())
             .select(F.col(item_col).cast("string").alias("__item"), words(F.col(item_text_col)).alias("__words"))
             .withColumn("__n", F.least(F.size("__words"), F.lit(SPAN))).filter("__n > 0"))
    lengths = sorted(r[0] for r in items.select("__n").distinct().collect())  # at most SPAN values
    texts = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("__text"))
    counted = texts.select(*_KEY, F.size(words(F.col("__text"))).cast("bigint").alias("n_words"))
    nothing = F.sha2(F.lit(""), 256)
    if not lengths:
        return counted.select(F.col("__id").alias(id_col), "n_words", F.lit(0).cast("bigint").alias("n_hit"), F.lit(0).cast("bigint").alias("n_items"),
                              nothing.alias("items_sha256"), F.lit(False).alias("contaminated"))

    found = [_windows(items.filter(F.col("__n") == n), n, ["__item"]) for n in lengths]
    windows = stored(_union(found).select("__item", "n", "fp", "wa", "wb").distinct(), "windows")
    small = windows.count() <= BROADCAST_ROWS

    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    prints = texts.select(*_KEY, words(F.col("__text")).alias("__words"))
    prints = _hashed(prints).drop("__words")
    for n in lengths:
        prints = _fingerprints(prints, n)
    prints = prints.select(*_KEY, F.explode(F.array_distinct(F.concat(*[F.col(f"fp{n}") for n in lengths]))).alias("fp"))
    met = stored(prints.join(bounded(windows.select("fp").distinct()), "fp", "left_semi").select(*_KEY).distinct(), "met")

    same = (F.col("t.__id").eqNullSafe(F.col("m.__id"))) & (F.col("t.__th") == F.col("m.__th")) & (F.col("t.__tl") == F.col("m.__tl"))
    near = texts.alias("t").join(met.alias("m"), same, "left_semi").dropDuplicates(_KEY)
    near = stored(near.select(*_KEY, words(F.col("__text")).alias("__words")), "near")
    distinct = windows.select("n", "fp", "wa", "wb").distinct()
    hits = stored(_union([_windows(near, n, _KEY).join(bounded(distinct.filter(F.col("n") == n)), ["n", "fp", "wa", "wb"]) for n in lengths]), "hits")

    covered = F.aggregate(
        F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("n")).alias("stop")))),
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda s, x: F.struct((s.hit + F.greatest(F.lit(0), x.stop - F.greatest(x.start, s.reach))).alias("hit"), F.greatest(s.reach, x.stop).alias("reach")))
    hit = hits.groupBy(*_KEY).agg(covered.getField("hit").cast("bigint").alias("n_hit"))
    of = (hits.select(*_KEY, "n", "wa", "wb").distinct().join(bounded(windows.select("__item", "n", "wa", "wb")), ["n", "wa", "wb"])
          .select(*_KEY, "__item").distinct().groupBy(*_KEY).agg(F.sort_array(F.collect_list("__item")).alias("__items")))

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.withColumnsRenamed({k: f"{k}r" for k in _KEY})
        on = F.col("__id").eqNullSafe(F.col("__idr")) & (F.col("__th") == F.col("__thr")) & (F.col("__tl") == F.col("__tlr"))
        return left.join(right, on, how).drop(*[f"{k}r" for k in _KEY])

    found = joined(counted, joined(hit, of, "inner"), "left")
    zero = F.lit(0).cast("bigint")
    return found.select(
        F.col("__id").alias(id_col), "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
        F.when(F.col("__items").isNull(), zero).otherwise(F.size("__items").cast("bigint")).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("__items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"))


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
