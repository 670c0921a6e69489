"""URL filters: fixed host and path rules, and gradient-boosted trees for the rest.

The trees see lexical features of a URL only: lengths, depth, digit ratio,
character entropy, parameter counts, and statistics of the host's suffixes
(how often URLs below a suffix are blocked, and how common it is). They are
trained from labelled URLs; the suffix statistics count all labelled URLs, for a
training URL all but those of its own fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

TRAINING_ROWS = 20_000  # labelled URLs that the trees are fitted on at most, chosen by hash
TREES, DEPTH = 15, 4
PRIOR = 20.0            # URLs that a suffix's block rate is smoothed by
FOLDS = 5               # parts of the labelled URLs, by hash; training rows see the suffix statistics of the other parts

Rule = tuple[str, str, str]  # verdict, host, path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` to the next `/`, `?`, `#` or end, A-Z lower-cased; path: then to
    `?`, `#` or end. Both empty for null and where no `://` stands."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], what: int) -> Column:
    """`what` of the longest rule that fits (0: verdict, 1: its text), else null."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    chosen = F.lit(None).cast("string")
    for verdict, at, begin in reversed(longest):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(begin))
        chosen = F.when(fits, F.lit((verdict, at + begin)[what])).otherwise(chosen)
    return chosen


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def lexical(df: DataFrame) -> DataFrame:
    """Lexical features of `__url`, `__host` and `__path`."""
    url = F.coalesce(F.col("__url"), F.lit(""))
    host, n = F.col("__host"), F.greatest(F.length("__host"), F.lit(1))
    share = [(F.length(host) - F.length(F.replace(host, F.lit(c)))) / n for c in "abcdefghijklmnopqrstuvwxyz0123456789.-"]
    entropy = reduce(lambda a, b: a + b, [F.when(s > 0, -s * F.log2(s)).otherwise(F.lit(0.0)) for s in share])
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.withColumns({
        "f_length": F.length(url).cast("double"),
        "f_host_length": F.length("__host").cast("double"),
        "f_path_length": F.length("__path").cast("double"),
        "f_labels": F.size(F.split("__host", r"\.")).cast("double"),
        "f_depth": F.regexp_count("__path", F.lit("/[^/]")).cast("double"),
        "f_digits": _share(url, "[0-9]").cast("double"),
        "f_host_digits": _share(F.col("__host"), "[0-9]").cast("double"),
        "f_hyphens": F.regexp_count("__host", F.lit("-")).cast("double"),
        "f_entropy": entropy.cast("double"),
        "f_parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1).cast("double"),
        "f_fragment": F.contains(url, F.lit("#")).cast("double"),
        "f_secure": F.startswith(url, F.lit("https://")).cast("double"),
    })


FEATURES = ["f_length", "f_host_length", "f_path_length", "f_labels", "f_depth", "f_digits", "f_host_digits", "f_hyphens", "f_entropy",
            "f_parameters", "f_fragment", "f_secure", "f_tld_rate", "f_tld_count", "f_site_rate", "f_site_count"]
_SUFFIXES = {"tld": r"[^.]*$", "site": r"[^.]*\.?[^.]*$"}


def _with_suffix_statistics(df: DataFrame, labelled: DataFrame, rate: float, own: bool = False) -> DataFrame:
    """Smoothed block rates and counts of each row's suffixes over the labelled rows. `own`: the rows are labelled
    themselves, and see the statistics of the other folds only, so that no label enters its own URL's features."""
    fold = F.pmod(F.xxhash64("__url", F.lit(3)), F.lit(FOLDS))
    for name, pattern in _SUFFIXES.items():
        suffix = F.regexp_extract("__host", pattern, 0).alias("__suffix")
        sums = [F.sum("__label").alias("__blocked"), F.count(F.lit(1)).alias("__rows")]
        keys = ["__suffix", "__fold"] if own else ["__suffix"]
        table = labelled.groupBy(suffix, *([fold.alias("__fold")] if own else [])).agg(*sums)
        if own:  # all folds' sums less the fold's own
            every = Window.partitionBy("__suffix")
            table = table.withColumns({c: F.sum(c).over(every) - F.col(c) for c in ("__blocked", "__rows")})
        blocked, rows = F.coalesce("__blocked", F.lit(0.0)), F.coalesce("__rows", F.lit(0))
        df = (df.withColumns({"__suffix": suffix, "__fold": fold}).join(table, keys, "left")
              .withColumns({f"f_{name}_rate": (blocked + rate * PRIOR) / (rows + PRIOR), f"f_{name}_count": F.log1p(rows.cast("double"))})
              .drop("__suffix", "__fold", "__blocked", "__rows"))
    return df


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url",
               labelled: DataFrame | None = None) -> DataFrame:
    """Allow or block every URL: the longest fitting rule decides, the trees where none fits.

    `labelled`: rows of (url, label; 1 is block) to train from; by default the URLs that a
    rule decides. Returns per row: the id column, host, path, rule (null: none fits), verdict,
    and score (the trees' probability of block). Null and odd URLs have an empty host and path
    and are judged like others. Without both labels to learn from, the score is the share of
    block labels (0 without any), and the verdict block from 0.5. Repeated rows give repeated
    results; other columns are not carried.
    """
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__url")).withColumns({"__host": host, "__path": path})
    rows = rows.withColumns({"__rule": matching_rule(F.col("__host"), F.col("__path"), rules, 1), "__verdict": matching_rule(F.col("__host"), F.col("__path"), rules, 0)})
    if labelled is None:
        known = rows.filter("__verdict is not null").select("__url", "__host", "__path", (F.col("__verdict") == "block").cast("double").alias("__label"))
    else:
        known = labelled.select(F.col("url").cast("string").alias("__url"), F.col("label").cast("double").alias("__label")).withColumns({"__host": host, "__path": path}).filter("__label is not null")
    n, blocked = known.agg(F.count(F.lit(1)), F.sum("__label")).first()
    rate = float((blocked or 0.0) / n) if n else 0.0
    if 0 < rate < 1:
        # The smallest hashes: a sample of fixed size, the same on every run.
        sample = stored(known.withColumn("__o", F.xxhash64("__url", F.lit(10))).orderBy("__o", "__url").limit(TRAINING_ROWS).drop("__o"), "urls")
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="__features")
        train = assembler.transform(lexical(_with_suffix_statistics(sample, known, rate, own=True))).select("__features", "__label").coalesce(6)
        model = GBTClassifier(featuresCol="__features", labelCol="__label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=10, maxMemoryInMB=64).fit(train)
        scored = model.transform(assembler.transform(lexical(_with_suffix_statistics(rows, known, rate))))
        scored = scored.withColumn("__score", vector_to_array("probability")[1])
    else:
        scored = rows.withColumn("__score", F.lit(rate))
    return scored.select(
        F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"),
        F.coalesce("__verdict", F.when(F.col("__score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), F.col("__score").alias("score"))
