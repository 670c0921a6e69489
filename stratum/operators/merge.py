"""Apply a change feed to a table by key (MERGE), and row-level UPDATE.

Fates of target rows and feed rows, kept from the reference's MERGE:

  target has key | feed row                  | fate
  ---------------+---------------------------+----------------------------------
  yes            | DELETE                    | target row deleted
  yes            | INSERT, is_update         | non-key columns replaced, restamped
  yes            | INSERT, not is_update     | ignored (no clause matches)
  no             | INSERT (either flag)      | inserted, stamped
  no             | DELETE                    | ignored
  NULL key       | INSERT                    | inserted (= never matches NULL)
  key twice      | INSERT x2                 | both inserted
  on k rows      | any matching              | each target row gets that fate

Deliberate difference: the DELETE half of an update pair (is_update) is
dropped before matching; otherwise one target row would meet two fates.
Two or more DELETE/UPDATE feed rows for one existing key are an error,
raised inside the plan (`raise_error`), never resolved arbitrarily.

Plan: the feed is first reduced to one row per key -- fixed-width counts in a
hash aggregate (partial aggregation, so a hot key costs one row per task),
plus the key's single update row; target rows then meet that summary in a
left join (AQE splits a skewed target partition and broadcasts a small
summary at run time); new keys come from a left anti join of the feed's
INSERT rows against target keys. Rows with a NULL key carry an extra join
key (a row hash) so they never match and never pile into one task. No full
outer join and no per-key collection of rows. Pass a materialized feed (a
written table): the plan reads it more than once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratum.operators.changes import ACTION, IS_UPDATE, NULL_SPREAD, _keys, any_null, null_spread

FATE = "_fate"


def _plan(target: DataFrame, changes: DataFrame, keys: list[str], action_col: str, update_col: str):
    action = F.col(action_col)
    is_upd = F.coalesce(F.col(update_col), F.lit(False))
    src = changes.filter(~((action == "DELETE") & is_upd))
    value_cols = [c for c in target.columns if c in changes.columns and c not in keys]
    on = [*keys, NULL_SPREAD]

    # Per key: how many DELETE and INSERT+update rows (fixed-width counts, so a
    # hash aggregate), then the one update row's values joined on.
    counts = (src.filter(~any_null(keys)).groupBy(*keys)
              .agg(F.count_if(action == "DELETE").alias("__del"),
                   F.count_if((action == "INSERT") & is_upd).alias("__upd")))
    updates = (src.filter((action == "INSERT") & is_upd & ~any_null(keys))
               .select(*keys, F.struct(*value_cols).alias("__new")))
    per_key = counts.join(updates, on=keys, how="left").withColumn(NULL_SPREAD, F.lit(0).cast("bigint"))

    matched = target.withColumn(NULL_SPREAD, null_spread(keys, target.columns)).join(per_key, on=on, how="left")
    fate = (
        F.when(F.col("__del") + F.col("__upd") > 1,
               F.raise_error(F.lit("MERGE: several DELETE/UPDATE changes for one key")).cast("string"))
        .when(F.col("__del") >= 1, F.lit("DELETE"))
        .when(F.col("__upd") == 1, F.lit("UPDATE"))
        .when(F.col("__del").isNotNull(), F.lit("IGNORED"))
        .otherwise(F.lit("KEEP"))
    )
    target_fates = matched.withColumn(FATE, fate)

    inserts = _new_key_rows(target, src.filter(action == "INSERT"), keys)
    return target_fates, inserts, value_cols


def _new_key_rows(target: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate rows whose key is absent from `target` (NULL keys are always absent).

    The target's key column is first narrowed to the candidates' keys by a
    left semi join -- planned as a broadcast when the candidate keys are
    small (measured at run time), so the big key column is filtered where it
    is read instead of being shuffled -- and only then used in the anti join.
    """
    cand_keys = candidates.filter(~any_null(keys)).select(*keys).distinct()
    target_keys = (target.filter(~any_null(keys)).select(*keys)
                   .join(cand_keys, on=keys, how="left_semi")
                   .distinct()  # a key on many target rows becomes one row, collapsed map-side
                   .withColumn(NULL_SPREAD, F.lit(0).cast("bigint")))
    return (candidates.withColumn(NULL_SPREAD, null_spread(keys, candidates.columns))
            .join(target_keys, on=[*keys, NULL_SPREAD], how="left_anti"))


def insert_new_keys(target: DataFrame, changes: DataFrame, key: str | list[str], *,
                    stamps: Mapping[str, Column] | None = None,
                    action_col: str = ACTION) -> DataFrame:
    """The rows a MERGE of an insert-only feed adds to `target` (the rest of the
    target is unchanged: existing keys are ignored). Appending these rows is
    the whole MERGE -- no rewrite of the target."""
    keys = _keys(key)
    stamps = dict(stamps or {})
    inserts = _new_key_rows(target, changes.filter(F.col(action_col) == "INSERT"), keys)
    types = dict(target.dtypes)
    out = []
    for c in target.columns:
        if c in stamps:
            out.append(stamps[c].cast(types[c]).alias(c))
        elif c in inserts.columns:
            out.append(F.col(c).cast(types[c]).alias(c))
        else:
            out.append(F.lit(None).cast(types[c]).alias(c))
    return inserts.select(*out)


OLD = "_old"
WEIGHT = "_w"


def merge_fates(target: DataFrame, changes: DataFrame, key: str | list[str], *,
                stamps: Mapping[str, Column] | None = None,
                action_col: str = ACTION, update_col: str = IS_UPDATE) -> DataFrame:
    """Every row the MERGE meets, with its fate (KEEP, IGNORED, UPDATE, DELETE or INSERT).

    The target's columns hold the row as it is after the MERGE (a deleted one as
    it was); `_old` holds what an updated row was before. One result thus tells the
    new table (all but DELETE) and the signed rows that marts need (`signed_rows`).
    """
    keys = _keys(key)
    stamps = dict(stamps or {})
    target_fates, inserts, value_cols = _plan(target, changes, keys, action_col, update_col)

    is_update = F.col(FATE) == "UPDATE"
    kept_cols = []
    for c in target.columns:
        if c in stamps:
            kept_cols.append(F.when(is_update, stamps[c]).otherwise(F.col(c)).alias(c))
        elif c in value_cols:
            kept_cols.append(F.when(is_update, F.col("__new").getField(c)).otherwise(F.col(c)).alias(c))
        else:
            kept_cols.append(F.col(c))
    kept = target_fates.select(*kept_cols, FATE, F.when(is_update, F.struct(*target.columns)).alias(OLD))

    types = dict(target.dtypes)
    ins_cols = []
    for c in target.columns:
        if c in stamps:
            ins_cols.append(stamps[c].cast(types[c]).alias(c))
        elif c in inserts.columns:
            ins_cols.append(F.col(c).cast(types[c]).alias(c))
        else:
            ins_cols.append(F.lit(None).cast(types[c]).alias(c))
    return kept.unionByName(inserts.select(*ins_cols, F.lit("INSERT").alias(FATE), F.lit(None).cast(kept.schema[OLD].dataType).alias(OLD)))


def signed_rows(fates: DataFrame, columns: list[str]) -> DataFrame:
    """What a MERGE changed, as rows with a weight `_w`: +1 for a row that came, -1 for one that went
    (an update is both). Feed rows that changed nothing, such as a DELETE of an absent key, give none."""
    row = [F.col(c) for c in columns]
    came, went = F.struct(*row, F.lit(1).alias(WEIGHT)), F.struct(*row, F.lit(-1).alias(WEIGHT))
    was = F.struct(*[F.col(OLD).getField(c).alias(c) for c in columns], F.lit(-1).alias(WEIGHT))
    fate = F.col(FATE)
    signed = F.when(fate == "INSERT", F.array(came)).when(fate == "DELETE", F.array(went)).when(fate == "UPDATE", F.array(came, was))
    return fates.filter(fate.isin("INSERT", "DELETE", "UPDATE")).select(F.explode(signed).alias("__s")).select("__s.*")


def merge_changes(target: DataFrame, changes: DataFrame, key: str | list[str], *,
                  stamps: Mapping[str, Column] | None = None,
                  action_col: str = ACTION, update_col: str = IS_UPDATE,
                  observation: Observation | None = None) -> DataFrame:
    """The target table after the MERGE, with target's schema and column order.

    With `observation`, the rows inserted / updated / deleted are counted
    while the result is computed (read `observation.get` after the write):
    the MERGE's affected-row counts without a second pass.
    """
    both = merge_fates(target, changes, key, stamps=stamps, action_col=action_col, update_col=update_col).drop(OLD)
    if observation is not None:
        fate = F.col(FATE)
        both = both.observe(observation, F.count_if(fate == "INSERT").alias("rows_inserted"),
                            F.count_if(fate == "UPDATE").alias("rows_updated"),
                            F.count_if(fate == "DELETE").alias("rows_deleted"))
    return both.filter(F.col(FATE) != "DELETE").drop(FATE)


def merge_counts(target: DataFrame, changes: DataFrame, key: str | list[str], *,
                 action_col: str = ACTION, update_col: str = IS_UPDATE) -> DataFrame:
    """Rows inserted / updated / deleted by the MERGE (one row), in one global aggregate."""
    keys = _keys(key)
    target_fates, inserts, _ = _plan(target, changes, keys, action_col, update_col)
    fate = F.col(FATE)
    per_target = target_fates.select(F.when(fate == "DELETE", 1).otherwise(0).alias("d"),
                                     F.when(fate == "UPDATE", 1).otherwise(0).alias("u"),
                                     F.lit(0).alias("i"))
    per_insert = inserts.select(F.lit(0).alias("d"), F.lit(0).alias("u"), F.lit(1).alias("i"))
    return per_target.unionByName(per_insert).agg(
        F.sum("i").cast("bigint").alias("rows_inserted"),
        F.sum("u").cast("bigint").alias("rows_updated"),
        F.sum("d").cast("bigint").alias("rows_deleted"),
    )


def update_where_in(df: DataFrame, set_col: str, value, key: str, *, pick: str = "min",
                    keys: DataFrame | None = None, keys_col: str | None = None) -> DataFrame:
    """UPDATE t SET c = v WHERE k IN (SELECT ...): the table after the update.

    With `keys`, the rows whose key stands in its column `keys_col` (default:
    `key`): the distinct keys are joined as a flag, so a key listed twice
    changes nothing, a small key side is broadcast by its measured size, and
    rows with a NULL key match nothing and are spread by a row hash. Without
    it, the one key that the reference's `LIMIT 1` subquery picks, made
    deterministic: a scalar subquery (min or max of k), evaluated once. The
    update rewrites every row and is published as a new snapshot by the caller
    (`tables.publish_snapshot`); Parquet files are never updated in place.
    """
    new = F.lit(value).cast(dict(df.dtypes)[set_col])
    if keys is None:
        agg = F.min(key) if pick == "min" else F.max(key)
        return df.withColumn(set_col, F.when(F.col(key) == df.agg(agg).scalar(), new).otherwise(F.col(set_col)))
    listed = keys.select(F.col(keys_col or key).alias("__key")).filter("__key IS NOT NULL").distinct()
    listed = listed.select("__key", F.lit(0).cast("bigint").alias("__spread"), F.lit(True).alias("__hit"))
    spread = df.withColumn(NULL_SPREAD, null_spread([key], df.columns))
    on = (F.col(key) == F.col("__key")) & (F.col(NULL_SPREAD) == F.col("__spread"))
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    return spread.join(listed, on, "left").select(
        *[F.when(hit, new).otherwise(F.col(c)).alias(c) if c == set_col else F.col(c) for c in df.columns])


def semi_in(df: DataFrame, key: str, keys_df: DataFrame, keys_col: str | None = None) -> DataFrame:
    """WHERE key IN (SELECT keys_col FROM keys_df): a left semi join.

    NULL keys on either side never match, as with IN; the planner broadcasts
    the key side only when its measured size is under the broadcast limit.
    """
    right = keys_df.select(F.col(keys_col or key).alias(key))
    return df.filter(F.col(key).isNotNull()).join(right, on=key, how="left_semi")
