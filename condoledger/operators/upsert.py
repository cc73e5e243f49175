"""Upsert operators U1–U11.

Parquet tables have no MERGE, so every upsert is a pure function
(state, changes) -> new state with an ``action`` column (INSERT / UPDATE /
KEEP). The caller writes the new state to a new path (never over the path
it is reading). All are joins on the key: full outer for update-or-insert,
anti for insert-only, left for update-only, and shuffled at any size: both
sides grow with the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import unbounded

INSERT, UPDATE, KEEP = "INSERT", "UPDATE", "KEEP"


def _changed(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def one_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source with one row per key, the smallest by its other columns: a
    key that a file repeats must not multiply the target's row. A min of
    structs, so repeats collapse before the shuffle."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    one = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_one"))
    return one.select(*[F.col(c) if c in keys else F.col(f"_one.{c}").alias(c) for c in source.columns])


def one_value_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source with one row per key, for the coalescing updates. Rows that
    differ in blanks only are taken together, so a blank cell of one does not
    hide the value of another. Rows that say different things are not mixed:
    one whole row counts, the smallest by its columns in order, blanks last
    (``conflicting_rows`` has the rest)."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    # (is null, value) per column, so that a struct orders blanks last
    row = F.struct(*[x for c in rest for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c))])
    one = source.groupBy(*keys).agg(F.min(row).alias("_one"), *[F.min(c).alias(c) for c in rest], *[F.max(c).alias(f"_m_{c}") for c in rest])
    conflict = F.lit(False)
    for c in rest:
        conflict = conflict | (F.col(f"_m_{c}") != F.col(c))
    one = one.withColumn("_conflict", F.coalesce(conflict, F.lit(False)))
    return one.select(*[F.col(c) if c in keys else F.when(F.col("_conflict"), F.col(f"_one.{c}")).otherwise(F.col(c)).alias(c)
                        for c in source.columns])


def conflicting_rows(source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that ``one_value_per_key`` passes over: they say something else
    than the row taken for their key (for a reject report)."""
    rest = [c for c in source.columns if c not in keys]
    taken = one_value_per_key(source, keys).withColumnsRenamed({c: f"_t_{c}" for c in rest})
    other = F.lit(False)
    for c in rest:
        other = other | F.coalesce(F.col(c) != F.col(f"_t_{c}"), F.lit(False)) | (F.col(c).isNotNull() & F.col(f"_t_{c}").isNull())
    return source.join(taken, keys).filter(other).select(*source.columns)


def repeated_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several source rows claim, with their number (for a reject report)."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str],
                 unique: bool = False) -> DataFrame:
    """Matched -> the ``update`` columns take the source values; not
    matched -> source row inserted; target-only rows kept. ``unique`` states
    that the source has one row per key already (an aggregate over the key)."""
    cols = target.columns
    source = source if unique else one_per_key(source, keys)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys],
                      F.lit(True).alias("_in_s"))
    t = target.withColumn("_in_t", F.lit(True))
    j = t.join(unbounded(s), keys, "full")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update:
            out.append(F.when(F.col("_in_s"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            src = F.col(f"_s_{c}") if f"_s_{c}" in j.columns else F.lit(None)
            out.append(F.when(F.col("_in_t"), F.col(c)).otherwise(src).alias(c))
    action = (F.when(F.col("_in_t").isNull(), F.lit(INSERT))
              .when(F.col("_in_s").isNull(), F.lit(KEEP)).otherwise(F.lit(UPDATE)))
    return j.select(*out, action.alias("action"))


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str | Column] | None = None,
                  key_exprs: dict[str, Column] | None = None) -> DataFrame:
    """Source rows whose key is not in the target (anti join).

    ``key_exprs`` names derived key columns (e.g. ISNULL(descripcion,'')) that
    are computed on both sides before the anti join.
    """
    if key_exprs:
        s = source.withColumns(key_exprs)
        t = target.withColumns(key_exprs)
        ks = list(key_exprs)
    else:
        s, t, ks = source, target, keys
    return s.join(unbounded(t.select(*ks).distinct()), ks, "left_anti").drop(*(key_exprs or {}))


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """New state = target + absent source rows; action INSERT for the new ones."""
    new = insert_absent(target, source, keys).select(*target.columns).withColumn("action", F.lit(INSERT))
    return target.withColumn("action", F.lit(KEEP)).unionByName(new)


def update_nonnull(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Matched rows take COALESCE(new, old) per column."""
    source = one_value_per_key(source.select(*keys, *cols), keys)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_m"))
    j = target.join(unbounded(s), keys, "left")
    changed = F.lit(False)
    for c in cols:
        changed = changed | (F.col("_m") & _changed(F.coalesce(F.col(f"_s_{c}"), F.col(c)), F.col(c)))
    return j.select(*[F.coalesce(F.col(f"_s_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in target.columns],
                    F.when(changed, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"))


def update_changed(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str],
                   keep_old_when_null: bool = True) -> DataFrame:
    """Update a row only when some column differs (null-safe); each column
    is replaced under its own guard, and a NULL new value keeps the old one."""
    source = (one_value_per_key if keep_old_when_null else one_per_key)(source.select(*keys, *cols), keys)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_m"))
    j = target.join(unbounded(s), keys, "left")
    new = {c: (F.coalesce(F.col(f"_s_{c}"), F.col(c)) if keep_old_when_null else F.col(f"_s_{c}")) for c in cols}
    changed = F.lit(False)
    for c in cols:
        changed = changed | (F.col("_m").isNotNull() & _changed(new[c], F.col(c)))
    return j.select(*[F.when(F.col("_m").isNotNull(), new[c]).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in target.columns],
                    F.when(changed, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"))


def update_guarded_unique(target: DataFrame, source: DataFrame, key: str, col: str) -> DataFrame:
    """Set ``col`` from the source only if no OTHER target row already
    holds that value (D14), and only if it changes. Of several source rows
    that claim one value, the lowest key of a target row gets it."""
    s = one_per_key(source.select(key, F.col(col).alias("_new")).filter(F.col("_new").isNotNull()), [key])
    s = (s.join(unbounded(target.select(key)), key, "left_semi").groupBy("_new").agg(F.min(key).alias(key)))
    holders = (target.filter(F.col(col).isNotNull())
               .groupBy(F.col(col).alias("_new"))
               .agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_k")))
    j = target.join(unbounded(s), key, "left").join(unbounded(holders), "_new", "left")
    taken = (F.col("_n") > 1) | ((F.col("_n") == 1) & (F.col("_k") != F.col(key)))
    apply = F.col("_new").isNotNull() & ~F.coalesce(taken, F.lit(False)) & _changed(F.col("_new"), F.col(col))
    return j.select(*[F.when(apply, F.col("_new")).otherwise(F.col(c)).alias(c) if c == col else F.col(c)
                      for c in target.columns],
                    F.when(apply, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"))


def fill_nulls(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """U8: only NULL target columns are filled: COALESCE(old, new)."""
    source = one_value_per_key(source.select(*keys, *cols), keys)
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols])
    j = target.join(unbounded(s), keys, "left")
    filled = F.lit(False)
    for c in cols:
        filled = filled | (F.col(c).isNull() & F.col(f"_s_{c}").isNotNull())
    return j.select(*[F.coalesce(F.col(c), F.col(f"_s_{c}")).alias(c) if c in cols else F.col(c)
                      for c in target.columns],
                    F.when(filled, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"))


def surrogate_keys(new_rows: DataFrame, existing: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """Deterministic identity for new rows: max(existing id) + a dense
    row number over the natural key. The max is a single scalar; the row
    number uses per-partition offsets (no single-task window)."""
    from .windows import global_row_number
    start = existing.agg(F.max(id_col)).first()[0] or 0
    numbered = global_row_number(new_rows, order, name="_rid")
    return numbered.withColumn(id_col, (F.col("_rid") + F.lit(start)).cast("bigint")).drop("_rid")


def reset(source: DataFrame) -> DataFrame:
    """TRUNCATE + reload = the source is the whole new state (write with
    mode('overwrite') to a new path)."""
    return source.withColumn("action", F.lit(INSERT))


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order`` (ascending), as the smallest
    struct of (order columns, other columns). An aggregation, not a window:
    partial aggregation collapses a key repeated in a third of the rows
    before the shuffle (used where one bank id arrives with two spellings)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)
