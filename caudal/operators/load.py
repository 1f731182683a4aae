"""Load semantics as DataFrame jobs (LOAD1-LOAD9).

The reference's database statements (insert-if-absent, upsert, delete by key set,
dimension lookups, constraint checks, manifest diff) become joins:
- insert-if-absent = first row per id inside the batch (``min(struct(position, row))``,
  partial aggregation) + ``left_anti`` against the ids of the target partitions the batch touches;
- upsert = full outer join on the id, the update side wins;
- delete = ``left_anti`` rewrite (the removed count is the ``left_semi`` count).
Writers append/overwrite Parquet; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.text import normalize_name


def first_per_id(batch: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """First row (smallest ``order_col``) of every id inside a batch.

    Written as an aggregate of ``min(struct(order, row))`` so the work is partially
    aggregated map-side; a hot id collapses to one row per task before the shuffle.
    """
    cols = [c for c in batch.columns if c != id_col]
    packed = F.struct(F.col(order_col).alias("__o"), *[F.col(c) for c in cols if c != order_col])
    best = batch.groupBy(id_col).agg(F.min(packed).alias("__b"))
    return best.select(id_col, F.col("__b.__o").alias(order_col),
                       *[F.col(f"__b.`{c}`").alias(c) for c in cols if c != order_col]).select(*batch.columns)


def last_per_id(batch: DataFrame, id_col: str, order_col: str | None = None) -> DataFrame:
    """Last row of every id inside a batch: greatest ``order_col`` (dropped), or, without one, the last as the rows come
    (file by file, line by line)."""
    order = F.monotonically_increasing_id() if order_col is None else F.col(order_col)
    cols = [c for c in batch.columns if c not in (id_col, order_col)]
    best = batch.withColumn("__o", order).groupBy(id_col).agg(F.max_by(F.struct("__o", *cols), "__o").alias("__b"))
    return best.select(id_col, *[F.col(f"__b.`{c}`").alias(c) for c in cols])


def insert_if_absent(batch: DataFrame, existing_ids: DataFrame, id_col: str = "id",
                     order_col: str = "pos", partition: list[str] | None = None) -> DataFrame:
    """LOAD1 / LOAD2: rows to append: first row per id in the batch, ids already in the target skipped.

    ``partition`` names columns that both sides have, that follow from the id and by which the target is laid
    out: only the target partitions the batch touches are then read (a semi-join that prunes at run time).
    """
    if partition:
        existing_ids = existing_ids.join(batch.select(*partition).distinct(), partition, "left_semi")
    first = first_per_id(batch, id_col, order_col)
    return first.join(existing_ids.select(id_col), id_col, "left_anti")


def already_present(batch: DataFrame, existing_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """LOAD2: distinct batch ids that the target already holds (the "already present" count)."""
    return batch.select(id_col).distinct().join(existing_ids.select(id_col), id_col, "left_semi")


def upsert(target: DataFrame, updates: DataFrame, id_col: str = "id", order_col: str | None = None) -> DataFrame:
    """LOAD3: new rows overwrite old ones with the same id; other target rows stay.

    An id that repeats among the updates is written once: the last row wins (``last_per_id``: greatest ``order_col``, which
    the target need not have, or the last as they come). A full outer join on the id follows; the
    update side wins column by column when present. ``tables.merge_last`` does so by partition.
    """
    keep = [c for c in updates.columns if c in target.columns]
    u = last_per_id(updates.select(*keep, *([order_col] if order_col and order_col not in keep else [])), id_col, order_col)
    u = u.select(*[F.col(c).alias(f"__u_{c}") for c in u.columns])
    j = target.join(u, target[id_col] == u[f"__u_{id_col}"], "full")
    has_u = F.col(f"__u_{id_col}").isNotNull()
    taken = [c for c in keep if f"__u_{c}" in u.columns]
    return j.select(*[F.when(has_u, F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
                      for c in target.columns])


def lookup_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, dim_id: str,
                     out: str, normalize: bool = False, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """LOAD4: name -> id lookup. Returns (matched rows with ``out``, unmatched rows).

    The dimension is de-duplicated on the (optionally normalised) name first, so a
    repeated name cannot multiply facts. The join is a plain left join; Catalyst/AQE
    broadcast the dimension only when its measured size is under the threshold.
    ``strict`` raises when any fact has no match (one ``isEmpty`` action on the
    distinct unmatched names).
    """
    fk = normalize_name(fact_key) if normalize else F.col(fact_key)
    dk = normalize_name(dim_key) if normalize else F.col(dim_key)
    d = dim.select(dk.alias("__k"), F.col(dim_id).alias(out)).groupBy("__k").agg(F.min(out).alias(out))
    j = facts.withColumn("__k", fk).join(d, "__k", "left").drop("__k")
    matched, unmatched = j.filter(F.col(out).isNotNull()), j.filter(F.col(out).isNull()).drop(out)
    if strict:
        missing = unmatched.select(fact_key).distinct()
        if not missing.isEmpty():
            names = [r[0] for r in missing.limit(10).collect()]  # a sample for the message only
            raise ValueError(f"lookup of {fact_key!r} found no {dim_key!r} for e.g. {names}")
    return matched, unmatched


def skip_loaded_groups(candidates: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """LOAD5: drop candidate rows whose group (e.g. location, code) is already loaded."""
    return candidates.join(target.select(*keys).distinct(), keys, "left_anti")


def delete_by_keys(target: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """LOAD6: (remaining rows, deleted rows) for a delete by key set."""
    k = keys.select(*on).distinct()
    return target.join(k, on, "left_anti"), target.join(k, on, "left_semi")


def constraint_violations(df: DataFrame, not_null: list[str] | None = None,
                          ordered: tuple[str, str] | None = None,
                          enums: dict[str, list[str]] | None = None,
                          max_len: dict[str, int] | None = None) -> DataFrame:
    """LOAD8: one row per (row, violated rule) with the rule name; empty when clean."""
    checks: list[tuple[str, Column]] = []
    for c in not_null or []:
        checks.append((f"not_null:{c}", F.col(c).isNull()))
    if ordered:
        a, b = ordered
        checks.append((f"check:{a}<={b}", F.col(a) > F.col(b)))
    for c, allowed in (enums or {}).items():
        checks.append((f"enum:{c}", F.col(c).isNotNull() & ~F.col(c).isin(*allowed)))
    for c, n in (max_len or {}).items():
        checks.append((f"length:{c}", F.length(c) > n))
    flags = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks])
    return df.withColumn("violation", F.explode(F.array_compact(flags)))


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """LOAD8: values of a UNIQUE column that occur more than once, with their count."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def manifest_diff(manifest: DataFrame, state: DataFrame) -> DataFrame:
    """LOAD9: resolved resources vs last known state: ``nuevo`` (unknown id), ``modificado``
    (hash differs, or empty hash), null when unchanged."""
    s = state.select("resource_id", F.col("hash").alias("hash_anterior"))
    j = manifest.filter(F.col("archivo_local").isNotNull()).join(s, "resource_id", "left")
    h = F.coalesce(F.col("hash"), F.lit(""))
    status = (F.when(F.col("hash_anterior").isNull(), F.lit("nuevo"))
              .when((h == "") | (h != F.col("hash_anterior")), F.lit("modificado")))
    return j.withColumn("motivo", status)


def affected_modules(diff: DataFrame) -> DataFrame:
    """LOAD9: distinct modules with at least one new or modified resource."""
    return diff.filter(F.col("motivo").isNotNull()).select("modulo").distinct()


def refreshed_state(state: DataFrame, diff: DataFrame, synced_at: Column | None = None) -> DataFrame:
    """LOAD9 + LOAD3: state table after the sync (changed resources upserted)."""
    ts = synced_at if synced_at is not None else F.current_timestamp()
    changed = diff.filter(F.col("motivo").isNotNull()).select(
        "resource_id", "package", "modulo", F.coalesce("hash", F.lit("")).alias("hash"), "archivo_local",
        ts.alias("last_synced"))
    return upsert(state.select(*changed.columns), changed, "resource_id")
