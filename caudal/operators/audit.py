"""Audit, profiling and reconciliation jobs.

All are aggregates over the tables involved; counts from several tables are
unioned as small frames (one row per table or task), never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame], total_label: str = "TOTAL") -> DataFrame:
    """Row count per table plus a TOTAL row (the table list is an input)."""
    parts = [df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabla"), "registros")
             for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    r = u.rollup("tabla").agg(F.sum("registros").cast("long").alias("registros"))
    return r.select(F.coalesce("tabla", F.lit(total_label)).alias("tabla"), "registros")


def _reconciled(origen: Column, missing: Column) -> list[Column]:
    """Difference and reason: the task's configured reason, ``(*)`` added when the target has more rows than the
    source; without a source N/A, and without a target ``sin destino``."""
    diff = F.when(missing, F.lit(None).cast("long")).otherwise(origen - F.col("destino_n"))
    reason = F.col("motivo")
    return [diff.alias("diferencia"),
            F.when(missing, F.lit("N/A")).when(F.col("destino_n").isNull(), F.lit("sin destino"))
            .when(diff < 0, F.concat(reason, F.lit(" (*)"))).otherwise(reason).alias("motivo")]


def reconcile(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Per task, source rows after cleaning vs target rows, their difference and the reason.

    source_counts: (tarea, destino, origen or null for a missing source, motivo); target_counts: (destino, destino_n).
    """
    j = source_counts.join(target_counts, "destino", "left")
    return j.select("tarea", "destino", "origen", "destino_n", *_reconciled(F.col("origen"), F.col("origen").isNull()))


def reconcile_shared(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Several sources feed one target: sum of sources vs target; any missing source -> N/A.

    Columns as for ``reconcile``; the reason is the target's (the least text among its sources).
    """
    s = source_counts.groupBy("destino").agg(
        F.sum("origen").cast("long").alias("origen"), F.bool_or(F.col("origen").isNull()).alias("falta"),
        F.min("motivo").alias("motivo"))
    j = s.join(target_counts, "destino", "left")
    origen = F.when(F.col("falta"), F.lit(None).cast("long")).otherwise(F.col("origen"))
    return j.select("destino", origen.alias("origen"), "destino_n", *_reconciled(origen, F.col("falta")))


def drop_accounting(tagged: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows in, rows kept and rows per drop reason (``reason`` null = kept)."""
    return tagged.groupBy(F.coalesce(F.col(reason), F.lit("conservada")).alias("motivo")).agg(
        F.count(F.lit(1)).alias("filas"))


def rows_by_year(tagged: DataFrame, ts: str, reason: str = "reason") -> DataFrame:
    """Rows per year with kept / dropped counts."""
    y = F.year(ts).alias("anio")
    return tagged.groupBy(y).agg(
        F.sum(F.when(F.col(reason).isNull(), 1).otherwise(0)).cast("long").alias("conservadas"),
        F.sum(F.when(F.col(reason).isNotNull(), 1).otherwise(0)).cast("long").alias("descartadas"))


def unmapped_categories(df: DataFrame, label: str, mapped: Column) -> DataFrame:
    """Labels that do not map, by frequency."""
    return df.filter(mapped.isNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def files_per_code(df: DataFrame, code: str, file: str) -> DataFrame:
    """Which files contain each code (sorted file list, bounded by the file count)."""
    return df.select(code, file).distinct().groupBy(code).agg(F.sort_array(F.collect_list(file)).alias("archivos"))


def parameter_coverage(df: DataFrame, code: str, station: str, total_label: str = "Total", file: str | None = None,
                       names: DataFrame | None = None) -> DataFrame:
    """Rows and stations per code plus a Total row with distinct stations overall; codes without rows
    do not appear, a null code is a code.

    With ``file`` the stations of a code are counted per file and summed. ``names`` (code, nombre) adds the
    parameter's name, null where there is none and on the Total row.
    """
    # the input is read once: its rows per code, file and station count for the code and for the total, which is there without rows too
    one = df.groupBy(F.col(code).alias("__c"), (F.col(file) if file else F.lit(0)).alias("__f"), F.col(station).alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    for_code = F.struct(F.lit(False).alias("whole"), F.col("__c").alias("c"), F.col("__f").alias("f"), F.col("__s").alias("s"), F.col("__n").alias("n"))
    for_total = F.struct(F.lit(True).alias("whole"), F.lit(None).alias("c"), F.lit(None).alias("f"), F.col("__s").alias("s"), F.col("__n").alias("n"))
    both = one.select(F.inline(F.array(for_code, for_total)))
    stations = both.groupBy("whole", "c", "f", "s").agg(F.sum("n").alias("n"))
    counted = stations.groupBy("whole", "c", "f").agg(F.sum("n").alias("filas"), F.count("s").alias("estaciones"))
    counted = counted.unionByName(df.sparkSession.range(1).select(
        F.lit(True).alias("whole"), F.lit(None).alias("c"), F.lit(None).alias("f"), F.lit(0).cast("long").alias("filas"), F.lit(0).cast("long").alias("estaciones")))
    per = counted.groupBy("whole", F.col("c").alias(code)).agg(F.sum("filas").alias("filas"), F.sum("estaciones").alias("estaciones"))
    label = F.when(F.col("whole"), F.lit(total_label)).otherwise(F.col(code)).alias(code)
    if names is None:
        return per.select(label, "filas", "estaciones")
    names = names.select(F.lit(False).alias("__whole"), F.col(names.columns[0]).alias("__code"), F.col("nombre"))
    per = per.join(names, (F.col("whole") == F.col("__whole")) & (F.col(code) == F.col("__code")), "left")
    return per.select(label, "filas", "estaciones", "nombre")


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls per column (one aggregate pass), as rows (columna, nulos)."""
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"`{c}`").alias("nulos"))
                                          for c in cols])).alias("r")).select("r.*")


def null_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where both columns of a pair are null (one aggregate pass)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.count_if(F.col(f"`{a}`").isNull() & F.col(f"`{b}`").isNull()).alias(f"{a}|{b}")
                   for a, b in pairs])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("columna_a"), F.lit(b).alias("columna_b"), F.col(f"`{a}|{b}`").alias("ambos_nulos"))
        for a, b in pairs])).alias("r")).select("r.*")


def duplicate_names(df: DataFrame, name: str, skip: str | None = "SIN_NOMBRE") -> DataFrame:
    """Names occurring more than once (nulls and the placeholder skipped)."""
    f = df.filter(F.col(name).isNotNull())
    if skip:
        f = f.filter(F.col(name) != skip)
    return f.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A10: distinct values of a column with their counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def keyword_search(df: DataFrame, col: str, keywords: list[str], mode: str = "contains") -> DataFrame:
    """Rows whose lower-cased ``col`` contains / starts with a keyword (case-insensitive)."""
    low = F.lower(F.col(col))
    cond = None
    for k in keywords:
        c = low.contains(k.lower()) if mode == "contains" else low.startswith(k.lower())
        cond = c if cond is None else (cond | c)
    return df.filter(cond)
