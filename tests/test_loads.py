import pytest
from pyspark.sql import functions as F

from caudal.operators import load, tables


def test_insert_if_absent_first_wins_and_idempotent(spark):
    batch = spark.createDataFrame([("a", 2, 20.0), ("a", 1, 10.0), ("b", 3, 30.0), ("c", 4, 40.0)],
                                  "id string, pos long, v double")
    existing = spark.createDataFrame([("c",)], "id string")
    first = load.insert_if_absent(batch, existing)
    got = {r.id: r.v for r in first.collect()}
    assert got == {"a": 10.0, "b": 30.0}
    again = load.insert_if_absent(batch, existing.unionByName(first.select("id")))
    assert again.count() == 0
    assert {r.id for r in load.already_present(batch, existing).collect()} == {"c"}


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    upd = spark.createDataFrame([("b", 20), ("c", 30)], "id string, v int")
    assert {r.id: r.v for r in load.upsert(target, upd).collect()} == {"a": 1, "b": 20, "c": 30}


def test_lookup_dimension_normalised(spark):
    facts = spark.createDataFrame([(" Río Negro ",), ("Salto",), ("Nowhere",)], "departamento string")
    dim = spark.createDataFrame([(1, "Rio Negro"), (2, "SALTO"), (3, "salto")], "did int, nombre string")
    m, u = load.lookup_dimension(facts, dim, "departamento", "nombre", "did", "departamento_id", normalize=True)
    assert sorted(r.departamento_id for r in m.collect()) == [1, 2]
    assert [r.departamento for r in u.collect()] == ["Nowhere"]


def test_delete_and_skip_groups(spark):
    t = spark.createDataFrame([(1, "NDCI"), (1, "NDTI"), (2, "NDCI")], "location_id int, code string")
    keys = spark.createDataFrame([(1, "NDCI")], "location_id int, code string")
    rem, dele = load.delete_by_keys(t, keys, ["location_id", "code"])
    assert rem.count() == 2 and dele.count() == 1
    assert load.skip_loaded_groups(t, keys, ["location_id", "code"]).count() == 2


def test_constraints(spark):
    df = spark.createDataFrame([("a", 1, 2, "HORA"), (None, 3, 2, "SEMANAL")], "code string, a int, b int, g string")
    v = load.constraint_violations(df, not_null=["code"], ordered=("a", "b"), enums={"g": ["HORA", "DIA"]},
                                   max_len={"code": 0})
    assert sorted(r.violation for r in v.collect()) == ["check:a<=b", "enum:g", "length:code", "not_null:code"]
    assert load.unique_violations(spark.createDataFrame([("x",), ("x",), ("y",)], "k string"), "k").count() == 1


def test_manifest_diff(spark):
    man = spark.createDataFrame([("1", "p", "m1", "h1", "f1"), ("2", "p", "m2", "h2", "f2"), ("3", "p", "m3", "", "f3"),
                                 ("4", "p", "m4", "h4", "f4"), ("5", "p", "m5", "h5", None)],
                                "resource_id string, package string, modulo string, hash string, archivo_local string")
    st = spark.createDataFrame([("2", "old"), ("3", ""), ("4", "h4")], "resource_id string, hash string")
    d = {r.resource_id: r.motivo for r in load.manifest_diff(man, st).collect()}
    assert d == {"1": "nuevo", "2": "modificado", "3": "modificado", "4": None}
    assert {r.modulo for r in load.affected_modules(load.manifest_diff(man, st)).collect()} == {"m1", "m2", "m3"}
    new_state = {r.resource_id: r.hash for r in load.refreshed_state(
        st.withColumns({"package": F.lit("p"), "modulo": F.lit("m"), "archivo_local": F.lit("f"),
                        "last_synced": F.current_timestamp()}), load.manifest_diff(man, st)).collect()}
    assert new_state["2"] == "h2" and new_state["4"] == "h4" and new_state["1"] == "h1"


def test_lookup_strict_raises(spark):
    facts = spark.createDataFrame([("Salto",), ("Nowhere",)], "departamento string")
    dim = spark.createDataFrame([(2, "Salto")], "did int, nombre string")
    with pytest.raises(ValueError):
        load.lookup_dimension(facts, dim, "departamento", "nombre", "did", "departamento_id", strict=True)
    m, u = load.lookup_dimension(facts.filter(F.col("departamento") == "Salto"), dim, "departamento", "nombre",
                                 "did", "departamento_id", strict=True)
    assert m.count() == 1 and u.count() == 0


def test_first_per_id_with_a_hot_id(spark):
    # one id holds a third of the rows: the aggregate still returns its first row only
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                               .alias("id"), (n - F.col("id")).alias("pos"), F.col("id").alias("v"))
    out = load.first_per_id(df, "id", "pos")
    hot = out.filter(F.col("id") == "hot").collect()
    assert len(hot) == 1 and hot[0].v == n - 3 and hot[0].pos == 3
    assert out.count() == 1 + 2 * n // 3


def test_upsert_writes_a_repeated_id_once(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    upd = spark.createDataFrame([("a", 10, 1), ("a", 30, 3), ("a", 20, 2), ("c", 5, 1)], "id string, v int, pos int")
    got = load.upsert(target, upd, order_col="pos").collect()
    assert sorted((r.id, r.v) for r in got) == [("a", 30), ("b", 2), ("c", 5)]


def test_insert_reads_only_the_partitions_of_the_batch(spark):
    batch = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "id string, code string, pos long")
    existing = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, code string")
    got = load.insert_if_absent(batch, existing, partition=["code"]).collect()
    assert [r.id for r in got] == ["b"]  # an id names its partition: ids of other partitions are not read


def test_reconciliation_cases(spark):
    from caudal.operators import audit
    src = spark.createDataFrame([("t1", "a", 5, "m"), ("t2", "b", 3, "m"), ("t3", "c", 4, "m"), ("t4", "d", None, "m"), ("t5", "e", 7, "m")],
                                "tarea string, destino string, origen long, motivo string")
    tgt = spark.createDataFrame([("a", 5), ("b", 4), ("c", 1), ("d", 9)], "destino string, destino_n long")
    got = {r.tarea: (r.diferencia, r.motivo) for r in audit.reconcile(src, tgt).collect()}
    assert got == {"t1": (0, "m"), "t2": (-1, "m (*)"), "t3": (3, "m"), "t4": (None, "N/A"), "t5": (None, "sin destino")}
    src = spark.createDataFrame([("a", 2, "m"), ("a", 2, "m"), ("b", 1, "m"), ("b", None, "m"), ("c", 1, "m")],
                                "destino string, origen long, motivo string")
    got = {r.destino: (r.origen, r.diferencia, r.motivo) for r in audit.reconcile_shared(src, tgt).collect()}
    assert got == {"a": (4, -1, "m (*)"), "b": (None, None, "N/A"), "c": (1, 0, "m")}


def test_parameter_coverage_with_a_null_code(spark):
    from caudal.operators import audit
    df = spark.createDataFrame([("A", "s1", "f1"), ("A", "s1", "f2"), ("A", "s2", "f2"), (None, "s3", "f1")], "code string, st string, f string")
    names = spark.createDataFrame([("A", "Alfa")], "code string, nombre string")
    got = [(r.code, r.filas, r.estaciones, r.nombre) for r in audit.parameter_coverage(df, "code", "st", file="f", names=names).collect()]
    assert sorted(got, key=str) == sorted([("A", 3, 3, "Alfa"), (None, 1, 1, None), ("Total", 4, 3, None)], key=str)


def test_upsert_without_an_order_column_takes_the_last_row(spark):
    target = spark.createDataFrame([("a", "h0"), ("b", "h0")], "id string, h string")
    upd = spark.createDataFrame([("a", "h9"), ("a", "h1"), ("c", "z"), ("c", None)], "id string, h string").coalesce(1)
    got = {r.id: r.h for r in load.upsert(target, upd).collect()}
    assert got == {"a": "h1", "b": "h0", "c": None}


def test_a_load_reads_only_the_partitions_of_its_batch(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(400).select(F.format_string("id%d", "id").alias("id"), (F.col("id") % 40).cast("int").alias("dia"), F.col("id").alias("pos"))
    tables.append(rows, path, ["dia"])
    table = spark.read.schema(rows.schema).parquet(path)
    batch = tables.stage(spark.createDataFrame([("id3", 3, 1), ("new", 3, 2), ("new", 3, 1), ("id7", 7, 1)], "id string, dia int, pos long"))
    seen = tables.read_touched(table, batch, ["dia"])
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dia" in plan and seen.select("dia").distinct().count() == 2
    got = tables.new_rows(batch, table, ["dia"])
    assert [(r.id, r.pos) for r in got.collect()] == [("new", 1)]
    for _ in range(2):  # a repeated load adds nothing
        tables.load_new(batch, path, ["dia"])
    assert spark.read.parquet(path).count() == 401


def test_many_or_several_partition_columns(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = spark.range(100).select(F.col("id").cast("string").alias("id"), (F.col("id") % 5).cast("int").alias("a"),
                                   F.when(F.col("id") % 2 == 0, F.lit("x")).alias("b"), F.col("id").alias("pos"))
    tables.append(rows, path, ["a", "b"])
    table = spark.read.schema(rows.schema).parquet(path)
    batch = tables.stage(rows.where("a = 1 AND b = 'x' OR a = 2 AND b = 'x'"))
    assert tables.read_touched(table, batch, ["a", "b"]).count() == 20
    monkeypatch.setattr(tables, "MAX_NAMED", 1)
    assert tables.read_touched(table, batch, ["a", "b"]).count() == 20


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(60).select(F.col("id").cast("string").alias("id"), F.lit("old").alias("v")).withColumn("cubo", tables.id_bucket("id", 12))
    tables.append(rows, path, ["cubo"])
    before = {p.relative_to(path): p.stat().st_mtime_ns for p in __import__("pathlib").Path(path).glob("cubo=*/*.parquet")}
    upd = spark.createDataFrame([("5", "x", 2), ("5", "y", 1), ("new", "n", 1)], "id string, v string, turn int").withColumn("cubo", tables.id_bucket("id", 12))
    tables.merge_last(spark, path, upd, ["cubo"], "id", "turn")
    got = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 61 and got["5"] == "x" and got["new"] == "n" and sum(v == "old" for v in got.values()) == 59
    touched = {r.cubo for r in upd.collect()}
    after = {p.relative_to(path): p.stat().st_mtime_ns for p in __import__("pathlib").Path(path).glob("cubo=*/*.parquet")}
    assert {f for f in before if int(f.parts[0][5:]) not in touched} == {f for f in after if int(f.parts[0][5:]) not in touched}
    assert all(after[f] == before[f] for f in after if f in before) and not any(f in after for f in before if int(f.parts[0][5:]) in touched)


def test_parameter_coverage_reads_its_rows_once_and_counts_none(spark):
    from caudal.operators import audit
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    rows = [("A", "s1", "f1"), ("A", None, "f1"), ("A", "s1", "f2"), ("B", "s1", "f1"), (None, "s2", "f1"), ("Total", "s3", "f1")]
    df = spark.createDataFrame(rows, "code string, st string, f string")
    df = df.withColumn("st", F.udf(seen, "string")("st"))
    names = spark.createDataFrame([("A", "Alfa"), ("A", "Alef"), ("Total", "T")], "code string, nombre string")
    got = [tuple(r) for r in audit.parameter_coverage(df, "code", "st", file="f", names=names).select("code", "filas", "estaciones", "nombre").collect()]
    assert sorted(got, key=str) == sorted([("A", 3, 2, "Alfa"), ("A", 3, 2, "Alef"), ("B", 1, 1, None), (None, 1, 1, None), ("Total", 1, 1, "T"),
                                           ("Total", 6, 3, None)], key=str)
    assert read.value == len(rows)
    assert [tuple(r) for r in audit.parameter_coverage(df, "code", "st").where("code = 'A'").collect()] == [("A", 3, 1)]
    assert [tuple(r) for r in audit.parameter_coverage(df.where("false"), "code", "st", file="f").collect()] == [("Total", 0, 0)]
