"""Domain tables derived from the driver tables (TPC-H-ish parquet).

The hydrology model (departments, stations, grid points, water bodies and their
fact tables) is re-expressed over the given tables with fixed integer rules, so
that every query's work grows with the input and an independent DuckDB oracle
(``caudal.plans.oracle``) can rebuild the same rows. Each builder returns a lazy
DataFrame; joins are left to Catalyst/AQE (no forced broadcast).

Rules (mirrored in ``oracle.py``):
- department = nation row; polygon in a 5x5 lattice of 1-degree cells, cell
  origin lon -58.4 + key%5, lat -35 + key div 5. Shape: key%7=6 tiny square
  [.72,.80]^2, else key%3: 0 wide square [.1,1.2]x[.1,.9] (overlaps the next
  cell), 1 diamond |dx|+|dy| < .45 around (.5,.5), 2 L-shape.
- station = supplier row at lon -58.4 + (37k%500)/100 + .003,
  lat -35 + (53k%500)/100 + .0041 (never on a polygon edge).
- grid point = lattice (-58.4 + i/3, -35 + j/3), i = partkey%16, j = (partkey div 16)%16.
- water body = nation row, centre (x0 + .52, y0 + .52), bbox half-width .02.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions.geometry import bbox_ring, point_struct

LON0 = -58.4
LAT0 = -35.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _idiv(c: Column, n: int) -> Column:
    return F.floor(c / F.lit(n)).cast("long")


# ---------------------------------------------------------------- departments

def _ring(points: list[tuple[float, float]], x0: Column, y0: Column) -> Column:
    pts = points + [points[0]]
    return F.array(*[point_struct(x0 + F.lit(dx), y0 + F.lit(dy)) for dx, dy in pts])


SHAPES = {
    0: [(0.1, 0.1), (1.2, 0.1), (1.2, 0.9), (0.1, 0.9)],
    1: [(0.5, 0.05), (0.95, 0.5), (0.5, 0.95), (0.05, 0.5)],
    2: [(0.1, 0.1), (0.9, 0.1), (0.9, 0.5), (0.5, 0.5), (0.5, 0.9), (0.1, 0.9)],
    3: [(0.72, 0.72), (0.8, 0.72), (0.8, 0.8), (0.72, 0.8)],
}


def departamentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    shape = F.when(k % 7 == 6, F.lit(3)).otherwise(k % 3)
    x0 = F.lit(LON0) + (k % 5).cast("double")
    y0 = F.lit(LAT0) + _idiv(k, 5).cast("double")
    ring = None
    for s, pts in SHAPES.items():
        ring = F.when(shape == s, _ring(pts, x0, y0)) if ring is None else ring.when(shape == s, _ring(pts, x0, y0))
    return n.select(
        k.alias("departamento_id"),
        F.col("n_name").alias("nombre"),
        F.lpad(k.cast("string"), 2, "0").alias("codigo"),
        F.array(ring).alias("rings"),
    )


#: A hole in each shape, and an island beside it.
HOLES = {s: [(0.4, 0.4), (0.4, 0.46), (0.46, 0.46), (0.46, 0.4)] if s < 3 else [(0.74, 0.74), (0.74, 0.78), (0.78, 0.78), (0.78, 0.74)] for s in SHAPES}
ISLAND = [(0.01, 0.01), (0.04, 0.01), (0.04, 0.04), (0.01, 0.04)]


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departments with ``gtype`` and ``parts``: key % 3 = 0 their polygon, 1 the polygon with a hole, 2 a MultiPolygon of
    the polygon with a hole and an island."""
    k = F.col("departamento_id")
    x0 = F.lit(LON0) + (k % 5).cast("double")
    y0 = F.lit(LAT0) + _idiv(k, 5).cast("double")
    hole = F.when(k % 7 == 6, _ring(HOLES[3], x0, y0)).otherwise(_ring(HOLES[0], x0, y0))
    outer = F.element_at("rings", 1)
    parts = (F.when(k % 3 == 0, F.array(F.array(outer))).when(k % 3 == 1, F.array(F.array(outer, hole)))
             .otherwise(F.array(F.array(outer, hole), F.array(_ring(ISLAND, x0, y0)))))
    return departamentos(spark, sf_dir).select(
        "*", F.when(k % 3 == 2, "MultiPolygon").otherwise("Polygon").alias("gtype"), parts.alias("parts"))


# ---------------------------------------------------------------- stations / grid / water bodies

def estaciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("estacion_id"),
        F.col("s_name").alias("nombre"),
        (F.lit(LON0) + ((k * 37) % 500) / F.lit(100) + F.lit(0.003)).alias("lon"),
        (F.lit(LAT0) + ((k * 53) % 500) / F.lit(100) + F.lit(0.0041)).alias("lat"),
    )


def grid_coords(partkey: Column) -> tuple[Column, Column]:
    lon = F.lit(LON0) + (partkey % 16) / F.lit(3)
    lat = F.lit(LAT0) + (_idiv(partkey, 16) % 16) / F.lit(3)
    return lon, lat


def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid coordinates: the registry's own source (a row per part, far fewer than facts)."""
    lon, lat = grid_coords(F.col("p_partkey"))
    return read(spark, sf_dir, "part").select(lon.alias("lon"), lat.alias("lat"))


def sentinel_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    cx = F.lit(LON0) + (k % 5).cast("double") + F.lit(0.52)
    cy = F.lit(LAT0) + _idiv(k, 5).cast("double") + F.lit(0.52)
    return n.select(
        k.alias("location_id"),
        F.concat(F.lit("Laguna "), F.col("n_name")).alias("nombre"),
        F.array(bbox_ring(cx, cy, 0.02)).alias("rings"),
    )


# ---------------------------------------------------------------- raw source frames (string typed)

def _with_text(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with a text column that is there as if read from a file: not computed again at each use."""
    return df.select("*", F.inline(F.array(F.struct(text.alias(name)))))


def _by_turns(key: Column, forms: list[Column]) -> Column:
    """Form i for the rows with key % n = i."""
    out = None
    for i, f in enumerate(forms):
        out = (F.when if out is None else out.when)(key % len(forms) == i, f)
    return out


def _day_texts(day: Column) -> list[Column]:
    """A day as sources write it."""
    plain = F.date_format(day, "yyyy-MM-dd")
    return [plain, F.date_format(day, "yyyy/M/d"), F.date_format(day, "yyyyMMdd"), F.date_format(day, "MM/dd/yyyy"),
            F.date_format(day, "dd-MMM-yyyy"), F.concat(plain, F.lit("\r")), F.concat(F.lit("\u00a0"), plain, F.lit("\t"))]


def _hour_texts(ts: Column) -> list[Column]:
    """An hour as sources write it."""
    plain = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return [plain, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.concat(F.date_format(ts - F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm"), F.lit("-03:00")),
            F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.date_format(ts, "yyyy-MM-dd HH"), F.date_format(ts, "MM/dd/yyyy hh:mm a"),
            F.date_format(ts, "d MMM yyyy HH:mm"), F.concat(plain, F.lit("\r")), F.concat(F.lit("\u00a0"), F.date_format(ts, "yyyy/MM/dd H:mm"))]

def raw_ose_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-shaped quarterly categorical samples (``;`` CSV columns, all text)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(su, li.l_suppkey == su.s_suppkey).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
    ln = F.col("l_linenumber")
    valor = (
        F.when(F.col("l_returnflag") == "R", "Presencia")
        .when(F.col("l_returnflag") == "A", "Ausencia")
        .when(ln % 3 == 0, "<1")
        .when(ln % 3 == 1, F.lit(None).cast("string"))
        .otherwise("Indeterminado")
    )
    return j.select(
        F.lit("microbiologia").alias("area_analisis"),
        F.lit("M1").alias("metodo"),
        F.lit("Lab A").alias("laboratorio"),
        F.lit("Centro").alias("localidad"),
        _by_turns(ln, [F.concat(F.lit(" "), F.lower("n_name")), F.col("n_name"), F.concat(F.col("n_name"), F.lit("\t")),
                       F.concat(F.initcap("n_name"), F.lit("\u00a0")), F.concat(F.translate("n_name", "AEIOUC", "ÁÈÎÕÜḈ"), F.lit("\r"))])
        .alias("departamento"),
        (F.col("l_orderkey") * 10 + ln).cast("string").alias("id_muestra_m"),
        F.when(F.col("l_linestatus") == "F", "COLIFORMES TOTALES").otherwise("COLIFORMES FECALES").alias("parametro"),
        valor.alias("valor"),
        F.concat(F.lit("Trimestre "), F.quarter("l_shipdate").cast("string")).alias("trimestre"),
        F.year("l_shipdate").alias("año"),
    )


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4-shaped hourly series from ``events``: text columns with padding and garbage."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    texts = _by_turns(F.col("event_id"), _hour_texts(F.date_trunc("hour", "ts")))
    return _with_text(e, F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string")).otherwise(texts), "fecha").select(
        "fecha",
        F.concat(F.lit(" S"), F.col("user_id").cast("string"), _by_turns(F.col("event_id"), [F.lit(" "), F.lit("\u00a0"), F.lit("\r")])).alias("estacion_id"),
        F.when(F.col("event_type") == "error", F.lit("no_numerico"))
        .otherwise(F.col("value").cast("string")).alias("precip_horario"),
        F.col("event_id"),
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7-shaped claim rows from orders x customer x nation."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    tipo = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Alto Consumo")
        .when(F.col("o_orderpriority") == "2-HIGH", "Error en EstimaciÃ³n (Social)")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Denuncia de Notificación de facturas")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Error de Lectura Web")
        .otherwise(F.when(k % 2 == 0, "Tipo Desconocido").otherwise("Varios"))
    )
    fecha = F.when(k % 61 == 3, F.lit("fecha invalida")).otherwise(_by_turns(k, _day_texts(F.to_date("o_orderdate"))))
    return _with_text(j, fecha, "fecha_ingreso").select(
        F.when(F.col("c_nationkey") % 2 == 0, "Norte").otherwise("Sur").alias("region"),
        F.when(k % 50 == 7, F.lit("SIN DATOS")).otherwise(F.col("n_name")).alias("departamento"),
        "fecha_ingreso",
        tipo.alias("tipo_reclamo_comercial"),
        k.cast("string").alias("id_reclamo_comercial_m"),
        F.lit("x").alias("extra"),
    )


# ---------------------------------------------------------------- typed fact tables

def oseparam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly categorical samples keyed by department (direct form of CLN5 output)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li.l_suppkey == su.s_suppkey)
    ln = F.col("l_linenumber")
    q0 = F.trunc(F.to_date("l_shipdate"), "quarter")
    value_cat = (
        F.when(F.col("l_returnflag") == "R", "Presencia")
        .when(F.col("l_returnflag") == "A", "Ausencia")
        .when(ln % 3 == 1, F.lit(None).cast("string"))
        .otherwise("Indeterminado")
    )
    return (
        j.filter(~((F.col("l_returnflag") == "N") & (ln % 3 == 0)))  # the '<1' rows the cleaner drops
        .select(
            F.col("s_nationkey").alias("departamento_id"),
            F.when(F.col("l_linestatus") == "F", "COLIFORMES TOTALES").otherwise("COLIFORMES FECALES").alias("code"),
            q0.cast("timestamp_ntz").alias("fecha_inicio"),
            F.last_day(F.add_months(q0, 2)).cast("timestamp_ntz").alias("fecha_fin"),
            F.lit(None).cast("double").alias("value"),
            value_cat.alias("value_cat"),
            F.lit("TRIMESTRE").alias("granularidad"),
            (F.col("l_orderkey") * 10 + ln).cast("string").alias("id_muestra_m"),
        )
    )


def reclamosose(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("c_nationkey").alias("departamento_id"),
        F.col("o_orderpriority").alias("tipo_reclamo"),
        F.when(F.col("c_nationkey") % 2 == 0, "Norte").otherwise("Sur").alias("region"),
        F.col("o_orderdate").alias("fecha_inicio"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("fecha_fin"),
        F.col("o_orderkey").cast("string").alias("id_reclamo_comercial_m"),
    )


def gemsparams(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
    return li.select(
        F.col("l_suppkey").alias("location_id"),
        F.when(F.col("l_returnflag") == "A", "TOTCOLI").when(F.col("l_returnflag") == "N", "ECOLI")
        .otherwise("PH").alias("code"),
        F.col("l_shipdate").alias("fecha_inicio"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("fecha_fin"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("value"),
        F.lit("mg/l").alias("unit"),
        F.lit("Good").alias("data_quality"),
        F.lit(None).cast("double").alias("depth"),
        F.lit("DIA").alias("granularidad"),
    )


def registrotempprec(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    day = F.to_date("l_shipdate").cast("timestamp_ntz")
    return li.select(
        F.col("l_suppkey").alias("location_id"),
        (day + F.expr("INTERVAL 9 HOURS")).alias("fecha_inicio"),
        (day + F.expr("INTERVAL '1 08:59:59' DAY TO SECOND")).alias("fecha_fin"),
        (F.col("l_quantity") / 2).alias("temperatura_maxima"),
        (F.col("l_tax") * 100).alias("temperatura_minima"),
        (F.col("l_discount") * 100).alias("pluviometro"),
        F.lit("DIA").alias("granularidad"),
    )


def puntomedicion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-day grid values (long form, as CLN9/CLN10 produce) with grid coordinates."""
    li = read(spark, sf_dir, "lineitem").select("l_partkey", "l_discount", "l_returnflag", "l_shipdate")
    lon, lat = grid_coords(F.col("l_partkey"))
    d = F.to_date("l_shipdate")
    dom = F.dayofmonth(d)
    start_day = F.when(dom <= 10, 1).when(dom <= 20, 11).otherwise(21)
    start = F.make_date(F.year(d), F.month(d), start_day)
    end = F.when(dom <= 10, F.date_add(start, 9)).when(dom <= 20, F.date_add(start, 9)).otherwise(F.last_day(d))
    return li.select(
        lon.alias("lon"), lat.alias("lat"),
        (F.col("l_discount") * 100).alias("value"),
        F.when(F.col("l_returnflag") == "A", "IBH").when(F.col("l_returnflag") == "N", "PAD")
        .otherwise("ANR").alias("type"),
        start.alias("fecha_inicio"),
        end.alias("fecha_fin"),
        F.lit("PERIODO").alias("granularidad"),
    )


def sentinel_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily index values per water body (normalised difference of tax and discount)."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_tax", "l_discount", "l_linestatus", "l_shipdate")
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li.l_suppkey == su.s_suppkey)
    v = F.try_divide(F.col("l_tax") - F.col("l_discount"), F.col("l_tax") + F.col("l_discount"))
    return (
        j.select(
            F.col("s_nationkey").alias("location_id"),
            F.when(F.col("l_linestatus") == "F", "NDCI").otherwise("NDTI").alias("code"),
            F.to_date("l_shipdate").alias("fecha_inicio"),
            F.to_date("l_shipdate").alias("fecha_fin"),
            v.alias("value"),
            F.lit("DIA").alias("granularidad"),
        )
        .filter(F.col("value").isNotNull())
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel table for the spectral index (SP1-SP4) from ``embeddings``.

    Each embedding is one scene; element triples (3i, 3i+1, 3i+2) are the red,
    green and red-edge reflectance of pixel i; scene class scl = (vec_id + i) % 8
    (6 = water); location = label; pixel coordinates on a small lattice around
    the water body centre; cloud cover = (vec_id * 7) % 40; date = 2015-01-01 + (3*vec_id % 2190) days,
    so every size of the table spreads over the same six years.
    """
    e = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    px = e.select(
        "vec_id", "label",
        F.posexplode(F.sequence(F.lit(0), F.floor(F.size("embedding") / 3).cast("int") - 1)).alias("i", "_p"),
        "embedding",
    )
    i = F.col("i")
    k = F.col("label")
    cx = F.lit(LON0) + (k % 5).cast("double") + F.lit(0.52)
    cy = F.lit(LAT0) + _idiv(k, 5).cast("double") + F.lit(0.52)
    return px.select(
        F.col("label").alias("location_id"),
        F.col("vec_id").alias("scene_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("vec_id") * 3 % 2190).cast("int")).alias("fecha"),
        ((F.col("vec_id") * 7) % 40).cast("double").alias("cloud_cover"),
        (cx + ((i % 5) - 2) * F.lit(0.01)).alias("lon"),
        (cy + (_idiv(i, 5) - 2) * F.lit(0.01)).alias("lat"),
        ((F.col("vec_id") + i) % 8).cast("int").alias("scl"),
        F.element_at("embedding", i * 3 + 1).cast("double").alias("red"),
        F.element_at("embedding", i * 3 + 2).cast("double").alias("green"),
        F.element_at("embedding", i * 3 + 3).cast("double").alias("rededge1"),
    )


def raw_lab_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2-shaped lab rows (CSV text columns) from lineitem."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
    k = F.col("l_suppkey")
    code = F.when(F.col("l_returnflag") == "A", "TOTCOLI").when(F.col("l_returnflag") == "N", "ECOLI").otherwise("pH")
    return _with_text(li, _by_turns(F.col("l_orderkey"), _day_texts(F.to_date("l_shipdate"))), "Sample Date").select(
        F.concat(F.when(k % 9 == 4, F.lit("ARG")).otherwise(F.lit("URY")), F.lpad(k.cast("string"), 6, "0"))
        .alias("GEMS Station Number"),
        "Sample Date",
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lpad((F.col("l_linenumber") + 7).cast("string"), 2, "0"), F.lit(":30:00")))
        .alias("Sample Time"),
        code.alias("Parameter Code"),
        F.lit("M1").alias("Analysis Method Code"),
        F.lit(None).cast("string").alias("Value Flags"),
        F.when(F.col("l_tax") == 0, F.lit("no_numerico")).otherwise(F.col("l_quantity").cast("string")).alias("Value"),
        F.when(code == "pH", F.lit("---")).otherwise(F.lit(" mg/l ")).alias("Unit"),
        F.lit(" Good ").alias("Data Quality"),
        (F.col("l_linenumber") * 0.5).cast("string").alias("Depth"),
        F.lit("x").alias("Remark"),
    )


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5-shaped daily rain/temperature rows (one station per supplier)."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    return li.select(
        F.col("l_suppkey").alias("estacion"),
        F.to_date("l_shipdate").alias("fecha"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity") / 2).alias("temperaturaMaxima"),
        (F.col("l_tax") * 100).alias("temperaturaMinima"),
        (F.col("l_discount") * 100).alias("pluviometro"),
    )


def raw_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8-shaped watershed names in file order: brand name, missing when p_size is a multiple of 10."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("NOMBRE"),
        (F.col("p_size") % 5).alias("Cluster"),
        (F.col("p_retailprice") / 100).alias("A_pon_cuen"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("double")).otherwise(F.col("p_retailprice") / 1000).alias("Factor_K"),
    )


def raw_lab_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3-shaped station list: country from the supplier's nation (region AMERICA -> Uruguay)."""
    s = estaciones(spark, sf_dir)
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = s.join(su, s.estacion_id == su.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.concat(F.lit("URY"), F.lpad(F.col("estacion_id").cast("string"), 6, "0")).alias("GEMS Station Number"),
        F.when(F.col("n_regionkey") == 1, F.lit("Uruguay")).otherwise(F.col("n_name")).alias("Country Name"),
        F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"),
    )


# Catalogue datasets and the file-name stems used to build resources.
CATALOGUE_PACKAGES = [
    ("inia-anr-por-grilla", "inia_gras_anr_"),
    ("inia-pad-por-grilla", "inia_gras_pad_"),
    ("inia-ibh-por-grilla", "INIA_GRAS_IBH_"),
    ("inia-precipitacion-temps-extremas-lb", "ppt_tmax_tmin_lb_"),
    ("inia-precipitacion-temps-extremas-tyt", "ppt_tmax_tmin_tyt_"),
    ("inia-precipitacion-temps-extremas-sg", "ppt_tmax_tmin_xx_"),
    ("inia-precipitacion-temps-extremas-tb", "ppt_tmax_tmin_tb_"),
    ("inia-precipitacion-temps-extremas-le", "ppt_tmax_tmin_le_"),
    ("reclamos-comerciales", "solicitudes_y_reclamos-comerciales_"),
    ("calidad-de-agua", "calidad_bacteriologia_"),
    ("inumet-observaciones-meteorologicas-precipitacion-puntual-en-el-uruguay", "precipitacion_horaria_"),
    ("inumet-observaciones-meteorologicas-humedad-relativa-en-el-uruguay", "humedad_relativa_"),
]


def catalogue_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12-shaped resource manifest from ``pages``: one resource per page.

    package = page_id mod 12 into the dataset list, file = stem + year (2020 + page_id
    mod 10) + ".csv", format CSV except every fifth page (XLSX), hash = md5(html).
    """
    pg = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    pk = F.col("page_id") % len(CATALOGUE_PACKAGES)
    pkg, stem = None, None
    for i, (p, s) in enumerate(CATALOGUE_PACKAGES):
        pkg = F.when(pk == i, p) if pkg is None else pkg.when(pk == i, p)
        stem = F.when(pk == i, s) if stem is None else stem.when(pk == i, s)
    fname = F.concat(stem, (F.lit(2020) + F.col("page_id") % 10).cast("string"), F.lit("_"),
                     F.lpad((F.col("page_id") % 12 + 1).cast("string"), 2, "0"), F.lit(".csv"))
    return pg.select(
        F.col("page_id").cast("string").alias("resource_id"),
        pkg.alias("package"),
        F.concat(F.lit("Datos "), stem, F.lit(" precipitacion humedad bacteriologia")).alias("name"),
        F.when(F.col("page_id") % 5 == 0, F.lit("XLSX")).otherwise(F.lit("csv")).alias("format"),
        F.concat(F.regexp_extract("url", r"^(https?://[^/]+)", 1), F.lit("/dataset/"), fname).alias("url"),
        F.md5("html").alias("hash"),
    )


def file_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous sync state: resources of pages whose url has ``/en/``; the hash differs
    when the url carries a query string (a changed file)."""
    pg = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pg.filter(F.col("url").contains("/en/")).select(
        F.col("page_id").cast("string").alias("resource_id"),
        F.when(F.col("url").contains("?"), F.md5("url")).otherwise(F.md5("html")).alias("hash"),
    )
