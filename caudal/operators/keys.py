"""Document builders and natural keys (KEY2, KEY3, KEY5); KEY1 is ``functions.ids.stable_id``
and KEY4 is ``operators.soil.grid_registry``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.geometry import parts_of
from caudal.functions.ids import stable_id, widen_floats

# Natural key column order per fact table (KEY5). Literal parts are written as
# ("lit", value). Order matters: it is part of the id.
NATURAL_KEYS: dict[str, list] = {
    "oseparam": ["departamento_id", "code", "fecha_inicio", "fecha_fin", "value_cat", "granularidad",
                 "id_muestra_m"],
    "gemsparams": ["location_id", "code", "fecha_inicio", "fecha_fin", "value", "unit", "data_quality", "depth",
                   "granularidad"],
    "puntomedicion": ["punto_id", "valor", "tipo", "fecha_inicio", "fecha_fin", ("lit", "PERIODO")],
    "paraminumet": ["location_id", "fecha", "code", "granularidad"],
    "registrotempprec": ["location_id", "fecha_inicio", "fecha_fin", "temperatura_maxima", "temperatura_minima",
                         "pluviometro", "granularidad"],
    "reclamosose": ["departamento_id", "tipo_reclamo", "region", "fecha_inicio", "fecha_fin",
                    "id_reclamo_comercial_m"],
    "sentinel_params": ["location_id", "code", "fecha", "fecha", "valor", ("lit", "DIA")],
    "erosion_cuenca": ["area_id", "ponderacion", "cluster"],
    "erosion_suelos": ["area_id", "grupo", "perfil", "factor_k", "taxonomia"],
    "departamentos": ["nombre", "codigo"],
}


def _part(p) -> Column:
    if isinstance(p, tuple) and p[0] == "lit":
        return F.lit(p[1])
    return F.col(p)


def with_natural_id(df: DataFrame, table: str, out: str = "id") -> DataFrame:
    """KEY5: attach the deterministic id of a fact row from its table's natural key."""
    parts = NATURAL_KEYS[table]
    cols = [p for p in parts if isinstance(p, str)]
    d = widen_floats(df, [c for c in dict.fromkeys(cols) if c in df.columns])
    return d.withColumn(out, stable_id(*[_part(p) for p in parts]))


def station_docs(df: DataFrame, name: str = "nombre", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """KEY2: point documents: id from (nombre, lat, lon); coordinates in [lon, lat] order."""
    return df.select(
        stable_id(name, lat, lon).alias("id"), F.col(name).alias("nombre"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")).alias("location"),
        F.col(lon).alias("lon"), F.col(lat).alias("lat"))


def _num_text(v: Column) -> Column:
    """Coordinate text as a WKT writer prints it: integral values without a decimal part."""
    return F.when(v == F.floor(v), F.floor(v).cast("long").cast("string")).otherwise(v.cast("string"))


def geometry_wkt(parts: Column, gtype: Column | None = None) -> Column:
    """Canonical text of a geometry: ``POLYGON ((x y, ...), (hole), ...)`` of its one part, or, of type MultiPolygon,
    ``MULTIPOLYGON (((x y, ...), (hole)), ((...)))``."""
    def ring(r):
        return F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat(_num_text(p["lon"]), F.lit(" "), _num_text(p["lat"]))), ", "), F.lit(")"))

    texts = F.transform(parts, lambda rings: F.concat(F.lit("("), F.array_join(F.transform(rings, ring), ", "), F.lit(")")))
    one = F.concat(F.lit("POLYGON "), F.element_at(texts, 1))
    if gtype is None:
        return one
    return F.when(gtype == "MultiPolygon", F.concat(F.lit("MULTIPOLYGON ("), F.array_join(texts, ", "), F.lit(")"))).otherwise(one)


def polygon_wkt(rings: Column, gtype: Column | None = None) -> Column:
    """``geometry_wkt`` of a list of rings: one polygon, or, of type MultiPolygon, the outer ring of each part."""
    one = F.array(rings)
    parts = one if gtype is None else F.when(gtype == "MultiPolygon", F.transform(rings, lambda r: F.array(r))).otherwise(one)
    return geometry_wkt(parts, gtype)


def area_docs(df: DataFrame, geometry: str = "rings", name: str = "nombre", gtype: str | None = None) -> DataFrame:
    """KEY3: area documents: id from (geometry text, name or None); ``SIN_NOMBRE`` default applied after the id.

    ``geometry`` names a column of parts (polygons with their holes) or of rings, ``gtype`` one with the geometry type;
    polygons without one.
    """
    geom = geometry_wkt(parts_of(df, geometry, gtype), F.col(gtype) if gtype else None)
    nm = F.when(F.col(name).isNull() | (F.col(name) == ""), F.lit(None).cast("string")).otherwise(F.col(name))
    return df.select(stable_id(geom, nm).alias("id"),
                     F.coalesce(nm, F.lit("SIN_NOMBRE")).alias("nombre"), F.col(geometry))
