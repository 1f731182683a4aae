"""DuckDB twins of the surrogate tables (see ``surrogates.py`` for the rules).

Each constant is a CTE body over the driver tables; ``with_ctes`` assembles the
ones a query needs. These are independent re-statements of the rules in plain
SQL, used only as the correctness oracle.
"""

from __future__ import annotations

CTES: dict[str, str] = {}

CTES["deptos"] = """
  SELECT n_nationkey AS departamento_id, n_name AS nombre,
         CASE WHEN n_nationkey % 7 = 6 THEN 3 ELSE n_nationkey % 3 END AS shape,
         CAST(-58.4 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) AS x0,
         CAST(-35.0 AS DOUBLE) + CAST(n_nationkey // 5 AS DOUBLE) AS y0
  FROM nation"""

CTES["estaciones"] = """
  SELECT s_suppkey AS estacion_id, s_name AS nombre,
         CAST(-58.4 AS DOUBLE) + ((s_suppkey * 37) % 500) / 100 + 0.003 AS lon,
         CAST(-35.0 AS DOUBLE) + ((s_suppkey * 53) % 500) / 100 + 0.0041 AS lat
  FROM supplier"""

# Closed forms of the four department shapes (strict inequalities; no station or
# grid point lies on an edge).
CTES["station_depto"] = """
  SELECT e.estacion_id, d.departamento_id, d.nombre
  FROM estaciones e JOIN deptos d ON (
       (d.shape = 0 AND e.lon > d.x0 + 0.1 AND e.lon < d.x0 + 1.2 AND e.lat > d.y0 + 0.1 AND e.lat < d.y0 + 0.9)
    OR (d.shape = 1 AND abs(e.lon - (d.x0 + 0.5)) + abs(e.lat - (d.y0 + 0.5)) < 0.45)
    OR (d.shape = 2 AND ((e.lon > d.x0 + 0.1 AND e.lon < d.x0 + 0.5 AND e.lat > d.y0 + 0.1 AND e.lat < d.y0 + 0.9)
                      OR (e.lon >= d.x0 + 0.5 AND e.lon < d.x0 + 0.9 AND e.lat > d.y0 + 0.1 AND e.lat < d.y0 + 0.5)))
    OR (d.shape = 3 AND e.lon > d.x0 + 0.72 AND e.lon < d.x0 + 0.8 AND e.lat > d.y0 + 0.72 AND e.lat < d.y0 + 0.8))"""

CTES["oseparam"] = """
  SELECT s.s_nationkey AS departamento_id,
         CASE WHEN l.l_linestatus = 'F' THEN 'COLIFORMES TOTALES' ELSE 'COLIFORMES FECALES' END AS code,
         CAST(date_trunc('quarter', l.l_shipdate) AS TIMESTAMP) AS fecha_inicio,
         CASE WHEN l.l_returnflag = 'R' THEN 'Presencia' WHEN l.l_returnflag = 'A' THEN 'Ausencia'
              WHEN l.l_linenumber % 3 = 1 THEN NULL ELSE 'Indeterminado' END AS value_cat
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE NOT (l.l_returnflag = 'N' AND l.l_linenumber % 3 = 0)"""

CTES["reclamos"] = """
  SELECT c.c_nationkey AS departamento_id, o.o_orderpriority AS tipo_reclamo, o.o_orderdate AS fecha_inicio
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

CTES["gems"] = """
  SELECT l_suppkey AS location_id,
         CASE l_returnflag WHEN 'A' THEN 'TOTCOLI' WHEN 'N' THEN 'ECOLI' ELSE 'PH' END AS code,
         l_shipdate AS fecha_inicio,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS value
  FROM lineitem"""

CTES["registro"] = """
  SELECT l_suppkey AS location_id, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 9 HOUR AS fecha_inicio,
         l_discount * 100 AS pluviometro
  FROM lineitem"""

CTES["grid"] = """
  SELECT CAST(-58.4 AS DOUBLE) + (l_partkey % 16) / 3 AS lon,
         CAST(-35.0 AS DOUBLE) + ((l_partkey // 16) % 16) / 3 AS lat,
         l_discount * 100 AS value,
         CASE l_returnflag WHEN 'A' THEN 'IBH' WHEN 'N' THEN 'PAD' ELSE 'ANR' END AS type,
         make_date(year(l_shipdate), month(l_shipdate),
                   CASE WHEN day(l_shipdate) <= 10 THEN 1 WHEN day(l_shipdate) <= 20 THEN 11 ELSE 21 END) AS fecha_inicio
  FROM lineitem"""

CTES["grid_points"] = """
  SELECT DISTINCT CAST(-58.4 AS DOUBLE) + (p_partkey % 16) / 3 AS lon,
         CAST(-35.0 AS DOUBLE) + ((p_partkey // 16) % 16) / 3 AS lat
  FROM part"""

CTES["ndci_loc"] = """
  SELECT n_nationkey AS location_id, 'Laguna ' || n_name AS nombre,
         CAST(-58.4 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) + 0.52 AS lon,
         CAST(-35.0 AS DOUBLE) + CAST(n_nationkey // 5 AS DOUBLE) + 0.52 AS lat
  FROM nation"""

CTES["sentinel"] = """
  SELECT s.s_nationkey AS location_id,
         CASE WHEN l.l_linestatus = 'F' THEN 'NDCI' ELSE 'NDTI' END AS code,
         CAST(l.l_shipdate AS DATE) AS fecha_inicio,
         (l.l_tax - l.l_discount) / (l.l_tax + l.l_discount) AS value
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_tax + l.l_discount <> 0"""

# Dependencies between CTEs, so a query lists only what it reads directly.
DEPS = {
    "station_depto": ["estaciones", "deptos"],
}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    if not parts:
        b = body.lstrip()
        return "WITH " + b.lstrip(",").lstrip() if b.startswith(",") else body
    return f"WITH {parts}\n{body}"


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Same formula and radius as ``caudal.functions.geometry.haversine_m``."""
    return (f"(2 * 6378100.0 * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")
