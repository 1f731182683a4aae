"""File sources and sinks (SRC1-SRC9).

Readers declare schemas (messy columns as strings; cleaners coerce), read many
files in one scan and keep the file path as a column when an attribute lives in
the path. Single-document formats (a GeoJSON FeatureCollection, a JSON array) are
read with ``multiLine``; such a file is one task by nature, so writers here split
large collections into one document per partition.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caudal.functions.geometry import coordinates_json, parts_from_geojson, parts_of

LOG = logging.getLogger(__name__)

# The CSV dialects of the sources.
DIALECTS = {
    "semicolon_utf8": {"sep": ";", "encoding": "UTF-8"},
    "semicolon_latin1": {"sep": ";", "encoding": "ISO-8859-1"},
    "comma_iso88591": {"sep": ",", "encoding": "ISO-8859-1"},
    "comma": {"sep": ",", "encoding": "UTF-8"},
}


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, paths: str | list[str], columns: list[str] | StructType,
                   dialect: str = "comma", header: bool = True, with_path: bool = False,
                   skip_unreadable: bool = False, rejected: str | None = None) -> DataFrame:
    """SRC1: delimited scan with a dialect; malformed rows are kept with nulls (PERMISSIVE).

    ``rejected`` names a column for the whole line of a malformed row (fewer or more fields than columns, a value that is
    not of its column's type); null for the others. ``line_counts`` adds them up per file.

    A corrupt or vanished file ends the job. ``skip_unreadable`` leaves such files out instead;
    ``unread_files`` then tells which gave no row.
    """
    schema = columns if isinstance(columns, StructType) else string_schema(columns)
    if rejected:
        schema = StructType([*schema.fields, StructField(rejected, StringType(), True)])
    opts = dict(DIALECTS[dialect])
    r = (spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
         .option("sep", opts["sep"]).option("encoding", opts["encoding"])
         .option("ignoreMissingFiles", str(skip_unreadable).lower())
         .option("ignoreCorruptFiles", str(skip_unreadable).lower()))
    df = (r.option("columnNameOfCorruptRecord", rejected) if rejected else r).csv(paths)
    if with_path:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    if rejected:  # whether a line is malformed shows only when all its fields are read: no column is pruned below this
        df = df.select(F.inline(F.array(F.struct(*df.columns))))
    return df


def line_counts(rows: DataFrame, rejected: str, path_col: str = "source_file") -> DataFrame:
    """SRC1 / A04: lines of each file and how many of them were malformed. ``unread_files`` lists the files without any."""
    return rows.groupBy(path_col).agg(F.count(F.lit(1)).alias("filas"), F.count(rejected).alias("rechazadas"))


def split_rejected(rows: DataFrame, rejected: str) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows without the column, and the malformed lines (``rejected``, and the file if it is there)."""
    keep = [rejected, *(["source_file"] if "source_file" in rows.columns else [])]
    return rows.filter(F.col(rejected).isNull()).drop(rejected), rows.filter(F.col(rejected).isNotNull()).select(*keep)


def unread_files(spark: SparkSession, paths: str | list[str], rows: DataFrame, path_col: str = "source_file") -> DataFrame:
    """SRC1: listed files (path, length) of which ``rows`` has none: skipped as unreadable, or empty."""
    listed = spark.read.format("binaryFile").load(paths).select("path", "length")  # content is not read
    plain = F.regexp_replace(path_col, "^file:/+", "/")
    seen = rows.select(plain.alias("__p")).distinct()
    return listed.join(seen, F.regexp_replace("path", "^file:/+", "/") == F.col("__p"), "left_anti")


def read_many(spark: SparkSession, groups: list[tuple[str, list[str]]], dialect: str = "comma",
              attribute: str | None = None, pattern: str | None = None) -> DataFrame:
    """SRC2: several globs with differing columns -> one frame (missing columns null).

    ``groups`` is a list of (glob, columns). The attribute taken from the path is
    ``regexp_extract(file_path, pattern, 1)``. A glob that matches nothing is skipped and
    logged; each glob is one parallel scan.
    """
    frames = []
    for glob, cols in groups:
        try:
            df = read_delimited(spark, glob, cols, dialect, with_path=True)
            df.schema  # resolves the path listing (metadata only); a glob matching nothing raises here
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # the source's file is there: its failure is no reason to skip it
            LOG.warning("no input matches %s: skipped", glob)
            continue
        frames.append(df)
    if not frames:
        raise FileNotFoundError(f"no input matched {[g for g, _ in groups]}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if attribute and pattern:
        out = out.withColumn(attribute, F.regexp_extract("source_file", pattern, 1))
    return out


GEOMETRY_SCHEMA = "struct<type:string, coordinates:string>"


def _line_from_geojson(gtype: Column, coords_json: Column) -> Column:
    line = F.from_json(coords_json, "array<array<double>>")
    return F.when(gtype == "LineString", F.transform(line, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))


def read_geojson_collection(spark: SparkSession, path: str, properties: list[str]) -> DataFrame:
    """SRC3: FeatureCollection -> one row per feature: properties, type, parts (polygons with their holes), all rings in
    one list, line coords.

    ``pos`` is the feature's position in its file (for order-dependent rules).
    """
    schema = (f"type string, features array<struct<type:string, properties:struct<"
              f"{', '.join(f'`{p}`:string' for p in properties)}>, geometry:struct<type:string, coordinates:string>>>")
    raw = spark.read.schema(schema).option("multiLine", "true").json(path).withColumn(
        "source_file", F.col("_metadata.file_path"))
    f = raw.select("source_file", F.posexplode("features").alias("pos", "f"))
    return _features(f, properties)


def _features(f: DataFrame, properties: list[str]) -> DataFrame:
    g = F.col("f.geometry")
    return f.select(
        "source_file", "pos", *[F.col(f"f.properties.`{p}`").alias(p) for p in properties],
        g["type"].alias("gtype"),
        parts_from_geojson(g["type"], g["coordinates"]).alias("parts"),
        F.flatten(parts_from_geojson(g["type"], g["coordinates"])).alias("rings"),
        _line_from_geojson(g["type"], g["coordinates"]).alias("coords"),
    )


def read_geojson_lines(spark: SparkSession, path: str, properties: list[str]) -> DataFrame:
    """SRC4: newline-delimited GeoJSON features (splittable, parallel)."""
    schema = (f"type string, properties struct<{', '.join(f'`{p}`:string' for p in properties)}>, "
              f"geometry struct<type:string, coordinates:string>")
    raw = spark.read.schema(schema).json(path).withColumn("source_file", F.col("_metadata.file_path"))
    f = raw.select("source_file", F.monotonically_increasing_id().alias("pos"), F.struct("*").alias("f"))
    return _features(f, properties)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC5: files each holding a JSON array of records."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_sidecar_coords(spark: SparkSession, glob: str) -> DataFrame:
    """SRC6: per-station ``lon, lat`` text files (note the order) -> (estacion, lat, lon).

    The station is the name of the file's parent directory (a ``key=value`` folder
    name gives its value).
    """
    t = spark.read.option("wholetext", "true").text(glob).withColumn("p", F.col("_metadata.file_path"))
    parent = F.element_at(F.split("p", "/"), -2)
    station = F.regexp_replace(parent, r"^[^=]*=", "")
    parts = F.split(F.trim("value"), ",")
    return t.select(F.url_decode(station).alias("estacion"),
                    F.trim(parts.getItem(1)).cast("double").alias("lat"),
                    F.trim(parts.getItem(0)).cast("double").alias("lon"))


def read_code_file_map(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: JSON object code -> list of files; the first file of each list is used."""
    m = spark.read.option("multiLine", "true").option("primitivesAsString", "true").json(path)
    entries = F.array(*[F.struct(F.lit(c).alias("code"), F.col(f"`{c}`").alias("files")) for c in m.columns])
    return m.select(F.explode(entries).alias("e")).select(
        F.col("e.code").alias("code"), F.element_at("e.files", 1).alias("file"))


def write_report_csv(df: DataFrame, path: str) -> None:
    """SRC8: report/series export with a header row."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_facts(df: DataFrame, path: str, partition_by: list[str], mode: str = "append",
                sort_within: list[str] | None = None) -> None:
    """SRC9: measurement-table sink: Parquet partitioned for pruning (e.g. code, year),
    rows clustered inside files for row-group statistics."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


#: Records in one JSON document: what a task holds as one string.
DOCUMENT_RECORDS = 10_000


def _documents(records: DataFrame, head: str, tail: str, per_document: int) -> DataFrame:
    """JSON texts (column ``j``) joined to documents of at most ``per_document`` records of one partition."""
    place = F.monotonically_increasing_id()  # partition in the upper bits, row in the lower 33
    rows = records.withColumn("__d", place - F.pmod(F.pmod(place, F.lit(1 << 33)), F.lit(per_document)))
    return rows.groupBy("__d").agg(F.concat(F.lit(head), F.concat_ws(",", F.collect_list("j")), F.lit(tail)).alias("value")).select("value")


def write_json_arrays(df: DataFrame, path: str, per_document: int = DOCUMENT_RECORDS) -> None:
    """Write records as JSON arrays of bounded length, one per file (parallel writers)."""
    recs = df.select(F.to_json(F.struct("*")).alias("j"))
    _documents(recs, "[", "]", per_document).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def _feature_text(features: DataFrame, properties: list[str], geometry: str | None) -> Column:
    """A GeoJSON feature from (props..., gtype, geometry); ``geometry`` names a column of parts or rings."""
    column = geometry or ("parts" if "parts" in features.columns else "rings")
    return F.concat(
        F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*[F.col(p) for p in properties])),
        F.lit(',"geometry":{"type":"'), F.col("gtype"), F.lit('","coordinates":'),
        coordinates_json(parts_of(features, column, "gtype"), F.col("gtype")), F.lit("}}"))


def write_feature_collections(features: DataFrame, path: str, properties: list[str], per_document: int = DOCUMENT_RECORDS,
                              geometry: str | None = None) -> None:
    """Write GeoJSON FeatureCollections of bounded length from (props..., gtype, parts or rings), one per file."""
    records = features.select(_feature_text(features, properties, geometry).alias("j"))
    _documents(records, '{"type":"FeatureCollection","features":[', "]}", per_document).write.mode(
        "overwrite").option("maxRecordsPerFile", 1).text(path)


def write_feature_lines(features: DataFrame, path: str, properties: list[str], geometry: str | None = None) -> None:
    """Write newline-delimited GeoJSON features."""
    features.select(_feature_text(features, properties, geometry).alias("value")).write.mode("overwrite").text(path)
