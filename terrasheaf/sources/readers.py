"""File readers.  Each has a ``parse_`` twin that works on rows already read.

Text files are split by Spark, so the input ordinal is carried as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.geo import TILE_DEGREES, tile_bounds

_SOURCE = "struct<provider:string,resource:string,dataset:string,record_id:string,recordId:string,version:string,confidence:string>"
_ADDRESS = "struct<freeform:string,postcode:string,locality:string,region:string,country:string>"
FEATURE_SCHEMA = (
    "struct<id:string,properties:struct<id:string,names:struct<primary:string>,"
    f"addresses:array<{_ADDRESS}>,confidence:string,operating_status:string,basic_category:string,"
    "taxonomy:struct<primary:string,hierarchy:array<string>,alternates:array<string>>,"
    "categories:struct<primary:string,alternate:array<string>>,"
    f"sources:array<{_SOURCE}>>,geometry:struct<type:string,coordinates:array<string>>>"
)
ROAD_SCHEMA = (
    "struct<id:string,properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<double>>>>"
)
EDGE_FIELDS = (
    "graphId:bigint,wayId:bigint,lat:double,lon:double,innerLat:double,innerLon:double,"
    "forwardAccess:bigint,reverseAccess:bigint,roadClass:int,use:int,toll:boolean,tunnel:boolean,unpaved:boolean"
)
SCAN_SCHEMA = (
    "struct<index:int,minLat:double,maxLat:double,minLon:double,maxLon:double,complete:boolean,truncated:boolean,"
    f"maxResults:int,visitedTiles:bigint,visitedNodes:bigint,returned:bigint,edges:array<struct<{EDGE_FIELDS}>>>"
)
ADJACENCY_SCHEMA = (
    "struct<sourceGraphId:bigint,endLat:double,endLon:double,endNodeGraphId:bigint,deadend:boolean,notThru:boolean,"
    "forward:boolean,wayId:bigint,forwardAccess:bigint,reverseAccess:bigint,opposingGraphId:bigint,nativeOutgoingDegree:int,"
    "outgoingDirectedEdges:array<struct<graphId:bigint,endNodeGraphId:bigint,forwardAccess:bigint,isRoad:boolean,"
    "isShortcut:boolean,autoBit:boolean,motorcycleBit:boolean>>>"
)
REGION_SCHEMA = (
    "struct<properties:struct<id:string,parent:string,name:string,urls:struct<pbf:string>,`iso3166-1:alpha2`:array<string>>,"
    "geometry:string>"
)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``file``, ``ord`` and ``line``.

    The ordinal is file number, byte offset of the split and row packed in one
    long.  It grows along each file, because a row takes at least one byte; files
    follow each other by name.  Only file names pass through the driver.
    """
    lines = spark.read.text(path)
    names = spark.createDataFrame(list(enumerate(sorted(lines.inputFiles()))) or [(0, "")], "file_no long, file string")
    # Local paths are written with one slash by the scan and with three by the listing.
    names = names.withColumn("file", F.regexp_replace("file", "^file:/+", "file:/"))
    rows = lines.select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
        F.col("value").alias("line"),
    )
    ordinal = F.shiftleft("file_no", 42) + F.col("start") + F.col("row")
    return rows.join(names, "file").select("file", ordinal.alias("ord"), "line")


def parse_place_features(lines: DataFrame) -> DataFrame:
    """Place features from JSON lines; a line that is no such object is marked broken."""
    full = lines.filter(F.trim("line") != "").withColumn("f", F.from_json(F.trim("line"), FEATURE_SCHEMA))
    broken = F.coalesce("f.id", F.to_json("f.properties"), F.to_json("f.geometry")).isNull()
    return full.select("ord", "f.id", "f.properties", "f.geometry", broken.alias("broken"))


def read_place_features(spark: SparkSession, path: str) -> DataFrame:
    return parse_place_features(text_lines(spark, path))


def way_id(feature_id: Column, props: Column) -> Column:
    """Way id from a number, ``w123`` or the attributes ``@id`` and ``id``."""

    def number(text: Column) -> Column:
        digits = F.regexp_extract(text, "^w?([0-9]+)$", 1)
        value = F.when(digits != "", digits.try_cast("bigint"))
        return F.when(value > 0, value)

    attribute = F.coalesce(F.nullif(F.try_element_at(props, F.lit("@id")), F.lit("")), F.try_element_at(props, F.lit("id")))
    return F.coalesce(number(feature_id), number(attribute))


def parse_road_features(lines: DataFrame) -> DataFrame:
    """Road lines from a GeoJSON sequence: way_id, tags, shape and class."""
    text = F.trim(F.regexp_replace("line", "^\\x1e+", ""))
    f = lines.filter(text != "").select("ord", F.from_json(text, ROAD_SCHEMA).alias("f"))
    shape = F.transform("f.geometry.coordinates", lambda p: F.struct(F.get(p, F.lit(1)).alias("lat"), F.get(p, F.lit(0)).alias("lon")))
    rows = f.filter((F.col("f.geometry.type") == "LineString") & (F.size("f.geometry.coordinates") > 0)).select(
        "ord",
        way_id(F.col("f.id"), F.col("f.properties")).alias("way_id"),
        F.coalesce(F.try_element_at(F.col("f.properties"), F.lit("highway")), F.lit("")).alias("highway"),
        F.col("f.properties").alias("tags"),
        shape.alias("shape"),
    )
    return rows.filter(F.col("way_id").isNotNull())


def read_road_features(spark: SparkSession, path: str) -> DataFrame:
    return parse_road_features(text_lines(spark, path))


def parse_edge_scan(documents: DataFrame) -> DataFrame:
    """(window, edge) rows from one scan document per row in column ``line``.

    A window without edges, or a document that cannot be parsed, is one row with null edge columns.
    """
    d = documents.select(F.from_json("line", SCAN_SCHEMA).alias("d")).select("d.*")
    whole = F.coalesce(F.col("complete") & ~F.col("truncated") & F.col("maxResults").isNull() & (F.col("returned") == F.size("edges")), F.lit(False))
    names = {"graphId": "graph_id", "wayId": "way_id", "innerLat": "inner_lat", "innerLon": "inner_lon", "forwardAccess": "forward_access",
             "reverseAccess": "reverse_access", "roadClass": "road_class", "use": "road_use"}
    rows = d.select(F.col("index").alias("window_index"), whole.alias("whole"), "visitedTiles", F.explode_outer("edges").alias("e"))
    return rows.select("window_index", "whole", F.col("visitedTiles").alias("visited_tiles"), "e.*").withColumnsRenamed(names)


def read_edge_scan(spark: SparkSession, path: str) -> DataFrame:
    return parse_edge_scan(spark.read.text(path, wholetext=True).select(F.col("value").alias("line")))


def parse_adjacency(lines: DataFrame) -> DataFrame:
    """Adjacency rows from JSON lines, in the column names of the graph operators."""
    d = lines.filter(F.trim("line") != "").select(F.from_json("line", ADJACENCY_SCHEMA).alias("d")).select("d.*")
    outgoing = F.transform(
        "outgoingDirectedEdges",
        lambda o: F.struct(
            o["graphId"].alias("graph_id"), o["endNodeGraphId"].alias("end_node"), o["forwardAccess"].alias("forward_access"),
            o["isRoad"].alias("is_road"), o["isShortcut"].alias("is_shortcut"),
        ),
    )
    return d.select(
        F.col("sourceGraphId").alias("source_id"), F.col("endNodeGraphId").alias("end_node"), F.col("opposingGraphId").alias("opposing_id"), "deadend",
        F.col("wayId").alias("way_id"), F.col("forwardAccess").alias("forward_access"), F.col("reverseAccess").alias("reverse_access"),
        F.col("endLat").alias("end_lat"), F.col("endLon").alias("end_lon"), F.col("nativeOutgoingDegree").alias("out_degree"), outgoing.alias("outgoing"),
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return parse_adjacency(spark.read.text(path).select(F.col("value").alias("line")))


def parse_polygons(lines: DataFrame) -> DataFrame:
    """Ring segments from polygon text: file, ord and line in; segments out.

    A file is a name line, then rings: a label (``!`` marks a hole), vertices,
    END.  Rings are closed when open; rings under three vertices drop out.  The
    windows run inside one polygon file, whose size is that of one outline.
    """
    flow = Window.partitionBy("file").orderBy("ord")
    text = F.trim("line")
    parts = F.split(text, r"\s+")
    rows = lines.select("file", "ord", text.alias("t"), F.get(parts, F.lit(0)).try_cast("double").alias("lon"), F.get(parts, F.lit(1)).try_cast("double").alias("lat"))
    rows = rows.withColumn("n", F.row_number().over(flow)).filter((F.col("n") > 1) & (F.col("t") != ""))
    rows = rows.withColumn("before", F.lag("t").over(flow))
    head = ((F.col("before").isNull()) | (F.col("before") == "END")) & (F.col("t") != "END")
    rows = rows.withColumn("head", head).withColumn("ring_no", F.sum(F.col("head").cast("int")).over(flow))
    rows = rows.withColumn("label", F.max(F.when(F.col("head"), F.col("t"))).over(Window.partitionBy("file", "ring_no")))
    points = rows.filter(~F.col("head") & (F.col("t") != "END") & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    ring = Window.partitionBy("file", "ring_no").orderBy("ord")
    whole = Window.partitionBy("file", "ring_no")
    first = F.min_by(F.struct("lon", "lat"), F.col("ord")).over(whole)
    points = points.withColumns(
        {"seq": F.row_number().over(ring) - 1, "size": F.count(F.lit(1)).over(whole), "first": first, "next": F.lead(F.struct("lon", "lat")).over(ring)}
    )
    points = points.filter(F.col("size") >= 3).withColumn("to", F.coalesce("next", "first"))
    out = points.select(
        F.col("file").alias("region_id"), (F.col("ring_no") - 1).cast("int").alias("ring_no"), F.startswith("label", F.lit("!")).alias("is_hole"), F.col("seq").cast("int").alias("seq"),
        F.col("lon").alias("ax"), F.col("lat").alias("ay"), F.col("to.lon").alias("ex"), F.col("to.lat").alias("ey"),
    )
    return out.filter((F.col("ax") != F.col("ex")) | (F.col("ay") != F.col("ey")))


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    return parse_polygons(text_lines(spark, path))


def parse_region_index(documents: DataFrame) -> DataFrame:
    """Region nodes from catalogue documents in column ``line``."""
    f = documents.select(F.explode(F.from_json("line", f"struct<features:array<{REGION_SCHEMA}>>")["features"]).alias("f"))
    props = F.col("f.properties")
    empty = F.coalesce(F.regexp_replace(F.col("f.geometry"), r"[^0-9]", ""), F.lit("")) == ""
    return f.select(
        F.trim(props["id"]).alias("id"),
        F.coalesce(F.trim(props["parent"]), F.lit("")).alias("parent"),
        props["name"].alias("name"),
        F.coalesce(props["urls"]["pbf"], F.lit("")).alias("url"),
        F.get(props["iso3166-1:alpha2"], F.lit(0)).alias("iso"),
        empty.alias("empty_geometry"),
    ).filter(F.col("id") != "")


def read_region_index(spark: SparkSession, path: str) -> DataFrame:
    return parse_region_index(spark.read.text(path, wholetext=True).select(F.col("value").alias("line")))


def inventory_documents(files: DataFrame, markers: list[str], arrays: list[str], max_bytes: int) -> DataFrame:
    """Known documents among files: marker, version, bytes, digest, array lengths.

    files: path, content (binary).  ``state`` is MATCH, OTHER or INVALID; every
    file is parsed, ``oversize`` only tells those above ``max_bytes``.
    """
    size = F.octet_length("content")
    text = F.decode("content", "UTF-8")
    doc = files.withColumns({"bytes": size, "sha256": F.sha2("content", 256), "j": F.try_parse_json(text)})
    marker = F.try_variant_get("j", "$.schema", "string")
    lengths = F.map_from_entries(
        F.array_compact(
            F.array(
                *[
                    F.when(n.isNotNull(), F.struct(F.lit(a).alias("key"), n.alias("value")))
                    for a in arrays
                    for n in [F.size(F.try_variant_get("j", f"$.{a}", "array<variant>"))]
                ]
            )
        )
    )
    state = F.when(F.col("j").isNull(), "INVALID").when(marker.isin(markers), "MATCH").otherwise("OTHER")
    return doc.select(
        "path", state.alias("state"), marker.alias("marker"), F.try_variant_get("j", "$.version", "int").alias("version"), "bytes", (F.col("bytes") > max_bytes).alias("oversize"), "sha256", lengths.alias("array_lengths")
    )


def artifact_inventory(spark: SparkSession, path: str, markers: list[str], arrays: list[str], max_bytes: int = 25 * 1024 * 1024) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path)
    return inventory_documents(files.select("path", "content"), markers, arrays, max_bytes)


def literal_mentions(files: DataFrame, words: list[str]) -> DataFrame:
    """Number of files that mention each literal, and the counters of the screening.

    files: path, text (null where it cannot be read).  ``words`` is the short
    fixed list of the audit; all are tested in the scan itself, on whole texts, so
    files are neither copied nor joined.  Counters: files checked, matching any
    literal, unreadable, and binary (a zero byte stands in the text).
    """
    found = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(w)), F.lit(w)) for w in words]))
    marks = F.array_compact(
        F.array(
            F.lit("(checked)"),
            F.when(F.size(found) > 0, "(matching)"),
            F.when(F.col("text").isNull(), "(unreadable)"),
            F.when(F.contains("text", F.lit("\0")), "(binary)"),
        )
    )
    rows = files.select(F.explode(F.concat(F.coalesce(found, F.array().cast("array<string>")), marks)).alias("literal"))
    return rows.groupBy("literal").agg(F.count(F.lit(1)).alias("files"))


def tile_files(files: DataFrame, root: str) -> DataFrame:
    """Level, index, bounds and digest of tile files below ``root``.

    files: path, content.  A path that names no tile of a known level is dropped
    to ``problem`` rows rather than failing the job.
    """
    rel = F.regexp_replace("path", f"^.*?{root.rstrip('/')}/", "")
    rows = files.select(rel.alias("path"), F.sha2("content", 256).alias("sha256"))
    rows = rows.withColumns(
        {
            "level": F.regexp_extract("path", r"^([0-9])/", 1).try_cast("int"),
            "tile_index": F.regexp_replace(F.regexp_extract("path", r"^[0-9]/([0-9/]+)\.gph$", 1), "/", "").try_cast("bigint"),
        }
    )
    known = F.coalesce(F.col("level").isin(list(TILE_DEGREES)) & F.col("tile_index").isNotNull(), F.lit(False))
    rows = rows.withColumn("b", tile_bounds(F.col("level"), F.col("tile_index")))
    return rows.select("path", "level", "tile_index", "sha256", "b.*", F.when(~known, "unsupported_path").alias("problem"))


def tile_file_inventory(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gph").load(root)
    return tile_files(files.select("path", "content"), root)
