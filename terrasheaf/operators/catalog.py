"""Region catalogue, source choice, object versions, releases and layer classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

# Containers that are not part of a canonical region path.
ROOT_CONTAINERS = ["africa", "asia", "australia-oceania", "central-america", "europe", "north-america", "south-america"]

# First zoom of each road class.
ROAD_MIN_ZOOM = {
    "motorway": 4, "trunk": 5, "primary": 7, "secondary": 9,
    "motorway_link": 9, "trunk_link": 9, "primary_link": 10, "secondary_link": 10,
    "tertiary": 11, "tertiary_link": 11,
    "unclassified": 12, "residential": 12, "road": 12, "living_street": 12,
    "service": 13, "track": 13,
}
MINOR_ROADS = ["unclassified", "residential", "road", "living_street"]


def climb(nodes: DataFrame) -> DataFrame:
    """Add ``path`` (own id first, then its ancestors) and ``iso_path``.

    nodes: id, parent, iso.  A parent that is not listed still ends the path; a
    cycle stops at the first repeated id.  One left join per level, until no
    region has a level above; lineage is cut after each.
    """
    parents = nodes.select(F.col("id").alias("_pid"), F.col("parent").alias("_pparent"), F.col("iso").alias("_piso"))
    out = nodes.withColumns({"_next": F.nullif(F.trim("parent"), F.lit("")), "path": F.array("id"), "iso_path": F.array("iso")})
    while not out.filter(F.col("_next").isNotNull()).isEmpty():
        out = out.join(parents, F.col("_next") == F.col("_pid"), "left").withColumns(
            {
                "path": F.when(F.col("_next").isNotNull(), F.concat("path", F.array("_next"))).otherwise(F.col("path")),
                "iso_path": F.when(F.col("_next").isNotNull(), F.concat("iso_path", F.array("_piso"))).otherwise(F.col("iso_path")),
                "_up": F.nullif(F.trim("_pparent"), F.lit("")),
            }
        )
        seen = F.array_contains("path", F.col("_up"))
        out = cut_lineage(out.withColumn("_next", F.when(~seen, F.col("_up"))).drop("_pid", "_pparent", "_piso", "_up"))
    return out.drop("_next")


def region_ancestry(nodes: DataFrame) -> DataFrame:
    """Canonical path id, country ancestor and ISO code of each region."""
    up = climb(nodes)
    down = F.reverse("path")
    drop = (F.size(down) > 1) & F.element_at(down, 1).isin(ROOT_CONTAINERS)
    parts = F.when(drop, F.slice(down, F.lit(2), F.size(down))).otherwise(down)
    step = F.filter(
        F.transform("iso_path", lambda x, i: F.struct(i.alias("i"), x.alias("iso"))), lambda s: s["iso"].isNotNull() & (F.trim(s["iso"]) != "")
    )
    first = F.get(step, F.lit(0))
    code = F.get(F.filter(step, lambda s: s["iso"].rlike("^[A-Za-z]{2}$")), F.lit(0))["iso"]
    return up.select(
        "id", F.array_join(parts, "/").alias("canonical_id"), F.get("path", first["i"]).alias("country_id"), F.upper(code).alias("country_iso")
    )


def leaf_regions(nodes: DataFrame) -> DataFrame:
    """Downloadable regions without a downloadable descendant.  nodes: also ``url``."""
    has_url = F.coalesce(F.trim("url"), F.lit("")) != ""
    above = climb(nodes).filter(has_url).select(F.explode(F.slice("path", F.lit(2), F.size("path"))).alias("id"))
    return nodes.filter(has_url).join(above.distinct(), "id", "left_anti")


def source_cover(cells: DataFrame, primary: str = "primary") -> DataFrame:
    """Greedy cover in fixed order: which sources add cells of their own.

    cells: region_id, source_id, size_order, is_primary, cy, cx.  A skipped source
    adds nothing, so a source is kept exactly when it is first on some cell.
    """
    order = F.struct((~F.col("is_primary")).cast("int").alias("p"), F.col("size_order").alias("o"), F.col("source_id").alias("s"))
    first = cells.groupBy("region_id", "cy", "cx").agg(F.min(order).alias("f"))
    own = first.groupBy("region_id", F.col("f.s").alias("source_id")).agg(F.count(F.lit(1)).alias("own_cells"))
    sources = cells.select("region_id", "source_id", "is_primary").distinct()
    out = sources.join(own, ["region_id", "source_id"], "left").withColumn("own_cells", F.coalesce("own_cells", F.lit(0)))
    return out.withColumn("selected", F.col("is_primary") | (F.col("own_cells") > 0))


def source_preview(leaves: DataFrame, buffer: DataFrame) -> DataFrame:
    """Leaf regions that meet each buffer with their overlap in cells.

    leaves: source_id, cy, cx.  buffer: region_id, primary_id, cy, cx.
    """
    hit = leaves.join(buffer, ["cy", "cx"]).groupBy("region_id", "primary_id", "source_id").agg(F.count(F.lit(1)).alias("overlap_cells"))
    out = hit.withColumn("is_primary", F.col("source_id") == F.col("primary_id")).drop("primary_id")
    return out


def latest_versions(objects: DataFrame) -> DataFrame:
    """Current state of each (type, id); deleted objects drop out."""
    cols = [c for c in objects.columns if c not in ("type", "id")]
    last = objects.groupBy("type", "id").agg(F.max_by(F.struct(*cols), F.struct("version", "timestamp")).alias("r"))
    return last.select("type", "id", *[F.col(f"r.{c}").alias(c) for c in cols]).filter(F.coalesce("visible", F.lit(True)))


def release_history(releases: DataFrame) -> DataFrame:
    """Releases, the latest of each region and kind marked; the reader orders them."""
    newest = releases.groupBy("region_id", "kind").agg(F.max(F.struct("built_at", "version")).alias("n"))
    newest = newest.select("region_id", "kind", F.col("n.built_at").alias("built_at"), F.col("n.version").alias("version"), F.lit(True).alias("latest"))
    return releases.join(newest, ["region_id", "kind", "built_at", "version"], "left").withColumn("latest", F.coalesce("latest", F.lit(False)))


def layer_classify(objects: DataFrame) -> DataFrame:
    """Map layers of each tagged object: layer, min_zoom, class, subclass, attributes.

    objects: id, is_node, is_closed, tags map, relation_level (least admin level
    of its boundary relations, NULL when there is none).
    """

    def tag(name: str) -> Column:
        return F.coalesce(F.try_element_at(F.col("tags"), F.lit(name)), F.lit(""))

    def number(name: str) -> Column:
        return F.floor(tag(name).try_cast("double")).cast("long")

    def some(*pairs: tuple[str, Column]) -> Column:
        """Attribute map of the filled pairs."""
        entries = [F.when(v.isNotNull() & (v.cast("string") != ""), F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))) for k, v in pairs]
        return F.map_from_entries(F.array_compact(F.array(*entries)))

    def layer(name: str, when: Column, zoom: Column, klass: Column, sub: Column | None, *attrs: tuple[str, Column]) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(name).alias("layer"),
                zoom.cast("int").alias("min_zoom"),
                klass.cast("string").alias("class"),
                (F.lit(None) if sub is None else sub).cast("string").alias("subclass"),
                some(*attrs).alias("attributes"),
            ),
        )

    node, way = F.col("is_node"), ~F.col("is_node")
    names = [("name", tag("name")), ("name_en", F.when(tag("name:en") != tag("name"), tag("name:en")))]
    place, natural, highway = tag("place"), tag("natural"), tag("highway")
    is_place = node & place.isin("city", "town", "village")
    is_pass = tag("mountain_pass") == "yes"
    zoom = F.lit(None).cast("int")
    for name, value in ROAD_MIN_ZOOM.items():
        zoom = F.when(highway == name, value).otherwise(zoom)
    road = F.when(highway.isin(MINOR_ROADS), "minor").otherwise(highway)
    is_road = way & zoom.isNotNull()
    yes = lambda key: F.when((tag(key) != "") & (tag(key) != "no"), F.lit("yes"))
    ref = ("ref", tag("ref"))
    waterway, water, landuse = tag("waterway"), tag("water"), tag("landuse")
    is_water = (
        (natural == "water") | landuse.isin("reservoir", "basin") | water.isin("lake", "reservoir", "pond") | (waterway == "riverbank")
    )
    admin = tag("boundary") == "administrative"
    own_level = F.when(admin, F.coalesce(tag("admin_level").try_cast("double"), F.lit(99.0))).otherwise(F.lit(99.0))
    level = F.least(own_level, F.coalesce(F.col("relation_level").cast("double"), F.lit(99.0)))
    is_border = way & (admin | F.col("relation_level").isNotNull()) & (tag("maritime") != "yes") & (level <= 10)
    layers = F.array_compact(
        F.array(
            layer("place", is_place, F.when(place == "city", 5).when(place == "town", 7).otherwise(10), place, None, ("population", number("population")), *names),
            layer("mountain_peak", node & ~is_place & (natural.isin("peak", "volcano") | is_pass), F.lit(9), F.when(is_pass, "pass").otherwise(natural), None, ("ele", number("ele")), *names),
            layer("transportation", is_road, zoom, road, highway, ref, ("surface", tag("surface")), ("oneway", tag("oneway")), ("bridge", yes("bridge")), ("tunnel", yes("tunnel")), ("layer", number("layer"))),
            layer("transportation_name", is_road & ((tag("name") != "") | (tag("ref") != "")), F.greatest(zoom, F.lit(7)), road, highway, ref, *names),
            layer("waterway", way & waterway.isin("river", "stream", "canal"), F.when(waterway == "river", 8).otherwise(11), waterway, None, *names),
            layer("water", way & F.col("is_closed") & is_water, F.lit(6), F.when(water != "", water).otherwise("lake"), None, *names),
            layer(
                "boundary", is_border, F.when(level <= 4, 3).when(level <= 6, 8).when(level == 7, 10).otherwise(12), F.lit(None), None,
                ("admin_level", level.cast("int")), ("disputed", F.when(tag("disputed") == "yes", 1).otherwise(0)),
            ),
        )
    )
    return objects.select("id", F.explode(layers).alias("l")).select("id", "l.*")
