"""The scene catalogue: classification, times, search, incident windows, tiles, upserts, resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.functions.boxes import box, intersection, touches
from skysift.functions.scores import utm_zone
from skysift.functions.utm import from_utm, to_utm
from skysift.operators.spatial import overlapping_pairs

#: Words in a file's name or path, the vendor, and whether the path counts too; the first that fits.
VENDORS = (
    ("Capella Space", "SAR", ("capella",), ("capella",)),
    ("Airbus", "Optical", ("airbus", "pleiades", "spot", "phr"), ()),
    ("Vantor / Maxar", "Optical", ("maxar", "wv"), ("gegd", "vantor")),
)


#: The tags of a sidecar XML that hold the acquisition time.
TIME_TAGS = ("FIRST_LINE_TIME", "IMAGERY_DATE", "ACQUISITION_DATE", "firstLineTime")


def vendor(filename: Column, path: Column, bands: Column) -> tuple[Column, Column]:
    """(provider, modality) by the vendor words; an unknown one-band file named sar, hh or vv is SAR."""
    name, whole = F.lower(filename), F.lower(path)
    provider = modality = F
    for who, kind, in_name, in_path in VENDORS:
        fits = F.lit(False)
        for w in in_name:
            fits = fits | name.contains(w)
        for w in in_path:
            fits = fits | whole.contains(w)
        provider, modality = provider.when(fits, who), modality.when(fits, kind)
    radar = (bands == 1) & (name.contains("sar") | name.contains("hh") | name.contains("vv"))
    return provider.otherwise("Unknown Vendor"), modality.otherwise(F.when(radar, "SAR").otherwise("Optical"))


def acquisition_time(filename: Column, sidecar: Column | None = None, xml: Column | None = None, tags: Column | None = None, modified: Column | None = None) -> Column:
    """ISO text of the acquisition time: sidecar JSON, sidecar XML, TIFF tags, the file's name, its modification time; the first found.

    In a name the time of day needs a literal T; a date alone is midnight UTC.
    A name's numbers may look like dates ("1234_20240105"): the first valid date
    counts that begins a run of digits and has one separator or none, else the
    first match with separators of any kind.
    """
    tries = []
    if sidecar is not None:
        tries += [F.get_json_object(sidecar, p) for p in ("$.collect.start_time", "$.acquisition_time", "$.datetime", "$.startTime")]
    if xml is not None:
        found = F.trim(F.regexp_extract(xml, rf"<(?:{'|'.join(TIME_TAGS)})>([^<]*)</", 1))
        tries.append(F.when(found != "", found))
    if tags is not None:
        tries += [F.try_element_at(tags, F.lit(k)) for k in ("TIFFTAG_DATETIME", "AREA_OR_POINT", "acquisition_date")]
    time = r"(?:T\d{2}[-_]?\d{2}[-_]?\d{2})?"
    plain = F.regexp_extract_all(filename, F.lit(rf"(?<!\d)(?=(\d{{4}}([-_]?)\d{{2}}\2\d{{2}}{time}))"), 1)
    loose = F.regexp_extract(filename, rf"(\d{{4}}[-_]?\d{{2}}[-_]?\d{{2}}{time})", 1)

    def read(found: Column) -> Column:
        raw = F.regexp_replace(found, "[-_T]", "")
        full, day = F.try_to_timestamp(F.substring(raw, 1, 14), F.lit("yyyyMMddHHmmss")), F.try_to_timestamp(F.substring(raw, 1, 8), F.lit("yyyyMMdd"))
        return F.when(F.length(raw) >= 14, full).otherwise(day)

    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("t")
    in_name = F.get(F.filter(F.transform(F.concat(plain, F.array(loose)), read), lambda t: t.isNotNull()), F.lit(0))
    tries.append(F.regexp_replace(iso(in_name), "Z$", "+00:00"))
    if modified is not None:
        tries.append(F.regexp_replace(iso(modified), "Z$", "+00:00"))
    return F.coalesce(*tries)


def search(catalog: DataFrame, target: tuple[float, float, float, float], *, start: str | None = None, end: str | None = None, modality: str | None = None) -> DataFrame:
    """Scenes (xmin … ymax, ts, modality) that touch a box, with the share of it they cover, most first.

    Times that cannot be read pass the time window.
    """
    out = catalog
    if modality is not None:
        out = out.filter(F.lower("modality") == modality.lower())
    when = F.try_to_timestamp("ts")
    if start is not None:
        out = out.filter(when.isNull() | (when >= F.lit(start).cast("timestamp")))
    if end is not None:
        out = out.filter(when.isNull() | (when <= F.lit(end).cast("timestamp")))
    t = tuple(F.lit(float(v)) for v in target)
    size = (target[2] - target[0]) * (target[3] - target[1])
    out = out.filter(touches(box(), t))
    return out.withColumn("buffer_coverage_pct", F.bround(intersection(box(), t) / size * 100, 2)).orderBy(F.desc("buffer_coverage_pct"), "scene_id")


def metric_buffer(points: DataFrame, metres: float = 1000.0) -> DataFrame:
    """`ring` of the four corners, in degrees, of a square of 2 x metres around (lon, lat), made in the point's UTM zone."""
    zone = utm_zone(F.col("lon"), F.col("lat"))
    east, north = to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))
    out = points.withColumn("epsg", zone).withColumns({"__e": east, "__n": north})
    corners = []
    for dx, dy in ((1, -1), (1, 1), (-1, 1), (-1, -1)):
        x, y = from_utm(F.col("__e") + dx * metres, F.col("__n") + dy * metres, F.col("epsg"))
        corners.append(F.struct(x.alias("x"), y.alias("y")))
    return out.withColumn("ring", F.array(*corners)).drop("__e", "__n")


def incident_windows(incidents: DataFrame, scenes: DataFrame, *, half: float = 0.1, pixel: float = 0.01) -> DataFrame:
    """Pixel windows of each scene (north up, `pixel` degrees) that a square around an incident touches, rounded outward and clipped."""
    area = incidents.select("incident_id", (F.col("lon") - half).alias("xmin"), (F.col("lat") - half).alias("ymin"), (F.col("lon") + half).alias("xmax"), (F.col("lat") + half).alias("ymax"))
    pairs = overlapping_pairs(area, scenes.select("scene_id", "xmin", "ymin", "xmax", "ymax"), cell=8.0)
    width, height = F.round((F.col("r_xmax") - F.col("r_xmin")) / pixel), F.round((F.col("r_ymax") - F.col("r_ymin")) / pixel)
    # A corner that lies on a pixel's edge but for rounding stays on it.
    down, up = (lambda v: F.floor(F.round(v, 6))), (lambda v: F.ceil(F.round(v, 6)))
    c0, c1 = F.greatest(down((F.col("l_xmin") - F.col("r_xmin")) / pixel), F.lit(0)), F.least(up((F.col("l_xmax") - F.col("r_xmin")) / pixel), width)
    r0, r1 = F.greatest(down((F.col("r_ymax") - F.col("l_ymax")) / pixel), F.lit(0)), F.least(up((F.col("r_ymax") - F.col("l_ymin")) / pixel), height)
    return pairs.select(F.col("l_incident_id").alias("incident_id"), F.col("r_scene_id").alias("scene_id"), r0.cast("long").alias("row_off"), c0.cast("long").alias("col_off"), (r1 - r0).cast("long").alias("height"), (c1 - c0).cast("long").alias("width"))


def upserted(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of both by key, the latest of `new`, by `order`, before those of `old`."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    last = Window.partitionBy(key).orderBy(F.desc("__new"), F.desc(order))
    return both.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n", "__new")


def pending(manifest: DataFrame, results: DataFrame, key: str, *, overwrite: bool = False) -> DataFrame:
    """The tiles without a result yet; all with `overwrite`."""
    return manifest if overwrite else manifest.join(results.select(key).distinct(), key, "left_anti")


def tile_stride(kind: Column, size: int = 512) -> Column:
    """Stride by the shape of what is sought: linear 50 %, cluster 35 %, else 20 % overlap."""
    return F.greatest(F.lit(32), F.when(kind == "linear", size - int(size * 0.50)).when(kind == "cluster", size - int(size * 0.35)).otherwise(size - int(size * 0.20)))


def metric_stride(gsd: Column, metres: float = 25.0, size: int = 512) -> Column:
    """Stride that keeps an overlap of so many metres, 60 % of the tile at the most."""
    return F.greatest(F.lit(32), size - F.least((metres / gsd).cast("int"), F.lit(int(size * 0.60))))


def truncation_risk(width: Column, height: Column, stride: Column, size: int = 512) -> Column:
    overlap = size - stride
    return F.when(overlap <= 0, 1.0).otherwise(F.least(F.lit(1.0), F.bround(F.greatest(width, height) / F.when(overlap > 0, overlap), 4)))


def adaptive_grid(images: DataFrame, stride: int, size: int = 512) -> DataFrame:
    """Windows at every stride, those at the border partial."""
    at = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(stride).cast("long"))
    out = images.withColumn("row_off", F.explode(at("height"))).withColumn("col_off", F.explode(at("width")))
    return out.withColumns({"win_h": F.least(F.lit(size), F.col("height") - F.col("row_off")), "win_w": F.least(F.lit(size), F.col("width") - F.col("col_off"))})


def ground_sample(a: Column, e: Column, geographic: Column) -> tuple[Column, Column]:
    """Metres a pixel on both axes; degrees count 111,320 m."""
    m = F.when(geographic, 111320.0).otherwise(1.0)
    return F.abs(a) * m, F.abs(e) * m
