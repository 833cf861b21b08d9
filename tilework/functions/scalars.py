"""Column functions: text, properties, geometry helpers, rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- text ---


def slug(text: Column, limit: int = 80) -> Column:
    """Lower-case words joined by dashes."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, limit)


#: The Latin letters that folding replaces, and what by.
ACCENTED, PLAIN = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def folded(text: Column) -> Column:
    """Without accents, lower case, words split by single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, ACCENTED, PLAIN)), "[^a-z0-9]+", " "))


def terms(text: Column) -> Column:
    """Words of three characters or more that are not all digits, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.filter(F.split(folded(text), " "), lambda w: (F.length(w) >= 3) & ~w.rlike("^[0-9]+$"))))


def first_number(text: Column) -> Column:
    """The first number in a text, decimal comma or point."""
    return F.nullif(F.replace(F.regexp_extract(text, r"[-+]?[0-9]+(?:[.,][0-9]+)?", 0), F.lit(","), F.lit(".")), F.lit("")).try_cast("double")


def numeric_property(properties: Column, keys: list[str]) -> Column:
    """The first of the keys (any case) whose value holds a number; true and false are none."""
    low = F.map_from_entries(F.transform(F.map_entries(properties), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    value = lambda k: F.when(~F.lower(low[k]).isin("true", "false"), first_number(low[k]))
    return F.coalesce(*(value(k) for k in keys))


def unsafe_path(path: Column) -> Column:
    """Why a relative path is refused, or null."""
    return (
        F.when(path.rlike(r"^([A-Za-z]:)?[/\\]"), "absolute").when(path.rlike(r"(^|/)\.\.(/|$)"), "parent").when(path.rlike(r"[\\:?#\x00]"), "character").when(F.length(path) == 0, "empty")
    )


def declared_epsg(name: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(name), r"epsg(?::|::|/)([0-9]+)", 1), F.lit("")).cast("int")


def inferred_epsg(declared: Column, x: Column, y: Column) -> Column:
    """The declared system, else the one whose ranges hold the first coordinate; a coordinate in neither range fails the plan."""
    known = F.when(x.between(-180, 180) & y.between(-90, 90), 4326).when(x.between(0, 2e6) & y.between(5e6, 8e6), 2154)
    lost = F.raise_error(F.concat_ws(" ", F.lit("no reference system holds"), x.cast("string"), y.cast("string"))).cast("int")
    return F.coalesce(declared, known, F.when(x.isNotNull() & y.isNotNull(), lost))


def stable_id(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{kind}_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24))


def seed64(*parts: Column) -> Column:
    """The first eight bytes of the hash, big-endian, unsigned."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16), 16, 10).cast("decimal(20,0)")


# --- rules ---

#: Widths by importance, and bounds of a source width, in metres.
WIDTHS = {1: 10.0, 2: 8.0, 3: 7.0, 4: 6.0, 5: 5.0, 6: 2.5, 7: 1.5}
NARROWEST, WIDEST, DEFAULT_WIDTH = 1.5, 30.0, 4.0


def importance_rank(value: Column) -> Column:
    rank = F.bround(value).cast("int")
    return F.when(rank.between(1, 7), rank)


def road_width(width: Column, importance: Column) -> tuple[Column, Column]:
    """Width and the method that gave it."""
    by_rank = F.element_at(F.create_map(*(F.lit(x) for kv in WIDTHS.items() for x in kv)), importance_rank(importance))
    clamped = F.least(F.greatest(width, F.lit(NARROWEST)), F.lit(WIDEST))
    good = width > 0
    return F.when(good, clamped).otherwise(F.coalesce(by_rank, F.lit(DEFAULT_WIDTH))), F.when(good, "source").when(by_rank.isNotNull(), "importance").otherwise("default")


#: Fixed values in the four rules below and in travel_rate: their limits, class names and coefficients.


def fire_regime(elapsed_s: Column, area_m2: Column, rate: Column) -> Column:
    return F.when((elapsed_s <= 60) | (area_m2 <= 1000), "incipient").when(rate <= 0.01, "stalled").when(rate < 0.08, "slowed").otherwise("established")


def visibility_reasons(regime: Column, distance_m: Column, zoom: Column) -> Column:
    return F.array_compact(F.array(F.when(regime != "established", F.concat(F.lit("regime_"), regime)), F.when(distance_m >= 1500, F.lit("distance")), F.when(zoom < 1, F.lit("wide_zoom"))))


def acceptance(expected: Column, reasons: Column) -> tuple[Column, Column]:
    """Class and sample kind."""
    hard = F.size(reasons) > 0
    return (
        F.when(~expected, "negative_context").when(hard, "valid_low_or_partial_signal_positive").otherwise("standard_positive"),
        F.when(~expected, "negative").when(hard, "hard_positive").otherwise("positive"),
    )


def visibility_tier(expected: Column, pixels: Column) -> Column:
    return F.when(~expected, "none_expected").when(pixels <= 32, "trace").when(pixels <= 256, "small").when(pixels <= 2048, "moderate").otherwise("clear")


def incident_calendar(index: Column, per_day: int, seconds: int = 8640) -> tuple[Column, Column, Column]:
    """Day, slot in the day, seconds since the start, of a state index from 1."""
    day = F.floor((index - 1) / per_day) + 1
    return day.cast("long"), ((index - 1) % per_day + 1).cast("long"), ((index - 1) * seconds).cast("long")


def travel_rate(fuel: Column, wind: Column, alignment: Column, upslope: Column, moisture_percent: Column, humidity: Column, base: float = 0.12) -> Column:
    """Spread over an edge in m/s."""
    moisture = F.greatest(F.lit(0.32), F.least(F.lit(1.0), 1.22 - moisture_percent / 25 - humidity / 280))
    slope = F.greatest(F.lit(-0.65), F.least(F.lit(0.65), 3.8 * upslope))
    return F.greatest(F.lit(0.015), F.least(F.lit(0.42), base * (0.22 + 0.78 * fuel) * F.exp(0.09 * wind * alignment) * F.exp(slope) * moisture))


def luminance(r: Column, g: Column, b: Column) -> Column:
    return 0.2126 * r + 0.7152 * g + 0.0722 * b


def saturation(r: Column, g: Column, b: Column) -> Column:
    top = F.greatest(r, g, b)
    return F.when(top == 0, 0.0).otherwise((top - F.least(r, g, b)) / top)


# --- geometry ---


def owner_tile(v: Column, side: int) -> Column:
    """West or south edge of the half-open tile that holds v."""
    return (F.floor(v / side) * side).cast("long")


def snapped_owner_tile(v: Column, side: int, tolerance: float, last: int) -> Column:
    """As owner_tile, but values near a tile edge go to the edge first, and the outer edge to the last tile."""
    edge = F.bround(v / side) * side
    at = F.when(F.abs(v - edge) <= tolerance, edge).otherwise(v)
    return F.least(F.floor(at / side) * side, F.lit(last)).cast("long")


#: The conic projection's ellipsoid and parameters (degrees, metres).
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
ORIGIN_LON, ORIGIN_LAT, PARALLELS, FALSE_EAST, FALSE_NORTH = 3.0, 46.5, (49.0, 44.0), 700_000.0, 6_600_000.0


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres east and north of a longitude and latitude in degrees."""
    import math

    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    iso = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    scale = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    p1, p2, p0 = (math.radians(x) for x in (*PARALLELS, ORIGIN_LAT))
    n = (math.log(scale(p1)) - math.log(scale(p2))) / (math.log(iso(p1)) - math.log(iso(p2)))
    c = SEMI_MAJOR * scale(p1) / (n * iso(p1) ** n)
    p = F.radians(lat)
    sine = e * F.sin(p)
    r = c * F.pow(F.tan(F.lit(math.pi / 4) - p / 2) / F.pow((1 - sine) / (1 + sine), F.lit(e / 2)), F.lit(n))
    angle = n * F.radians(lon - ORIGIN_LON)
    return FALSE_EAST + r * F.sin(angle), FALSE_NORTH + c * iso(p0) ** n - r * F.cos(angle)


def shoelace(ring: Column) -> Column:
    """Twice the signed area of a closed ring of (x, y)."""
    edges = F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.element_at(ring, i)["x"] * F.element_at(ring, i + 1)["y"] - F.element_at(ring, i + 1)["x"] * F.element_at(ring, i)["y"])
    return F.aggregate(edges, F.lit(0).cast("double"), lambda a, x: a + x)


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd crossing test against a closed ring."""
    def crosses(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        return F.when(((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]), 1).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.size(ring) - 1), crosses), F.lit(0), lambda s, v: s + v) % 2 == 1


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of value, which is evaluated once however often f names it."""
    return F.transform(F.array(value), f)[0]


def look_at_quaternion(position: tuple[Column, ...], target: tuple[Column, ...]) -> tuple[Column, Column, Column, Column]:
    """(w, x, y, z) of the rotation whose -z axis looks from position to target, z up (y up where the view is near vertical)."""
    cross = lambda a, b: [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    unit = lambda v: F.transform(v, lambda x: x / F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2]))

    def turned(m: Column) -> Column:
        """Of the matrix whose columns are right, top and back, one after the other."""
        at = lambda i, k: m[3 * k + i]
        trace = at(0, 0) + at(1, 1) + at(2, 2)
        s0, s1, s2, s3 = (2 * F.sqrt(F.greatest(F.lit(1e-12), x)) for x in (trace + 1, 1 + at(0, 0) - at(1, 1) - at(2, 2), 1 + at(1, 1) - at(0, 0) - at(2, 2), 1 + at(2, 2) - at(0, 0) - at(1, 1)))
        a, b, c = at(2, 1) - at(1, 2), at(0, 2) - at(2, 0), at(1, 0) - at(0, 1)
        d, e, g = at(0, 1) + at(1, 0), at(0, 2) + at(2, 0), at(1, 2) + at(2, 1)
        by_first, by_second = (at(0, 0) >= at(1, 1)) & (at(0, 0) >= at(2, 2)), at(1, 1) >= at(2, 2)
        return (
            F.when(trace > 0, F.array(s0 / 4, a / s0, b / s0, c / s0)).when(by_first, F.array(a / s1, s1 / 4, d / s1, e / s1))
            .when(by_second, F.array(b / s2, d / s2, s2 / 4, g / s2)).otherwise(F.array(c / s3, e / s3, g / s3, s3 / 4))
        )

    def seen(f: Column) -> Column:
        steep = F.abs(f[2]) > 0.98
        up = [F.lit(0.0), F.when(steep, 1.0).otherwise(0.0), F.when(steep, 0.0).otherwise(1.0)]
        right = _once(F.array(*cross(f, up)), unit)
        return _once(right, lambda r: _once(F.concat(r, F.array(*cross(r, f)), F.transform(f, lambda x: -x)), turned))

    ahead = F.array(*(t - p for p, t in zip(position, target, strict=True)))
    found = _once(_once(ahead, unit), seen)
    return tuple(found[k] for k in range(4))
