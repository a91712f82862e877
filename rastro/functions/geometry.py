"""Planar geometry in degrees, as SQL text; x is the longitude, y the latitude.

The helpers return text because they nest lambdas within lambdas, which reads better in SQL
and is much quicker to build. Arguments are SQL text too.

A district is a struct (zona_id, nombre, minx, miny, maxx, maxy, edges). Its edges cover all
rings, holes included; an edge is a struct (x, y, y2, dx, dy, len2): start, end height,
direction and squared length.
"""

BOUNDARY = 1e-9  # a point this close to an edge lies on the boundary
DISTANCE_DIGITS = 9

SHAPES = (
    "array<struct<zona_id:int,nombre:string,minx:double,miny:double,maxx:double,maxy:double,"
    "edges:array<struct<x:double,y:double,y2:double,dx:double,dy:double,len2:double>>>>"
)


def number(value):
    """A double literal."""
    return f"{float(value)!r}D"


# --- rings -----------------------------------------------------------------------------------


def ring_edges(rings):
    """Edges of all rings; an open ring is closed, edges without length are dropped."""
    edge = """named_struct('x', a_.x, 'y', a_.y, 'y2', b_.y, 'dx', b_.x - a_.x, 'dy', b_.y - a_.y,
        'len2', (b_.x - a_.x) * (b_.x - a_.x) + (b_.y - a_.y) * (b_.y - a_.y))"""
    following = "concat(slice(ring_, 2, size(ring_)), slice(ring_, 1, 1))"
    of_ring = f"zip_with(ring_, {following}, (a_, b_) -> {edge})"
    return f"filter(flatten(transform({rings}, ring_ -> {of_ring})), e_ -> e_.len2 > 0)"


def ring_box(ring):
    """name -> text of the limits of one ring."""
    return {
        f"{end}{axis}": f"array_{end}(transform({ring}, p_ -> p_.{axis}))"
        for end in ("min", "max")
        for axis in ("x", "y")
    }


# --- a point and a district --------------------------------------------------------------------


def in_box(x, y):
    """Whether the point lies in the box of district_, limits included."""
    return (
        f"({x} BETWEEN district_.minx AND district_.maxx"
        f" AND {y} BETWEEN district_.miny AND district_.maxy)"
    )


def box_distance(x, y):
    """Distance to the box of district_; 0 inside. Never more than to what the box holds."""
    dx = f"greatest(district_.minx - {x}, {x} - district_.maxx, 0D)"
    dy = f"greatest(district_.miny - {y}, {y} - district_.maxy, 0D)"
    return f"sqrt(pow({dx}, 2D) + pow({dy}, 2D))"


def boundary_distance(x, y):
    """Distance from the point to the nearest edge of district_."""
    along = f"(({x} - e_.x) * e_.dx + ({y} - e_.y) * e_.dy) / e_.len2"
    t = f"greatest(0D, least(1D, {along}))"
    squared = f"pow({x} - (e_.x + {t} * e_.dx), 2D) + pow({y} - (e_.y + {t} * e_.dy), 2D)"
    return f"sqrt(array_min(transform(district_.edges, e_ -> {squared})))"


def odd_crossings(x, y):
    """Even-odd rule: whether a ray to the right meets the edges of district_ an odd time."""
    meets = f"{x} < try_divide(e_.dx * ({y} - e_.y), e_.dy) + e_.x"
    crossing = f"(e_.y > {y}) != (e_.y2 > {y}) AND {meets}"
    return f"(size(filter(district_.edges, e_ -> {crossing})) % 2 = 1)"


# --- a point and all districts --------------------------------------------------------------------


def first_containing(districts, x, y):
    """zona_id of the first district that strictly contains the point, else null."""
    holds = (
        f"{in_box(x, y)} AND {odd_crossings(x, y)}"
        f" AND {boundary_distance(x, y)} > {number(BOUNDARY)}"
    )
    return f"get(filter({districts}, district_ -> {holds}), 0).zona_id"


def first_box(districts, x, y):
    """zona_id of the first district whose box holds the point, else null."""
    return f"get(filter({districts}, district_ -> {in_box(x, y)}), 0).zona_id"


def nearest(districts, x, y):
    """Struct (d, zona_id) of the district with the nearest boundary, the first on ties.

    Edges are only measured where the district's box could still beat the best so far.
    """
    distance = f"round({boundary_distance(x, y)}, {DISTANCE_DIGITS})"
    found = f"named_struct('d', {distance}, 'zona_id', district_.zona_id)"
    hopeless = f"{box_distance(x, y)} > best_.d + {number(2 * BOUNDARY)}"
    start = "named_struct('d', double('infinity'), 'zona_id', int(NULL))"
    step = f"IF({hopeless}, best_, least(best_, {found}))"
    return f"aggregate({districts}, {start}, (best_, district_) -> {step})"


def measured(districts, x, y):
    """Per district a struct (zona_id, d, odd): boundary distance and even-odd rule."""
    fact = (
        f"named_struct('zona_id', district_.zona_id, 'd', {boundary_distance(x, y)},"
        f" 'odd', {odd_crossings(x, y)})"
    )
    return f"transform({districts}, district_ -> {fact})"


def among(districts, candidates):
    """The districts whose id is a candidate; all of them where the candidates are null."""
    chosen = f"coalesce(array_contains({candidates}, district_.zona_id), true)"
    return f"filter({districts}, district_ -> {chosen})"


# --- a point and zone centres ------------------------------------------------------------------


def zone_array(rows):
    """Array of structs (zona_id, lat, lon, radio_km), as one constant."""
    zones = [
        f'{{"zona_id":{zid},"lat":{float(lat)!r},"lon":{float(lon)!r},"radio_km":{float(radius)!r}}}'
        for zid, lat, lon, radius in rows
    ]
    return f"from_json('[{','.join(zones)}]', 'array<struct<zona_id:int,lat:double,lon:double,radio_km:double>>')"


def _centers(zones, lat, lon):
    distance = f"sqrt(pow({lat} - zone_.lat, 2D) + pow({lon} - zone_.lon, 2D))"
    center = f"named_struct('d', {distance}, 'zona_id', zone_.zona_id, 'radio_km', zone_.radio_km)"
    return f"transform({zones}, zone_ -> {center})"


def nearest_center(zones, lat, lon):
    """Id of the zone centre nearest to the point, the lowest id on ties."""
    return f"array_min({_centers(zones, lat, lon)}).zona_id"


def centers_within(zones, lat, lon, reach):
    """The centres that are farther from the point than the nearest one by ``reach`` at most."""
    distance = f"sqrt(pow({lat} - zone_.lat, 2D) + pow({lon} - zone_.lon, 2D))"
    best = f"array_min(transform({zones}, zone_ -> {distance}))"
    # the nearest distance is the argument of a function, so it is found once
    near = f"filter({zones}, zone_ -> {distance} <= best_ + {reach})"
    return f"flatten(transform(array({best}), best_ -> {near}))"


def center_within_radius(zones, lat, lon, degrees_per_km):
    """Id of the nearest centre that has the point within its radius, else null."""
    reaches = f"reached_.d <= reached_.radio_km * {number(degrees_per_km)}"
    return f"array_min(filter({_centers(zones, lat, lon)}, reached_ -> {reaches})).zona_id"
