"""Image, point-set and geometry metrics on array columns; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def _mean(a: Column) -> Column:
    return _sum(a) / F.size(a)


def mse(a: Column, b: Column) -> Column:
    """M01; arrays of different length are an error."""
    same = F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))).otherwise(F.raise_error(F.lit("arrays differ in length")).cast("array<double>"))
    return _mean(same)


def psnr(m: Column, peak: float = 255.0) -> Column:
    return F.when(m == 0, F.lit(float("inf"))).otherwise(20 * F.log10(F.lit(peak)) - 10 * F.log10(m))


def ssim(a: Column, b: Column, peak: float = 255.0) -> Column:
    """One window over the whole image."""
    # The usual constants of the index.
    c1, c2 = (0.01 * peak) ** 2, (0.03 * peak) ** 2
    a, b = F.transform(a, lambda x: x.cast("double")), F.transform(b, lambda x: x.cast("double"))
    ma, mb = _mean(a), _mean(b)
    va, vb = _mean(F.transform(a, lambda x: (x - ma) * (x - ma))), _mean(F.transform(b, lambda x: (x - mb) * (x - mb)))
    cov = _mean(F.zip_with(a, b, lambda x, y: (x - ma) * (y - mb)))
    return ((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))


def area_ratio(mask: Column, level: float = 128) -> Column:
    """Share above the level."""
    return _mean(F.transform(mask, lambda x: (x > level).cast("double")))


def change_ratio(a: Column, b: Column, threshold: float) -> Column:
    """M05 without morphology: share of pixels (arrays of channels) whose largest channel
    difference is above the threshold."""
    return _mean(F.zip_with(a, b, lambda x, y: (F.array_max(F.zip_with(x, y, lambda p, q: F.abs(p.cast("double") - q))) > threshold).cast("double")))


def entropy_bits(counts: Column) -> Column:
    """Shannon bits of a histogram."""
    total = _sum(F.transform(counts, lambda x: x.cast("double")))
    return -_sum(F.transform(counts, lambda x: F.when(x > 0, x / total * F.log2(x / total)).otherwise(0.0)))


def view_score(bits: Column, edges: Column) -> Column:
    # Weights of entropy and edge density.
    return 0.7 * bits + 30.0 * edges


def bbox(low: list[Column], high: list[Column]) -> Column:
    """Extents, centre, diagonal, volume from minima and maxima an axis."""
    ext = [h - x for x, h in zip(low, high, strict=True)]
    vol = ext[0]
    for e in ext[1:]:
        vol = vol * e
    square = ext[0] * ext[0]
    for e in ext[1:]:
        square = square + e * e
    return F.struct(F.array(*ext).alias("extents"), F.array(*[(x + h) / 2 for x, h in zip(low, high, strict=True)]).alias("centre"), F.sqrt(square).alias("diagonal"), vol.alias("volume"))


def clamped_size(width: Column, height: Column, least: float, most: float) -> Column:
    """The padded size whose aspect lies in the range."""
    ratio = width / height
    return F.struct(F.when(ratio < least, F.ceil(height * least)).otherwise(width).alias("width"), F.when(ratio > most, F.ceil(width / most)).otherwise(height).alias("height"))


def matmul(a: Column, b: Column) -> Column:
    """Product of matrices as arrays of rows."""
    dot = lambda r, j: _sum(F.transform(F.sequence(F.lit(1), F.size(r)), lambda k: F.element_at(r, k) * F.element_at(F.element_at(b, k), j)))
    return F.transform(a, lambda row: F.transform(F.sequence(F.lit(1), F.size(F.element_at(b, 1))), lambda j: dot(row, j)))


def is_rotation(m: Column, eps: float = 1e-6) -> Column:
    """Orthonormal rows and determinant 1."""
    e = lambda i, j: F.element_at(F.element_at(m, i), j)
    dot = lambda i, j: sum((e(i, k) * e(j, k) for k in (2, 3)), e(i, 1) * e(j, 1))
    det = e(1, 1) * (e(2, 2) * e(3, 3) - e(2, 3) * e(3, 2)) - e(1, 2) * (e(2, 1) * e(3, 3) - e(2, 3) * e(3, 1)) + e(1, 3) * (e(2, 1) * e(3, 2) - e(2, 2) * e(3, 1))
    out = F.abs(det - 1) < eps
    for i in (1, 2, 3):
        for j in range(i, 4):
            out = out & (F.abs(dot(i, j) - (1.0 if i == j else 0.0)) < eps)
    return F.coalesce(out, F.lit(False))


def passes(score: Column, threshold: Column | float, direction: str) -> Column:
    """Distances pass at or below the threshold, confidences at or above it. A null
    score never passes."""
    if direction not in ("lower", "higher"):
        raise ValueError("direction is lower or higher")
    return F.coalesce(score <= threshold if direction == "lower" else score >= threshold, F.lit(False))


def clamped(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def consistency(scores: Column, how: str) -> Column:
    """One score from those of the views that are there."""
    values = F.filter(F.map_values(scores), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return {"max": F.array_max(values), "min": F.array_min(values), "mean": F.when(F.size(values) > 0, _mean(values))}[how]


# Where the sides of a model face.
NORMALS = {"front": (0, -1, 0), "back": (0, 1, 0), "left": (1, 0, 0), "right": (-1, 0, 0), "top": (0, 0, 1), "bottom": (0, 0, -1)}


def front_rotation(side: Column) -> Column:
    """The matrix, as rows, that turns the side to the front and keeps the top up (the
    back, where the top or bottom turns); null for another name. The side, its upward
    direction and their product go to front, top and theirs, so the rows are those three."""

    def rows(name: str) -> Column:
        f, u = NORMALS[name], NORMALS["back" if name in ("top", "bottom") else "top"]
        cross = (f[1] * u[2] - f[2] * u[1], f[2] * u[0] - f[0] * u[2], f[0] * u[1] - f[1] * u[0])
        return F.array(*[F.array(*[F.lit(float(s * x)) for x in v]) for s, v in ((-1, cross), (-1, f), (1, u))])

    return F.create_map(*[c for n in NORMALS for c in (F.lit(n), rows(n))])[side]


def decision_fault(side: Column, confidence: Column, reason: Column, least: float) -> Column:
    """The first thing wrong with a decision, null if it is sound."""
    return (
        F.when(side.isNull() | confidence.isNull() | reason.isNull(), "missing field")
        .when(~side.isin(*NORMALS), "unknown side")
        .when(confidence < least, "confidence too low")
        .when((confidence > 1) | F.isnan(confidence), "confidence above 1")
    )


def checked_decision(side: Column, confidence: Column, reason: Column, least: float) -> Column:
    """The decision, its reason trimmed; an unsound one fails the query."""
    fault = decision_fault(side, confidence, reason, least)
    sound = F.struct(side.alias("side"), confidence.cast("double").alias("confidence"), F.trim(reason).alias("reason"))
    return F.when(fault.isNull(), sound).otherwise(F.raise_error(fault))


def slot_views(scores: Column) -> Column:
    """W15, M21 without choice of views: scores maps the views that are there to their score.
    Each slot takes its own view; without a front the best view does, the first of equals."""
    entries = F.transform(F.map_entries(scores), lambda e, i: F.struct(e["value"].alias("score"), (-i).alias("at"), e["key"].alias("view")))
    own = lambda s: F.when(F.map_contains_key(scores, s), F.lit(s))
    return F.struct(F.coalesce(own("front"), F.array_max(entries)["view"]).alias("front"), *[own(s).alias(s) for s in ("left", "back", "right")])


SLOTS = ("front", "left", "back", "right")
# For the pair of views left out, the view of each slot, how far it is turned, and
# the view that is up.
VIEW_PLANS = {
    "top_bottom": ({"front": "front", "left": "left", "back": "back", "right": "right"}, {"front": 0, "left": 0, "back": 0, "right": 0}, "top"),
    "front_back": ({"front": "top", "left": "left", "back": "bottom", "right": "right"}, {"front": 0, "left": 270, "back": 180, "right": 90}, "bottom"),
    "left_right": ({"front": "front", "left": "bottom", "back": "back", "right": "top"}, {"front": 270, "left": 270, "back": 90, "right": 270}, "left"),
}
NO_SCORE = -1e9


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def excluded_pair(scores: Column, threshold: Column, judged_front: Column) -> Column:
    """Top and bottom are left out, unless top scores more than the threshold above front
    and the judge (null: wasn't asked) holds it for the front."""
    of = lambda view: F.coalesce(F.try_element_at(scores, F.lit(view)), F.lit(NO_SCORE))
    return F.when((of("top") - of("front") > threshold) & F.coalesce(judged_front, F.lit(False)), "front_back").otherwise("top_bottom")


def view_plan(scores: Column, selects: Column, strategy: Column, threshold: Column, judged_front: Column) -> Column:
    """From the scores of the views there are, which view goes into each slot. Without
    selection each slot has its own view, if there; a missing front is the view of greatest
    score, in the order of slots, then top and bottom. With it the pair left out tells. Fails
    without views, for an unknown strategy, a side view that isn't there, or fewer than two
    views in all."""
    order = F.array(*map(F.lit, (*SLOTS, "top", "bottom")))
    there = F.filter(order, lambda v: F.map_contains_key(scores, v))
    best = F.array_max(F.transform(there, lambda v, i: F.struct(scores[v].alias("score"), (-i).alias("i"), v.alias("view"))))["view"]
    own = F.map_filter(_lookup({s: s for s in SLOTS}), lambda _, v: F.array_contains(there, v))
    plain = F.map_from_arrays(F.array(*map(F.lit, SLOTS)), F.array(*[F.coalesce(F.try_element_at(own, F.lit(s)), best if s == "front" else F.lit(None).cast("string")) for s in SLOTS]))
    pair = excluded_pair(scores, threshold, judged_front)
    told = {name: F.element_at(F.create_map(*[x for k, parts in VIEW_PLANS.items() for x in (F.lit(k), F.lit(parts[i]) if i == 2 else _lookup(parts[i]))]), pair) for i, name in enumerate(("slots", "turns", "up"))}
    slots = F.when(~selects, plain).when(strategy == "entropy_edge", told["slots"]).otherwise(F.raise_error(F.concat(F.lit("unknown strategy "), strategy)).cast("map<string,string>"))

    def checked(s: Column) -> Column:
        sides = F.filter(F.array(*[s[x] for x in SLOTS[1:]]), lambda v: v.isNotNull())
        count = F.size(sides) + 1
        fault = F.when(F.size(there) == 0, "there are no views").when(~F.forall(sides, lambda v: F.array_contains(there, v)), "a side view is missing").when(count < 2, "at least two views are needed")
        return F.struct(
            s.alias("slots"),
            F.when(selects, told["turns"]).otherwise(_lookup(dict.fromkeys(SLOTS, 0))).alias("turns"),
            F.when(selects, told["up"]).otherwise("top").alias("virtual_up"),
            F.when(fault.isNull(), count).otherwise(F.raise_error(fault).cast("int")).alias("input_count"),
            F.transform_values(scores, lambda _, x: F.round(x, 4)).alias("scores"),
        )

    return F.transform(F.array(slots), checked)[0]
