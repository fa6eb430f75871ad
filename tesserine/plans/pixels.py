"""Queries of image neighbourhoods and meshes, on grids made from the embeddings: each 64
vectors are an image, and each 32 a mesh."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import images, meshes
from .base import Tables, query, r6

_AT = "image AS (SELECT vec_id // 64 AS id, vec_id % 64 AS y, unnest(range(1, 65)) - 1 AS x, embedding FROM embeddings), grid AS (SELECT id, y, x, greatest(0, least(255, CAST(floor(128 + 512 * CAST(embedding[x + 1] AS DOUBLE)) AS INT))) AS v FROM image)"


def _rows(t: Tables) -> DataFrame:
    level = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(128 + 512 * x.cast("double")).cast("int")))
    return t.embeddings.select(F.expr("vec_id div 64").alias("id"), (F.col("vec_id") % 64).cast("int").alias("y"), F.transform("embedding", level).alias("values"))


@query(
    "WITH "
    + _AT
    + """, size AS (SELECT id, max(y) + 1 AS h, count(*) AS n FROM grid GROUP BY id),
    bits AS (SELECT id, sum(-(c / n) * log2(c / n)) AS entropy FROM (SELECT id, v, count(*)::DOUBLE AS c FROM grid GROUP BY ALL) JOIN size USING (id) GROUP BY id),
    three AS (SELECT *, sum(v) OVER (PARTITION BY id, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS s FROM grid),
    nine AS (SELECT *, sum(s) OVER (PARTITION BY id, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS ss FROM three),
    e AS (SELECT id, count(*) FILTER (WHERE CASE WHEN h >= 3 AND y > 0 AND y < h - 1 AND x > 0 AND x < 63 THEN least(255, 9 * v - ss) ELSE v END >= 32) AS strong FROM nine JOIN size USING (id) GROUP BY id)
    SELECT id, round(entropy, 6) AS entropy, round(strong / n, 6) AS edge_density, round(entropy * 0.7 + strong / n * 30, 6) AS score FROM size JOIN bits USING (id) JOIN e USING (id)"""
)
def image_scores(t: Tables) -> DataFrame:
    """Entropy and edge density of every image."""
    return images.entropy_edge_scores(_rows(t), band=16).select("id", *[r6(c).alias(c) for c in ("entropy", "edge_density", "score")])


def _window(of: str, by: str, order: str, pick: str, name: str, src: str) -> str:
    return f"{name} AS (SELECT *, {pick}({of}) OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS {name}_v FROM {src})"


@query(
    "WITH "
    + _AT
    + """, pair AS (SELECT a.id, a.y, a.x, CASE WHEN greatest(abs(a.v - b.v), abs(a.v // 2 - b.v // 2), abs(a.v - (a.v + b.v) // 2)) > 12 THEN 1 ELSE 0 END AS m FROM grid a JOIN grid b ON b.id = a.id AND b.x = a.x AND b.y = CASE WHEN a.y % 2 = 0 THEN a.y + 1 ELSE a.y - 1 END), """
    + ", ".join([_window("m", "id, y", "x", "min", "e1", "pair"), _window("e1_v", "id, x", "y", "min", "e2", "e1"), _window("e2_v", "id, y", "x", "max", "d1", "e2"), _window("d1_v", "id, x", "y", "max", "d2", "d1")])
    + " SELECT id, sum(d2_v)::BIGINT AS changed_pixels, count(*) AS total_pixels, round(sum(d2_v) / count(*), 6) AS changed_ratio FROM d2 GROUP BY id"
)
def opened_masks(t: Tables) -> DataFrame:
    """Change masks between neighbouring rows of every image, opened by squares of three."""
    rows = _rows(t)
    other = rows.select("id", F.expr("case when y % 2 = 0 then y + 1 else y - 1 end").alias("y"), F.col("values").alias("_other"))
    both = rows.join(other, ["id", "y"])
    colour = lambda v, mixed: F.array(v, F.floor(v / 2).cast("int"), mixed)
    before = F.transform("values", lambda v: colour(v, v))
    after = F.zip_with("values", "_other", lambda v, w: colour(w, F.floor((v + w) / 2).cast("int")))
    out = images.change_stats(both.select("id", "y", before.alias("before"), after.alias("after")), 12, 3, band=16)
    return out.select("id", "changed_pixels", "total_pixels", r6("changed_ratio").alias("changed_ratio"))


@query(
    """WITH p AS (SELECT vec_id AS v, vec_id // 32 AS mesh, vec_id % 32 AS i, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
    f AS (SELECT mesh, i // 4 AS part, v + o[1] AS a, v + o[2] AS b, v + o[3] AS c FROM p, (SELECT unnest([[0, 2, 1], [0, 1, 3], [0, 3, 2], [1, 2, 3]]) AS o) WHERE mesh % 2 = 0 AND i % 4 = 0
      UNION ALL SELECT mesh, i // 8, v, v + 1, v + 2 FROM p WHERE mesh % 2 = 1 AND i % 8 <= 5),
    t AS (SELECT f.*, p.x AS ax, p.y AS ay, p.z AS az, q.x AS bx, q.y AS by_, q.z AS bz, r.x AS cx, r.y AS cy, r.z AS cz FROM f JOIN p ON p.v = a JOIN p q ON q.v = b JOIN p r ON r.v = c),
    g AS (SELECT mesh, count(*) AS faces, count(DISTINCT part) AS parts, max(greatest(ax, bx, cx)) - min(least(ax, bx, cx)) AS dx, max(greatest(ay, by_, cy)) - min(least(ay, by_, cy)) AS dy, max(greatest(az, bz, cz)) - min(least(az, bz, cz)) AS dz,
      sum(sqrt(((by_ - ay) * (cz - az) - (bz - az) * (cy - ay)) ** 2 + ((bz - az) * (cx - ax) - (bx - ax) * (cz - az)) ** 2 + ((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)) ** 2) / 2) AS area,
      sum((ax * (by_ * cz - bz * cy) + ay * (bz * cx - bx * cz) + az * (bx * cy - by_ * cx)) / 6) AS volume FROM t GROUP BY mesh),
    e AS (SELECT mesh, least(u, w) AS u, greatest(u, w) AS w FROM (SELECT mesh, a AS u, b AS w FROM t UNION ALL SELECT mesh, b, c FROM t UNION ALL SELECT mesh, c, a FROM t)),
    s AS (SELECT mesh, max(n) = 2 AND min(n) = 2 AS tight FROM (SELECT mesh, u, w, count(*) AS n FROM e GROUP BY ALL) GROUP BY mesh),
    n AS (SELECT mesh, count(*) AS vertices FROM p GROUP BY mesh)
    SELECT g.mesh, vertices, faces, parts, round(dx, 5) AS dx, round(sqrt(dx * dx + dy * dy + dz * dz), 5) AS diag, round(area, 5) AS area, tight, round(CASE WHEN tight THEN volume END, 5) AS volume FROM g JOIN s USING (mesh) JOIN n USING (mesh)"""
)
def mesh_figures(t: Tables) -> DataFrame:
    """Meshes of tetrahedra (closed) and of strips (open)."""
    at = F.array(*[F.col("embedding")[i].cast("double") for i in range(3)])
    points = t.embeddings.select(F.col("vec_id").alias("v"), F.expr("vec_id div 32").alias("mesh"), (F.col("vec_id") % 32).alias("i"), at.alias("p"))
    body = F.array(*[F.array(*map(F.lit, f)) for f in ((0, 2, 1), (0, 1, 3), (0, 3, 2), (1, 2, 3))])
    steps = F.when(F.col("mesh") % 2 == 0, F.when(F.col("i") % 4 == 0, body)).when(F.col("i") % 8 <= 5, F.array(F.array(F.lit(0), F.lit(1), F.lit(2))))
    faces = points.select("mesh", "v", F.posexplode(steps).alias("n", "o"))
    faces = faces.select("mesh", (F.col("v") * 4 + F.col("n")).alias("face"), *[(F.col("v") + F.col("o")[i]).alias(x) for i, x in enumerate("abc")])
    for x in "abc":
        faces = faces.join(points.select(F.col("v").alias(x), F.col("p").alias(f"p{x}")), x)
    n = points.groupBy("mesh").agg(F.count("*").alias("n_vertices"))
    out = meshes.mesh_stats(faces.join(n, "mesh").withColumn("error", F.lit(None).cast("string")), "mesh")
    five = lambda c, name: F.round(c, 5).alias(name)
    return out.select("mesh", F.col("mesh_vertices").alias("vertices"), F.col("mesh_faces").alias("faces"), F.col("mesh_components").alias("parts"), five("mesh_bbox_dx", "dx"), five("mesh_bbox_diag", "diag"), five("mesh_surface_area", "area"), F.col("mesh_is_watertight").alias("tight"), five("mesh_volume", "volume"))
