"""Label files, geometry and annotation queries on the text boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import Tables, boxes, draw_sql, integer_sql, pick_sql, query, r4, r4_sql
from docsynth.catalog.corpora import CONTENT, PARTS
from docsynth.functions import geometry as g
from docsynth.operators import annotations as ann
from docsynth.operators import structure
from docsynth.operators.ordered import scan
from docsynth.rng import draw, integer, pick
from docsynth.session import work_path
from docsynth.sources import hierarchy, labels, markup

C = F.col
CORNERS = [("l", "t"), ("r", "t"), ("r", "b"), ("l", "b")]


def quads(t: Tables) -> DataFrame:
    return boxes(t).withColumn("quad", g.box_to_quad(C("l"), C("t"), C("r"), C("b")))


def spread(df: DataFrame, quad: Column, *keep: str, digits: bool = True) -> DataFrame:
    """The corners of a quad as columns x1, y1, ..; four decimals."""
    cols = [
        (r4(quad[i][a]) if digits else quad[i][a].cast("bigint")).alias(f"{a}{i + 1}") for i in range(4) for a in ("x", "y")
    ]
    return df.select(*keep, *cols)


def spread_sql(fx, fy, digits: bool = True) -> str:
    out = []
    for i, (x, y) in enumerate(CORNERS):
        for a, f in (("x", fx), ("y", fy)):
            e = f(x, y)
            out.append(f"{r4_sql(e) if digits else f'CAST({e} AS BIGINT)'} AS {a}{i + 1}")
    return ", ".join(out)


LINE_SQL = """'img' || image_id || ';' || l || ';' || t || ';' || r || ';' || t || ';' || r || ';' || b || ';' || l || ';' || b ||
    ';text@' || content"""


def label_rows(t: Tables) -> DataFrame:
    name = F.concat(F.lit("img"), C("image_id").cast("string"))
    return quads(t).select(name.alias("name"), "quad", F.concat(F.lit("text@"), "content").alias("label"))


def written_lines(t: Tables, df: DataFrame, name: str) -> str:
    """Write one text column to a new folder and return the folder."""
    path = work_path(t.spark, name)
    df.write.text(path)
    return path


@query(f"SELECT {LINE_SQL} AS line FROM boxes")
def write_labels(t: Tables) -> DataFrame:
    path = work_path(t.spark, "labels")
    rows = label_rows(t).withColumns({"mode": F.lit("table"), "lang": F.substring("label", 6, 1)})
    labels.write_labels(rows, path)
    return t.spark.read.text(path).select(C("value").alias("line"))


@query(
    "SELECT 'img' || image_id AS name, 'text' AS kind, content, 'text' AS role, l, t, r, b FROM boxes"
)
def read_labels(t: Tables) -> DataFrame:
    line = labels.label_line(C("name"), C("quad"), C("label"))
    path = written_lines(t, label_rows(t).select(line), "labels")
    box = g.quad_to_box(C("quad"))
    found = labels.read_labels(t.spark, path)
    return found.select("name", "kind", "content", "role", *[box[k].cast("bigint").alias(k) for k in "ltrb"])


@query(
    """SELECT CASE WHEN r % 2 = 0 THEN l || ';' || t || ';' || r || ';' || t || ';' || r || ';' || b || ';' || l || ';' || b || ';' ||
    content ELSE l || ';' || t || ';' || r || ';' || content END AS line FROM boxes"""
)
def labels_2pt_to_4pt(t: Tables) -> DataFrame:
    parts = [C(k).cast("string") for k in "ltr"]
    five = F.concat_ws(";", *parts, C("b").cast("string"), C("content"))
    line = F.when(C("r") % 2 == 0, five).otherwise(F.concat_ws(";", *parts, C("content")))
    return boxes(t).select(line.alias("value")).select(labels.two_to_four_points(C("value")).alias("line"))


@query("SELECT ann_id AS image, content AS label, l, t, r, b FROM boxes")
def read_labelme(t: Tables) -> DataFrame:
    pts = F.array(F.array("l", "t"), F.array("r", "b"))
    shape = F.struct(F.concat(F.lit("text@"), "content").alias("label"), pts.alias("points"))
    doc = F.to_json(F.struct(C("ann_id").alias("imagePath"), F.array(shape).alias("shapes")))
    path = written_lines(t, boxes(t).select(doc), "labelme")
    return markup.read_labelme(t.spark, path, multi_line=False)


@query(
    """SELECT ann_id, CAST(p.i AS BIGINT) AS slot_no, CASE p.i WHEN 1 THEN content ELSE 'key@' || content END AS name, r - l AS width, b - t AS height,
    l AS x, t AS y, 'f' || p.i AS font, CASE p.i WHEN 1 THEN '#00ff00' END AS colour FROM boxes, (VALUES (1), (2)) AS p(i)"""
)
def read_slice_html(t: Tables) -> DataFrame:
    def tag(name: Column, font: str) -> Column:
        return F.concat(
            F.lit("<a onmouseover=\"window.status='"), name, F.lit("'\"><img width=\""), (C("r") - C("l")).cast("string"),
            F.lit('" height="'), (C("b") - C("t")).cast("string"), F.lit('" border="0" alt="'), C("l").cast("string"), F.lit(","),
            C("t").cast("string"), F.lit(f',{font}"></a>'),
        )

    html = F.concat(tag(C("content"), "f1#00ff00"), tag(F.concat(F.lit("key@"), "content"), "f2"))
    return markup.slice_html(boxes(t).select("ann_id", html.alias("html")), "html")


@query("SELECT 'bg' || image_id || '.jpg' AS jpg, l, t, r, b FROM boxes")
def read_background_boxes(t: Tables) -> DataFrame:
    jpg = F.concat(F.lit("bg"), C("image_id").cast("string"), F.lit(".jpg"))
    line = F.concat_ws(";", jpg, *[C(k).cast("string") for k in "ltrb"], F.lit("x"))
    return labels.read_background_boxes(t.spark, written_lines(t, boxes(t).select(line), "backgrounds"))


@query(
    """SELECT 'img' || image_id AS name, 'text' AS kind, 'text' AS content, CASE WHEN r % 2 = 0 THEN content END AS font, l, t, r, b
    FROM boxes"""
)
def read_slot_labels(t: Tables) -> DataFrame:
    spec = F.when(C("r") % 2 == 0, F.concat(F.lit("text@text|"), "content")).otherwise(F.lit("text@text"))
    rows = quads(t).select(
        labels.label_line(F.concat(F.lit("img"), C("image_id").cast("string")), C("quad"), spec).alias("value")
    )
    return labels.slots_of(labels.parse_label_lines(rows))


@query(
    """SELECT n_name AS word FROM (SELECT '户名' || n_name AS n_name FROM nation JOIN customer ON c_nationkey = n_nationkey)"""
)
def read_corpus(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, C("c_nationkey") == C("n_nationkey"))
    line = F.concat(F.lit("a.jpg;0;0;1;0;1;1;0;1;text@"), F.concat(F.lit("户名"), "n_name"))
    return labels.decode_corpus(joined.select(labels.encode_text(line, "GBK").alias("content")), "GBK")


@query(
    """SELECT 'docs' AS mode, lang, printf('%s_%s_%08d_%d', 'docs', lang, doc_id, 0) AS name, length(text) AS n FROM documents"""
)
def write_dataset(t: Tables) -> DataFrame:
    from docsynth.sources import dataset

    name = dataset.sample_name(F.lit("docs"), C("lang"), C("doc_id"), F.lit(0))
    rows = t.documents.select(F.lit("docs").alias("mode"), "lang", name.alias("name"), F.length("text").alias("n"))
    path = work_path(t.spark, "dataset")
    dataset.write_dataset(rows, path)
    return t.spark.read.parquet(path)


@query(
    f"""SELECT url, {CONTENT} AS content, CAST(len(regexp_extract_all(html, '<img [^>]*src="([^"]*)"', 1)) AS BIGINT) AS n_images FROM {PARTS}"""
)
def write_articles(t: Tables) -> DataFrame:
    from docsynth.operators import web
    from docsynth.sources import dataset

    rows = t.pages.select("url", web.article_text(C("html")).alias("content"), web.image_urls(C("html")).alias("image_urls"))
    path = work_path(t.spark, "articles")
    rows.write.json(path)
    return t.spark.read.schema(dataset.ARTICLE).json(path).select("url", "content", F.size("image_urls").alias("n_images"))


@query(
    """SELECT s_suppkey AS statement_no, s_name AS statement, CAST(section_no AS BIGINT) AS section_no, section, CAST(item_no AS BIGINT) AS item_no,
    CASE WHEN section_no = 0 AND item_no = 0 THEN s_name WHEN section_no = 0 THEN 'nation ' || s_nationkey WHEN section_no = 1 THEN
    'balance' END AS item FROM supplier, (VALUES (0, 'identity', 0), (0, 'identity', 1), (1, 'money', 0), (2, 'empty', NULL))
    AS v(section_no, section, item_no)"""
)
def read_hierarchy(t: Tables) -> DataFrame:
    def section(name: str, *items: Column) -> Column:
        return F.struct(F.lit(name).alias("section"), (F.array(*items) if items else F.array().cast("array<string>")).alias("items"))

    nation = F.concat(F.lit("nation "), C("s_nationkey").cast("string"))
    sections = F.array(section("identity", C("s_name"), nation), section("money", F.lit("balance")), section("empty"))
    nested = t.supplier.select(C("s_suppkey").alias("statement_no"), C("s_name").alias("statement"), sections.alias("sections"))
    return hierarchy.explode_hierarchy(nested)


@query(
    f"""SELECT doc_id AS "index", l.lang, printf('%s_%s_%08d_%d', 'doc', l.lang, doc_id, 0) AS name,
    {draw_sql('doc_id', 50)} AS seed FROM documents, (VALUES ('en'), ('fr'), ('km')) AS l(lang)"""
)
def synth_source(t: Tables) -> DataFrame:
    from docsynth.sources import dataset

    # Ranges of the table's ids and all languages are offered; the filter goes down into the source.
    span = t.documents.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).first()
    offered = dataset.samples(t.spark, span.first or 0, -1 if span.last is None else span.last, ["de", "en", "fr", "km", "zh"])
    samples = offered.where(C("lang").isin("en", "fr", "km")).join(t.documents.select(C("doc_id").alias("index")), "index")
    name = dataset.sample_name(F.lit("doc"), C("lang"), C("index"), F.lit(0))
    return samples.select("index", "lang", name.alias("name"), draw(C("index"), 50).alias("seed"))


# ---------------------------------------------------------------- geometry


@query(
    f"SELECT ann_id, l, t, r, b, {spread_sql(lambda x, y: x, lambda x, y: y, False)} FROM boxes"
)
def box_to_quad(t: Tables) -> DataFrame:
    df = quads(t)
    box = g.quad_to_box(C("quad"))
    df = df.select("ann_id", "quad", *[box[k].cast("bigint").alias(k) for k in "ltrb"])
    return spread(df, C("quad"), "ann_id", "l", "t", "r", "b", digits=False)


@query(
    f"SELECT ann_id, {spread_sql(lambda x, y: f'{x} + image_id % 50', lambda x, y: f'{y} + 30', False)} FROM boxes"
)
def shift_points(t: Tables) -> DataFrame:
    moved = g.shift_points(C("quad"), C("image_id") % 50, F.lit(30))
    return spread(quads(t).select("ann_id", moved.alias("q")), C("q"), "ann_id", digits=False)


ROT = f"(SELECT *, cos(radians(a)) AS c, sin(radians(a)) AS s FROM (SELECT *, {integer_sql('image_id', 51, -5, 5)} AS a FROM boxes))"
DX = "((1 - c) * 210 - s * 380 + CAST(trunc(760 * abs(s) + 420 * abs(c)) AS BIGINT) / 2 - 210)"
DY = "(s * 210 + (1 - c) * 380 + CAST(trunc(760 * abs(c) + 420 * abs(s)) AS BIGINT) / 2 - 380)"


@query(
    f"SELECT ann_id, {spread_sql(lambda x, y: f'c * {x} + s * {y} + {DX}', lambda x, y: f'-s * {x} + c * {y} + {DY}')} FROM {ROT}"
)
def rotate_points(t: Tables) -> DataFrame:
    turned = g.rotate_points(C("quad"), F.lit(420), F.lit(760), integer(C("image_id"), 51, -5, 5))
    return spread(quads(t).select("ann_id", turned.alias("q")), C("q"), "ann_id")


P_SQL = "(SELECT *, (image_id % 10) / CAST(100 AS DOUBLE) AS p, (image_id % 7) / CAST(100 AS DOUBLE) AS q FROM boxes)"


def _px(x: str, y: str) -> str:
    return f"floor(((1 - p - q) * {x} - 420 * p * {y} / 760 + 420 * p) / (1 - (p + q) * {y} / 760))"


def _py(x: str, y: str) -> str:
    return f"floor((1 - p - q) * {y} / (1 - (p + q) * {y} / 760))"


@query(f"SELECT ann_id, {spread_sql(_px, _py, False)} FROM {P_SQL}")
def perspective_points(t: Tables) -> DataFrame:
    left, right = (C("image_id") % 10) / F.lit(100.0), (C("image_id") % 7) / F.lit(100.0)
    warped = g.perspective_points(C("quad"), F.lit(420), F.lit(760), left, right)
    return spread(quads(t).select("ann_id", warped.alias("q")), C("q"), "ann_id", digits=False)


# One fixed mock-up: the page corners and where they lie in the scene.
PAGE = [(0.0, 0.0), (420.0, 0.0), (420.0, 760.0), (0.0, 760.0)]
SCENE = [(50.0, 40.0), (400.0, 60.0), (430.0, 700.0), (20.0, 720.0)]
WARP = g.homography(PAGE, SCENE)
H = [f"CAST({v!r} AS DOUBLE)" for v in WARP]


@query(
    "SELECT ann_id, "
    + spread_sql(
        lambda x, y: f"({H[0]} * {x} + {H[1]} * {y} + {H[2]}) / ({H[6]} * {x} + {H[7]} * {y} + 1)",
        lambda x, y: f"({H[3]} * {x} + {H[4]} * {y} + {H[5]}) / ({H[6]} * {x} + {H[7]} * {y} + 1)",
    )
    + " FROM (SELECT ann_id, l - 3 AS l, t - 3 AS t, r + 3 AS r, b + 3 AS b FROM boxes)"
)
def quad_warp_points(t: Tables) -> DataFrame:
    warped = g.warp_points(g.inflate_quad(C("quad"), F.lit(3.0)), [F.lit(v) for v in WARP])
    return spread(quads(t).select("ann_id", warped.alias("q")), C("q"), "ann_id")


# A mock-up for each nation: where the corners of a page lie in it.
SCENES = {"x0": (50, 3), "y0": (40, 1), "x1": (400, 2), "y1": (60, 5), "x2": (430, 1), "y2": (700, 4), "x3": (20, 2), "y3": (720, 3)}
SCENE_SQL = f"""(SELECT n_nationkey AS scene, {", ".join(f"CAST({a} + {b} * n_nationkey AS DOUBLE) AS {c}" for c, (a, b) in SCENES.items())} FROM nation)"""
WARPS_SQL = f"""(SELECT scene, x0, y0, (x1 - x0 + g * x1) / 420 AS ma, (x3 - x0 + h * x3) / 760 AS mb, (y1 - y0 + g * y1) / 420 AS md,
    (y3 - y0 + h * y3) / 760 AS me, g / 420 AS mg, h / 760 AS mh FROM (SELECT *,
      ((x0 - x1 + x2 - x3) * (y3 - y2) - (x3 - x2) * (y0 - y1 + y2 - y3)) / ((x1 - x2) * (y3 - y2) - (x3 - x2) * (y1 - y2)) AS g,
      ((x1 - x2) * (y0 - y1 + y2 - y3) - (x0 - x1 + x2 - x3) * (y1 - y2)) / ((x1 - x2) * (y3 - y2) - (x3 - x2) * (y1 - y2)) AS h FROM {SCENE_SQL}))"""


@query(
    "SELECT ann_id, "
    + spread_sql(lambda x, y: f"(ma * {x} + mb * {y} + x0) / (mg * {x} + mh * {y} + 1)", lambda x, y: f"(md * {x} + me * {y} + y0) / (mg * {x} + mh * {y} + 1)")
    + f" FROM (SELECT w.*, ann_id, l - 3 AS l, t - 3 AS t, r + 3 AS r, b + 3 AS b FROM boxes JOIN {WARPS_SQL} w ON image_id % 25 = scene)"
)
def scene_warp_points(t: Tables) -> DataFrame:
    """Every page in its own mock-up."""
    scenes = t.nation.select(C("n_nationkey").alias("scene"), *[(a + b * C("n_nationkey")).cast("double").alias(c) for c, (a, b) in SCENES.items()])
    warp = g.rectangle_to_quad(F.lit(420.0), F.lit(760.0), [(C(f"x{i}"), C(f"y{i}")) for i in range(4)])
    scenes = scenes.select("scene", *[m.alias(f"m{i}") for i, m in enumerate(warp)])
    placed = quads(t).join(scenes, C("image_id") % 25 == C("scene"))
    warped = g.warp_points(g.inflate_quad(C("quad"), F.lit(3.0)), [C(f"m{i}") for i in range(8)])
    return spread(placed.select("ann_id", warped.alias("q")), C("q"), "ann_id")


@query(f"SELECT ann_id, {spread_sql(lambda x, y: x, lambda x, y: y, False)} FROM boxes")
def order_clockwise(t: Tables) -> DataFrame:
    mixed = F.array(C("quad")[2], C("quad")[0], C("quad")[3], C("quad")[1])
    return spread(quads(t).select("ann_id", g.order_clockwise(mixed).alias("q")), C("q"), "ann_id", digits=False)


@query(
    """SELECT ann_id, CAST(round_even((r - l) / CAST(16 AS DOUBLE), 0) * 16 AS BIGINT) AS width,
    CAST(round_even((b - t) / CAST(12 AS DOUBLE), 0) * 12 AS BIGINT) AS height, CAST(round_even(l / CAST(16 AS DOUBLE), 0) * 16 AS BIGINT) AS l,
    CAST(round_even(b / CAST(6 AS DOUBLE), 0) * 6 AS BIGINT) AS b FROM boxes"""
)
def snap_to_grid(t: Tables) -> DataFrame:
    cols = {"width": (C("r") - C("l"), 16), "height": (C("b") - C("t"), 12), "l": (C("l"), 16), "b": (C("b"), 6)}
    return boxes(t).select("ann_id", *[g.snap(c, F.lit(float(u))).cast("bigint").alias(n) for n, (c, u) in cols.items()])


@query(
    """WITH p AS (SELECT image_id, max(r) AS w, max(b) AS h FROM boxes GROUP BY image_id)
    SELECT x.ann_id, CAST(trunc(l * least(600 / w, 800 / h)) AS BIGINT) AS l, CAST(trunc(t * least(600 / w, 800 / h)) AS BIGINT) AS t,
    CAST(trunc(r * least(600 / w, 800 / h)) AS BIGINT) AS r, CAST(trunc(b * least(600 / w, 800 / h)) AS BIGINT) AS b
    FROM boxes x JOIN p ON x.image_id = p.image_id"""
)
def scale_boxes(t: Tables) -> DataFrame:
    page = boxes(t).groupBy("image_id").agg(F.max("r").alias("w"), F.max("b").alias("h"))
    scale, _ = g.fit_scale(C("w"), C("h"), F.lit(600), F.lit(800), keep_ratio=True)
    return boxes(t).join(page, "image_id").select("ann_id", *[(C(k) * scale).cast("bigint").alias(k) for k in "ltrb"])


@query(
    f"""WITH a AS (SELECT c_custkey, length(c_name) AS n, {integer_sql('c_custkey', 52, 150, 400)} AS radius FROM customer),
    d AS (SELECT *, 2 * asin(CAST(0.7 AS DOUBLE) * 24 * sqrt(CAST(2 AS DOUBLE)) / 2 / radius) AS d FROM a),
    v AS (SELECT c_custkey, n, edge, k, -d * (n - 1) / 2 AS turn, radius, radius + edge AS far,
        CASE WHEN k = 0 THEN -d / 2 WHEN k = n + 1 THEN d * (n - 1) + d / 2 ELSE d * (k - 1) END AS angle
      FROM d, (VALUES (12), (-12)) AS e(edge), range(0, n + 2) AS r(k)),
    w AS (SELECT *, far * sin(angle) AS dx, radius - far * cos(angle) AS dy FROM v),
    p AS (SELECT c_custkey, edge, CASE WHEN edge > 0 THEN k ELSE 2 * n + 3 - k END AS place,
      CASE WHEN dx = 0 THEN 0 ELSE CAST(trunc(dx * cos(turn) - dy * sin(turn)) AS BIGINT) END AS x,
      CAST(trunc(CASE WHEN dx = 0 THEN dy ELSE dx * sin(turn) + dy * cos(turn) END) AS BIGINT) AS y FROM w),
    o AS (SELECT *, x - min(x) OVER (PARTITION BY c_custkey) AS ox, y - min(y) OVER (PARTITION BY c_custkey) AS oy FROM p)
    SELECT c_custkey, count(*) AS n, string_agg(ox || ',' || oy, ';' ORDER BY place) AS outline FROM o GROUP BY c_custkey"""
)
def arc_polygon(t: Tables) -> DataFrame:
    arcs = t.customer.withColumns({"n": F.length("c_name"), "size": F.lit(24), "radius": integer(C("c_custkey"), 52, 150, 400)})
    outlines = ann.arc_outlines(arcs, "n", "size", "radius")
    coords = F.transform("outline", lambda p: F.concat_ws(",", p["x"].cast("int").cast("string"), p["y"].cast("int").cast("string")))
    return outlines.select("c_custkey", F.size("outline").alias("n"), F.array_join(coords, ";").alias("outline"))


# ---------------------------------------------------------------- annotation sets


@query(
    f"""SELECT ann_id, CAST(p.i AS BIGINT) AS poly_no, content AS text, false AS ignore_tag,
    (l + p.i * 5) || ',' || t || ';' || (r + p.i * 5) || ',' || t || ';' || (r + p.i * 5) || ',' || b || ';' || (l + p.i * 5) || ',' || b AS poly
    FROM boxes, (VALUES (0), (1)) AS p(i)"""
)
def encode_labels(t: Tables) -> DataFrame:
    two = F.concat(C("quad"), g.shift_points(C("quad"), F.lit(5), F.lit(0)))
    label = F.concat(F.lit("text@"), "content")
    rows = quads(t).select("ann_id", F.array(label, label).alias("labels"), two.alias("points"))
    enc = ann.encode_labels(rows)
    zipped = F.posexplode_outer(F.arrays_zip("polys", "texts", "ignore_tags")).alias("poly_no", "z")
    coords = F.transform("z.polys", lambda p: F.concat_ws(",", p["x"].cast("bigint").cast("string"), p["y"].cast("bigint").cast("string")))
    return enc.select("ann_id", zipped).select(
        "ann_id", "poly_no", C("z.texts").alias("text"), C("z.ignore_tags").alias("ignore_tag"), F.array_join(coords, ";").alias("poly")
    )


@query(
    "SELECT ann_id, l || ',' || t || ';' || r || ',' || t || ';' || r || ',' || b || ';' || l || ',' || b AS poly, content AS text FROM boxes"
)
def select_label_keys(t: Tables) -> DataFrame:
    rows = quads(t).select(C("ann_id").alias("image_id"), C("quad").alias("polys"), F.concat(F.lit("text@"), "content").alias("label"))
    coords = F.transform("polys", lambda p: F.concat_ws(",", p["x"].cast("bigint").cast("string"), p["y"].cast("bigint").cast("string")))
    return ann.select_label_keys(rows).select(C("image_id").alias("ann_id"), F.array_join(coords, ";").alias("poly"), "text")


@query(
    """WITH p AS (SELECT *, 4 + CAST(content[2] AS BIGINT) AS n FROM boxes)
    SELECT ann_id, max(n) OVER (PARTITION BY image_id) AS corners, l AS last_x, b + CAST(content[2] AS BIGINT) AS last_y FROM p"""
)
def pad_polygons(t: Tables) -> DataFrame:
    steps = F.sequence(F.lit(1), F.substring("content", 2, 1).cast("int"))
    extra = F.transform(steps, lambda i: g.point(C("l"), C("b") + i))
    polygon = F.concat(g.box_to_quad(C("l"), C("t"), C("r"), C("b")), extra)
    padded = ann.pad_polygons(boxes(t), "image_id", polygon, corners=F.size(steps) + 4)
    last = F.element_at("quad", -1)
    return padded.select(
        "ann_id", F.size("quad").alias("corners"), last["x"].cast("bigint").alias("last_x"), last["y"].cast("bigint").alias("last_y")
    )


@query(
    """SELECT image_id, 'text' AS kind, content, l, t, r, b FROM boxes UNION ALL
    SELECT image_id, 'table', '1', min(l), min(t), max(r), max(b) FROM boxes GROUP BY image_id UNION ALL
    SELECT image_id, 'column', CAST(l // 100 AS VARCHAR), min(l), min(t), max(r), max(b) FROM boxes GROUP BY image_id, l // 100"""
)
def merge_annotations(t: Tables) -> DataFrame:
    text = boxes(t)
    tables = structure.bounding_union(text, "image_id").withColumn("content", F.lit("1"))
    numbered = text.withColumn("col", F.floor(C("l") / 100))
    cols = structure.bounding_union(numbered, "image_id", "col").withColumn("content", C("col").cast("string"))
    return ann.merge_annotations(("text", text), ("table", tables), ("column", cols))


@query(
    """SELECT image_id, ann_id, CAST(coalesce(sum(r - l + 12) OVER (PARTITION BY image_id ORDER BY t, l, ann_id ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
    CAST(sum(r - l + 12) OVER (PARTITION BY image_id) - 12 AS BIGINT) AS along,
    max(b - t) OVER (PARTITION BY image_id) AS across FROM boxes"""
)
def layout_offsets(t: Tables) -> DataFrame:
    blocks = boxes(t).withColumns({"w": C("r") - C("l"), "h": C("b") - C("t")})
    placed = ann.layout_offsets(blocks, "image_id", structure.band("t"), structure.READING, "w", 12)
    size = ann.container_size(blocks, "image_id", "w", "h", 12)
    return placed.join(size, "image_id").select("image_id", "ann_id", "offset", "along", "across")


MODES = ["all", "rows", "cols", "header", "border"]


@query(
    f"""WITH m AS (SELECT image_id, l, t, r, b, {pick_sql('image_id', 90, MODES)} AS mode, min(t) OVER (PARTITION BY image_id) AS t0,
      max(b) OVER (PARTITION BY image_id) AS b0 FROM boxes)
    SELECT image_id, 'h' AS axis, l AS x1, t AS y1, r AS x2, t AS y2 FROM m WHERE mode IN ('all', 'rows') OR (mode IN ('header', 'border') AND t = t0)
    UNION SELECT image_id, 'h', l, b, r, b FROM m WHERE mode IN ('all', 'rows') OR (mode = 'header' AND t = t0) OR (mode = 'border' AND b = b0)
    UNION SELECT image_id, 'v', l, t, l, b FROM m WHERE mode IN ('all', 'cols')
    UNION SELECT image_id, 'v', r, t, r, b FROM m WHERE mode IN ('all', 'cols')"""
)
def rule_segments(t: Tables) -> DataFrame:
    return ann.rule_segments(boxes(t), pick(C("image_id"), 90, MODES))


ALIGNS = [across + down for across in "lmr" for down in "tmb"]


@query(
    f"""WITH c AS (SELECT ann_id, l, t, r + 60 AS r, b + 30 AS b, '  ' || content || ' ' AS s, {pick_sql('l + t', 91, ALIGNS)} AS a FROM boxes),
    p AS (SELECT *, CASE a[1] WHEN 'l' THEN l + 2 WHEN 'r' THEN r - 6 ELSE (l + r) // 2 END AS x,
      CASE a[2] WHEN 't' THEN t + 4 WHEN 'b' THEN b - 8 ELSE (t + b) // 2 END AS y, length(s) * 8 AS w FROM c),
    q AS (SELECT *, CASE a[1] WHEN 'l' THEN x WHEN 'r' THEN x - w ELSE x - w // 2 END AS l0,
      CASE a[2] WHEN 't' THEN y WHEN 'b' THEN y - 12 ELSE y - 6 END AS t0 FROM p)
    SELECT ann_id, a AS align, x, y, l0 + 16 AS l, t0 AS t, l0 + w - 8 AS r, t0 + 12 AS b FROM q"""
)
def align_in_cell(t: Tables) -> DataFrame:
    cells = boxes(t).select("ann_id", "l", "t", (C("r") + 60).alias("r"), (C("b") + 30).alias("b"), F.concat(F.lit("  "), "content", F.lit(" ")).alias("s"), pick(C("l") + C("t"), 91, ALIGNS).alias("align"))
    x, y = g.align_in_cell(C("align"), C("l"), C("t"), C("r"), C("b"), [2, 4, 6, 8])
    placed = cells.select("ann_id", "s", "align", x.alias("x"), y.alias("y"))
    box = g.text_in_cell(C("s"), 8, C("align"), C("x"), C("y"), F.lit(12))
    return placed.select("ann_id", "align", "x", "y", *[v.cast("bigint").alias(k) for k, v in zip("ltrb", box, strict=True)])


@query(
    f"""WITH w AS (SELECT ann_id, l, t, r, b, {draw_sql('image_id * 100 + l + t', 92)} % (greatest(l - 3, 0) + 1) AS wl,
      {draw_sql('image_id * 100 + l + t', 93)} % (greatest(t - 3, 0) + 1) AS wt,
      r + 3 + {draw_sql('image_id * 100 + l + t', 94)} % (greatest(499 - r - 3, 0) + 1) AS wr,
      b + 3 + {draw_sql('image_id * 100 + l + t', 95)} % (greatest(899 - b - 3, 0) + 1) AS wb FROM boxes)
    SELECT ann_id, wl, wt, wr, wb, l - wl AS x1, t - wt AS y1, r - wl AS x2, t - wt AS y2, r - wl AS x3, b - wt AS y3, l - wl AS x4,
      b - wt AS y4 FROM w"""
)
def crop_points(t: Tables) -> DataFrame:
    window = g.crop_window(C("quad"), 500, 900, 3, C("image_id") * 100 + C("l") + C("t"), 92)
    cut = quads(t).withColumn("w", window).withColumn("q", g.shift_points(C("quad"), -C("w.l"), -C("w.t")))
    names = ["wl", "wt", "wr", "wb"]
    return spread(cut.select("ann_id", "q", *[C(f"w.{n[1]}").alias(n) for n in names]), C("q"), "ann_id", *names, digits=False)


@query(
    f"""WITH p AS (SELECT p_partkey, {integer_sql('p_partkey', 96, 0, 300)} AS x, {integer_sql('p_partkey', 97, 0, 600)} AS y, 60 + p_size AS w,
      40 + p_size % 7 AS h, {integer_sql('p_partkey', 98, 0, 45)} AS a, p_partkey % 2 = 0 AS o FROM part),
    q AS (SELECT *, CAST(trunc(h * abs(sin(radians(a))) + w * abs(cos(radians(a))) + CAST(1e-9 AS DOUBLE)) AS BIGINT) AS cw,
      CAST(trunc(h * abs(cos(radians(a))) + w * abs(sin(radians(a))) + CAST(1e-9 AS DOUBLE)) AS BIGINT) AS ch FROM p)
    SELECT p_partkey, x + CASE WHEN o THEN CAST(floor((cw - w) / 2) AS BIGINT) ELSE 0 END AS l, y + CASE WHEN o THEN CAST(floor((ch - h) / 2) AS BIGINT) ELSE 0 END AS t,
      x + CASE WHEN o THEN CAST(floor((cw - w) / 2) AS BIGINT) + w ELSE cw END AS r, y + CASE WHEN o THEN CAST(floor((ch - h) / 2) AS BIGINT) + h ELSE ch END AS b FROM q"""
)
def stamp_box(t: Tables) -> DataFrame:
    key, size = C("p_partkey"), C("p_size").cast("bigint")
    box = g.stamp_box(integer(key, 96, 0, 300), integer(key, 97, 0, 600), 60 + size, 40 + size % 7, integer(key, 98, 0, 45), key % 2 == 0)
    return t.part.select("p_partkey", *[v.cast("bigint").alias(k) for k, v in zip("ltrb", box, strict=True)])


@query(
    """WITH p AS (SELECT ann_id, l, t, r, b, lead(l) OVER w AS l2, lead(t) OVER w AS t2, lead(r) OVER w AS r2, lead(b) OVER w AS b2 FROM boxes
      WINDOW w AS (PARTITION BY image_id ORDER BY t, l, ann_id))
    SELECT ann_id, (t2 <= (t + b) // 2 AND (t + b) // 2 <= b2) OR (t <= (t2 + b2) // 2 AND (t2 + b2) // 2 <= b) AS same_row,
      (l2 <= (l + r) // 2 AND (l + r) // 2 <= r2) OR (l <= (l2 + r2) // 2 AND (l2 + r2) // 2 <= r) AS same_col,
      (l + r) // 2 BETWEEN l2 AND r2 AND (t + b) // 2 BETWEEN t2 AND b2 AS inside FROM p WHERE l2 IS NOT NULL"""
)
def centre_overlap(t: Tables) -> DataFrame:
    """Each box against the next one in reading order."""
    after = scan(boxes(t), ["image_id"], structure.band("t"), ["t", "l", "ann_id"], next={f"{k}2": C(k) for k in "ltrb"}).where(C("l2").isNotNull())
    x, y = F.floor((C("l") + C("r")) / 2), F.floor((C("t") + C("b")) / 2)
    inside = x.between(C("l2"), C("r2")) & y.between(C("t2"), C("b2"))
    row, col = (g.centre_inside(C(a), C(b), C(f"{a}2"), C(f"{b}2")) for a, b in ("tb", "lr"))
    return after.select("ann_id", row.alias("same_row"), col.alias("same_col"), inside.alias("inside"))


@query(
    """WITH v AS (SELECT vec_id, label % 4 AS k, list_transform(embedding[1:4], lambda x: least(abs(CAST(x AS DOUBLE)) / 2, 0.5)) AS e FROM embeddings)
    SELECT vec_id, CAST(CASE k WHEN 1 THEN trunc(e[1] * 255) WHEN 2 THEN trunc(e[1] * 255) WHEN 3 THEN trunc((1 - (e[1] + e[4])) * 255) ELSE 0 END AS BIGINT) AS red,
      CAST(CASE k WHEN 1 THEN trunc(e[1] * 255) WHEN 2 THEN trunc(e[2] * 255) WHEN 3 THEN trunc((1 - (e[2] + e[4])) * 255) ELSE 0 END AS BIGINT) AS green,
      CAST(CASE k WHEN 1 THEN trunc(e[1] * 255) WHEN 2 THEN trunc(e[3] * 255) WHEN 3 THEN trunc((1 - (e[3] + e[4])) * 255) ELSE 0 END AS BIGINT) AS blue FROM v"""
)
def css_colour(t: Tables) -> DataFrame:
    """Grey, rgb and cmyk colours from the first numbers of a vector; no number is black."""
    size = F.element_at(F.array(*map(F.lit, (0, 1, 3, 4))), (C("label") % 4 + 1).cast("int"))
    parts = F.slice(F.transform("embedding", lambda x: F.least(F.abs(x.cast("double")) / 2, F.lit(0.5))), F.lit(1), size)
    colour = g.css_colour(F.when(size > 0, parts))
    return t.embeddings.select("vec_id", *[colour[i].cast("bigint").alias(c) for i, c in enumerate(("red", "green", "blue"))])
