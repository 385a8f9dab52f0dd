"""Queries over recovered table structure and collisions of boxes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import Tables, boxes, query
from docsynth.operators import overlap, structure
from docsynth.operators.ordered import number_rows
from docsynth.plans.recovery import Recovery, over_pages


def recovered(t: Tables, step: Callable[[Recovery], DataFrame]) -> DataFrame:
    return over_pages(boxes(t), step)


@query("SELECT image_id, ann_id, row_number() OVER (PARTITION BY image_id ORDER BY t, l, ann_id) AS seq FROM boxes")
def reading_order(t: Tables) -> DataFrame:
    return structure.reading_order(boxes(t)).select("image_id", "ann_id", "seq")


@query("SELECT image_id, ann_id, row_no FROM line_boxes")
def row_clusters(t: Tables) -> DataFrame:
    return structure.row_clusters(boxes(t)).select("image_id", "ann_id", "row_no")


@query("SELECT image_id, cols_max FROM col_max")
def column_count(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: structure.column_count(pages.sizes))


@query("SELECT image_id, ann_id, col_no FROM col_boxes")
def column_clusters(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.column_texts).select("image_id", "ann_id", "col_no")


@query("SELECT * FROM padded")
def column_padding(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.padded_columns)


@query("SELECT * FROM row_ext")
def row_extents(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.extents)


HIDDEN = """(SELECT image_id, row_no, l, top AS t, r, top + avg_h AS b FROM (SELECT x.image_id, row_no, l, r, avg_h, t - pb AS gap,
    (pb + t) // 2 - avg_h // 2 AS top FROM (SELECT *, lag(b) OVER (PARTITION BY image_id ORDER BY row_no) AS pb FROM row_ext) x
    JOIN (SELECT image_id, CAST(floor(sum(b - t) / count(*)) AS BIGINT) AS avg_h FROM row_ext GROUP BY image_id) m
    ON x.image_id = m.image_id) WHERE gap > avg_h)"""


@query(f"SELECT * FROM {HIDDEN}")
def hidden_rows(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.hidden)


ADDED = f"(SELECT *, 0 AS inserted FROM row_ext UNION ALL SELECT *, 1 AS inserted FROM {HIDDEN})"


@query(
    f"""SELECT image_id, row_no, CAST(inserted AS BIGINT) AS inserted, t, b, row_number() OVER (PARTITION BY image_id ORDER BY t, inserted, row_no) AS seq
    FROM {ADDED}"""
)
def add_rows(t: Tables) -> DataFrame:
    placed = number_rows(recovered(t, lambda pages: pages.all_rows), ["image_id"], structure.band("t"), ["t", "inserted", "row_no"], "seq")
    return placed.select("image_id", "row_no", "inserted", "t", "b", "seq")


TRIMMED = f"""(SELECT image_id, row_no, l, t, r, b, CAST(inserted AS BIGINT) AS inserted FROM (SELECT *, row_number() OVER (PARTITION BY image_id
    ORDER BY inserted, row_no) AS k, count(*) OVER (PARTITION BY image_id) AS n FROM {ADDED}) WHERE k > 2 AND k <= n - 1)"""


@query(f"SELECT * FROM {TRIMMED}")
def trim_rows(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.trimmed)


HEIGHTS = f"""(SELECT image_id, seq, l, t2 AS t, r, coalesce(lead(t2) OVER (PARTITION BY image_id ORDER BY seq), b2) AS b FROM
    (SELECT image_id, seq, l, r, t - coalesce(above, below, 0) AS t2, b + coalesce(below, above, 0) AS b2 FROM (SELECT *,
      row_number() OVER w AS seq, CAST(floor((t - lag(b) OVER w) / 2) AS BIGINT) AS above,
      CAST(floor((lead(t) OVER w - b) / 2) AS BIGINT) AS below FROM {TRIMMED}
      WINDOW w AS (PARTITION BY image_id ORDER BY t, inserted, row_no))))"""


@query(f"SELECT * FROM {HEIGHTS}")
def row_heights(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.final_rows)


@query("SELECT * FROM grid")
def grid_cells(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.full_cells).select("image_id", "row_no", "col_no", "l", "t", "r", "b")


@query("SELECT * FROM assigned")
def assign_text_to_cell(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: structure.assign_text_to_cell(pages.boxes, pages.full_cells, pages.whole))


@query(
    "SELECT image_id, ann_id FROM boxes WHERE ann_id NOT IN (SELECT ann_id FROM assigned)"
)
def texts_outside_cells(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: structure.texts_outside_cells(pages.boxes, pages.full_cells, pages.whole)).select("image_id", "ann_id")


@query(
    """WITH tab AS (SELECT image_id, CAST(row_no > 8 AS BIGINT) AS table_no, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b
      FROM line_boxes GROUP BY ALL)
    SELECT x.image_id, x.ann_id, tab.table_no FROM boxes x JOIN tab ON x.image_id = tab.image_id AND x.l >= tab.l AND x.t >= tab.t
      AND x.r <= tab.r AND x.b <= tab.b"""
)
def cells_in_tables(t: Tables) -> DataFrame:
    rows = structure.row_clusters(boxes(t)).withColumn("table_no", (F.col("row_no") > 8).cast("bigint"))
    tables = structure.bounding_union(rows, "image_id", "table_no")
    return structure.cells_in_tables(boxes(t), tables).select("image_id", "ann_id", "table_no")


@query("SELECT image_id, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM boxes GROUP BY image_id")
def bounding_union(t: Tables) -> DataFrame:
    return structure.bounding_union(boxes(t), "image_id")


@query(
    """SELECT image_id, max(r) - min(l) AS width, max(b) - min(t) AS height FROM boxes GROUP BY image_id
    HAVING max(r) - min(l) >= 110 AND max(b) - min(t) >= 110"""
)
def min_size_filter(t: Tables) -> DataFrame:
    size = structure.bounding_union(boxes(t), "image_id").select(
        "image_id", (F.col("r") - F.col("l")).alias("width"), (F.col("b") - F.col("t")).alias("height")
    )
    return size.where((F.col("width") >= 110) & (F.col("height") >= 110))


@query(
    """SELECT image_id, height, cnt FROM (SELECT image_id, b - t AS height, count(*) AS cnt, min((t, l, ann_id)) AS seen FROM boxes
    GROUP BY image_id, b - t) QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY cnt DESC, seen) = 1"""
)
def modal_value(t: Tables) -> DataFrame:
    return structure.modal_height(boxes(t), F.col("b") - F.col("t"), "height")


@query(
    """SELECT image_id, content, cnt FROM (SELECT image_id, content, count(*) AS cnt, min((t, l, ann_id)) AS seen FROM boxes
    GROUP BY image_id, content) QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY cnt DESC, seen) = 1"""
)
def top1(t: Tables) -> DataFrame:
    return structure.modal_height(boxes(t), F.col("content"), "content")


@query(
    """WITH d AS (SELECT image_id, ann_id, b - t AS h, CASE WHEN r % 2 = 0 THEN reverse(content) ELSE content END AS c FROM boxes),
    m AS (SELECT image_id, CAST(floor(avg(h) FILTER (regexp_matches(c, '^[0-9,)(]'))) AS BIGINT) AS mean FROM d GROUP BY image_id)
    SELECT d.image_id, ann_id, CASE WHEN regexp_matches(c, '^[0-9,)(-]') THEN coalesce(mean + 3, h) ELSE h END AS font_size
    FROM d JOIN m ON d.image_id = m.image_id"""
)
def digit_height_avg(t: Tables) -> DataFrame:
    mixed = F.when(F.col("r") % 2 == 0, F.reverse("content")).otherwise(F.col("content"))
    return structure.digit_heights(boxes(t).withColumn("content", mixed)).select("image_id", "ann_id", "font_size")


@query(
    """SELECT image_id, ann_id, dense_rank() OVER (PARTITION BY image_id ORDER BY t) AS "row",
    row_number() OVER (PARTITION BY image_id, t ORDER BY l, ann_id) AS col FROM boxes"""
)
def cells_to_rows(t: Tables) -> DataFrame:
    return structure.cells_to_rows(boxes(t)).select("image_id", "ann_id", "row", "col")


@query(
    """SELECT a.image_id, a.row_no, a.col_no, a.content, row_number() OVER (PARTITION BY a.image_id, a.row_no, a.col_no
    ORDER BY x.t, x.l, x.ann_id) AS line_no FROM assigned a JOIN boxes x ON a.ann_id = x.ann_id"""
)
def cell_texts(t: Tables) -> DataFrame:
    out = recovered(t, lambda pages: structure.cell_texts(pages.assigned, pages.boxes, pages.whole))
    return out.select("image_id", "row_no", "col_no", "content", "line_no")


@query(
    """WITH f AS (SELECT a.image_id, a.row_no, a.col_no, arg_min(x.content, (x.t, x.l, x.ann_id)) AS text FROM assigned a
      JOIN boxes x ON a.ann_id = x.ann_id GROUP BY ALL)
    SELECT g.image_id, g.row_no, string_agg(coalesce(text, ' '), '|' ORDER BY g.col_no) AS texts FROM grid g LEFT JOIN f
      ON g.image_id = f.image_id AND g.row_no = f.row_no AND g.col_no = f.col_no GROUP BY g.image_id, g.row_no"""
)
def cells_to_rows_text(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: structure.cells_to_rows_text(pages.full_cells, pages.assigned, pages.boxes, pages.whole))


@query(
    """SELECT image_id, maxw // (maxw // minw) AS unit_w, minh - minh % 2 AS unit_h FROM (SELECT image_id, min(r - l) AS minw,
    max(r - l) AS maxw, min(b - t) AS minh FROM boxes GROUP BY image_id)"""
)
def grid_unit(t: Tables) -> DataFrame:
    w, h = F.col("r") - F.col("l"), F.col("b") - F.col("t")
    spans = boxes(t).groupBy("image_id").agg(F.min(w).alias("minw"), F.max(w).alias("maxw"), F.min(h).alias("minh"))
    unit = F.floor(F.col("maxw") / F.floor(F.col("maxw") / F.col("minw")))
    return spans.select("image_id", unit.alias("unit_w"), (F.col("minh") - F.col("minh") % 2).alias("unit_h"))


@query(
    """WITH x AS (SELECT *, content LIKE 'R%' AS is_text, CAST(sum(CASE WHEN content LIKE 'R%' THEN 1 ELSE 0 END) OVER
      (PARTITION BY image_id ORDER BY t, l, ann_id) AS BIGINT) AS table_no FROM boxes)
    SELECT image_id, table_no, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM x WHERE NOT is_text GROUP BY image_id, table_no"""
)
def table_extent(t: Tables) -> DataFrame:
    return structure.table_extents(boxes(t), F.col("content").startswith("R"))


@query(
    """SELECT image_id, row_no, CASE WHEN col_no BETWEEN 2 AND 3 THEN 2 ELSE col_no END AS col_no, min(l) AS l, min(t) AS t,
    max(r) AS r, max(b) AS b, count(*) AS n_texts FROM grid GROUP BY ALL"""
)
def merge_cells(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: structure.merge_cells(pages.full_cells, "col_no", 2, 3, F.count(F.lit(1))))


@query(
    """WITH rows_ AS (SELECT image_id, min(t) AS top, max(b) AS bottom FROM row_ext GROUP BY image_id)
    SELECT c.image_id, c.col_no, c.l, r.top AS t, c.r, r.bottom AS b FROM table_cols c JOIN rows_ r ON c.image_id = r.image_id"""
)
def column_extents(t: Tables) -> DataFrame:
    def extents(pages: Recovery) -> DataFrame:
        span = pages.extents.groupBy("image_id").agg(F.min("t").alias("t"), F.max("b").alias("b"))
        return pages.columns.drop("t", "b").join(span, "image_id").select("image_id", "col_no", "l", "t", "r", "b")

    return recovered(t, extents)


# ---------------------------------------------------------------- collisions

CROSS = "x.l < y.r AND y.l < x.r AND x.t < y.b AND y.t < x.b"
SIMILAR = """abs((x.r - x.l) * (x.b - x.t) - (y.r - y.l) * (y.b - y.t)) <=
    greatest((x.r - x.l) * (x.b - x.t), (y.r - y.l) * (y.b - y.t)) * CAST(0.1 AS DOUBLE)"""


@query(
    f"""WITH d AS (SELECT image_id, l, t, r, b, count(*) AS copies FROM boxes GROUP BY ALL)
    SELECT x.image_id, x.l, x.t, x.r, x.b, x.copies,
      x.copies > 1 OR bool_or({CROSS} AND (x.l, x.t, x.r, x.b) <> (y.l, y.t, y.r, y.b)) AS "any",
      x.copies > 1 OR bool_or({CROSS} AND (x.l, x.t, x.r, x.b) <> (y.l, y.t, y.r, y.b) AND {SIMILAR}) AS similar,
      x.copies > 1 OR bool_or((x.l, x.t, x.r, x.b) <> (y.l, y.t, y.r, y.b) AND (({CROSS}) OR
        (y.l >= x.l AND y.r <= x.r AND y.t >= x.t AND y.b <= x.b) OR (y.l <= x.l AND y.r >= x.r AND y.t <= x.t AND y.b >= x.b)))
        AS nested
    FROM d x JOIN d y ON x.image_id = y.image_id GROUP BY x.image_id, x.l, x.t, x.r, x.b, x.copies"""
)
def overlaps(t: Tables) -> DataFrame:
    return overlap.overlaps(boxes(t))


@query("SELECT DISTINCT image_id, l, t, r, b FROM boxes")
def distinct_boxes(t: Tables) -> DataFrame:
    return boxes(t).select("image_id", "l", "t", "r", "b").distinct()


AREA = "({0}.r - {0}.l) * ({0}.b - {0}.t)"


@query(
    f"""WITH RECURSIVE d AS (SELECT image_id, l, t, r, b, min(ann_id) AS ann_id FROM boxes GROUP BY image_id, l, t, r, b),
    o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY t, l, ann_id) AS k FROM d),
    s AS (SELECT image_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(ann_id VARCHAR, l BIGINT, t BIGINT, r BIGINT, b BIGINT)[]) AS kept
        FROM (SELECT DISTINCT image_id FROM o)
      UNION ALL SELECT s.image_id, o.k, CASE WHEN len(list_filter(kept, lambda x: x.l < o.r AND o.l < x.r AND x.t < o.b AND o.t < x.b
        AND abs({AREA.format('x')} - {AREA.format('o')}) <= greatest({AREA.format('x')}, {AREA.format('o')}) * CAST(0.1 AS DOUBLE))) = 0
        THEN list_append(kept, {{'ann_id': o.ann_id, 'l': o.l, 't': o.t, 'r': o.r, 'b': o.b}}) ELSE kept END
      FROM s JOIN o ON o.image_id = s.image_id AND o.k = s.k + 1),
    e AS (SELECT image_id, max(k) AS k FROM o GROUP BY image_id)
    SELECT image_id, x.ann_id AS ann_id, x.l AS l, x.t AS t, x.r AS r, x.b AS b FROM (SELECT s.image_id, unnest(kept) AS x FROM s
      JOIN e ON e.image_id = s.image_id AND e.k = s.k)"""
)
def dedupe_boxes(t: Tables) -> DataFrame:
    return overlap.dedupe_boxes(boxes(t).drop("content"), ["t", "l"])


ORDER_BOXES = """(SELECT DISTINCT split_part(ann_id, '-', 1) AS image_id, l, t, r, b FROM boxes)"""


@query(
    f"""WITH d AS {ORDER_BOXES},
    u AS (SELECT image_id, min(l) AS ul, min(t) AS ut, max(r) AS ur, max(b) AS ub FROM d GROUP BY image_id),
    xs AS (SELECT image_id, l AS x FROM d UNION SELECT image_id, r FROM d),
    st AS (SELECT p.image_id, p.x AS sl, q.x AS sr FROM xs p JOIN xs q ON p.image_id = q.image_id AND p.x < q.x),
    ob AS (SELECT st.*, d.t, d.b FROM st JOIN d ON st.image_id = d.image_id AND d.l < sr AND d.r > sl
      UNION ALL SELECT st.*, ub, ub FROM st JOIN u ON st.image_id = u.image_id),
    sp AS (SELECT ob.image_id, sl, sr, t AS lo, coalesce(max(b) OVER (PARTITION BY ob.image_id, sl, sr ORDER BY t, b
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ut) AS hi FROM ob JOIN u ON ob.image_id = u.image_id)
    SELECT image_id, (sr - sl) * (lo - hi) AS area, sl AS l, hi AS t, sr AS r, lo AS b FROM sp WHERE lo > hi
    QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY (sr - sl) * (lo - hi) DESC, sl DESC, sr DESC, hi DESC, lo DESC) = 1"""
)
def largest_gap(t: Tables) -> DataFrame:
    by_order = boxes(t).withColumn("image_id", F.substring_index("ann_id", "-", 1))
    return overlap.largest_gap(by_order)


@query(
    f"""WITH heights AS MATERIALIZED (SELECT * FROM {HEIGHTS}),
    cells AS MATERIALIZED (SELECT h.image_id, h.seq AS row_no, c.col_no, c.l, h.t, c.r, h.b FROM heights h JOIN padded c
      ON h.image_id = c.image_id),
    a AS MATERIALIZED (SELECT x.image_id, x.ann_id, x.content, c.row_no, c.col_no FROM boxes x JOIN cells c ON x.image_id = c.image_id
      AND (x.l + x.r) // 2 BETWEEN c.l AND c.r AND (x.t + x.b) // 2 BETWEEN c.t AND c.b
      QUALIFY row_number() OVER (PARTITION BY x.ann_id ORDER BY c.row_no, c.col_no) = 1)
    SELECT c.*, a.ann_id, a.content FROM cells c LEFT JOIN a ON c.image_id = a.image_id AND c.row_no = a.row_no
      AND c.col_no = a.col_no"""
)
def table_recovery(t: Tables) -> DataFrame:
    return recovered(t, lambda pages: pages.table).select("image_id", "row_no", "col_no", "l", "t", "r", "b", "ann_id", "content")
