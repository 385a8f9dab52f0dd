"""Text tables, reports' layout and record shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import Tables, boxes, draw_sql, hierarchy, integer_sql, pick_sql, query, uniform_sql
from docsynth.functions.binding import let
from docsynth.operators import records, tables
from docsynth.operators.ordered import number_rows
from docsynth.operators.records import BOLD, OPTIONAL, SHADED, SYNONYMS
from docsynth.rng import draw, integer, pick, uniform

C = F.col


def customer_rows(t: Tables) -> DataFrame:
    """One table per nation, one row per customer."""
    base = t.customer.select(
        C("c_nationkey").cast("bigint").alias("table_id"),
        "c_custkey",
        F.array("c_name", "c_mktsegment", F.floor("c_acctbal").cast("string")).alias("cells"),
    )
    return number_rows(base, ["table_id"], {"block": F.floor(C("c_custkey") / 4096)}, ["c_custkey"], "row_no")


ROWS = """(SELECT CAST(c_nationkey AS BIGINT) AS table_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_no,
    c_custkey, c_name AS a, c_mktsegment AS b, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS c FROM customer)"""
WIDTHS = f"(SELECT table_id, max(length(a)) AS wa, max(length(b)) AS wb, max(length(c)) AS wc, max(row_no) AS n FROM {ROWS} GROUP BY table_id)"
DRAWN = f"""(SELECT r.table_id, row_no * 2 - 1 AS line_no, CASE WHEN row_no = 1 THEN '╔' ELSE '╠' END || repeat('═', wa) ||
    CASE WHEN row_no = 1 THEN '╦' ELSE '╬' END || repeat('═', wb) || CASE WHEN row_no = 1 THEN '╦' ELSE '╬' END || repeat('═', wc) ||
    CASE WHEN row_no = 1 THEN '╗' ELSE '╣' END AS line FROM {ROWS} r JOIN {WIDTHS} w ON r.table_id = w.table_id UNION ALL
    SELECT r.table_id, row_no * 2, '║' || rpad(a, CAST(wa AS INTEGER), ' ') || '║' || rpad(b, CAST(wb AS INTEGER), ' ') || '║' ||
      rpad(c, CAST(wc AS INTEGER), ' ') || '║' FROM {ROWS} r JOIN {WIDTHS} w ON r.table_id = w.table_id UNION ALL
    SELECT table_id, n * 2 + 1, '╚' || repeat('═', wa) || '╩' || repeat('═', wb) || '╩' || repeat('═', wc) || '╝' FROM {WIDTHS})"""


def drawn(t: Tables) -> DataFrame:
    rows = customer_rows(t).select("table_id", "row_no", "cells")
    return tables.render(rows, tables.column_widths(rows))


TARGETS = f"""(SELECT table_id, wa + wb + wc + 4 AS total, [wa, wb, wc] AS ws FROM
    (SELECT table_id, least(greatest(wa, 8), 30) AS wa, least(greatest(wb, 8), 30) AS wb, least(greatest(wc, 8), 30) AS wc FROM {WIDTHS}))"""


@query(
    f"""SELECT table_id, CAST(i AS BIGINT) AS col_no, CAST(ws[i + 1] + sign(target - total) * (abs(target - total) // 3 +
    CASE WHEN i < abs(target - total) % 3 THEN 1 ELSE 0 END) AS BIGINT) AS width FROM (SELECT *, 40 + table_id % 20 AS target FROM {TARGETS}),
    (VALUES (0), (1), (2)) AS v(i)"""
)
def column_widths(t: Tables) -> DataFrame:
    rows = customer_rows(t)
    return tables.fit_widths(tables.column_widths(rows, 8, 30), 40 + C("table_id") % 20)


@query(
    f"""SELECT table_id, CAST(i AS BIGINT) AS col_no, CAST(ws[i + 1] + (target - total) // 3 + CASE WHEN i < (target - total) % 3 THEN 1
    ELSE 0 END AS BIGINT) AS width FROM (SELECT *, max(total) OVER (PARTITION BY table_id % 5) AS target FROM {TARGETS}),
    (VALUES (0), (1), (2)) AS v(i)"""
)
def equal_table_width(t: Tables) -> DataFrame:
    widths = tables.column_widths(customer_rows(t), 8, 30)
    stack = t.nation.select(C("n_nationkey").cast("bigint").alias("table_id"), (C("n_nationkey") % 5).alias("stack_id"))
    return tables.equal_table_width(widths, stack)


@query(f"SELECT * FROM {DRAWN}")
def render_text_table(t: Tables) -> DataFrame:
    return drawn(t)


@query(
    f"""SELECT * FROM {DRAWN} UNION ALL SELECT table_id, 0, repeat(' ', greatest(wa + wb + wc + 4 - length(n_name), 0) // 2) || n_name
    FROM {WIDTHS} JOIN nation ON n_nationkey = table_id"""
)
def titled_table(t: Tables) -> DataFrame:
    titles = t.nation.select(C("n_nationkey").cast("bigint").alias("table_id"), C("n_name").alias("title"))
    return tables.titled(drawn(t), titles, "t")


CELLS = f"""(SELECT table_id, row_no * 2 AS line_no, i AS col_no, [rpad(a, CAST(wa AS INTEGER), ' '), rpad(b, CAST(wb AS INTEGER), ' '),
    rpad(c, CAST(wc AS INTEGER), ' ')][i + 1] AS text, [0, wa + 1, wa + wb + 2][i + 1] + 1 AS x, [wa, wb, wc][i + 1] AS w FROM
    (SELECT r.*, wa, wb, wc FROM {ROWS} r JOIN {WIDTHS} w ON r.table_id = w.table_id), (VALUES (0), (1), (2)) AS v(i))"""


@query(f"SELECT table_id, line_no, CAST(col_no AS BIGINT) AS col_no, text FROM {CELLS}")
def parse_text_table(t: Tables) -> DataFrame:
    return tables.parse_text_table(drawn(t))


@query(
    f"""SELECT table_id, line_no, CAST(col_no AS BIGINT) AS col_no, text, x * 12 AS l, (x + w) * 12 AS r, (line_no - 1) * 30 + 15 AS t,
    (line_no + 1) * 30 + 15 AS b FROM {CELLS}"""
)
def cell_positions(t: Tables) -> DataFrame:
    return tables.cell_positions(drawn(t), 24, 30)


@query(
    f"""SELECT table_id, line_no, CASE WHEN line_no = 2 THEN line[1] || translate(line[2:length(line) - 1], '║', ' ') || line[length(line)]
    ELSE line END AS line FROM {DRAWN} WHERE line NOT LIKE '╠%'"""
)
def edit_text_table(t: Tables) -> DataFrame:
    kept = tables.drop_inner_rules(drawn(t))
    merged = F.when(C("line_no") == 2, tables.merge_row(C("line"))).otherwise(C("line"))
    return kept.withColumn("line", merged)


def body_sql(b: str, c: str) -> str:
    return f"'║' || rpad(a, CAST(wa AS INTEGER), ' ') || '║' || {b} || '║' || {c} || '║'"


PADDED_B, PADDED_C = "rpad(b, CAST(wb AS INTEGER), ' ')", "rpad(c, CAST(wc AS INTEGER), ' ')"


def aligned_sql(side: str) -> str:
    """The second cell drawn anew from its value: a rule of its own, not an edit of the line."""
    half = "(wb - length(b)) // 2"
    left = {"l": "1", "r": "wb - length(b) - 1", "c": half}[side]
    return f"CASE WHEN length(b) < wb THEN rpad(repeat(' ', CAST({left} AS INTEGER)) || b, CAST(wb AS INTEGER), ' ') ELSE b END"


@query(
    "SELECT d.table_id, d.line_no, side, CASE WHEN d.line_no % 2 = 1 THEN d.line "
    + " ".join(f"WHEN side = '{x}' THEN {body_sql(aligned_sql(x), PADDED_C)}" for x in "lrc")
    + f""" END AS line FROM {DRAWN} d JOIN {WIDTHS} w ON d.table_id = w.table_id
    LEFT JOIN {ROWS} r ON r.table_id = d.table_id AND r.row_no * 2 = d.line_no, (VALUES ('l'), ('r'), ('c')) AS v(side)"""
)
def align_column(t: Tables) -> DataFrame:
    line = C("line")
    sides = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), tables.align_column(line, 1, x).alias("line")) for x in "lrc"]))
    return drawn(t).select("table_id", "line_no", sides.alias("s")).select("table_id", "line_no", "s.*")


@query(
    f"""SELECT d.table_id, d.line_no, side, CASE WHEN d.line_no % 2 = 0 THEN {body_sql(PADDED_B, "repeat(' ', b4) || " + PADDED_C + " || repeat(' ', 5 - b4)")}
    ELSE left(d.line, length(d.line) - 1) || '═════' || right(d.line, 1) END AS line FROM {DRAWN} d JOIN {WIDTHS} w ON d.table_id = w.table_id
    LEFT JOIN {ROWS} r ON r.table_id = d.table_id AND r.row_no * 2 = d.line_no, (VALUES ('l', 0), ('r', 5), ('m', 2)) AS v(side, b4)"""
)
def widen_table(t: Tables) -> DataFrame:
    line = C("line")
    sides = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), tables.widen(line, 5, x).alias("line")) for x in "lrm"]))
    return drawn(t).select("table_id", "line_no", sides.alias("s")).select("table_id", "line_no", "s.*")


BLANK = "'║' || repeat(' ', wa) || '║' || repeat(' ', wb) || '║' || repeat(' ', wc) || '║'"


@query(
    f"""SELECT table_id, 't' AS side, line_no + CASE WHEN line LIKE '╚%' THEN 2 ELSE 0 END AS line_no, line FROM {DRAWN} UNION ALL
    SELECT table_id, 't', n * 2 + 1 + i, {BLANK} FROM {WIDTHS}, (VALUES (0), (1)) AS v(i) UNION ALL
    SELECT table_id, 'b', line_no + CASE WHEN line LIKE '╔%' THEN 0 ELSE 2 END, line FROM {DRAWN} UNION ALL
    SELECT table_id, 'b', 2 + i, {BLANK} FROM {WIDTHS}, (VALUES (0), (1)) AS v(i)"""
)
def heighten_table(t: Tables) -> DataFrame:
    rows = [tables.heighten(drawn(t), 2, x).select("table_id", F.lit(x).alias("side"), "line_no", "line") for x in "tb"]
    return rows[0].unionByName(rows[1])


HEIGHT = "1 + c_custkey % 3"


@query(
    f"""WITH RECURSIVE h AS (SELECT table_id, row_no, {HEIGHT} AS height FROM {ROWS}),
    p AS (SELECT table_id, row_no, height AS fill, CAST(1 AS BIGINT) AS page FROM h WHERE row_no = 1 UNION ALL
      SELECT h.table_id, h.row_no, CASE WHEN p.fill >= 7 THEN h.height ELSE p.fill + h.height END,
        p.page + CASE WHEN p.fill >= 7 THEN 1 ELSE 0 END FROM p JOIN h ON h.table_id = p.table_id AND h.row_no = p.row_no + 1)
    SELECT table_id, row_no, page FROM p"""
)
def paginate(t: Tables) -> DataFrame:
    return tables.paginate(customer_rows(t).withColumn("height", 1 + C("c_custkey") % 3), 7)


@query(
    f"""WITH e AS (SELECT table_id AS page_id, row_no AS rn, b = 'BUILDING' AS is_title, 20 + c_custkey % 5 * 10 AS height FROM {ROWS}),
    s AS (SELECT *, CAST(sum(height + 6) OVER (PARTITION BY page_id ORDER BY rn) AS BIGINT) AS fin FROM e),
    f AS (SELECT * FROM s WHERE fin - 6 <= 700),
    z AS (SELECT page_id, max(fin) AS used, arg_max(is_title, rn) AS tl, max(rn) AS lst FROM f GROUP BY page_id)
    SELECT f.page_id, rn, fin - 6 - height AS top, greatest((700 - used + 6) // 36, 0) AS n_texts FROM f JOIN z ON f.page_id = z.page_id
    WHERE NOT (tl AND rn = lst)"""
)
def page_fill(t: Tables) -> DataFrame:
    blocks = customer_rows(t).select(
        C("table_id").alias("page_id"),
        C("row_no").alias("rn"),
        (C("cells")[1] == "BUILDING").alias("is_title"),
        (20 + C("c_custkey") % 5 * 10).alias("height"),
    )
    return tables.page_fill(blocks, 700, 6, 30)


@query("SELECT image_id, (max(b) - min(t) - 40) // 30 // 2 AS lines_per_page FROM boxes GROUP BY image_id")
def lines_per_page(t: Tables) -> DataFrame:
    room = F.max("b") - F.min("t") - 40
    return boxes(t).groupBy("image_id").agg(F.floor(F.floor(room / 30) / 2).alias("lines_per_page"))


@query(
    f"""SELECT CAST(c_nationkey AS BIGINT) AS table_id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 2 AS row_no,
    c_custkey FROM customer"""
)
def multi_line_cells(t: Tables) -> DataFrame:
    return customer_rows(t).select("table_id", F.floor((C("row_no") - 1) / 2).alias("row_no"), "c_custkey")


@query(
    """SELECT c_custkey, i AS pos, c_name[i] AS ch, (i - 1) * (10 + (400 - length(c_name) * 10) // length(c_name)) AS x
    FROM customer, range(1, 100) AS s(i) WHERE i <= length(c_name)"""
)
def spread_chars(t: Tables) -> DataFrame:
    gap = F.floor((400 - F.length("c_name") * 10) / F.length("c_name"))
    chars = F.posexplode_outer(F.split("c_name", "")).alias("i", "ch")
    return t.customer.select("c_custkey", chars, gap.alias("gap")).select(
        "c_custkey", (C("i") + 1).alias("pos"), "ch", (C("i") * (10 + C("gap"))).alias("x")
    )


@query(f"SELECT table_id, row_no, row_no > 1 AND (row_no - 1) % 2 = 1 AS striped FROM {ROWS}")
def stripe_rows(t: Tables) -> DataFrame:
    striped = (C("row_no") > 1) & (F.pmod(C("row_no") - 1, F.lit(2)) == 1)
    return customer_rows(t).select("table_id", "row_no", striped.alias("striped"))


@query(
    f"""SELECT table_id, row_no, a AS item FROM {ROWS} WHERE row_no <= 30 UNION ALL
    SELECT table_id + 1000, row_no, a FROM {ROWS} WHERE row_no > table_id % 7 AND row_no <= table_id % 7 + 5"""
)
def truncate_table(t: Tables) -> DataFrame:
    rows = customer_rows(t).select("table_id", "row_no", C("cells")[0].alias("item"))
    start = C("table_id") % 7
    part = rows.where((C("row_no") > start) & (C("row_no") <= start + 5)).withColumn("table_id", C("table_id") + 1000)
    return rows.where(C("row_no") <= 30).unionByName(part)


# ---------------------------------------------------------------- stacked and joined blocks


def info_lines(t: Tables) -> DataFrame:
    return t.nation.select(
        C("n_nationkey").cast("bigint").alias("table_id"), F.lit(1).cast("bigint").alias("line_no"), C("n_name").alias("line")
    )


@query(
    f"""SELECT CAST(n_nationkey AS BIGINT) AS table_id, CAST(1 AS BIGINT) AS block_no, CAST(1 AS BIGINT) AS line_no, n_name AS line
    FROM nation UNION ALL SELECT table_id, 2, line_no, line FROM {DRAWN} UNION ALL
    SELECT CAST(n_nationkey AS BIGINT), 3, 1, 'Annual Report ' || n_name FROM nation"""
)
def stack_tables(t: Tables) -> DataFrame:
    head = info_lines(t)
    foot = head.withColumn("line", F.concat(F.lit("Annual Report "), "line"))
    return tables.stack(head, drawn(t), foot)


@query(
    f"""WITH a AS (SELECT table_id, row_no AS line_no, a AS line FROM {ROWS}),
    b AS (SELECT s_nationkey AS table_id, s_name AS line, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS line_no FROM supplier),
    w AS (SELECT table_id, max(length(line)) AS n FROM a GROUP BY table_id), v AS (SELECT table_id, max(length(line)) AS n FROM b GROUP BY table_id),
    f AS (SELECT coalesce(a.table_id, b.table_id) AS table_id, coalesce(a.line_no, b.line_no) AS line_no, coalesce(a.line, '') AS x,
      coalesce(b.line, '') AS y FROM a FULL JOIN b ON a.table_id = b.table_id AND a.line_no = b.line_no)
    SELECT CAST(f.table_id AS BIGINT) AS table_id, line_no, x || repeat(' ', coalesce(w.n, 0) - length(x)) || y ||
      repeat(' ', coalesce(v.n, 0) - length(y)) AS line FROM f LEFT JOIN w ON f.table_id = w.table_id LEFT JOIN v ON f.table_id = v.table_id"""
)
def side_by_side(t: Tables) -> DataFrame:
    left = customer_rows(t).select("table_id", C("row_no").alias("line_no"), C("cells")[0].alias("line"))
    base = t.supplier.select(C("s_nationkey").cast("bigint").alias("table_id"), "s_suppkey", C("s_name").alias("line"))
    right = number_rows(base, ["table_id"], {"block": F.floor(C("s_suppkey") / 4096)}, ["s_suppkey"], "line_no")
    return tables.side_by_side(left, right.drop("s_suppkey"))


@query(
    f"""WITH m AS (SELECT *, (count(*) OVER (PARTITION BY table_id) + 1) // 2 AS mid FROM {ROWS})
    SELECT x.table_id, x.row_no AS rn, x.a AS "left", y.a AS "right" FROM m x LEFT JOIN m y ON x.table_id = y.table_id
      AND y.row_no = x.row_no + x.mid WHERE x.row_no <= x.mid"""
)
def double_column(t: Tables) -> DataFrame:
    rows = customer_rows(t).select("table_id", C("row_no").alias("rn"), C("cells")[0].alias("item"))
    return tables.double_column(rows)


@query(
    f"""WITH m AS (SELECT *, (count(*) OVER (PARTITION BY table_id) + 1) // 2 AS mid FROM {ROWS})
    SELECT x.table_id, x.row_no AS rn, x.a AS "left", y.a AS "right" FROM m x LEFT JOIN m y ON x.table_id = y.table_id
      AND y.row_no = x.row_no + x.mid WHERE x.row_no <= x.mid"""
)
def double_column_lossless(t: Tables) -> DataFrame:
    rows = customer_rows(t).select("table_id", C("row_no").alias("rn"), C("cells")[0].alias("item"))
    return tables.double_column(rows, lossless=True)


@query(
    """WITH p AS (SELECT statement_no, row_number() OVER (PARTITION BY statement_no ORDER BY section_no, item_no) AS leaf_no, statement,
      section, item FROM hierarchy),
    n AS (SELECT statement_no, 1 AS level, statement AS node, leaf_no FROM p UNION ALL
      SELECT statement_no, 2, statement || '/' || section, leaf_no FROM p UNION ALL
      SELECT statement_no, 3, statement || '/' || section || '/' || item, leaf_no FROM p)
    SELECT CAST(statement_no AS BIGINT) AS statement_no, CAST(level AS BIGINT) AS level, node, min(leaf_no) AS first_leaf,
      count(*) AS span FROM n GROUP BY ALL"""
)
def flatten_header(t: Tables) -> DataFrame:
    leaves = hierarchy(t).withColumn("path", F.array("statement", "section", "item"))
    chunk = {"section": C("section_no"), "block": F.floor(C("item_no") / 4096)}
    return tables.flatten_header(leaves, "statement_no", "path", chunk, ["section_no", "item_no"])


@query(
    """SELECT c_custkey, CAST(i AS BIGINT) AS line_no, CASE i WHEN 0 THEN 'name:' || c_name || '|segment:' || c_mktsegment ELSE
    'nation:' || c_nationkey END AS line FROM customer, (VALUES (0), (1)) AS v(i)"""
)
def key_value_rows(t: Tables) -> DataFrame:
    record = F.create_map(
        F.lit("name"), C("c_name"), F.lit("segment"), C("c_mktsegment"), F.lit("nation"), C("c_nationkey").cast("string")
    )
    return tables.key_value_rows(t.customer, ["c_custkey"], F.map_entries(record), 2)


@query(
    """SELECT c_custkey, CAST(0 AS BIGINT) AS line_no, 'name|segment|nation' AS line FROM customer UNION ALL
    SELECT c_custkey, 1, c_name || '|' || c_mktsegment || '|' || c_nationkey FROM customer"""
)
def header_and_values(t: Tables) -> DataFrame:
    record = F.create_map(
        F.lit("name"), C("c_name"), F.lit("segment"), C("c_mktsegment"), F.lit("nation"), C("c_nationkey").cast("string")
    )
    return tables.header_and_values(t.customer, ["c_custkey"], F.map_entries(record))


@query(
    """SELECT o_orderkey, CAST(i AS BIGINT) AS part, CASE i WHEN 0 THEN o_orderstatus || '|' || o_orderpriority || '|' || o_custkey ELSE
    strftime(o_orderdate, '%Y-%m-%d') || '| | ' END AS line FROM orders, (VALUES (0), (1)) AS v(i)"""
)
def fold_wide_rows(t: Tables) -> DataFrame:
    cells = F.array("o_orderstatus", "o_orderpriority", C("o_custkey").cast("string"), C("o_orderdate").cast("date").cast("string"))
    folded = tables.fold_wide_rows(t.orders, ["o_orderkey"], cells, 3)
    return folded.select("o_orderkey", "part", F.array_join("cells", "|").alias("line"))


@query("SELECT image_id, l // 100 AS row_no, t // 40 AS col_no, content, ann_id FROM boxes")
def transpose(t: Tables) -> DataFrame:
    cells = boxes(t).select("image_id", F.floor(C("t") / 40).alias("r"), F.floor(C("l") / 100).alias("c"), "content", "ann_id")
    return cells.select("image_id", C("c").alias("row_no"), C("r").alias("col_no"), "content", "ann_id")


# ---------------------------------------------------------------- record shaping


@query(
    "SELECT c_custkey, "
    + ", ".join(f"{pick_sql('c_custkey', 60 + i, SYNONYMS[k] + [k])} AS head{i}" for i, k in enumerate(SYNONYMS))
    + " FROM customer"
)
def alias_columns(t: Tables) -> DataFrame:
    heads = [records.alias_of(k, C("c_custkey"), 60 + i).alias(f"head{i}") for i, k in enumerate(SYNONYMS)]
    return t.customer.select("c_custkey", *heads)


# What stands in the optional columns of a ledger row, in turn.
LEDGER_VALUES = ["event_id", "user_id", "event_type", "props"]


@query(
    "SELECT event_id, k, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN {i} < {len(OPTIONAL)} - k THEN '{c}=' || {LEDGER_VALUES[i % 4]} END" for i, c in enumerate(OPTIONAL))
    + f""", '类型=' || event_type], lambda x: x IS NOT NULL), '|') AS record, CASE WHEN k < 14 THEN event_id END AS "应用号",
    CASE WHEN k < 1 THEN user_id END AS "币种" FROM (SELECT *, {integer_sql('event_id', 68, 0, len(OPTIONAL))} AS k FROM events)"""
)
def drop_optional_columns(t: Tables) -> DataFrame:
    """Each row is a record of its own set of columns; columns are read back by name."""
    pairs = [x for i, c in enumerate(OPTIONAL) for x in (F.lit(c), C(LEDGER_VALUES[i % 4]).cast("string"))]
    k = integer(C("event_id"), 68, 0, len(OPTIONAL))
    record = records.drop_optional_columns(F.create_map(*pairs, F.lit("类型"), C("event_type")), k.cast("int"))
    wide = t.events.select("event_id", k.alias("k"), record.alias("r"))
    line = F.array_join(F.transform(F.map_entries("r"), lambda e: F.concat_ws("=", e["key"], e["value"])), "|")
    return wide.select("event_id", "k", line.alias("record"), *[F.try_element_at("r", F.lit(c)).cast("bigint").alias(c) for c in ("应用号", "币种")])


@query("SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO'")
def product_filter(t: Tables) -> DataFrame:
    return t.part.where(C("p_type") == "PROMO").select("p_partkey", "p_name")


@query(
    f"""WITH c AS (SELECT r_regionkey AS id, count(DISTINCT n_nationkey) + count(*) AS r, 3 + r_regionkey AS c FROM hierarchy h
      JOIN region ON r_regionkey = statement_no JOIN nation ON n_nationkey = section_no GROUP BY r_regionkey)
    SELECT CAST(id AS BIGINT) AS id, r, CAST(c AS BIGINT) AS c, zh, CASE WHEN zh THEN {uniform_sql('id', 64)} < 0.5 AND r > 30
      ELSE {uniform_sql('id', 64)} < 0.5 END AS hstack, zh AND {uniform_sql('id', 65)} < 0.5 AND r > 15 AS vstack,
      r >= 30 AND c > 3 AND c < 6 AS paginate, true AS truncate,
      {uniform_sql('id', 66)} < CASE WHEN zh THEN 0.5 ELSE 0.9 END AND c >= 3 AS complex FROM c,
      (VALUES (true), (false)) AS v(zh)"""
)
def layout_dispatch(t: Tables) -> DataFrame:
    per = hierarchy(t).groupBy("statement_no", "section_no").agg((F.count(F.lit(1)) + 1).alias("k"))
    sizes = per.groupBy(C("statement_no").alias("id")).agg(F.sum("k").alias("r")).withColumn("c", 3 + C("id"))
    both = sizes.withColumn("zh", F.explode(F.array(F.lit(True), F.lit(False))))
    return both.select("id", "r", "c", "zh", *[v.alias(k) for k, v in records.layout(C("r"), C("c"), C("zh"), C("id"), 64).items()])


@query(
    f"""SELECT c_custkey, CASE WHEN u < CAST(0.1 AS DOUBLE) THEN ' ' WHEN u < CAST(0.1 AS DOUBLE) + CAST(0.2 AS DOUBLE) THEN '-'
    WHEN u < CAST(0.1 AS DOUBLE) + CAST(0.2 AS DOUBLE) + CAST(0.3 AS DOUBLE) THEN '(' || c_name || ')' ELSE c_name END AS cell FROM
    (SELECT *, {uniform_sql('c_custkey', 67)} AS u FROM customer)"""
)
def inject_missing(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", records.inject_missing(C("c_name"), C("c_custkey"), 67, 0.1, 0.2, 0.3).alias("cell"))


HEADS = ["合计", "一、", "项目一", ""]


@query(
    f"""SELECT s_suppkey, regexp_matches(i, '{BOLD}') AS bold, contains('一二三四五六七八九十', left(i, 1)) AND i <> '' AS shaded FROM (SELECT s_suppkey,
    (['合计', '一、', '项目一', ''])[s_suppkey % 4 + 1] || s_name AS i FROM supplier)"""
)
def pattern_tags(t: Tables) -> DataFrame:
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (C("s_suppkey") % 4 + 1).cast("int"))
    item = F.concat(head, "s_name")
    return t.supplier.select("s_suppkey", item.rlike(BOLD).alias("bold"), item.rlike(SHADED).alias("shaded"))


@query(
    """WITH n AS (SELECT *, string_split(line, ' ') AS ws, regexp_extract_all(line, ' +|$') AS gs FROM (SELECT doc_id, line_no,
      trim(regexp_replace(line, ' +', ' ', 'g')) AS line FROM lines) WHERE line <> '')
    SELECT doc_id, line_no, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM n"""
)
def zip_by_position(t: Tables) -> DataFrame:
    from docsynth.catalog.base import lines

    words = F.regexp_extract_all("line", F.lit("[^ ]+"), F.lit(0))
    gaps = F.regexp_extract_all("line", F.lit(" +|$"), F.lit(0))
    trimmed = lines(t).withColumn("line", F.trim("line")).where(C("line") != "")
    checked = F.when(F.size(words) == F.size(gaps), words).otherwise(F.raise_error(F.lit("words and gaps differ")).cast("array<string>"))
    pairs = let(
        F.arrays_zip(checked.alias("w"), gaps.alias("g")),
        lambda zs: F.transform(zs, lambda z: F.struct(z["w"].alias("word"), F.size(zs).alias("n"))),
    )
    rows = trimmed.select("doc_id", "line_no", F.posexplode_outer(pairs).alias("i", "z"))
    return rows.select("doc_id", "line_no", "z.word", (C("i") + 1).alias("pos"), "z.n")


@query(
    """SELECT o_orderkey, r_name AS by_index, CAST(o_orderkey // 5 % 5 AS BIGINT) AS block_type FROM orders
    JOIN region ON r_regionkey = o_orderkey % 5"""
)
def round_robin(t: Tables) -> DataFrame:
    templates = t.region.select(C("r_regionkey").cast("bigint").alias("slot"), C("r_name").alias("by_index"))
    numbered = t.orders.select("o_orderkey", F.pmod(C("o_orderkey"), F.lit(5)).alias("slot"))
    block = F.pmod(F.floor(C("o_orderkey") / 5), F.lit(5)).alias("block_type")
    return numbered.join(templates, "slot").select("o_orderkey", "by_index", block)


SLOTS = ["name", "segment", "key@title", "image@photo", "height"]


@query(
    """SELECT c_custkey, slot, CASE WHEN slot LIKE 'key@%' OR slot LIKE 'image@%' THEN slot WHEN slot = 'name' THEN c_name
    WHEN slot = 'segment' THEN c_mktsegment ELSE '' END AS filled FROM customer, (VALUES ('name'), ('segment'), ('key@title'),
    ('image@photo'), ('height')) AS v(slot)"""
)
def fill_from_record(t: Tables) -> DataFrame:
    record = F.create_map(F.lit("name"), C("c_name"), F.lit("segment"), C("c_mktsegment"))
    slots = t.customer.select("c_custkey", record.alias("record"), F.explode_outer(F.array(*[F.lit(s) for s in SLOTS])).alias("slot"))
    fixed = C("slot").startswith("key@") | C("slot").startswith("image@")
    value = F.when(fixed, C("slot")).otherwise(F.coalesce(F.element_at("record", C("slot")), F.lit("")))
    return slots.select("c_custkey", "slot", value.alias("filled"))


@query(
    """SELECT p_partkey, CASE WHEN k = 0 THEN 'image' WHEN k = 1 THEN 'fixed' WHEN regexp_full_match(p_name, '[0-9]+') THEN 'digits'
    ELSE 'replace' END AS action FROM (SELECT *, p_partkey % 4 AS k FROM part)"""
)
def replaceable_slots(t: Tables) -> DataFrame:
    k = C("p_partkey") % 4
    label = F.when(k == 0, F.concat(F.lit("image@"), "p_name")).when(k == 1, F.concat(F.lit("key@"), "p_name")).otherwise(C("p_name"))
    return t.part.select("p_partkey", records.slot_action(label).alias("action"))


@query(
    """SELECT event_id, url, k FROM (SELECT event_id, k, i, 'u' || i AS url FROM (SELECT event_id,
    CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events), (VALUES (0), (1), (2)) AS v(i)) WHERE (k + i) % 3 = 1"""
)
def json_paths(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    item = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(((C("k") + i) % 3).alias("type"), F.concat(F.lit("u"), i.cast("string")).alias("url")))
    api = t.events.select("event_id", k.alias("k")).withColumn("body", F.to_json(F.struct(F.struct(item.alias("items")).alias("data"))))
    parsed = F.from_json("body", "data STRUCT<items ARRAY<STRUCT<type INT, url STRING>>>")
    found = api.select("event_id", "k", F.explode_outer(parsed["data"]["items"]).alias("item"))
    return found.where(C("item.type") == 1).select("event_id", C("item.url").alias("url"), "k")


COLOURS = ["Red", "Blue", "Green", "Small"]


@query(
    f"""SELECT p_partkey, coalesce((SELECT v FROM (VALUES ('Red'), ('Blue'), ('Green'), ('Small')) AS c(v) WHERE lower(v) =
    string_split(p_name, ' ')[1]), {pick_sql('p_partkey', 68, COLOURS)}) AS colour FROM part"""
)
def choose_option(t: Tables) -> DataFrame:
    wanted = F.lower(F.substring_index("p_name", " ", 1))
    same = F.filter(F.array(*[F.lit(c) for c in COLOURS]), lambda x: F.lower(x) == wanted)
    return t.part.select("p_partkey", F.coalesce(F.get(same, F.lit(0)), pick(C("p_partkey"), 68, COLOURS)).alias("colour"))


@query(
    f"""SELECT c_custkey, '{{' || array_to_string(list_transform(range(1, 4), lambda i: '"k' || i || '":{{' || array_to_string(
    list_transform(range(1, 3), lambda j: '"k' || j || '":"' || (({draw_sql('c_custkey', 69)} + i * 31 + j * 17) % 1000) || '"'), ',') || '}}'), ',')
    || '}}' AS record FROM customer"""
)
def nested_records(t: Tables) -> DataFrame:
    seed = draw(C("c_custkey"), 69)

    def key(i: Column) -> Column:
        return F.concat(F.lit("k"), i.cast("string"))

    def inner(i: Column) -> Column:
        return F.map_from_entries(
            F.transform(F.sequence(F.lit(1), F.lit(2)), lambda j: F.struct(key(j), ((seed + i * 31 + j * 17) % 1000).cast("string")))
        )

    outer = F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(key(i), inner(i))))
    return t.customer.select("c_custkey", F.to_json(outer).alias("record"))


def advancing_sql(table: str, ident: str, salt: int, n: int, start: str, low: int, high: int) -> str:
    return f"""(SELECT *, CAST({start} + sum(step) OVER (PARTITION BY {ident} ORDER BY i) AS BIGINT) AS pos FROM (SELECT *, CASE WHEN i = 0
    THEN 0 ELSE ({draw_sql(ident, salt)} + i * 7919 + i * i * 31) % {high - low + 1} + {low} END AS step
    FROM {table}, range(0, {n}) AS r(i)))"""


@query(
    f"""SELECT s_suppkey, pos AS row_no FROM {advancing_sql('supplier', 's_suppkey', 70, 20, '0', 2, 5)} WHERE pos < 39"""
)
def section_starts(t: Tables) -> DataFrame:
    starts = records.advancing(C("s_suppkey"), 70, 20, F.lit(0), 2, 5)
    return t.supplier.select("s_suppkey", F.explode_outer(starts).alias("row_no")).where(C("row_no") < 39)


@query(
    f"""SELECT s_suppkey, i + 1 AS line_no, pos AS page FROM {advancing_sql('supplier', 's_suppkey', 71, 10, integer_sql('s_suppkey', 72, 1, 200), 1, 10)}"""
)
def running_page_no(t: Tables) -> DataFrame:
    pages = records.advancing(C("s_suppkey"), 71, 10, integer(C("s_suppkey"), 72, 1, 200), 1, 10)
    return t.supplier.select("s_suppkey", F.posexplode_outer(pages).alias("i", "page")).select(
        "s_suppkey", (C("i") + 1).alias("line_no"), "page"
    )


@query(
    """WITH r AS (SELECT statement_no, section_no, CAST(NULL AS BIGINT) AS item_no, section AS text, 0 AS is_item FROM hierarchy
      GROUP BY ALL UNION ALL SELECT statement_no, section_no, item_no, item, 1 FROM hierarchy)
    SELECT CAST(statement_no AS BIGINT) AS statement_no, CAST(section_no AS BIGINT) AS section_no, text, CASE WHEN is_item = 1 THEN
      CAST(sum(is_item) OVER (PARTITION BY statement_no ORDER BY section_no, coalesce(item_no, -1)) AS BIGINT) END AS line_no FROM r"""
)
def item_numbers(t: Tables) -> DataFrame:
    from docsynth.plans.report import report_rows

    return report_rows(hierarchy(t)).select("statement_no", "section_no", "text", "line_no")

