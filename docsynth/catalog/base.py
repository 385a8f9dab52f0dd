"""Registry of queries with their SQL twins, and the derived inputs both sides share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsynth.operators.corpus import WORD
from docsynth.rng import M

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MODULE_OF: dict[str, str] = {}


class Tables:
    """The driver's tables of one scale factor."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def widen(df: DataFrame) -> DataFrame:
    """32-bit counters of Spark functions as BIGINT, as SQL engines return them."""
    return df.select(*[F.col(f.name).cast("bigint") if f.dataType.typeName() == "integer" else F.col(f.name) for f in df.schema])


def query(sql: str | None = None) -> Callable:
    """Register a function of :class:`Tables` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[fn.__name__] = lambda spark, path: widen(fn(Tables(spark, path)))
        MODULE_OF[fn.__name__] = fn.__module__.rsplit(".", 1)[-1]
        if sql is not None:
            ORACLE[fn.__name__] = with_inputs(sql)
        return fn

    return register


# ---------------------------------------------------------------- SQL side


def draw_sql(ident: str, salt: int) -> str:
    """The pseudo-random definition of ``docsynth.rng`` spelled in SQL."""
    i = f"CAST({ident} AS BIGINT)"
    x1 = f"(({i} % {M} * 48271 + ({i} >> 31) % 1000003 * 7919 + {salt * 69621 + 11}) % {M})"
    x2 = f"(({x1} * ({x1} + 12345) + {salt}) % {M})"
    return f"(({x2} * ({x2} + 54321) + 7) % {M})"


def uniform_sql(ident: str, salt: int) -> str:
    return f"({draw_sql(ident, salt)} / CAST({M} AS DOUBLE))"


def integer_sql(ident: str, salt: int, low: int, high: int) -> str:
    return f"({draw_sql(ident, salt)} % {high - low + 1} + {low})"


def pick_sql(ident: str, salt: int, options: list) -> str:
    items = ", ".join(f"'{o}'" if isinstance(o, str) else str(o) for o in options)
    return f"([{items}])[{draw_sql(ident, salt)} % {len(options)} + 1]"


def digits_sql(ident: str, salt: int, n: int) -> str:
    parts, left = [], n
    while left > 0:
        k = min(left, 6)
        parts.append(f"lpad(CAST({draw_sql(ident, salt + len(parts))} % {10**k} AS VARCHAR), {k}, '0')")
        left -= k
    return "(" + " || ".join(parts) + ")"


def letters_sql(ident: str, salt: int, n: int) -> str:
    return "(" + " || ".join(f"chr(CAST({draw_sql(ident, salt + i)} % 26 + 65 AS INTEGER))" for i in range(n)) + ")"


def r4(x: Column) -> Column:
    """Four decimals by plain double arithmetic, the same in every engine."""
    return F.floor(x * 10000.0 + 0.5) / 10000.0


def r4_sql(x: str) -> str:
    return f"(floor(({x}) * CAST(10000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(10000 AS DOUBLE))"


# Shared inputs in SQL; a query names them and they are put in front as WITH parts.
INPUTS: dict[str, str] = {
    "ledger": """SELECT user_id AS acct, ts, event_id, event_type, 1000000 + 3700 * user_id AS opening,
        CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END * CAST(round(value * 100) AS BIGINT) AS cents
        FROM events""",
    "boxes": """SELECT l_orderkey // 10 AS image_id,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' ||
          CAST(round(l_extendedprice * 100) AS BIGINT) AS ann_id,
        100 * (n % 4) + l_suppkey % 7 AS l, 40 * (n // 4) + l_partkey % 5 AS t,
        100 * (n % 4) + l_suppkey % 7 + 40 + CAST(l_quantity AS BIGINT) AS r,
        40 * (n // 4) + l_partkey % 5 + 16 + l_partkey % 5 AS b,
        l_returnflag || l_linenumber AS content
        FROM (SELECT *, (l_orderkey % 10) * 7 + l_linenumber - 1 AS n FROM lineitem)""",
    "line_boxes": """SELECT image_id, ann_id, l, t, r, b, content, CAST(sum(CASE WHEN pt IS NOT NULL AND
          ((pt <= (t + b) // 2 AND (t + b) // 2 <= pb) OR (t <= (pt + pb) // 2 AND (pt + pb) // 2 <= b))
          THEN 0 ELSE 1 END) OVER (PARTITION BY image_id ORDER BY t, l, ann_id) AS BIGINT) AS row_no
        FROM (SELECT *, lag(t) OVER w AS pt, lag(b) OVER w AS pb FROM boxes
              WINDOW w AS (PARTITION BY image_id ORDER BY t, l, ann_id))""",
    "line_sizes": "SELECT image_id, row_no, count(*) AS n FROM line_boxes GROUP BY ALL",
    "col_max": """SELECT image_id, max(n) AS cols_max FROM (SELECT image_id, n FROM line_sizes GROUP BY image_id, n
        HAVING count(*) > 2) GROUP BY image_id""",
    "full_rows": """SELECT s.image_id, s.row_no FROM line_sizes s JOIN col_max c
        ON s.image_id = c.image_id AND s.n = c.cols_max""",
    "normal": """SELECT x.* FROM line_boxes x JOIN full_rows f ON x.image_id = f.image_id AND x.row_no = f.row_no""",
    "col_boxes": """SELECT image_id, ann_id, l, t, r, b, CAST(sum(CASE WHEN pl IS NOT NULL AND
          ((pl <= (l + r) // 2 AND (l + r) // 2 <= pr) OR (l <= (pl + pr) // 2 AND (pl + pr) // 2 <= r))
          THEN 0 ELSE 1 END) OVER (PARTITION BY image_id ORDER BY l, t, ann_id) AS BIGINT) AS col_no
        FROM (SELECT *, lag(l) OVER w AS pl, lag(r) OVER w AS pr FROM normal
              WINDOW w AS (PARTITION BY image_id ORDER BY l, t, ann_id))""",
    "table_cols": """SELECT image_id, col_no, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM col_boxes
        GROUP BY image_id, col_no""",
    "page_edges": "SELECT image_id, min(l) AS left_min, max(r) AS right_max FROM boxes GROUP BY image_id",
    "row_ext": """SELECT g.image_id, row_no, left_min AS l, t, right_max AS r, t + h AS b FROM
        (SELECT image_id, row_no, arg_min(t, (t, l, ann_id)) AS t, max(b - t) AS h FROM line_boxes GROUP BY image_id, row_no) g
        JOIN page_edges e ON g.image_id = e.image_id""",
    "padded": """SELECT image_id, col_no, l - CASE WHEN no = 2 THEN least(lp, rp) ELSE lp END AS l, t,
        r + rp + CASE WHEN no = 1 THEN greatest(coalesce(n_lp - n_rp, 0), 0) ELSE 0 END AS r, b FROM
        (SELECT *, lead(lp) OVER w AS n_lp, lead(rp) OVER w AS n_rp, row_number() OVER w AS no FROM
          (SELECT c.*, coalesce(CAST(floor((l - lag(r) OVER v) / 2) AS BIGINT), l - left_min) AS lp,
             coalesce(CAST(floor((lead(l) OVER v - r) / 2) AS BIGINT), right_max - r) AS rp
           FROM table_cols c JOIN page_edges e ON c.image_id = e.image_id
           WINDOW v AS (PARTITION BY c.image_id ORDER BY col_no))
         WINDOW w AS (PARTITION BY image_id ORDER BY col_no))""",
    "grid": """SELECT g.image_id, g.row_no, c.col_no, c.l, g.t, c.r, g.b FROM row_ext g JOIN full_rows f
        ON g.image_id = f.image_id AND g.row_no = f.row_no JOIN padded c ON g.image_id = c.image_id""",
    "assigned": """SELECT image_id, ann_id, content, row_no, col_no FROM (SELECT x.image_id, x.ann_id, x.content, c.row_no, c.col_no,
        row_number() OVER (PARTITION BY x.image_id, x.ann_id ORDER BY c.row_no, c.col_no) AS k FROM boxes x JOIN grid c
        ON x.image_id = c.image_id AND (x.l + x.r) // 2 BETWEEN c.l AND c.r AND (x.t + x.b) // 2 BETWEEN c.t AND c.b)
        WHERE k = 1""",
    "words": r"""SELECT doc_id, lang, pos, word FROM (SELECT doc_id, lang,
        unnest(regexp_extract_all(text, '\p{L}[\p{L}\p{M}]*')) AS word,
        generate_subscripts(regexp_extract_all(text, '\p{L}[\p{L}\p{M}]*'), 1) AS pos FROM documents)""",
    "lines": """SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents""",
    "hierarchy": """SELECT r_regionkey AS statement_no, r_name AS statement, n_nationkey AS section_no,
        n_name AS section, s_suppkey AS item_no, s_name AS item, s_acctbal AS amount
        FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey""",
    "px": """SELECT vec_id AS image_id, (i - 1) // 16 AS y, (i - 1) // 4 % 4 AS x, (i - 1) % 4 AS ch, v FROM (
        SELECT vec_id, i, CAST(floor(least(greatest((CAST(embedding[i] AS DOUBLE) + 1) / 2, 0), 1) * 255 + 0.5) AS BIGINT)
        AS v FROM embeddings, range(1, 65) AS s(i))""",
    "pixels": """SELECT image_id, y, x, max(v) FILTER (ch = 0) AS red, max(v) FILTER (ch = 1) AS green,
        max(v) FILTER (ch = 2) AS blue, max(v) FILTER (ch = 3) AS alpha FROM px GROUP BY ALL""",
}


def with_inputs(sql: str) -> str:
    """Put the WITH parts of every shared input the statement names in front of it."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in INPUTS:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in found:
                visit(INPUTS[name])
                found.append(name)

    visit(sql)
    if not found:
        return sql
    parts = ", ".join(f"{n} AS MATERIALIZED ({INPUTS[n]})" for n in found)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {parts}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"


# ---------------------------------------------------------------- Spark side


def ledger(t: Tables) -> DataFrame:
    sign = F.when(F.col("event_type").isin("purchase", "error"), -1).otherwise(1)
    return t.events.select(
        F.col("user_id").alias("acct"),
        "ts",
        "event_id",
        "event_type",
        (F.lit(1000000) + 3700 * F.col("user_id")).alias("opening"),
        (sign * F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
    )


def boxes(t: Tables) -> DataFrame:
    """Every line item as a text box; an image holds ten orders in four columns of slots."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    n = F.col("l_orderkey") % 10 * 7 + F.col("l_linenumber") - 1
    left = 100 * (n % 4) + F.col("l_suppkey") % 7
    top = 40 * F.floor(n / 4) + F.col("l_partkey") % 5
    return t.lineitem.select(
        F.floor(F.col("l_orderkey") / 10).alias("image_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("ann_id"),
        left.alias("l"),
        top.alias("t"),
        (left + 40 + F.col("l_quantity").cast("bigint")).alias("r"),
        (top + 16 + F.col("l_partkey") % 5).alias("b"),
        F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")).alias("content"),
    )


def words(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    rows = t.documents.select("doc_id", "lang", F.posexplode_outer(found).alias("pos", "word"))
    return rows.where(F.col("pos").isNotNull()).withColumn("pos", F.col("pos") + 1)


def lines(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line")).withColumn(
        "line_no", F.col("line_no") + 1
    )


def hierarchy(t: Tables) -> DataFrame:
    """Statement -> section -> item rows; regions and nations are small and broadcast by their measured size."""
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_regionkey").alias("statement_no"),
            F.col("r_name").alias("statement"),
            F.col("n_nationkey").alias("section_no"),
            F.col("n_name").alias("section"),
            F.col("s_suppkey").alias("item_no"),
            F.col("s_name").alias("item"),
            F.col("s_acctbal").alias("amount"),
        )
    )


def pixels(t: Tables) -> DataFrame:
    """All 64 numbers of a vector as a 4 x 4 picture with red, green, blue and alpha in 0..255."""
    byte = F.transform(
        "embedding",
        lambda e: F.floor(F.least(F.greatest((e.cast("double") + 1) / 2, F.lit(0.0)), F.lit(1.0)) * 255 + 0.5),
    )
    quads = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice(F.col("v"), i * 4 + 1, F.lit(4)))
    return (
        t.embeddings.select(F.col("vec_id").alias("image_id"), byte.alias("v"))
        .select("image_id", F.posexplode_outer(quads).alias("pos", "q"))
        .select(
            "image_id",
            F.floor(F.col("pos") / 4).alias("y"),
            (F.col("pos") % 4).cast("bigint").alias("x"),
            *[F.col("q")[i].alias(c) for i, c in enumerate(("red", "green", "blue", "alpha"))],
        )
    )
