"""Scalar text, date and number functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import Tables, draw_sql, integer_sql, lines, pick_sql, query, words
from docsynth.functions import dates, text
from docsynth.functions.binding import let
from docsynth.rng import integer, pick

INVIS_SQL = (
    r"[\x00-\x09\x0b-\x1f\x7f-\x9f]|\p{Cf}|\p{Co}|\p{Zl}|\p{Zp}"
    r"|[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
)
WIDE_SQL = (
    r"[\x{1100}-\x{115F}\x{2E80}-\x{303E}\x{3041}-\x{A4CF}\x{AC00}-\x{D7A3}\x{F900}-\x{FAFF}\x{FE30}-\x{FE6F}"
    r"\x{FF00}-\x{FF60}\x{FFE0}-\x{FFE6}\x{1F300}-\x{1FAFF}\x{20000}-\x{3FFFD}]"
)


def width_sql(c: str) -> str:
    seen = rf"regexp_replace({c}, '\x1B\[[0-9;]*m|\p{{Mn}}', '', 'g')"
    return f"(length({seen}) + length(regexp_replace({seen}, '[^{WIDE_SQL[1:]}', '', 'g')))"


@query(f"SELECT doc_id, regexp_replace(text, '{INVIS_SQL}', '', 'g') AS clean FROM documents")
def remove_invisible(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.remove_invisible(F.col("text")).alias("clean"))


@query(
    rf"""SELECT doc_id, regexp_replace(text, '\p{{Mn}}', '', 'g') AS unmarked,
    regexp_replace(regexp_replace(text, '{INVIS_SQL}', '', 'g'), '\p{{Mn}}', '', 'g') AS clean FROM documents"""
)
def remove_marks(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        text.remove_marks(F.col("text")).alias("unmarked"),
        text.clean_text(F.col("text")).alias("clean"),
    )


@query(f"SELECT doc_id, line_no, {width_sql('line')} AS width FROM lines")
def display_width(t: Tables) -> DataFrame:
    return lines(t).select("doc_id", "line_no", text.display_width(F.col("line")).alias("width"))


@query(f"SELECT doc_id, max({width_sql('line')}) AS width, count(*) AS height FROM lines GROUP BY doc_id")
def text_size(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.text_size(F.col("text")).alias("s")).select("doc_id", "s.*")


@query(
    """SELECT doc_id, line_no, i AS piece_no, substr(line, (i - 1) * 40 + 1, 40) AS piece
    FROM lines, range(1, 100000) AS s(i) WHERE (i - 1) * 40 < length(line)"""
)
def wrap_chars(t: Tables) -> DataFrame:
    pieces = F.posexplode_outer(text.wrap_chars(F.col("line"), 40)).alias("i", "piece")
    found = lines(t).select("doc_id", "line_no", pieces).where(F.col("i").isNotNull())
    return found.select("doc_id", "line_no", (F.col("i") + 1).alias("piece_no"), "piece")


WRAPPED = r"""(SELECT doc_id, line_no, unnest(list_transform(regexp_extract_all(line, '(?s)(.{1,60})(?: +|\z)|(.{60})'),
    lambda x: rtrim(x))) AS piece,
    generate_subscripts(regexp_extract_all(line, '(?s)(.{1,60})(?: +|\z)|(.{60})'), 1) AS piece_no FROM lines)"""


@query(f"SELECT doc_id, line_no, piece_no, piece FROM {WRAPPED}")
def wrap_words(t: Tables) -> DataFrame:
    pieces = F.posexplode_outer(text.wrap_words(F.col("line"), 60)).alias("i", "piece")
    found = lines(t).select("doc_id", "line_no", pieces).where(F.col("i").isNotNull())
    return found.select("doc_id", "line_no", (F.col("i") + 1).alias("piece_no"), "piece")


@query(
    f"""WITH w AS (SELECT doc_id, line_no, piece_no, list_filter(string_split_regex(piece, ' +'), lambda x: x <> '') AS ws
      FROM {WRAPPED}),
    u AS (SELECT doc_id, line_no, piece_no, len(ws) - 1 AS gaps, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
    s AS (SELECT *, sum(length(word)) OVER (PARTITION BY doc_id, line_no, piece_no) AS total,
      coalesce(sum(length(word)) OVER (PARTITION BY doc_id, line_no, piece_no ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u)
    SELECT doc_id, line_no, piece_no, i AS word_no, word, CAST(before * 8 + CASE WHEN gaps > 0 THEN
      (i - 1) * ((600 - total * 8) // gaps) + least(i - 1, (600 - total * 8) % gaps) ELSE 0 END AS BIGINT) AS x FROM s"""
)
def justify_stretch(t: Tables) -> DataFrame:
    pieces = F.posexplode_outer(text.wrap_words(F.col("line"), 60)).alias("i", "piece")
    placed = F.posexplode_outer(text.justify_words(F.col("piece"), 600, 8)).alias("j", "w")
    return (
        lines(t)
        .select("doc_id", "line_no", pieces)
        .where(F.col("i").isNotNull())
        .select("doc_id", "line_no", (F.col("i") + 1).alias("piece_no"), placed)
        .where(F.col("j").isNotNull())
        .select("doc_id", "line_no", "piece_no", (F.col("j") + 1).alias("word_no"), "w.word", "w.x")
    )


@query(
    f"""WITH w AS (SELECT doc_id, line_no, piece_no, piece,
      piece_no = max(piece_no) OVER (PARTITION BY doc_id, line_no) AS last,
      list_filter(string_split_regex(piece, ' +'), lambda x: x <> '') AS ws FROM {WRAPPED}),
    g AS (SELECT *, len(ws) - 1 AS gaps, 64 - length(array_to_string(ws, '')) AS free FROM w)
    SELECT doc_id, line_no, piece_no, CASE WHEN last THEN piece WHEN gaps > 0 THEN array_to_string(list_transform(ws,
      lambda x, i: x || CASE WHEN i <= gaps THEN repeat(' ', free // gaps + CASE WHEN i <= free % gaps THEN 1 ELSE 0 END)
      ELSE '' END), '') ELSE array_to_string(ws, '') END AS line FROM g"""
)
def justify_lines(t: Tables) -> DataFrame:
    # The last-piece mark travels inside the list: a size beside the generator would be worked out again for every piece.
    marked = let(
        text.wrap_words(F.col("line"), 60),
        lambda ps: F.transform(ps, lambda p, i: F.struct(p.alias("piece"), (i + 1 == F.size(ps)).alias("last"))),
    )
    pieces = lines(t).select("doc_id", "line_no", F.posexplode_outer(marked).alias("i", "p")).where(F.col("i").isNotNull())
    justified = text.justify_line(F.col("p.piece"), 64, F.col("p.last"))
    return pieces.select("doc_id", "line_no", (F.col("i") + 1).alias("piece_no"), justified.alias("line"))


# A fold over the words in one string: finished lines end in a line feed, the open line stands last.
TAIL = "string_split(a, chr(10))[-1]"
REST = f"substr(w, greatest(22 - length({TAIL}), 0) + 1)"
MORE = f"greatest((length({REST}) - 3) // 22, 0)"
SPLIT = r"string_split_regex(trim(regexp_replace(line, '[\x09-\x0D ]+', ' ', 'g')), ' ')"


@query(
    f"""WITH f AS (SELECT doc_id, line_no, list_reduce(list_prepend('', {SPLIT}), lambda a, w:
      CASE WHEN w = '' THEN a WHEN length({TAIL}) + length(w) < 24 THEN a || w || ' ' WHEN length({TAIL}) + length(w) = 24 THEN a || w || chr(10)
      ELSE a || CASE WHEN length({TAIL}) < 22 THEN left(w, 22 - length({TAIL})) || '-' ELSE '' END || chr(10) ||
        array_to_string(list_transform(range({MORE}), lambda i: substr({REST}, i * 22 + 1, 22) || '-' || chr(10)), '') ||
        substr({REST}, {MORE} * 22 + 1) || CASE WHEN length({REST}) - {MORE} * 22 = 24 THEN chr(10) ELSE ' ' END END) AS text
      FROM lines),
    l AS (SELECT doc_id, line_no, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls FROM f)
    SELECT doc_id, line_no, unnest(list_transform(ls, lambda x: rtrim(x))) AS piece, generate_subscripts(ls, 1) AS piece_no FROM l"""
)
def wrap_hyphens(t: Tables) -> DataFrame:
    pieces = F.posexplode_outer(text.wrap_hyphens(F.col("line"), 24)).alias("i", "piece")
    found = lines(t).select("doc_id", "line_no", pieces).where(F.col("i").isNotNull())
    return found.select("doc_id", "line_no", (F.col("i") + 1).alias("piece_no"), "piece")


@query(
    f"""WITH f AS (SELECT doc_id, line_no, list_reduce(list_prepend('', list_filter({SPLIT}, lambda x: x <> '')), lambda a, w: CASE
      WHEN (length({TAIL}) + length(w)) * 8 <= 600 OR {TAIL} = '' THEN a || w || ' '
      WHEN 10 * ((length({TAIL}) + length(w)) * 8 - 600) <= (length({TAIL}) - length(replace({TAIL}, ' ', ''))) * 8
        THEN a || w || chr(1) || (600 - (length({TAIL}) + length(w)) * 8) || chr(10)
      ELSE rtrim(a) || chr(1) || (608 - length({TAIL}) * 8) || chr(10) || w || ' ' END) AS text FROM lines),
    l AS (SELECT doc_id, line_no, unnest(ls) AS piece, generate_subscripts(ls, 1) AS piece_no FROM
      (SELECT doc_id, line_no, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls FROM f)),
    w AS (SELECT doc_id, line_no, piece_no, string_split(rtrim(string_split(piece, chr(1))[1]), ' ') AS ws,
      coalesce(TRY_CAST(string_split(piece, chr(1))[2] AS BIGINT), 0) AS extra FROM l),
    u AS (SELECT doc_id, line_no, piece_no, extra, len(ws) - 1 AS gaps, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
    s AS (SELECT *, coalesce(sum(length(word)) OVER (PARTITION BY doc_id, line_no, piece_no ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u)
    SELECT doc_id, line_no, piece_no, i AS word_no, word, CAST(before * 8 + (i - 1) * 8 + CASE WHEN gaps > 0 THEN
      sign(extra) * ((i - 1) * (abs(extra) // gaps) + least(i - 1, abs(extra) % gaps)) ELSE 0 END AS BIGINT) AS x FROM s"""
)
def justify_squeezed(t: Tables) -> DataFrame:
    placed = F.posexplode_outer(text.justify_squeezed(F.col("line"), 600, 8)).alias("i", "ws")
    found = lines(t).select("doc_id", "line_no", placed).where(F.col("i").isNotNull())
    found = found.select("doc_id", "line_no", (F.col("i") + 1).alias("piece_no"), F.posexplode_outer("ws").alias("j", "w"))
    return found.select("doc_id", "line_no", "piece_no", (F.col("j") + 1).alias("word_no"), "w.word", "w.x")


@query(
    f"""SELECT o_orderkey, translate(d, '345678', ('345678345678')[k + 1 : k + 6]) AS like_date FROM (
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, CAST({draw_sql('o_orderkey', 10)} % 6 AS INTEGER) AS k FROM orders)"""
)
def date_like_digits(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select("o_orderkey", text.date_like_digits(day, F.col("o_orderkey")).alias("like_date"))


@query(
    f"""SELECT c_custkey, array_to_string(list_transform(string_split(c_name, ''), lambda ch, i:
    CASE WHEN regexp_full_match(ch, '[0-9]') THEN CAST(({draw_sql('c_custkey', 11)} + (i - 1) * (i - 1) * 31 + (i - 1) * 17) % 10
    AS VARCHAR) ELSE ch END), '') AS scrambled FROM customer"""
)
def scramble_digits(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.scramble_digits(F.col("c_name"), F.col("c_custkey")).alias("scrambled"))


@query(
    """SELECT doc_id, pos, substr(c, 1, instr(substr(c || c, 2), c)) AS unit FROM
    (SELECT doc_id, pos, repeat(word, 1 + length(word) % 3) AS c FROM words)"""
)
def minimal_period(t: Tables) -> DataFrame:
    many = F.repeat(F.col("word"), 1 + F.length("word") % 3)
    return words(t).withColumn("c", many).select("doc_id", "pos", text.minimal_period(F.col("c")).alias("unit"))


@query(
    """SELECT doc_id, line_no, length(c) - length(ltrim(c)) AS lead, length(c) - length(rtrim(c)) AS trail FROM
    (SELECT doc_id, line_no, repeat(' ', line_no % 4) || line || repeat(' ', length(line) % 3) AS c FROM lines)"""
)
def trim_counts(t: Tables) -> DataFrame:
    padded = F.concat(
        F.repeat(F.lit(" "), F.col("line_no") % 4), F.col("line"), F.repeat(F.lit(" "), F.length("line") % 3)
    )
    counts = text.trim_counts(F.col("c"))
    return lines(t).withColumn("c", padded).select("doc_id", "line_no", counts.alias("s")).select("doc_id", "line_no", "s.*")


@query(
    f"""SELECT c_custkey, translate('║' || c_name || '╬' || c_mktsegment || '╣', '{text.RULE_SIGNS}',
    '{" " * len(text.RULE_SIGNS)}') AS line FROM customer"""
)
def clear_rules(t: Tables) -> DataFrame:
    drawn = F.concat(F.lit("║"), "c_name", F.lit("╬"), "c_mktsegment", F.lit("╣"))
    return t.customer.select("c_custkey", text.clear_rules(drawn).alias("line"))


@query(
    f"""SELECT c_custkey, regexp_replace('户名:' || c_name || '，' || c_mktsegment, '{WIDE_SQL}', '__', 'g') AS line,
    {width_sql("'户名:' || c_name || '，' || c_mktsegment")} AS width FROM customer"""
)
def wide_to_dunder(t: Tables) -> DataFrame:
    mixed = F.concat(F.lit("户名:"), "c_name", F.lit("，"), "c_mktsegment")
    return t.customer.select(
        "c_custkey", text.wide_to_dunder(mixed).alias("line"), text.display_width(mixed).alias("width")
    )


@query(
    """SELECT c_custkey, CASE WHEN a = 0 THEN '-' WHEN a < 0 THEN '(' || format('{:,}', -a) || ')'
    ELSE format('{:,}', a) END AS money FROM (SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS a FROM customer)"""
)
def money_text(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.money_text(F.col("c_acctbal").cast("bigint")).alias("money"))


@query(
    """WITH d AS (SELECT o_orderkey, c, lpad(CAST(c AS VARCHAR), CAST(greatest(length(CAST(c AS VARCHAR)), 3) AS INTEGER), '0') AS s FROM
      (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)),
    p AS (SELECT o_orderkey, c, array_to_string(list_transform(string_split(s, ''), lambda x, i:
      ('零壹贰叁肆伍陆柒捌玖')[CAST(x AS INTEGER) + 1] || ('分角元拾百千万拾百千亿拾百千万拾百千兆')[length(s) - i + 1]), '') AS w FROM d),
    q AS (SELECT o_orderkey, c, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w,
      '零千零百零拾零[万亿]', '零', 'g'), '零[千百拾角分]', '零', 'g'), '零+', '零', 'g'),
      '零([元万亿兆])', '\\1', 'g'), '零$', '') AS w FROM p)
    SELECT o_orderkey, CASE WHEN c < 100 THEN '零' ELSE '' END || w || CASE WHEN w LIKE '%分' THEN '' ELSE '整' END AS capital
    FROM q"""
)
def rmb_upper(t: Tables) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.withColumn("c", cents).select("o_orderkey", text.rmb_upper(F.col("c")).alias("capital"))


@query(
    """SELECT c_custkey, CASE WHEN length(a) < 44 THEN rpad(a, 44, '<') ELSE a END AS line1,
    CASE WHEN length(b) < 42 THEN rpad(b, 42, '<') ELSE b END || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS line2 FROM
    (SELECT c_custkey, 'P<NAT' || upper(replace(c_name, '#', '')) || '<<' || upper(c_mktsegment) AS a,
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') || 'NAT' || c_nationkey AS b FROM customer)"""
)
def mrz_lines(t: Tables) -> DataFrame:
    surname = F.upper(F.replace("c_name", F.lit("#"), F.lit("")))
    body = F.concat(F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit("NAT"), F.col("c_nationkey").cast("string"))
    check = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")
    return t.customer.select(
        "c_custkey",
        text.mrz_first(F.lit("P<NAT"), surname, F.upper("c_mktsegment")).alias("line1"),
        text.mrz_second(body, check).alias("line2"),
    )


@query(f"SELECT c_custkey, translate(c_name, '0123456789', '{text.NATIVE_DIGITS}') AS native FROM customer")
def native_digits(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.native_digits(F.col("c_name")).alias("native"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS signature FROM part")
def signature_name(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.signature_name(F.col("p_name")).alias("signature"))


@query("SELECT p_partkey, lower(regexp_replace(trim(p_name), '\\s+', '_', 'g')) AS snake FROM part")
def snake_name(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.snake_name(F.col("p_name")).alias("snake"))


@query(
    r"""SELECT doc_id, regexp_replace(n, '\.[^.]*$', '') AS stem, regexp_extract(n, '(\.[^.]*)$', 1) AS ext,
    md5(p) || regexp_extract(n, '(\.[^.]*)$', 1) AS hashed FROM (SELECT doc_id, p, regexp_extract(p, '([^/]*)$', 1) AS n FROM
    (SELECT doc_id, 'out/' || lang || '/' || source || '-' || doc_id || '.label.txt' AS p FROM documents))"""
)
def stem_and_name(t: Tables) -> DataFrame:
    path = F.concat(F.lit("out/"), "lang", F.lit("/"), "source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".label.txt"))
    return t.documents.select("doc_id", path.alias("p")).select(
        "doc_id",
        text.stem(F.col("p")).alias("stem"),
        text.extension(F.col("p")).alias("ext"),
        F.concat(F.md5("p"), text.extension(F.col("p"))).alias("hashed"),
    )


@query(
    """SELECT s_suppkey, repeat('  ', CASE WHEN starts_with(i, '（') THEN 2 WHEN regexp_matches(i, '^[0-9]') THEN 3 ELSE 1 END) || i
    AS item FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '（' || s_name WHEN 1 THEN s_suppkey || '.' || s_name
    ELSE s_name END AS i FROM supplier)"""
)
def indent_item(t: Tables) -> DataFrame:
    kind = F.col("s_suppkey") % 3
    raw = (
        F.when(kind == 0, F.concat(F.lit("（"), "s_name"))
        .when(kind == 1, F.concat(F.col("s_suppkey").cast("string"), F.lit("."), "s_name"))
        .otherwise(F.col("s_name"))
    )
    return t.supplier.withColumn("i", raw).select("s_suppkey", text.indent_item(F.col("i")).alias("item"))


@query(
    r"""SELECT c_custkey, piece, x FROM (SELECT c_custkey, [trim(c_name), trim(c_mktsegment), trim(CAST(c_acctbal AS VARCHAR))] AS p,
    [2, 27, 42] AS xs, unnest(p) AS piece, unnest(xs) AS x FROM customer)"""
)
def split_on_gaps(t: Tables) -> DataFrame:
    line = F.concat(
        F.lit("  "), text.pad_right(F.col("c_name"), 25, " "), text.pad_right(F.col("c_mktsegment"), 15, " "), F.col("c_acctbal").cast("string")
    )
    return (
        t.customer.withColumn("line", line)
        .select("c_custkey", F.explode_outer(text.split_on_gaps(F.col("line"))).alias("s"))
        .select("c_custkey", "s.piece", "s.x")
    )


CODES = ", ".join(f"('{k}', '{v}')" for k, v in text.SHUANGPIN.items())


@query(
    f"""WITH code(k, v) AS (VALUES {CODES}),
    s AS (SELECT DISTINCT lower(word) AS w FROM words),
    p AS (SELECT w, w || '1' AS syl, CASE WHEN regexp_matches(w, '^[aoe]') THEN '' WHEN substr(w || '1', 2, 1) = 'h'
      THEN substr(w, 1, 2) ELSE substr(w, 1, 1) END AS ini FROM s),
    q AS (SELECT *, substr(w, length(ini) + 1) AS fin FROM p)
    SELECT w AS word, CASE WHEN length(syl) = 2 THEN syl ELSE coalesce(
      CASE WHEN ini = '' THEN substr(w, 1, 1) WHEN length(ini) = 2 THEN a.v ELSE ini END ||
      CASE WHEN length(fin) > 1 THEN z.v ELSE fin END, syl) END AS code
    FROM q LEFT JOIN code a ON a.k = ini LEFT JOIN code z ON z.k = fin"""
)
def shuangpin(t: Tables) -> DataFrame:
    syllables = words(t).select(F.lower("word").alias("word")).distinct()
    return syllables.select("word", text.shuangpin(F.concat("word", F.lit("1"))).alias("code"))


@query(
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN
    array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')
    ELSE p_name END AS header FROM part"""
)
def upper_header(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 3
    role = F.when(k == 0, "section").when(k == 1, "title").otherwise("item")
    return t.part.select("p_partkey", text.upper_header(F.col("p_name"), role).alias("header"))


# ---------------------------------------------------------------- dates


@query(
    f"""SELECT o_orderkey, i AS seq, strftime(last_day(CAST(o_orderdate AS DATE) + to_months(CAST(i - 1 AS INTEGER))), '%Y-%m-%d') AS day
    FROM (SELECT o_orderkey, o_orderdate, {integer_sql('o_orderkey', 20, 10, 20)} AS n FROM orders), range(1, 21) AS s(i)
    WHERE i <= n"""
)
def month_end_series(t: Tables) -> DataFrame:
    n = integer(F.col("o_orderkey"), 20, 10, 20).cast("int")
    ends = dates.month_ends(F.col("o_orderdate").cast("date"), n)
    return t.orders.select("o_orderkey", F.posexplode_outer(ends).alias("i", "d")).select(
        "o_orderkey", (F.col("i") + 1).alias("seq"), F.col("d").cast("string").alias("day")
    )


@query(
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH, '%Y-%m-%d') AS day FROM orders"""
)
def same_day_last_year(t: Tables) -> DataFrame:
    d = dates.same_day_last_year(F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", d.cast("string").alias("day"))


@query(
    f"""SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + to_months(CAST({pick_sql('o_orderkey', 21, [5, 10])} * 12 AS INTEGER)),
    '%Y-%m-%d') AS expiry FROM orders"""
)
def expiry(t: Tables) -> DataFrame:
    d = dates.expiry(F.col("o_orderdate").cast("date"), pick(F.col("o_orderkey"), 21, [5, 10]))
    return t.orders.select("o_orderkey", d.cast("string").alias("expiry"))


KM = ", ".join(f"'{m}'" for m in dates.MONTHS["km"])
NL = ", ".join(f"'{m}'" for m in dates.MONTHS["nl"])


@query(
    f"""SELECT o_orderkey, strftime(o_orderdate, '%d ') || upper(strftime(o_orderdate, '%b')) || ' /' || ([{KM}])[month(o_orderdate)]
    || strftime(o_orderdate, ' %Y') AS km, strftime(o_orderdate, '%d ') || ([{NL}])[month(o_orderdate)]
    || strftime(o_orderdate, ' %Y') AS nl, upper(strftime(o_orderdate, '%d %b %Y')) AS en FROM orders"""
)
def bilingual_date(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        dates.bilingual_date(d, "km", "insert").alias("km"),
        dates.bilingual_date(d, "nl", "replace").alias("nl"),
        dates.passport_date(d).alias("en"),
    )


@query(
    """SELECT p_partkey, repeat('_', room // unit) || p_name || repeat('_', (900 - room - width) // unit) AS filled FROM (SELECT *, width // length(p_name) AS unit
    FROM (SELECT p_partkey, p_name, p_partkey % 97 + 3 AS room, length(p_name) * 8 + p_partkey % 5 AS width FROM part))"""
)
def pad_to_cell(t: Tables) -> DataFrame:
    left = F.col("p_partkey") % 97 + 3
    right = left + F.length("p_name") * 8 + F.col("p_partkey") % 5
    filled = text.pad_to_cell(F.col("p_name"), left, right, F.lit(0), F.lit(900))
    return t.part.select("p_partkey", filled.alias("filled"))


@query("SELECT p_partkey, CAST(least(12 + p_size % 20, 2 * (80 + p_size * 3) // length(p_name)) AS BIGINT) AS font_size FROM part")
def fit_font_size(t: Tables) -> DataFrame:
    size, width = 12 + F.col("p_size") % 20, 80 + F.col("p_size") * 3
    return t.part.select("p_partkey", text.fit_font_size(F.col("p_name"), size, width).alias("font_size"))
