"""Generated products: statements, reports, papers, cards, forms, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import (
    Tables,
    digits_sql,
    draw_sql,
    hierarchy,
    integer_sql,
    ledger,
    letters_sql,
    pick_sql,
    query,
    uniform_sql,
    words,
)
from docsynth.catalog.corpora import LANGS, NUMBERED
from docsynth.catalog.tabular import CELLS, WIDTHS, advancing_sql, drawn
from docsynth.operators import annotations as ann
from docsynth.operators import corpus, structure, tables
from docsynth.plans import bank, forms, identity, report
from docsynth.rng import pick

C = F.col


@query(
    """SELECT acct, event_id, CASE WHEN cents > 0 THEN '贷' ELSE '借' END AS direction, abs(cents) / 100 AS amount,
    (opening + CAST(sum(cents) OVER (PARTITION BY acct ORDER BY ts, event_id) AS BIGINT)) / 100 AS balance FROM ledger"""
)
def running_balance(t: Tables) -> DataFrame:
    return bank.running_balance(ledger(t))


@query(
    """SELECT acct, strftime(min(ts), '%Y-%m-%d') AS start, strftime(max(ts), '%Y-%m-%d') AS finish,
    arg_min(event_type, (ts, event_id)) AS first_kind, (min(opening) + CAST(sum(cents) AS BIGINT)) / 100 AS closing FROM ledger
    GROUP BY acct"""
)
def statement_header(t: Tables) -> DataFrame:
    return bank.statement_header(ledger(t))


IDENT = "(acct * 101 + i)"


@query(
    f"""WITH a AS (SELECT c_custkey AS acct, DATE '2015-01-01' + CAST({integer_sql('c_custkey', 200, 0, 3000)} AS INTEGER) AS start,
      {integer_sql('c_custkey', 201, 10, 20)} AS n, {integer_sql('c_custkey', 202, 10000, 100000)} * 100 AS opening,
      {draw_sql('c_custkey', 203)} AS seed FROM customer),
    m AS (SELECT a.*, i, (seed + (i + 1) * 7919 + (i + 1) * (i + 1) * 104729) % 200001 - 100000 AS cents,
      strftime(last_day(start + to_months(CAST(i AS INTEGER))), '%Y-%m-%d') AS day FROM a, range(0, 20) AS r(i) WHERE i < n)
    SELECT day, acct, {digits_sql('acct', 204, 16)} AS card, i + 1 AS seq, 'RMB' AS currency, {integer_sql(IDENT, 208, 0, 2)} AS code,
      {pick_sql(IDENT, 209, bank.REMARKS)} AS remark, CASE WHEN cents > 0 THEN '贷' ELSE '借' END AS direction,
      abs(cents) / 100 AS amount, (opening + CAST(sum(cents) OVER (PARTITION BY acct ORDER BY i) AS BIGINT)) / 100 AS balance,
      CAST(0 AS BIGINT) AS term, '不转存' AS renewal, strftime(start, '%Y-%m-%d') AS value_from, '2099-12-31' AS value_to,
      {digits_sql('acct', 210, 6)} AS region, {integer_sql(IDENT, 211, 1000, 1099)} AS branch,
      {integer_sql(IDENT, 212, 10000, 19999)} AS "operator", {pick_sql(IDENT, 213, bank.CHANNELS)} AS channel FROM m"""
)
def bank_statement(t: Tables) -> DataFrame:
    return bank.bank_statement(t.customer.select(C("c_custkey").alias("acct")))


def _amount(salt: int) -> str:
    n = f"format('{{:,}}', {integer_sql('x', salt, 1, 9999999)})"
    return f"""CASE WHEN is_item = 0 THEN '' WHEN {uniform_sql('x', salt + 1)} >= CAST(0.7 AS DOUBLE) THEN '-'
        WHEN {uniform_sql('x', salt + 2)} < CAST(0.3 AS DOUBLE) THEN '(' || {n} || ')' ELSE {n} END"""


@query(
    f"""WITH r AS (SELECT statement_no, section_no, CAST(-1 AS BIGINT) AS item_no, section AS text, 0 AS is_item FROM hierarchy
      GROUP BY ALL UNION ALL SELECT statement_no, section_no, item_no, item, 1 FROM hierarchy),
    n AS (SELECT *, CAST(section_no AS BIGINT) * 100003 + item_no AS x, CAST(sum(is_item) OVER (PARTITION BY statement_no
      ORDER BY section_no, item_no) AS BIGINT) AS no FROM r)
    SELECT CAST(statement_no AS BIGINT) AS statement_no, CAST(section_no AS BIGINT) AS section_no, item_no,
      CASE WHEN is_item = 1 THEN '  ' || text ELSE text END AS item, CASE WHEN is_item = 1 THEN CAST(no AS VARCHAR) ELSE '' END AS line_no,
      CASE WHEN is_item = 0 THEN '' WHEN {uniform_sql('x', 101)} < CAST(0.7 AS DOUBLE) THEN
        '(' || ('一二三四五六七八九十')[{integer_sql('x', 100, 1, 10)}] || ')' ELSE ' ' END AS note,
      {_amount(110)} AS this_period, {_amount(120)} AS last_period FROM n"""
)
def financial_statement(t: Tables) -> DataFrame:
    return report.financial_statement(hierarchy(t))


SPEC_SQL = ", ".join(
    f"({k}, " + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in s) + ")" for k, s in enumerate(identity.SPECS)
)
MONTH = {k: "[" + ", ".join(f"'{m}'" for m in identity.dates.MONTHS[k]) + "]" for k in identity.dates.MONTHS}


def _styled(d: str) -> str:
    day, year = f"strftime({d}, '%d')", f"strftime({d}, '%Y')"
    return f"""CASE style WHEN 'dot' THEN strftime({d}, '%m.%d.%Y') WHEN 'slash' THEN strftime({d}, '%d/%m/%Y')
        WHEN 'title' THEN strftime({d}, '%d %b %Y') WHEN 'short' THEN strftime({d}, '%d %b %y')
        WHEN 'insert' THEN {day} || ' ' || ({MONTH['en']})[month({d})] || ' /' || ({MONTH['km']})[month({d})] || ' ' || {year}
        WHEN 'replace' THEN {day} || ' ' || ({MONTH['nl']})[month({d})] || ' ' || {year}
        ELSE upper(strftime({d}, '%d %b %Y')) END"""


@query(
    f"""WITH spec(slot, {', '.join(f'"{f}"' for f in identity.FIELDS)}) AS (VALUES {SPEC_SQL}),
    r AS (SELECT c_custkey AS id, spec.*, prefix || {letters_sql('c_custkey', 300, 5)}[1:n_letters] || {digits_sql('c_custkey', 310, 9)}[1:n_digits]
      || suffix AS number, {pick_sql('c_custkey', 320, identity.SURNAMES)} AS surname, {pick_sql('c_custkey', 321, identity.GIVEN)} AS given,
      {pick_sql('c_custkey', 322, ['F', 'M'])} AS sex, DATE '1950-01-01' + CAST({integer_sql('c_custkey', 323, 0, 20000)} AS INTEGER) AS born,
      DATE '1950-01-01' + CAST({integer_sql('c_custkey', 324, 24000, 27000)} AS INTEGER) AS issued
      FROM customer JOIN spec ON slot = c_custkey % 11),
    q AS (SELECT *, issued + to_months(CAST(years * 12 AS INTEGER)) AS fin, number || filler || {digits_sql('id', 330, 1)} || code ||
      {digits_sql('id', 331, 7)} || sex || {digits_sql('id', 333, 18)}[1:tail] AS body, mrz || surname || '<<' || given AS head FROM r)
    SELECT id, lang, type, code, nationality, authority, number, surname, given, sex, {_styled('born')} AS birth, {_styled('issued')} AS issue,
      {_styled('fin')} AS expiry, CASE WHEN mrz <> '' THEN CASE WHEN length(head) < 44 THEN rpad(head, 44, '<') ELSE head END END AS line1,
      CASE WHEN mrz <> '' THEN CASE WHEN length(body) < 42 THEN rpad(body, 42, '<') ELSE body END || {digits_sql('id', 340, 2)} END AS line2
    FROM q"""
)
def identity_records(t: Tables) -> DataFrame:
    return identity.identity_records(t.customer.select(C("c_custkey").alias("id")))


PARTS_SQL = ", ".join(
    f"('{p}', {int(2.04 * x)}, {int(2.04 * y)}, {int(2.04 * x) + int(2.04 * w)}, {int(2.04 * y) + int(2.04 * h)})"
    for p, x, y, w, h in identity.CARD_PARTS
)


@query(
    f"""WITH p(part, l, t, r, b) AS (VALUES {PARTS_SQL}),
    c AS (SELECT c_custkey AS id, upper(c_name) AS name, c_mktsegment AS issuer, {digits_sql('c_custkey', 350, 16)} AS num FROM customer),
    x AS (SELECT id, part, l, t, r, b, CASE part WHEN 'number' THEN num[1:4] || ' ' || num[5:8] || ' ' || num[9:12] || ' ' || num[13:16]
      WHEN 'holder' THEN name WHEN 'issuer' THEN issuer ELSE 'VALID THRU ' || lpad(CAST({integer_sql('id', 360, 1, 12)} AS VARCHAR), 2, '0')
      || '/' || {integer_sql('id', 361, 24, 33)} END AS text FROM c, p)
    SELECT id, part, text, CAST(l AS BIGINT) AS l, CAST(t AS BIGINT) AS t, CAST(r AS BIGINT) AS r, CAST(b AS BIGINT) AS b,
      part || '@' || text AS label FROM x"""
)
def card_records(t: Tables) -> DataFrame:
    people = t.customer.select(C("c_custkey").alias("id"), C("c_name").alias("name"), C("c_mktsegment").alias("issuer"))
    return identity.card_records(people)


def _blocks_sql() -> str:
    one = []
    for k, (kind, ratio, low, high) in enumerate(forms.BLOCKS):
        one.append(
            f"""SELECT c_custkey AS id, {draw_sql(f'c_custkey * 1009 + c * 11 + {k}', 430)} AS ord, '{kind}' AS kind, c AS copy
            FROM customer, range(1, 4) AS r(c) WHERE {uniform_sql('c_custkey', 400 + k)} < CAST({ratio} AS DOUBLE)
            AND c <= {integer_sql('c_custkey', 410 + k, low, high)}"""
        )
    return " UNION ALL ".join(one)


BLOCKS = f"""(SELECT id, row_number() OVER w AS pos, kind, copy, CASE WHEN (row_number() OVER w - 1) * 2 < count(*) OVER (PARTITION BY id)
    THEN 'first' ELSE 'second' END AS half FROM ({_blocks_sql()}) WINDOW w AS (PARTITION BY id ORDER BY ord, kind, copy))"""


@query(f"SELECT * FROM {BLOCKS}")
def form_blocks(t: Tables) -> DataFrame:
    return forms.form_blocks(t.customer.select(C("c_custkey").alias("id")))


def _word_sql(j: int | str, salt: int) -> str:
    return "(" + " || ".join(f"chr(CAST(((s{salt} >> {5 * m}) + ({j}) * {m + 3}) % 26 + 97 AS INTEGER))" for m in range(5)) + ")"


def _value_sql(j: int | str) -> str:
    return f"CASE WHEN (s445 + ({j}) * 7) % 10 < 2 THEN ' ' ELSE {_word_sql(j, 442)} END"


def _joined_sql(sign: str, *parts: str) -> str:
    return "(" + f" || '{sign}' || ".join(parts) + ")"


def _heads_sql() -> str:
    """Lines that a block has besides its numbered ones, at places from -1 on."""
    head = _joined_sql("|", "''", *[_word_sql(j, 443) for j in (301, 302, 303)])
    over = _joined_sql("|", "''", _word_sql(311, 443), "''", "''")
    marks = _joined_sql(" ", _word_sql(1, 441), f"(SELECT string_agg('[x]' || {_word_sql('j', 442)}, ' ' ORDER BY j) FROM range(1, n + 1) AS r(j))")
    return f"""SELECT id, pos, kind, -1 AS j, {over} AS line FROM d WHERE kind = 'nested'
      UNION ALL SELECT id, pos, kind, 0, {head} FROM d WHERE kind IN ('grid', 'nested')
      UNION ALL SELECT id, pos, kind, 0, {_joined_sql(': ', _word_sql(1, 441), _word_sql(2, 442))} FROM d WHERE kind = 'single'
      UNION ALL SELECT id, pos, kind, 0, {marks} FROM d WHERE kind = 'options'"""


BODIES = {
    "multi": _joined_sql(" ", _word_sql("j", 441), _word_sql("j + 10", 442), _word_sql("j + 20", 443)),
    "pairs": _joined_sql("|", _word_sql("j", 441), _value_sql("j"), _word_sql("j + 50", 441), _value_sql("j + 50")),
    "grid": _joined_sql("|", _word_sql("j", 441), _value_sql("j"), _value_sql("j + 100"), _value_sql("j + 200")),
    "beside": f"rpad({_word_sql('j', 441)}, 12, ' ') || rpad({_word_sql('j', 442)}, 12, ' ')",
}
BODIES["nested"] = BODIES["grid"]


@query(
    f"""WITH d AS MATERIALIZED (SELECT id, pos, kind, {', '.join(f"{draw_sql('id * 1009 + pos', k)} AS s{k}" for k in (441, 442, 443, 445))},
      {integer_sql('id * 1009 + pos', 440, 2, 5)} AS n FROM {BLOCKS}),
    x AS (SELECT id, pos, kind, j, CASE kind {' '.join(f"WHEN '{k}' THEN {v}" for k, v in BODIES.items())} END AS line
      FROM d, range(1, 6) AS r(j) WHERE j <= n AND kind NOT IN ('single', 'options') UNION ALL {_heads_sql()})
    SELECT id, pos, kind, row_number() OVER (PARTITION BY id, pos ORDER BY j) - 1 AS line_no, line FROM x"""
)
def form_block_bodies(t: Tables) -> DataFrame:
    return forms.block_lines(forms.form_blocks(t.customer.select(C("c_custkey").alias("id"))))


SLOT_ROWS = ", ".join(f"({k}, '{s}', {x}, {y}, {n})" for k, (s, x, y, n) in enumerate(forms.SLOTS, 1))


@query(
    f"""WITH v AS {NUMBERED}, z AS (SELECT lang, count(*) AS size FROM v GROUP BY lang),
    s(slot_no, slot, l, t, chars) AS (VALUES {SLOT_ROWS}),
    x AS (SELECT c_custkey AS id, {pick_sql('c_custkey', 40, LANGS)} AS lang, s.*, c_custkey * 100 + slot_no AS slot_id FROM customer, s),
    k AS (SELECT x.slot_id, x.lang, chars, k FROM x, range(0, 16) AS r(k) WHERE slot = 'text' AND k <= chars // 2),
    i AS MATERIALIZED (SELECT k.*, {draw_sql('k.slot_id * 1009 + k.k', 34)} % z.size AS idx FROM k JOIN z ON k.lang = z.lang),
    p AS (SELECT i.slot_id, i.chars, i.k, v.word, v.n_chars FROM i JOIN v ON v.lang = i.lang AND v.idx = i.idx),
    f AS (SELECT *, chars - coalesce(sum(n_chars + 1) OVER (PARTITION BY slot_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS lft FROM p),
    w AS (SELECT slot_id, string_agg(substr(word, 1, CAST(lft AS BIGINT)), ' ' ORDER BY k) AS text FROM f
      WHERE lft >= CASE WHEN k = 0 THEN 2 ELSE 4 END GROUP BY slot_id)
    SELECT id, CAST(slot_no AS BIGINT) AS slot_no, CASE WHEN slot = 'text' THEN 'text@' || coalesce(text, '') WHEN slot = '2024' THEN 'text@2024'
      ELSE slot END AS label, CAST(l AS BIGINT) AS l, CAST(t AS BIGINT) AS t, CAST(l + chars * 8 AS BIGINT) AS r, CAST(t + 16 AS BIGINT) AS b
    FROM x LEFT JOIN w ON x.slot_id = w.slot_id"""
)
def template_fill(t: Tables) -> DataFrame:
    ids = t.customer.select(C("c_custkey").alias("id"), pick(C("c_custkey"), 40, LANGS).alias("lang"))
    return forms.template_fill(ids, corpus.number_words(words(t)))


KINDS = ", ".join(
    f"({mode}, {c}, {len(kinds)}, {k}, '{kind}')" for mode, columns in enumerate(forms.PAGES) for c, kinds in enumerate(columns) for k, kind in enumerate(kinds)
)


@query(
    f"""WITH kinds(mode, col_no, n, k, kind) AS (VALUES {KINDS}),
    e AS (SELECT c_custkey AS id, kinds.*, CASE col_no WHEN 0 THEN {draw_sql('c_custkey', 450)} ELSE {draw_sql('c_custkey', 451)} END AS seed
      FROM customer JOIN kinds ON mode = c_custkey % 5),
    b AS (SELECT id, col_no, j, kind, CASE kind WHEN 'title' THEN 30 WHEN 'text' THEN 60 ELSE 120 + (seed + j * 7919) % 5 * 20 END AS height
      FROM e, range(0, 30) AS r(j) WHERE j % n = k),
    s AS (SELECT *, sum(height + 12) OVER (PARTITION BY id, col_no ORDER BY j) - height - 12 AS top FROM b),
    f AS (SELECT *, min(CASE WHEN top + height > 900 THEN j END) OVER (PARTITION BY id, col_no) AS stop FROM s),
    kept AS (SELECT * FROM f WHERE j < stop),
    z AS (SELECT id, col_no, max(top + height + 12) AS used, max(stop) - CASE WHEN arg_max(kind, j) = 'title' THEN 1 ELSE 0 END AS size
      FROM kept GROUP BY id, col_no)
    SELECT id, CAST(col_no AS BIGINT) AS col_no, j AS pos, kind, CAST(top AS BIGINT) AS top, CAST(height AS BIGINT) AS height FROM kept WHERE kind <> 'title' OR j < stop - 1
    UNION ALL SELECT id, col_no, size + q, 'text', CAST(used + q * 72 AS BIGINT), 60 FROM z, range(0, 13) AS r(q) WHERE used + q * 72 + 60 <= 900"""
)
def page_layout(t: Tables) -> DataFrame:
    return forms.page_layout(t.customer.select(C("c_custkey").alias("id")))


@query(
    f"""SELECT id, sender, slot, CASE WHEN slot = 'code' THEN {digits_sql('id', 460, 12)} WHEN titled THEN no || '. TITLE' ELSE '' END AS text
    FROM (SELECT o_orderkey AS id, o_custkey AS sender, o_orderstatus = 'F' AS titled, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)
      OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS no FROM orders), (VALUES ('code'), ('title')) AS v(slot)"""
)
def waybill_extras(t: Tables) -> DataFrame:
    bills = t.orders.select(
        C("o_orderkey").alias("id"), C("o_custkey").alias("sender"), (C("o_orderstatus") == "F").alias("titled")
    )
    return forms.waybill_extras(bills)


def _price(salt: int) -> str:
    n = f"{integer_sql('x', salt, 100000, 999999)} * CASE WHEN {uniform_sql('x', salt + 1)} < CAST(0.5 AS DOUBLE) THEN -1 ELSE 1 END"
    return f"""CASE WHEN sec THEN '' WHEN {uniform_sql('x', salt + 2)} < CAST(0.1 AS DOUBLE) THEN '-' ELSE format('{{:,}}', {n}) END"""


@query(
    f"""WITH st AS (SELECT s_suppkey, pos FROM {advancing_sql('supplier', 's_suppkey', 470, 6, '0', 3, 6)} WHERE pos < 15),
    r AS (SELECT s.s_suppkey AS id, k AS row_no, s.s_suppkey * 1009 + k AS x, st.pos IS NOT NULL AS sec FROM supplier s
      CROSS JOIN range(0, 16) AS g(k) LEFT JOIN st ON st.s_suppkey = s.s_suppkey AND st.pos = k)
    SELECT id, row_no, CASE WHEN sec THEN 'INDEX ' || {letters_sql('x', 480, 6)} ELSE 'Index ' || ({letters_sql('x', 480, 6)})[1] ||
      lower(({letters_sql('x', 480, 6)})[2:]) END AS item, CASE WHEN sec THEN '' ELSE '$' END AS currency, CAST(row_no AS VARCHAR) AS line,
      {_price(490)} AS price1, {letters_sql('x', 500, 6)} AS second, {_price(510)} AS price2 FROM r"""
)
def report_table(t: Tables) -> DataFrame:
    return forms.report_table(t.supplier.select(C("s_suppkey").alias("id")))


@query(
    f"""WITH pg AS (SELECT s_suppkey AS id, i - 1 AS k, pos AS page FROM
      {advancing_sql('supplier', 's_suppkey', 522, 11, integer_sql('s_suppkey', 523, 1, 200), 1, 10)} WHERE i > 0),
    e AS (SELECT *, {uniform_sql('id', 520)} < CAST(0.5 AS DOUBLE) AS ex, {integer_sql('id', 521, 100, 900)} AS first, id * 101 + k AS x FROM pg)
    SELECT id, k + 1 AS line_no, CASE WHEN ex THEN 'exhibit' ELSE 'contents' END AS kind, CASE WHEN ex THEN (first + k + 1) || '.' ||
      {integer_sql('x', 525, 1, 4)} || ('abcdef')[{draw_sql('x', 524)} % 6 + 1] ELSE CAST(page AS VARCHAR) END AS mark,
      {letters_sql('x', 526, 12)} AS text FROM e"""
)
def listing_table(t: Tables) -> DataFrame:
    return forms.listing_table(t.supplier.select(C("s_suppkey").alias("id")))


@query(
    f"""SELECT table_id, CASE WHEN line_no = 2 THEN 'title' ELSE 'cell' END AS kind, rtrim(text) AS content, x * 12 AS l,
      (line_no - 1) * 30 + 15 AS t, (x + w) * 12 AS r, (line_no + 1) * 30 + 15 AS b FROM {CELLS} UNION ALL
    SELECT table_id, 'table', '1', 12, 45, (wa + wb + wc + 3) * 12, (n * 2 + 1) * 30 + 15 FROM {WIDTHS} UNION ALL
    SELECT table_id, 'signature', 'sign@' || table_id, 12, (n * 2 + 2) * 30, 12 + 240, (n * 2 + 2) * 30 + 30 FROM {WIDTHS}"""
)
def slot_tables(t: Tables) -> DataFrame:
    cells = tables.cell_positions(drawn(t), 24, 30).withColumnRenamed("table_id", "image_id").withColumn("content", F.rtrim("text"))
    box = structure.bounding_union(cells, "image_id").withColumn("content", F.lit("1"))
    sign = box.select(
        "image_id",
        F.concat(F.lit("sign@"), C("image_id").cast("string")).alias("content"),
        C("l"),
        (C("b") + 15).alias("t"),
        (C("l") + 240).alias("r"),
        (C("b") + 45).alias("b"),
    )
    merged = ann.merge_annotations(
        ("title", cells.where(C("line_no") == 2)), ("cell", cells.where(C("line_no") != 2)), ("table", box), ("signature", sign)
    )
    return merged.withColumnRenamed("image_id", "table_id")
