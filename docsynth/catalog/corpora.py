"""Corpus, web and curation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import Tables, draw_sql, integer_sql, lines, pick_sql, query, r4, r4_sql, words
from docsynth.functions import text
from docsynth.operators import corpus, curate, web
from docsynth.rng import draw, integer, pick
from docsynth.session import materialise

LANGS = ["de", "en", "es", "fr"]


@query("SELECT word, count(*) AS cnt FROM words GROUP BY word")
def token_counts(t: Tables) -> DataFrame:
    return corpus.token_counts(words(t), "word")


@query(
    """WITH tok AS (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents),
    c AS (SELECT word, count(*) AS cnt FROM tok WHERE length(word) > 1 GROUP BY word)
    SELECT word, cnt, CASE WHEN cnt > (SELECT max(cnt) // 2 FROM c) AND NOT regexp_matches(word, '[0-9]') THEN 'key'
    WHEN regexp_matches(word, '[0-9]') THEN 'value' WHEN length(word) > 10 THEN 'text' ELSE 'value' END AS kind FROM c"""
)
def classify_corpus(t: Tables) -> DataFrame:
    tokens = t.documents.select(F.explode_outer(F.split("text", r"\s+")).alias("word")).where(F.length("word") > 1)
    return corpus.classify_corpus(corpus.token_counts(tokens, "word"))


VOCAB = """(SELECT lang, word, length(word) AS n_chars, row_number() OVER (PARTITION BY lang, length(word) ORDER BY word) - 1 AS idx
    FROM (SELECT DISTINCT lang, word FROM words))"""
NUMBERED = """(SELECT lang, word, length(word) AS n_chars, row_number() OVER (PARTITION BY lang ORDER BY length(word), word) - 1 AS idx
    FROM (SELECT DISTINCT lang, word FROM words))"""
# A sharp s becomes SS in capitals, as in Unicode's full mapping.
CASED = """CASE WHEN upper(replace(word[1], 'ß', 'ss')) = word[1] AND upper(word[1]) <> lower(word[1]) AND lower(word[2:]) = word[2:]
    THEN upper(replace(w[1], 'ß', 'ss')) || lower(w[2:]) WHEN upper(replace(word, 'ß', 'ss')) = word AND upper(word) <> lower(word)
    THEN upper(replace(w, 'ß', 'ss')) WHEN lower(word) = word AND upper(word) <> lower(word) THEN lower(w) ELSE w END"""


def vocabulary(t: Tables) -> DataFrame:
    """The words of the documents by language and length, written once."""
    return materialise(corpus.vocab_by_length(words(t)), "vocabulary")


@query(f"SELECT * FROM {VOCAB}")
def vocab_by_length(t: Tables) -> DataFrame:
    return corpus.vocab_by_length(words(t))


@query(
    r"""SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS word FROM documents)
    WHERE regexp_matches(word, '^\p{L}+$') AND length(word) > 7"""
)
def long_words(t: Tables) -> DataFrame:
    tokens = t.documents.select("doc_id", F.explode_outer(F.split("text", r"\s+")).alias("word"))
    return tokens.where(F.col("word").rlike(r"^\p{L}+$") & (F.length("word") > 7))


@query(
    r"""SELECT doc_id, line_no, CASE WHEN contains(s, ' ') THEN s ELSE upper(s[1]) || lower(s[2:]) END AS sentence FROM
    (SELECT doc_id, line_no, regexp_replace(line, '^\S+\s*', '') AS s FROM lines WHERE regexp_full_match(line, '[\x00-\x7F]*'))"""
)
def word_filters(t: Tables) -> DataFrame:
    kept = lines(t).where(F.col("line").rlike(r"^[\x00-\x7F]*$"))
    s = F.regexp_replace("line", r"^\S+\s*", "")
    single = F.concat(F.upper(F.substring("s", 1, 1)), F.lower(F.substring("s", 2, 2147483647)))
    return kept.withColumn("s", s).select(
        "doc_id", "line_no", F.when(F.contains("s", F.lit(" ")), F.col("s")).otherwise(single).alias("sentence")
    )


@query("SELECT doc_id, n AS n_lines FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents) WHERE n >= 3")
def min_rows_filter(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.size(F.split("text", "\n")).alias("n_lines")).where(F.col("n_lines") >= 3)


@query(
    f"""WITH v AS {VOCAB}, z AS (SELECT lang, n_chars, count(*) AS size FROM v GROUP BY ALL),
    k AS (SELECT doc_id, pos, w.lang, w.word, n_chars, {draw_sql('doc_id * 100003 + pos', 30)} % size AS idx
      FROM words w JOIN z ON z.lang = w.lang AND z.n_chars = length(w.word))
    SELECT doc_id, pos, word, {CASED} AS fake FROM (SELECT k.*, v.word AS w FROM k JOIN v ON k.lang = v.lang
      AND k.n_chars = v.n_chars AND k.idx = v.idx)"""
)
def word_like(t: Tables) -> DataFrame:
    tokens = words(t)
    ident = F.col("doc_id") * 100003 + F.col("pos")
    return corpus.word_like(tokens, vocabulary(t), ident).select("doc_id", "pos", "word", "fake")


@query(
    f"""WITH v AS {VOCAB}, z AS (SELECT lang, n_chars, count(*) AS size FROM v GROUP BY ALL),
    r AS (SELECT doc_id, lang, unnest(x) AS word, generate_subscripts(x, 1) - 1 AS pos FROM (SELECT doc_id, lang,
      regexp_extract_all(text, '\\p{{L}}[\\p{{L}}\\p{{M}}]*|[0-9]+|[^\\p{{L}}0-9]+') AS x FROM documents)),
    k AS (SELECT r.*, length(word) AS n, {draw_sql('doc_id * 100003 + pos', 30)} AS d,
      CAST({draw_sql('doc_id * 100003 + pos', 10)} % 6 AS INTEGER) AS s FROM r),
    m AS (SELECT k.*, v.word AS w FROM k LEFT JOIN z ON k.lang = z.lang AND k.n = z.n_chars AND regexp_matches(k.word, '^\\p{{L}}')
      LEFT JOIN v ON v.lang = k.lang AND v.n_chars = k.n AND v.idx = k.d % z.size)
    SELECT doc_id, string_agg(CASE WHEN regexp_matches(word, '^\\p{{L}}') THEN {CASED}
      WHEN regexp_matches(word, '^[0-9]') THEN translate(word, '345678', ('345678345678')[s + 1 : s + 6]) ELSE word END, ''
      ORDER BY pos) AS text FROM m GROUP BY doc_id"""
)
def sentence_like(t: Tables) -> DataFrame:
    return corpus.sentence_like(t.documents, vocabulary(t))


@query(
    f"""WITH v AS {VOCAB}, z AS (SELECT lang, n_chars, count(*) AS size FROM v GROUP BY ALL),
    s AS (SELECT c_custkey AS slot_id, {pick_sql('c_custkey', 40, LANGS)} AS lang, {integer_sql('c_custkey', 41, 4, 160)} AS budget
      FROM customer),
    b AS (SELECT slot_id, s.lang, budget, coalesce(max(n_chars) FILTER (n_chars * 8 <= budget), min(n_chars)) AS n_chars
      FROM s JOIN z ON s.lang = z.lang GROUP BY ALL)
    SELECT slot_id, budget, v.word FROM b JOIN z ON b.lang = z.lang AND b.n_chars = z.n_chars
      JOIN v ON v.lang = b.lang AND v.n_chars = b.n_chars AND v.idx = {draw_sql('slot_id', 32)} % z.size"""
)
def longest_word_that_fits(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    slots = t.customer.select(key.alias("slot_id"), pick(key, 40, LANGS).alias("lang"), integer(key, 41, 4, 160).alias("budget"))
    return corpus.longest_word_that_fits(slots, vocabulary(t), 8, F.col("slot_id")).select("slot_id", "budget", "word")


@query(
    f"""WITH v AS {NUMBERED}, z AS (SELECT lang, count(*) AS size FROM v GROUP BY lang),
    s AS (SELECT c_custkey AS slot_id, {pick_sql('c_custkey', 40, LANGS)} AS lang, {integer_sql('c_custkey', 42, 4, 40)} AS chars
      FROM customer),
    k AS (SELECT s.*, k FROM s, range(0, 21) AS r(k) WHERE k <= chars // 2),
    i AS MATERIALIZED (SELECT k.*, {draw_sql('k.slot_id * 1009 + k.k', 34)} % z.size AS idx FROM k JOIN z ON k.lang = z.lang),
    p AS (SELECT i.slot_id, i.chars, i.k, v.word, v.n_chars FROM i JOIN v ON v.lang = i.lang AND v.idx = i.idx),
    l AS (SELECT *, chars - coalesce(sum(n_chars + 1) OVER (PARTITION BY slot_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS lft FROM p)
    SELECT slot_id, string_agg(substr(word, 1, CAST(lft AS BIGINT)), ' ' ORDER BY k) AS text FROM l
    WHERE lft >= CASE WHEN k = 0 THEN 2 ELSE 4 END GROUP BY slot_id"""
)
def fill_width(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    slots = t.customer.select(key.alias("slot_id"), pick(key, 40, LANGS).alias("lang"), integer(key, 42, 4, 40).alias("chars"))
    return corpus.fill_width(slots, materialise(corpus.number_words(words(t)), "numbered"))


@query(f"SELECT doc_id, row_number() OVER (ORDER BY {draw_sql('doc_id', 36)}, doc_id) AS position FROM documents")
def shuffle(t: Tables) -> DataFrame:
    return corpus.shuffle(t.documents.select("doc_id"), "doc_id")


@query(
    f"""SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {draw_sql('doc_id', 37)}, doc_id) AS rn FROM documents
    QUALIFY rn <= 20"""
)
def sample(t: Tables) -> DataFrame:
    docs = t.documents.select("lang", "doc_id").withColumn("d", draw(F.col("doc_id"), 37))
    return corpus.top_n(docs, ["lang"], [F.col("d"), F.col("doc_id")], 20, F.col("d")).drop("d")


@query(
    f"""WITH n AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS idx FROM documents),
    z AS (SELECT lang, count(*) AS size, min(doc_id) AS seed FROM documents GROUP BY lang),
    d AS (SELECT lang, k AS draw_no, {draw_sql('seed * 101 + k', 38)} % size + 1 AS idx FROM z, range(1, 31) AS r(k))
    SELECT d.lang, draw_no, doc_id FROM d JOIN n ON n.lang = d.lang AND n.idx = d.idx"""
)
def sample_with_replacement(t: Tables) -> DataFrame:
    return corpus.sample_with_replacement(t.documents.select("lang", "doc_id"), "lang", "doc_id", 30)


@query(
    r"""SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(string_split_regex(substr(line, instr(line, '@') + 1), '\s+')) AS w
    FROM (SELECT 'text@' || line AS line FROM lines)) WHERE regexp_matches(w, '^\p{L}+$')"""
)
def read_word_sets(t: Tables) -> DataFrame:
    from docsynth.sources.labels import word_set

    return word_set(lines(t).select(F.concat(F.lit("text@"), "line").alias("value")))


# ---------------------------------------------------------------- pages

TEXT = r"""trim(regexp_replace(regexp_replace(regexp_replace(PART,
    '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gs'), '<[^>]*>', ' ', 'gs'), '\s+', ' ', 'g'))"""


ENTITIES = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("nbsp", "\u00a0"), ("amp", "&")]


def plain_sql(part: str) -> str:
    """Text of a part of a page, without tags, entities decoded."""
    out = TEXT.replace("PART", part)
    for name, sign in ENTITIES:
        out = f"replace({out}, '&{name};', '{sign}')"
    return out


PARTS = """(SELECT page_id, url, html, regexp_extract(html, '<article[^>]*>(.*)</article>', 1, 's') AS article,
    regexp_extract(html, '<body[^>]*>(.*)</body>', 1, 's') AS body FROM pages)"""
CONTENT = rf"""coalesce(nullif(array_to_string(list_filter(list_transform(string_split_regex(article, '<[pP](?:\s[^>]*)?>')[2:],
    lambda p: {plain_sql("regexp_replace(p, '</[pP]>.*', '', 's')")}), lambda p: p <> ''), chr(10)), ''),
    nullif({plain_sql("article")}, ''), {plain_sql("body")})"""


@query(
    f"SELECT page_id, url, {CONTENT} AS content FROM {PARTS}"
)
def article_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", web.article_text(F.col("html")).alias("content"))


@query(f"SELECT page_id FROM (SELECT page_id, {CONTENT} AS content FROM {PARTS}) WHERE length(content) > 0")
def drop_empty_content(t: Tables) -> DataFrame:
    articles = t.pages.select("page_id", web.article_text(F.col("html")).alias("content"))
    return articles.where(F.length("content") > 0).select("page_id")


@query(
    r"""SELECT DISTINCT host, link FROM (SELECT regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
    unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS link FROM pages)
    WHERE regexp_matches(host, 'example\.(com|org)$') AND regexp_matches(link, '^/[A-Za-z]+$')"""
)
def link_filter(t: Tables) -> DataFrame:
    found = t.pages.select(web.host(F.col("url")).alias("host"), F.explode_outer(web.links(F.col("html"))).alias("link"))
    kept = found.where(web.allowed(F.col("host"), r"example\.(com|org)$") & web.allowed(F.col("link"), "^/[A-Za-z]+$"))
    return kept.distinct()


@query(
    r"""SELECT site, page_id, row_number() OVER (PARTITION BY site ORDER BY page_id) AS rn FROM (SELECT page_id,
    regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS site FROM pages) QUALIFY rn <= 10"""
)
def per_site_cap(t: Tables) -> DataFrame:
    sites = t.pages.select(web.host(F.col("url")).alias("site"), "page_id")
    return corpus.top_n(sites, ["site"], [F.col("page_id")], 10, F.col("page_id"))


@query(
    r"""SELECT DISTINCT page_id, x AS ident FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, 'href="/([^"]+)"', 1)[2:],
    lambda s: lower(s))) AS x FROM pages)"""
)
def extract_ids(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit(r'href="/([^"]+)"'), F.lit(1))
    rest = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
    return t.pages.select("page_id", F.explode_outer(F.array_distinct(F.transform(rest, F.lower))).alias("ident")).where(F.col("ident").isNotNull())


@query(
    r"""SELECT regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS name, count(DISTINCT url) AS n_urls,
    min(url) AS first_url FROM pages GROUP BY 1"""
)
def mirror_groups(t: Tables) -> DataFrame:
    return curate.mirror_groups(t.pages, "url")


@query(
    r"""WITH n AS (SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS name FROM pages),
    d AS (SELECT regexp_replace(url, '[?#].*$', '') AS name FROM pages WHERE contains(url, '#'))
    SELECT name FROM n WHERE name NOT IN (SELECT name FROM d)"""
)
def incremental_todo(t: Tables) -> DataFrame:
    name = F.regexp_replace("url", r"[?#].*$", "").alias("name")
    done = t.pages.where(F.contains("url", F.lit("#"))).select(name)
    return curate.incremental_todo(t.pages.select(name), done, "name")


# ---------------------------------------------------------------- curation


@query(
    """SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS kept FROM documents"""
)
def keep_list(t: Tables) -> DataFrame:
    names = t.documents.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit("-page.jpg")).alias("name"))
    items = names.withColumn("stem", F.substring_index(text.stem(F.col("name")), "-", 1))
    reviewed = t.labels.select(F.col("doc_id").cast("string").alias("stem"))
    kept = curate.keep_list(items, reviewed, "stem").select("doc_id", F.lit(True).alias("kept"))
    return kept.unionByName(curate.removed(items, reviewed, "stem").select("doc_id", F.lit(False).alias("kept")))


@query(
    """SELECT doc_id || '_' || source || '_' || lang || '.jpg' AS composite, doc_id || '_' || source || '.png' AS mask,
    doc_id || '.jpg' AS "real" FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""
)
def assemble_triples(t: Tables) -> DataFrame:
    ident = F.col("doc_id").cast("string")
    name = F.concat(ident, F.lit("_"), F.col("source"), F.lit("_"), F.col("lang"), F.lit(".jpg"))
    two = F.concat(ident, F.lit("_"), F.col("source"))
    docs = t.documents
    split = docs.join(t.labels, "doc_id", "left_semi").select(name.alias("composite"))
    masks = docs.select(two.alias("mask_key"), F.concat(two, F.lit(".png")).alias("mask"))
    reals = docs.select(ident.alias("real_key"), F.concat(ident, F.lit(".jpg")).alias("real"))
    return curate.assemble_triples(docs.select(name.alias("composite")), masks, reals, split)


@query(
    f"""SELECT event_type, count(*) FILTER (k = 0) AS errors, count(*) AS total,
    {r4_sql('1 - CAST(count(*) FILTER (k = 0) AS DOUBLE) / count(*)')} AS score FROM (SELECT event_type,
    CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) % 10 AS k FROM events) GROUP BY event_type"""
)
def pass_rate(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint") % 10
    rated = curate.pass_rate(t.events.select("event_type", k.alias("k"), "value"), "event_type", F.try_divide("value", "k"))
    return rated.withColumn("score", r4(F.col("score")))


# Short codes of column headings.
HEADINGS = {"ECONOMY": "E", "STANDARD": "S", "PROMO": "P", "SMALL": "K"}
WHEN_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HEADINGS.items())


@query(f"SELECT p_partkey, CASE p_type {WHEN_SQL} ELSE p_type END AS code FROM part")
def dictionary_lookup(t: Tables) -> DataFrame:
    return curate.dictionary_lookup(t.part, "p_type", HEADINGS, "code").select("p_partkey", "code")
