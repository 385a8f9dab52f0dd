"""Configurable forms, filled templates, page compositions, report and listing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth import rng
from docsynth.functions.binding import let
from docsynth.operators import corpus
from docsynth.operators.ordered import scan
from docsynth.operators.records import advancing, slot_action

# Block kinds of a form with their probability and least and greatest number.
BLOCKS = [
    ("single", 0.8, 1, 3), ("multi", 0.5, 1, 2), ("pairs", 0.7, 1, 2), ("options", 0.4, 1, 2), ("grid", 0.6, 1, 1),
    ("nested", 0.3, 1, 1), ("beside", 0.3, 1, 2),
]


def form_blocks(forms: DataFrame) -> DataFrame:
    """Blocks of every form ``id`` in seeded order: ``pos, kind, copy, half``.

    ``half`` says on which side of a two-part form the block goes. A form's blocks are made and ordered in its own row.
    """
    i = F.col("id")
    none = F.array().cast("array<struct<order:bigint,kind:string,copy:bigint>>")

    def copies(k: int, kind: str, ratio: float, low: int, high: int) -> Column:
        made = F.transform(
            F.sequence(F.lit(1).cast("bigint"), rng.integer(i, 410 + k, low, high)),
            lambda c: F.struct(rng.draw(i * 1009 + c * 11 + k, 430).alias("order"), F.lit(kind).alias("kind"), c.alias("copy")),
        )
        return F.when(rng.uniform(i, 400 + k) < ratio, made).otherwise(none)

    lists = [copies(k, *spec) for k, spec in enumerate(BLOCKS)]
    rows = forms.select("id", F.concat(*lists).alias("blocks"))
    halved = let(
        F.array_sort("blocks"),
        lambda bs: F.transform(
            bs,
            lambda b, i: F.struct(
                b["kind"].alias("kind"),
                b["copy"].alias("copy"),
                F.when(i * 2 < F.size(bs), "first").otherwise("second").alias("half"),
            ),
        ),
    )
    rows = rows.select("id", F.posexplode_outer(halved).alias("i", "b")).where(F.col("i").isNotNull())
    return rows.select(
        "id",
        (F.col("i") + 1).alias("pos"),
        "b.kind",
        "b.copy",
        "b.half",
    )


def block_lines(blocks: DataFrame) -> DataFrame:
    """Text lines of every block of :func:`form_blocks`."""
    ident = F.col("id") * 1009 + F.col("pos")
    seeded = blocks.withColumns({f"s{k}": rng.draw(ident, k) for k in (441, 442, 443, 445)} | {"n": rng.integer(ident, 440, 2, 5)})

    def word(j: Column, salt: int) -> Column:
        """Five letters that vary with j."""
        letters = [F.char((F.shiftright(F.col(f"s{salt}"), 5 * m) + j * (m + 3)) % 26 + 97) for m in range(5)]
        return F.concat(*letters)

    rows = F.sequence(F.lit(1).cast("bigint"), F.col("n"))

    def value(j: Column) -> Column:
        return F.when((F.col("s445") + j * 7) % 10 < 2, F.lit(" ")).otherwise(word(j, 442))

    grid = F.transform(rows, lambda j: F.concat_ws("|", word(j, 441), value(j), value(j + 100), value(j + 200)))
    head = F.array(F.concat_ws("|", F.lit(""), word(F.lit(301), 443), word(F.lit(302), 443), word(F.lit(303), 443)))
    over = F.array(F.concat_ws("|", F.lit(""), word(F.lit(311), 443), F.lit(""), F.lit("")))
    by_kind = {
        "single": F.array(F.concat_ws(": ", word(F.lit(1), 441), word(F.lit(2), 442))),
        "multi": F.transform(rows, lambda j: F.concat_ws(" ", word(j, 441), word(j + 10, 442), word(j + 20, 443))),
        "pairs": F.transform(rows, lambda j: F.concat_ws("|", word(j, 441), value(j), word(j + 50, 441), value(j + 50))),
        "options": F.array(
            F.concat_ws(" ", word(F.lit(1), 441), F.array_join(F.transform(rows, lambda j: F.concat(F.lit("[x]"), word(j, 442))), " "))
        ),
        "grid": F.concat(head, grid),
        "nested": F.concat(over, head, grid),
        "beside": F.transform(rows, lambda j: F.concat(F.rpad(word(j, 441), 12, " "), F.rpad(word(j, 442), 12, " "))),
    }
    chosen = F.lit(None).cast("array<string>")
    for kind, lines in by_kind.items():
        chosen = F.when(F.col("kind") == kind, lines).otherwise(chosen)
    return seeded.select("id", "pos", "kind", F.posexplode_outer(chosen).alias("line_no", "line"))


# Slots of one template, label with rectangle in signs.
SLOTS = [("key@NAME", 10, 10, 12), ("text", 10, 40, 20), ("image@photo", 300, 10, 10), ("text", 10, 70, 30), ("2024", 10, 100, 6)]


def template_fill(ids: DataFrame, numbered: DataFrame) -> DataFrame:
    """Slots of the template for every ``id, lang``: fixed and image slots stay, the rest is filled to its width."""
    slots = F.array(
        *[
            F.struct(F.lit(k).cast("bigint").alias("slot_no"), F.lit(label).alias("slot"), *[F.lit(v).cast("bigint").alias(n) for n, v in (("l", x), ("t", y), ("chars", c))])
            for k, (label, x, y, c) in enumerate(SLOTS, 1)
        ]
    )
    rows = ids.select("id", "lang", F.explode_outer(slots).alias("s")).select("id", "lang", "s.*")
    rows = rows.withColumns({"action": slot_action(F.col("slot")), "slot_id": F.col("id") * 100 + F.col("slot_no")})
    filled = corpus.fill_width(rows.where(F.col("action") == "replace").select("slot_id", "lang", "chars"), numbered)
    out = rows.join(filled, "slot_id", "left")
    label = (
        F.when(F.col("action") == "replace", F.concat(F.lit("text@"), F.coalesce("text", F.lit(""))))
        .when(F.col("action") == "digits", F.concat(F.lit("text@"), "slot"))
        .otherwise(F.col("slot"))
    )
    return out.select("id", "slot_no", label.alias("label"), "l", "t", (F.col("l") + F.col("chars") * 8).alias("r"), (F.col("t") + 16).alias("b"))


# Block sequences of the five page compositions, one list per column.
PAGES = [
    [["title", "text", "table"]],
    [["text", "table"], ["title", "text"]],
    [["title", "table"], ["title", "table"]],
    [["table", "text", "text"]],
    [["text", "title"], ["table"]],
]
PAGE_HEIGHT, PAGE_GAP, TEXT_HEIGHT = 900, 12, 60


def page_layout(pages: DataFrame) -> DataFrame:
    """Blocks of every page ``id`` with kind and top: composition by id % 5, each column filled as in ``page_fill``.

    A column holds at most as many blocks as fit a page, so it is folded in the page's own row. Only the columns of the
    page's own composition are folded. The table of ids is small beside that work, so it is dealt out first.
    """
    i = F.col("id")
    most = PAGE_HEIGHT // (30 + PAGE_GAP) + 1
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def composition(columns: list[list[str]]) -> Column:
        return F.array(*[F.struct(F.lit(c).alias("col_no"), F.array(*[F.lit(k) for k in kinds]).alias("kinds")) for c, kinds in enumerate(columns)])

    # An id that is negative or null has no composition.
    own = F.when(i % len(PAGES) >= 0, F.get(F.array(*[composition(columns) for columns in PAGES]), (i % len(PAGES)).cast("int")))
    rows = pages.select("id").repartition(parts, "id").select("id", F.explode_outer(own).alias("s")).select("id", "s.*")
    seed = F.coalesce(*[F.when(F.col("col_no") == c, rng.draw(i, 450 + c)) for c in range(max(len(columns) for columns in PAGES))]) % 5
    rows = rows.withColumns({"seed": seed, "n": F.size("kinds")})

    def height(kind: Column, j: Column) -> Column:
        return F.when(kind == "title", 30).when(kind == "text", TEXT_HEIGHT).otherwise(120 + (F.col("seed") + j * 7919) % 5 * 20).cast("bigint")

    def block(j: Column) -> Column:
        return let(F.get("kinds", j % F.col("n")), lambda kind: F.struct(kind.alias("kind"), height(kind, j).alias("height")))

    none = F.array().cast("array<struct<kind:string,top:bigint,height:bigint>>")
    zero = F.struct(F.lit(0).cast("bigint").alias("used"), F.lit(False).alias("full"), none.alias("kept"))

    def put(s: Column, b: Column) -> Column:
        one = F.array(F.struct(b["kind"].alias("kind"), s["used"].alias("top"), b["height"].alias("height")))
        more = F.struct((s["used"] + b["height"] + PAGE_GAP).alias("used"), F.lit(False).alias("full"), F.concat(s["kept"], one).alias("kept"))
        stop = F.struct(s["used"].alias("used"), F.lit(True).alias("full"), s["kept"].alias("kept"))
        return F.when(~s["full"] & (s["used"] + b["height"] <= PAGE_HEIGHT), more).otherwise(stop)

    def filled(f: Column) -> Column:
        last_title = F.try_element_at(f["kept"], F.lit(-1))["kind"] == "title"
        more = F.greatest(F.floor((PAGE_HEIGHT - f["used"] + PAGE_GAP) / (TEXT_HEIGHT + PAGE_GAP)), F.lit(0)).cast("int")
        texts = F.when(
            more > 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(more, F.lit(1)) - 1),
                lambda j: F.struct(
                    F.lit("text").alias("kind"),
                    (f["used"] + j * (TEXT_HEIGHT + PAGE_GAP)).alias("top"),
                    F.lit(TEXT_HEIGHT).cast("bigint").alias("height"),
                ),
            ),
        ).otherwise(none)
        return F.concat(F.when(last_title, F.slice(f["kept"], F.lit(1), F.size(f["kept"]) - 1)).otherwise(f["kept"]), texts)

    blocks = F.transform(F.sequence(F.lit(0), F.lit(most)), block)
    rows = rows.where(F.col("kinds").isNotNull()).select("id", "col_no", F.posexplode_outer(let(F.aggregate(blocks, zero, put), filled)).alias("pos", "b"))
    return rows.where(F.col("pos").isNotNull()).select("id", "col_no", "pos", "b.*")


def waybill_extras(bills: DataFrame) -> DataFrame:
    """``bills(id, sender, titled)``: twelve-digit code, an extra code slot, and a running number of titled bills per sender."""
    counted = scan(bills, ["sender"], {"block": F.floor(F.col("id") / 65536)}, ["id"], sums={"title_no": F.col("titled").cast("bigint")})
    code = rng.digits(F.col("id"), 460, 12)
    slots = F.array(
        F.struct(F.lit("code").alias("slot"), code.alias("text")),
        F.struct(
            F.lit("title").alias("slot"),
            F.when(F.col("titled"), F.concat(F.col("title_no").cast("string"), F.lit(". TITLE"))).otherwise(F.lit("")).alias("text"),
        ),
    )
    return counted.select("id", "sender", F.explode_outer(slots).alias("s")).select("id", "sender", "s.*")


def report_table(ids: DataFrame, n_rows: int = 16, subtitles: tuple[int, int] = (3, 6)) -> DataFrame:
    """Index rows and price columns: section rows in capitals with blanks, ``$`` column, line number, second index, dashes."""
    i = F.col("id")
    starts = advancing(i, 470, n_rows // subtitles[0] + 1, F.lit(0), *subtitles)
    rows = ids.select("id", starts.alias("starts"), F.explode_outer(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("row_no"))
    ident = i * 1009 + F.col("row_no")
    section = F.array_contains("starts", F.col("row_no").cast("bigint")) & (F.col("row_no") < n_rows - 1)
    name = F.concat(F.lit("index "), rng.letters(ident, 480, 6))

    def price(salt: int) -> Column:
        n = rng.integer(ident, salt, 100000, 999999) * F.when(rng.uniform(ident, salt + 1) < 0.5, -1).otherwise(1)
        shown = F.when(rng.uniform(ident, salt + 2) < 0.1, F.lit("-")).otherwise(F.format_number(n, 0))
        return F.when(section, F.lit("")).otherwise(shown)

    return rows.select(
        "id",
        "row_no",
        F.when(section, F.upper(name)).otherwise(F.initcap(F.lower(name))).alias("item"),
        F.when(section, F.lit("")).otherwise(F.lit("$")).alias("currency"),
        F.col("row_no").cast("string").alias("line"),
        price(490).alias("price1"),
        rng.letters(ident, 500, 6).alias("second"),
        price(510).alias("price2"),
    )


def listing_table(ids: DataFrame) -> DataFrame:
    """Ten lines per id: exhibits ``number.digit letter`` or contents with growing page numbers."""
    i = F.col("id")
    exhibit = rng.uniform(i, 520) < 0.5
    first = rng.integer(i, 521, 100, 900)
    pages = advancing(i, 522, 11, rng.integer(i, 523, 1, 200), 1, 10)
    rows = ids.select("id", exhibit.alias("exhibit"), first.alias("first"), F.posexplode_outer(F.slice(pages, 2, 10)).alias("k", "page"))
    ident = i * 101 + F.col("k")
    letter = F.lower(F.char(rng.draw(ident, 524) % 6 + 65))
    number = F.concat((F.col("first") + F.col("k") + 1).cast("string"), F.lit("."), rng.integer(ident, 525, 1, 4).cast("string"), letter)
    return rows.select(
        "id",
        (F.col("k") + 1).alias("line_no"),
        F.when(F.col("exhibit"), F.lit("exhibit")).otherwise(F.lit("contents")).alias("kind"),
        F.when(F.col("exhibit"), number).otherwise(F.col("page").cast("string")).alias("mark"),
        rng.letters(ident, 526, 12).alias("text"),
    )
