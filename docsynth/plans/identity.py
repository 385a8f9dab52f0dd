"""Identity papers of eleven countries and payment cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth import rng
from docsynth.functions import dates
from docsynth.functions.text import mrz_first, mrz_second

# Layout of the papers. lang, type, code, nationality, authority, years valid, number prefix, letters,
# digits and suffix, filler and digits of the second machine line, first machine line prefix, date style.
FIELDS = [
    "lang", "type", "code", "nationality", "authority", "years", "prefix", "n_letters", "n_digits", "suffix", "filler", "tail",
    "mrz", "style",
]
SPECS = [
    ("bn", "P", "BGD", "BANGLADESHI", "DIP", 5, "", 2, 7, "", "", 7, "P<BGD", "en"),
    ("cs", "P", "CZE", "ČESKÁ REPUBLIKA/CZECH REPUBLIC", "", 10, "", 0, 8, "", "<", 16, "P<CZE", "dot"),
    ("id", "P", "IDN", "INDONESIA", "", 5, "A", 0, 7, "", "<", 7, "P<IDN", "en"),
    ("lo", "C-B1", "", "", "NON", 5, "", 0, 9, "", "", 0, "", "title"),
    ("ms", "P", "MYS", "MALAYSIA", "UTC SUNGAI PETANI", 5, "A", 0, 8, "", "", 15, "P<MYS", "en"),
    ("ne", "P", "NPL", "NEPALESE", "MOFA,DEPARTMET OF PASSPORT", 10, "", 0, 8, "", "<", 18, "P<NPL", "en"),
    ("si", "PA", "LKA", "SRI LANKAN", "කෝලෝම්බෝ", 10, "N", 0, 7, "", "<", 7, "PALKA", "slash"),
    ("el", "P", "GRC", "ΕΛΛΗΝΙΚΗ", "Α.Ε.Α/Δ.Δ-N.P.C.", 5, "", 2, 7, "", "", 7, "P<GRC", "short"),
    ("fil", "P", "PHL", "FILIPINO", "", 10, "P", 0, 7, "A", "", 7, "P<PHL", "en"),
    ("km", "PN", "KHM", "CAMBODIAN", "MIN PHNOM PENH", 5, "N", 0, 7, "", "<", 15, "PNKHM", "insert"),
    ("nl", "P", "NLD", "Nederlandse", "", 10, "", 5, 4, "", "", 16, "P<NLD", "replace"),
]
SURNAMES = ["ADAMS", "BAKER", "CLARK", "DAVIS", "EVANS", "FOSTER", "GRANT", "HUGHES", "IRVING", "JONES", "KELLY", "LEWIS"]
GIVEN = ["ANNA", "BRUNO", "CLARA", "DAVID", "EMMA", "FELIX", "GRACE", "HENRY", "IRIS", "JONAS", "KARIN", "LEON"]


def styled_date(d: Column, style: Column) -> Column:
    """A date as the paper of a country prints it."""
    day, month, year = (F.lpad(f(d).cast("string"), n, "0") for f, n in ((F.dayofmonth, 2), (F.month, 2), (F.year, 4)))
    name = dates.month_name(d, "en")
    title = F.concat(F.substring(name, 1, 1), F.lower(F.substring(name, 2, 2)))
    return (
        F.when(style == "dot", F.concat_ws(".", month, day, year))
        .when(style == "slash", F.concat_ws("/", day, month, year))
        .when(style == "title", F.concat_ws(" ", day, title, year))
        .when(style == "short", F.concat_ws(" ", day, title, F.substring(year, 3, 2)))
        .when(style == "insert", dates.bilingual_date(d, "km", "insert"))
        .when(style == "replace", dates.bilingual_date(d, "nl", "replace"))
        .otherwise(dates.passport_date(d))
    )


def identity_records(people: DataFrame) -> DataFrame:
    """A paper for every ``id``; the country goes round by id. The eleven layouts are a literal table."""
    i = F.col("id")
    spec = people.sparkSession.createDataFrame([(k, *s) for k, s in enumerate(SPECS)], ["slot", *FIELDS])
    rows = people.select("id", F.pmod(i, F.lit(len(SPECS))).alias("slot")).join(spec, "slot")
    number = F.concat(
        "prefix",
        F.substring(rng.letters(i, 300, 5), F.lit(1), F.col("n_letters").cast("int")),
        F.substring(rng.digits(i, 310, 9), F.lit(1), F.col("n_digits").cast("int")),
        "suffix",
    )
    first = F.lit("1950-01-01").cast("date")
    rows = rows.select(
        "id",
        *FIELDS,
        number.alias("number"),
        rng.pick(i, 320, SURNAMES).alias("surname"),
        rng.pick(i, 321, GIVEN).alias("given"),
        rng.pick(i, 322, ["F", "M"]).alias("sex"),
        F.date_add(first, rng.integer(i, 323, 0, 20000).cast("int")).alias("born"),
        F.date_add(first, rng.integer(i, 324, 24000, 27000).cast("int")).alias("issued"),
    )
    has_mrz = F.col("mrz") != ""
    body = F.concat(
        "number", "filler", rng.digits(i, 330, 1), "code", rng.digits(i, 331, 7), "sex",
        F.substring(rng.digits(i, 333, 18), F.lit(1), F.col("tail").cast("int")),
    )
    style = F.col("style")
    return rows.select(
        "id",
        "lang",
        "type",
        "code",
        "nationality",
        "authority",
        "number",
        "surname",
        "given",
        "sex",
        styled_date(F.col("born"), style).alias("birth"),
        styled_date(F.col("issued"), style).alias("issue"),
        styled_date(dates.expiry(F.col("issued"), F.col("years")), style).alias("expiry"),
        F.when(has_mrz, mrz_first(F.col("mrz"), F.col("surname"), F.col("given"))).alias("line1"),
        F.when(has_mrz, mrz_second(body, rng.digits(i, 340, 2))).alias("line2"),
    )


# The parts of a card face and where they stand before scaling.
CARD_SCALE = 2.04
CARD_PARTS = [("number", 20, 120, 300, 30), ("holder", 20, 170, 180, 20), ("legend", 220, 170, 90, 20), ("issuer", 20, 20, 140, 40)]


def card_records(people: DataFrame) -> DataFrame:
    """Every part of a card (``id, name, issuer``) with its text, label ``part@text`` and scaled box."""
    i = F.col("id")
    number = F.concat_ws(" ", *[F.substring(rng.digits(i, 350, 16), 1 + 4 * k, 4) for k in range(4)])
    month, year = F.lpad(rng.integer(i, 360, 1, 12).cast("string"), 2, "0"), rng.integer(i, 361, 24, 33).cast("string")
    texts = {
        "number": number,
        "holder": F.upper("name"),
        "legend": F.concat(F.lit("VALID THRU "), month, F.lit("/"), year),
        "issuer": F.col("issuer"),
    }
    parts = F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                texts[part].alias("text"),
                *[F.lit(int(CARD_SCALE * v)).cast("bigint").alias(k) for k, v in zip("lt", (x, y))],
                *[F.lit(int(CARD_SCALE * a) + int(CARD_SCALE * b)).cast("bigint").alias(k) for k, a, b in (("r", x, w), ("b", y, h))],
            )
            for part, x, y, w, h in CARD_PARTS
        ]
    )
    rows = people.select("id", F.explode_outer(parts).alias("p")).select("id", "p.*")
    return rows.withColumn("label", F.concat_ws("@", "part", "text"))
