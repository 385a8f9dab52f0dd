"""Text as Column expressions: cleaning, display width, wrapping, alignment, look-alikes, names, money."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsynth.functions.binding import let
from docsynth.rng import draw

# Character classes and signs of the text-table format.
WIDE = (
    r"[ᄀ-ᅟ⺀-〾ぁ-꓏가-힣豈-﫿︰-﹯＀-｠￠-￦"
    r"\x{1F300}-\x{1FAFF}\x{20000}-\x{3FFFD}]"
)
INVISIBLE = r"[\p{C}\p{Z}&&[^\n ]]"
MARKS = r"\p{Mn}"
ANSI_CODE = r"\x1B\[[0-9;]*m"
RULE_SIGNS = "═║╔╦╗╠╬╣╚╩╝"
BODY_SPLIT = "[║╬╦╩╣╠╗╔╝╚]"

# Capital money digits and units, lowest unit first.
MONEY_DIGITS = "零壹贰叁肆伍陆柒捌玖"
MONEY_UNITS = ["分", "角", "元", "拾", "百", "千", "万", "拾", "百", "千", "亿", "拾", "百", "千", "万", "拾", "百", "千", "兆"]

# Two-letter typing code of syllable initials and finals.
SHUANGPIN = {
    "ai": "d", "an": "j", "ang": "h", "ao": "c", "ch": "i", "ei": "w", "en": "f", "eng": "g", "i": "i", "ia": "x",
    "ian": "m", "iang": "l", "iao": "n", "ie": "p", "in": "b", "ing": "k", "iong": "s", "iu": "q", "ong": "s",
    "ou": "z", "sh": "u", "u": "u", "ua": "x", "uai": "k", "uan": "r", "uang": "l", "ue": "t", "ui": "v", "un": "y",
    "uo": "o", "ve": "t", "zh": "v",
}

NATIVE_DIGITS = "०१२३४५६७८९"


def remove_invisible(c: Column) -> Column:
    return F.regexp_replace(c, INVISIBLE, "")


def remove_marks(c: Column) -> Column:
    return F.regexp_replace(c, MARKS, "")


def clean_text(c: Column) -> Column:
    return remove_marks(remove_invisible(c))


def display_width(c: Column) -> Column:
    """Columns a text takes on a fixed grid: wide signs count twice, marks and colour codes not at all."""
    seen = F.regexp_replace(c, f"{ANSI_CODE}|{MARKS}", "")
    return F.length(seen) + F.length(F.regexp_replace(seen, f"[^{WIDE[1:]}", ""))


def text_size(c: Column) -> Column:
    """STRUCT<width, height> of a multi-line text."""
    lines = F.split(c, "\n")
    return F.struct(F.array_max(F.transform(lines, display_width)).alias("width"), F.size(lines).alias("height"))


def with_starts(items: Column, size: Callable[[Column], Column], gap: int = 0) -> Column:
    """Texts with the sum of the sizes and gaps before each: ARRAY<STRUCT<item, x>>, in one pass."""
    zero = F.struct(F.array().cast("array<struct<item:string,x:bigint>>").alias("out"), F.lit(0).cast("bigint").alias("x"))

    def step(s: Column, item: Column) -> Column:
        here = F.struct(item.alias("item"), s["x"].alias("x"))
        return F.struct(F.concat(s["out"], F.array(here)).alias("out"), (s["x"] + size(item) + gap).cast("bigint").alias("x"))

    return F.aggregate(items, zero, step, lambda s: s["out"])


def wrap_chars(line: Column, width: int) -> Column:
    """Pieces of at most ``width`` columns; a wide sign that would overflow starts the next piece."""
    plain = F.regexp_extract_all(line, F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("used"))

    def step(s: Column, ch: Column) -> Column:
        w = display_width(ch)
        over = s["used"] + w > width
        return F.struct(
            F.when(over, F.concat(s["done"], F.array(s["cur"]))).otherwise(s["done"]).alias("done"),
            F.when(over, ch).otherwise(F.concat(s["cur"], ch)).alias("cur"),
            F.when(over, w).otherwise(s["used"] + w).alias("used"),
        )

    def finish(s: Column) -> Column:
        return F.when(s["cur"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["cur"])))

    mixed = F.aggregate(F.split(line, ""), start, step, finish)
    return F.when(line.rlike(WIDE), mixed).otherwise(plain)


def wrap_words(line: Column, width: int) -> Column:
    """Greedy word wrap; a word longer than the box is cut; text with wide signs wraps by character."""
    pieces = F.regexp_extract_all(line, F.lit(f"(?s)(.{{1,{width}}})(?: +|\\z)|(.{{{width}}})"), F.lit(0))
    return F.when(line.rlike(WIDE), wrap_chars(line, width)).otherwise(F.transform(pieces, lambda p: F.rtrim(p)))


def words_of(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def wrap_hyphens(line: Column, width: int) -> Column:
    """Greedy wrap that breaks a word with a hyphen where it does not fit.

    A word goes on the open line if a column is left after it. One that ends exactly at the edge closes the line. Of a
    longer one as many signs stay as leave two columns, with a hyphen if there are any; the rest opens the next line and
    is broken again while it is too long. Text with wide signs wraps by character.
    """
    body = width - 2

    def step(s: Column, word: Column) -> Column:
        # Most words fit, and for those nothing else is worked out.
        end = F.length(s["open"]) + F.length(word)
        fits = F.struct(s["done"].alias("done"), F.concat(s["open"], word, F.lit(" ")).alias("open"))
        closes = F.struct(F.concat(s["done"], F.array(F.concat(s["open"], word))).alias("done"), F.lit("").alias("open"))
        return F.when(end < width, fits).when(end == width, closes).otherwise(broken(s, word))

    def broken(s: Column, word: Column) -> Column:
        return let(F.struct(s.alias("s"), word.alias("w"), F.greatest(F.lit(body) - F.length(s["open"]), F.lit(0)).alias("cut")), placed)

    def placed(v: Column) -> Column:
        # What does not fit of the word, as whole pieces and a last one of at most a line.
        pieces = F.greatest(F.ceil((F.length(v["w"]) - v["cut"] - width) / body), F.lit(0)).cast("int")
        return let(F.struct(v.alias("v"), pieces.alias("n"), F.substring(v["w"], v["cut"] + pieces * body + 1, F.lit(width)).alias("last")), chosen)

    def chosen(m: Column) -> Column:
        v = m["v"]
        done, open_, word, cut = v["s"]["done"], v["s"]["open"], v["w"], v["cut"]
        head = F.concat(open_, F.when(cut > 0, F.concat(F.substring(word, F.lit(1), cut), F.lit("-"))).otherwise(""))
        between = F.when(m["n"] > 0, F.transform(F.sequence(F.lit(0), m["n"] - 1), lambda i: F.concat(F.substring(word, cut + i * body + 1, F.lit(body)), F.lit("-"))))
        none = F.array().cast("array<string>")
        full = F.length(m["last"]) == width
        return F.struct(
            F.concat(done, F.array(head), F.coalesce(between, none), F.when(full, F.array(m["last"])).otherwise(none)).alias("done"),
            F.when(full, "").otherwise(F.concat(m["last"], F.lit(" "))).alias("open"),
        )

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    lines = F.aggregate(words_of(line), start, step, lambda s: F.when(s["open"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))
    return F.when(line.rlike(WIDE), wrap_chars(line, width)).otherwise(F.transform(lines, lambda x: F.rtrim(x)))


def justify_squeezed(line: Column, slot: int, char_width: int) -> Column:
    """Lines of words with their start in pixels, from edge to edge: ARRAY<ARRAY<STRUCT<word, x>>>.

    A line takes one more word than fits if its gaps need to give up at most a tenth of a space for each of its words;
    otherwise what is left over is shared out. The first gaps take the rest of a division. The last line is set plainly.
    """
    words = F.transform(words_of(line), lambda w: F.struct(w.alias("word"), (F.length(w) * char_width).cast("bigint").alias("width")))
    kind = "array<struct<word:string,x:bigint>>"
    none, zero = F.array().cast(kind), F.lit(0).cast("bigint")
    start = F.struct(F.array().cast(f"array<struct<ws:{kind},extra:bigint>>").alias("done"), none.alias("ws"), zero.alias("used"))

    def ended(ws: Column, extra: Column) -> Column:
        return F.array(F.struct(ws.alias("ws"), extra.cast("bigint").alias("extra")))

    def state(done: Column, ws: Column, used: Column) -> Column:
        return F.struct(done.alias("done"), ws.alias("ws"), used.alias("used"))

    def step(s: Column, w: Column) -> Column:
        # Most words fit, and for those nothing else is worked out.
        # What a line has used before a word is where the word starts if no gap is changed.
        over, more = s["used"] + w["width"] - slot, F.concat(s["ws"], F.array(F.struct(w["word"].alias("word"), s["used"].alias("x"))))
        squeezed = (F.size(s["ws"]) > 0) & (10 * over <= F.size(s["ws"]) * char_width)
        left = slot - s["used"] + char_width
        plain = F.when(F.size(s["ws"]) == 0, s["done"]).otherwise(F.concat(s["done"], ended(s["ws"], left)))
        return (
            F.when(over <= 0, state(s["done"], more, s["used"] + w["width"] + char_width))
            .when(squeezed, state(F.concat(s["done"], ended(more, -over)), none, zero))
            .otherwise(state(plain, F.array(F.struct(w["word"].alias("word"), zero.alias("x"))), w["width"] + char_width))
        )

    lines = F.aggregate(words, start, step, lambda s: F.when(F.size(s["ws"]) == 0, s["done"]).otherwise(F.concat(s["done"], ended(s["ws"], zero))))

    def place(x: Column) -> Column:
        gaps, size = F.size(x["ws"]) - 1, F.abs(x["extra"])
        share, rest = F.when(gaps > 0, F.floor(size / gaps)).otherwise(0), F.when(gaps > 0, size % gaps).otherwise(0)
        sign = F.signum(x["extra"].cast("double")).cast("bigint")
        return let(F.struct(x["ws"].alias("ws"), (sign * share).alias("share"), (sign * rest).alias("rest"), sign.alias("sign")), spread)

    def spread(m: Column) -> Column:
        def at(w: Column, i: Column) -> Column:
            first = F.when(i < F.abs(m["rest"]), m["sign"] * i).otherwise(m["rest"])
            return F.struct(w["word"].alias("word"), (w["x"] + i * m["share"] + first).cast("bigint").alias("x"))

        return F.when(m["sign"] == 0, m["ws"]).otherwise(F.transform(m["ws"], at))

    return F.transform(lines, place)


def justify_words(line: Column, slot: int, char_width: int) -> Column:
    """Word start positions in pixels so that the first and last word touch the slot: ARRAY<STRUCT<word, x>>."""
    words = F.filter(F.split(line, " +"), lambda w: w != "")

    def measure(ws: Column) -> Column:
        gaps = F.size(ws) - 1
        free = F.lit(slot) - F.length(F.array_join(ws, "")) * char_width
        share = F.when(gaps > 0, F.floor(free / gaps)).otherwise(0)
        extra = F.when(gaps > 0, F.pmod(free, gaps)).otherwise(0)
        return F.struct(with_starts(ws, lambda w: F.length(w) * char_width).alias("ws"), share.alias("share"), extra.alias("extra"))

    def place(m: Column) -> Column:
        def at(w: Column, i: Column) -> Column:
            return F.struct(w["item"].alias("word"), (w["x"] + i * m["share"] + F.least(i, m["extra"])).cast("bigint").alias("x"))

        return F.transform(m["ws"], at)

    return let(words, lambda ws: let(measure(ws), place))


def justify_line(line: Column, width: int, last: Column) -> Column:
    """Share the spaces of a line over its gaps, the first gaps taking the rest; the last line and single words stay."""
    words = F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")

    def measure(ws: Column) -> Column:
        gaps = F.size(ws) - 1
        free = F.lit(width) - F.length(F.array_join(ws, ""))
        share = F.when(gaps > 0, F.floor(free / gaps)).otherwise(0).cast("int")
        extra = F.when(gaps > 0, F.pmod(free, gaps)).otherwise(0)
        return F.struct(
            ws.alias("ws"), F.repeat(F.lit(" "), share).alias("gap"), F.repeat(F.lit(" "), share + 1).alias("wide"), extra.alias("extra")
        )

    def spread(m: Column) -> Column:
        head = F.call_function("array_join", F.slice(m["ws"], F.lit(1), m["extra"] + 1), m["wide"])
        tail = F.call_function("array_join", F.slice(m["ws"], m["extra"] + 2, F.size(m["ws"])), m["gap"])
        return F.when(F.size(m["ws"]) > 1, F.concat(head, m["gap"], tail)).otherwise(head)

    return F.when(last, line).otherwise(let(words, lambda ws: let(measure(ws), spread)))


def date_like_digits(c: Column, ident: Column, salt: int = 10) -> Column:
    """0, 1, 2 and 9 stay, the other digits move by a seeded shift: the text still reads as a date."""
    shift = draw(ident, salt) % 6
    moved = [F.translate(c, "345678", "345678"[k:] + "345678"[:k]) for k in range(6)]
    return F.element_at(F.array(*moved), (shift + 1).cast("int"))


def scramble_digits(c: Column, ident: Column, salt: int = 11) -> Column:
    """Every digit is replaced, seeded by the row and its position; everything else stays."""

    def scramble(seed: Column) -> Column:
        def digit(ch: Column, i: Column) -> Column:
            fresh = F.pmod(seed + i * i * 31 + i * 17, F.lit(10)).cast("string")
            return F.when(ch.rlike("^[0-9]$"), fresh).otherwise(ch)

        return F.array_join(F.transform(F.split(c, ""), digit), "")

    return let(draw(ident, salt), scramble)


def minimal_period(c: Column) -> Column:
    """Smallest unit whose repetition gives the text."""
    twice = F.substring(F.concat(c, c), 2, 2147483647)
    return F.when(c == "", c).otherwise(F.substring(c, F.lit(1), F.position(c, twice)))


def trim_counts(c: Column) -> Column:
    return F.struct(
        (F.length(c) - F.length(F.ltrim(c))).alias("lead"), (F.length(c) - F.length(F.rtrim(c))).alias("trail")
    )


def clear_rules(c: Column) -> Column:
    return F.translate(c, RULE_SIGNS, " " * len(RULE_SIGNS))


def wide_to_dunder(c: Column) -> Column:
    return F.regexp_replace(c, WIDE, "__")


def money_text(amount: Column) -> Column:
    """Whole amounts with separators: zero as ``-``, negative in brackets."""
    shown = F.format_number(F.abs(amount), 0)
    return F.when(amount == 0, F.lit("-")).when(amount < 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)


def rmb_upper(cents: Column) -> Column:
    """Capital Chinese amount of an integer number of cents."""
    digits = F.lpad(cents.cast("string"), F.greatest(F.length(cents.cast("string")), F.lit(3)), F.lit("0"))
    signs = F.split(F.translate(digits, "0123456789", MONEY_DIGITS), "")
    units = F.reverse(F.slice(F.array(*[F.lit(u) for u in MONEY_UNITS]), F.lit(1), F.length(digits)))
    full = F.array_join(F.zip_with(signs, units, lambda s, u: F.concat(s, u)), "")
    for pattern, by in (
        ("零千零百零拾零[万亿]", "零"),
        ("零[千百拾角分]", "零"),
        ("零+", "零"),
        ("零([元万亿兆])", "$1"),
        ("零$", ""),
    ):
        full = F.regexp_replace(full, pattern, by)
    full = F.when(cents < 100, F.concat(F.lit("零"), full)).otherwise(full)
    return F.when(full.endswith("分"), full).otherwise(F.concat(full, F.lit("整")))


def pad_right(c: Column, width: int, sign: str = "<") -> Column:
    """Fill on the right; longer text is kept whole."""
    return F.concat(c, F.repeat(F.lit(sign), F.greatest(F.lit(width) - F.length(c), F.lit(0))))


def mrz_first(prefix: Column, surname: Column, given: Column) -> Column:
    return pad_right(F.concat(prefix, surname, F.lit("<<"), given), 44)


def mrz_second(body: Column, check: Column) -> Column:
    return F.concat(pad_right(body, 42), check)


def native_digits(c: Column) -> Column:
    return F.translate(c, "0123456789", NATIVE_DIGITS)


def signature_name(c: Column) -> Column:
    return F.substring_index(c, " ", 1)


def snake_name(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(c), r"\s+", "_"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"(\.[^.]*)$", 1)


def indent_item(item: Column, unit: str = "  ") -> Column:
    """Depth by the item's first sign: bracket twice, digit three times, else once."""
    times = F.when(item.startswith("（"), 2).when(item.rlike("^[0-9]"), 3).otherwise(1)
    return F.concat(F.repeat(F.lit(unit), times), item)


def split_on_gaps(line: Column) -> Column:
    """Pieces parted by two or more spaces with their start column: ARRAY<STRUCT<piece, x>>."""
    runs = F.regexp_extract_all(line, F.lit(r"(\S(?:\S| (?=\S))*)|( +)"), F.lit(0))

    pieces = F.filter(with_starts(runs, display_width), lambda s: F.trim(s["item"]) != "")
    return F.transform(pieces, lambda s: F.struct(s["item"].alias("piece"), s["x"].alias("x")))


def shuangpin(syllable: Column) -> Column:
    """Two-letter code of a syllable that ends in its tone sign; unknown parts leave the input as it is."""
    codes = F.create_map(*[F.lit(x) for kv in SHUANGPIN.items() for x in kv])
    body = F.substring(syllable, F.lit(1), F.length(syllable) - 1)
    bare = syllable.rlike("^[aoe]")
    double = (F.substring(syllable, 2, 1) == "h") & ~bare
    n = F.when(bare, 0).when(double, 2).otherwise(1)
    final = F.substring(body, n + 1, F.length(body))
    initial = (
        F.when(bare, F.substring(body, 1, 1))
        .when(double, F.element_at(codes, F.substring(body, 1, 2)))
        .otherwise(F.substring(body, 1, 1))
    )
    ending = F.when(F.length(final) > 1, F.element_at(codes, final)).otherwise(final)
    return (
        F.when(F.length(syllable) == 1, F.concat(syllable, syllable))
        .when(F.length(syllable) == 2, syllable)
        .otherwise(F.coalesce(F.concat(initial, ending), syllable))
    )


def upper_header(c: Column, role: Column) -> Column:
    return F.when(role == "section", F.upper(c)).when(role == "title", F.initcap(c)).otherwise(c)


def pad_to_cell(c: Column, left: Column, right: Column, cell_left: Column, cell_right: Column) -> Column:
    """Fill the room beside a text in its cell with underscores, as many as whole units of its letters fit."""

    def filled(unit: Column) -> Column:
        def bar(room: Column) -> Column:
            return F.repeat(F.lit("_"), F.greatest(F.floor(room / unit), F.lit(0)).cast("int"))

        return F.when(unit > 0, F.concat(bar(left - cell_left), c, bar(cell_right - right))).otherwise(c)

    width = display_width(c)
    return let(F.when(width > 0, F.floor((right - left) / width)).otherwise(0), filled)


def fit_font_size(c: Column, size: Column, width: Column) -> Column:
    """Greatest size up to ``size`` at which the text fits: a display column is half a size wide."""
    columns = display_width(c)
    return F.when(columns > 0, F.least(size, F.floor(2 * width / columns))).otherwise(size).cast("bigint")
