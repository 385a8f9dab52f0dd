"""Shaping of generated records: headings, missing values, slots, seeded steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.functions.binding import let
from docsynth.rng import draw, pick, uniform

# Synonyms of ledger headings, and the order in which optional columns go.
SYNONYMS = {
    "工作日期": ["日期", "交易日期", "交易时间", "入账日期", "记账日期", "交易日"],
    "账号": ["卡号", "主卡卡号", "账号/卡号", "借记卡卡号"],
    "注释": ["摘要", "交易摘要", "交易种类", "摘要代码", "交易名称", "交易描述", "备注"],
    "钞汇": ["现转"],
    "余额": ["账户余额", "交易余额", "账号余额", "联机余额", "活存账户余额"],
    "应用号": ["产品大类", "存款种类", "产品子类"],
    "网点号": ["网点", "交易网点"],
    "操作员": ["交易柜员", "柜员", "柜员流水号", "授权柜员号", "柜员号"],
    "地区号": ["交易地点"],
    "币种": ["货币"],
    "通知种类": ["发行代码"],
    "发生额": ["交易金额"],
}
OPTIONAL = ["应用号", "序号", "存期", "通知种类", "利息税", "操作员", "界面", "起息日", "利息", "约转期", "地区号", "止息日", "钞汇", "币种"]


def alias_of(key: str, ident: Column, salt: int) -> Column:
    return pick(ident, salt, SYNONYMS[key] + [key])


def alias_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename whole columns."""
    return df.withColumnsRenamed(names)


def drop_optional_columns(record: Column, k: Column) -> Column:
    """A record (a map of column names) without the last ``k`` of the optional ledger columns; k may differ by row."""
    gone = F.slice(F.array(*[F.lit(c) for c in OPTIONAL]), len(OPTIONAL) - k + 1, k)
    return let(gone, lambda names: F.map_filter(record, lambda key, _: ~F.array_contains(names, key)))


def inject_missing(text: Column, ident: Column, salt: int, blank: float, dash: float, brace: float) -> Column:
    """Blank, dash or bracketed instead of the text with the given shares."""
    u = uniform(ident, salt)
    return (
        F.when(u < blank, F.lit(" "))
        .when(u < blank + dash, F.lit("-"))
        .when(u < blank + dash + brace, F.concat(F.lit("("), text, F.lit(")")))
        .otherwise(text)
    )


# Rows set in bold and rows shaded.
BOLD = "^.*[其项合总年]*[中目计前额].*"
SHADED = "^[一二三四五六七八九十]+.*"


def layout(rows: Column, cols: Column, chinese: Column, ident: Column, salt: int) -> dict[str, Column]:
    """What may be done with a statement of so many rows and columns: Chinese ones are stacked by size, English ones may
    always go side by side, are never put on top of each other and nearly always get a nested header."""
    side, top, nested = (uniform(ident, salt + i) for i in range(3))
    return {
        "hstack": (side < 0.5) & (~chinese | (rows > 30)),
        "vstack": chinese & (top < 0.5) & (rows > 15),
        "paginate": (rows >= 30) & (cols > 3) & (cols < 6),
        "truncate": F.lit(True),
        "complex": (nested < F.when(chinese, 0.5).otherwise(0.9)) & (cols >= 3),
    }


def slot_action(label: Column) -> Column:
    """What happens to a template slot: images and ``key@`` stay, digits stay digits, the rest is replaced."""
    return (
        F.when(label.startswith("image@"), "image")
        .when(label.startswith("key@"), "fixed")
        .when(label.rlike("^[0-9]+$"), "digits")
        .otherwise("replace")
    )


def advancing(ident: Column, salt: int, n: int, start: Column, low: int, high: int) -> Column:
    """ARRAY of n positions, each a seeded step of low..high after the one before; the first is ``start``."""
    steps = F.transform(
        F.sequence(F.lit(1), F.lit(n - 1)), lambda i: (draw(ident, salt) + i * 7919 + i * i * 31) % (high - low + 1) + low
    )

    def grow(s: Column, d: Column) -> Column:
        return F.concat(s, F.array(F.element_at(s, -1) + d))

    return F.aggregate(steps, F.array(start.cast("bigint")), grow)


def running(start: Column, steps: Column) -> Column:
    """ARRAY of the running totals of a short array, the start itself left out."""
    grown = F.aggregate(steps, F.array(start.cast("bigint")), lambda s, d: F.concat(s, F.array(F.element_at(s, -1) + d)))
    return F.slice(grown, F.lit(2), F.size(steps))
