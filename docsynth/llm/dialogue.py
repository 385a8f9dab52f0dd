"""Repair of conversation structure at the least cost, by a dynamic program over runs of equal symbols.

A conversation is the sequence of its rows by turn. Each row is a symbol, its kind of role and its fault, and a symbol
takes the repair from state to state of the pattern ``(s?(ua)+)?`` at some cost: a min-plus matrix. Equal rows and equal
consecutive symbols are one run; a run is advanced through binary powers of its symbol's matrix, which are kept. Choices
are unrolled from the costs of what is left: at each place the least letter among the cheapest, so the audit is the
ASCII-least of all cheapest ones.

Rows are sorted over all conversations at once, so a conversation of any length is spread over tasks, and cut into
segments. A segment becomes one matrix; costs go backwards and states forwards through a tree of segments
(:func:`docsynth.operators.ordered.entry_states`), and each segment is unrolled on its own. Only the digest of a repaired
conversation has to read its rows one after the other: it is streamed and holds one batch.

Defined cases: null role, text, turn or id count as one space where they are text; a null turn comes first, and rows of
one turn stand by role, then text. Repeated rows are rows of their own, next to each other. A null conv_id is a
conversation. An empty role has an empty initial, which no pattern takes. Other columns are ignored; a conversation that
loses all its rows has zeros, an empty audit and the digest of an empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsynth.operators.ordered import entry_states
from docsynth.session import materialise

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a segment, each standing for all equal ones of its turn.
SEGMENT = 4096
INK = r"[^\x20\x09-\x0D]"

#: States: nothing yet, after s, after u, after a. Those in which a conversation may end; where u or a leads.
ENDS = (0, 3)
NEXT = (2, 2, 3, 2)
NEVER = 1 << 50
#: Kinds of role by initial, and faults.
KINDS = {"s": 0, "u": 1, "a": 2}
FINE, GONE, CUT = 0, 1, 2
Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the damage that the checksum of ``conv_id:turn`` sets: (conv, turn, role, text, times)."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    sort = F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn")).cast("binary")) % 20
    told = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), as_text("role").alias("role"), as_text("text").alias("text"), sort.alias("sort")).where("sort <> 0")
    text = F.when(F.col("sort") == 1, "").when(F.col("sort") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("sort") == 4, "user").otherwise(F.col("role"))
    return told.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("sort") == 3, 2).otherwise(1).alias("times"))


def symbols(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turn, role, text, times, first, again, blank, opens): one row for equal rows of a turn, with the symbol of
    the first of them and that of the others; ``opens`` where role and text stand for the first time."""
    key = F.coalesce(F.col(conv).cast("string"), F.lit(""))
    merged = rows.select(key.alias("conv"), "turn", "role", "text", "times").groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    merged = materialise(merged, "turns")
    digest = F.sha2("text", 256)
    starts = merged.groupBy("conv", "role", digest.alias("digest")).agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("start"))
    starts = starts.select("conv", "role", "digest", F.col("start.turn").alias("start"))
    seen = merged.withColumn("digest", digest).join(starts, ["conv", "role", "digest"])
    initial = F.substring("role", 1, 1)
    kind = F.coalesce(*[F.when(initial == k, i) for k, i in KINDS.items()], F.lit(len(KINDS)))
    blank = ~F.col("text").rlike(INK)
    cut = ~F.col("text").rlike(rf"[.!?][\x20\x09-\x0D]*\z")
    opens = F.col("turn").eqNullSafe(F.col("start"))
    fault = F.when(blank | ~opens, GONE).when(cut, CUT).otherwise(FINE)
    return seen.select("conv", "turn", "role", "text", "times", (kind * 3 + fault).alias("first"), (kind * 3 + GONE).alias("again"), blank.alias("blank"), opens.alias("opens"))


def plus(a: Matrix, b: Matrix) -> Matrix:
    """Product in which times is plus and plus is the minimum."""
    return tuple(tuple(min(x + y for x, y in zip(row, col, strict=True)) for col in zip(*b, strict=True)) for row in a)


def advance(m: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in m)


@cache
def inserts() -> Matrix:
    """Cheapest way from state to state by inserting alone."""
    step = tuple(tuple(0 if i == j else INSERT if j == NEXT[i] else NEVER for j in range(4)) for i in range(4))
    return plus(plus(step, step), plus(step, step))


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of what may be done with a row, inserts left out."""
    kind, fault = divmod(symbol, 3)
    out = [("D", DELETE, state)]
    if fault != GONE:
        stays = TRUNCATED if fault == CUT else 0
        if kind == 0 and state == 0:
            out.append(("K", stays, 1))
        if kind == (2 if state == 2 else 1):
            out.append(("K", stays, NEXT[state]))
        out.append(("R", stays + REROLE, NEXT[state]))
    return out


@cache
def power(symbol: int, exponent: int) -> Matrix:
    """The matrix of 2**exponent rows of a symbol, with whatever is inserted before each."""
    if exponent:
        half = power(symbol, exponent - 1)
        return plus(half, half)
    step = tuple(tuple(min([c for _, c, to in choices(symbol, i) if to == j], default=NEVER) for j in range(4)) for i in range(4))
    return plus(inserts(), step)


def powers(symbol: int, length: int) -> list[Matrix]:
    """Matrices whose product in any order is that of a run."""
    return [power(symbol, e) for e in range(length.bit_length()) if length >> e & 1]


def after_last() -> Vector:
    """Cost of ending in each state, by inserts."""
    return advance(inserts(), tuple(0 if s in ENDS else NEVER for s in range(4)))


def product(runs: list[tuple[int, int]]) -> Matrix:
    out: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
    for symbol, length in runs:
        for m in powers(symbol, length):
            out = plus(out, m)
    return tuple(tuple(min(x, NEVER) for x in row) for row in out)


def costs(runs: list[tuple[int, int]], end: Vector) -> list[Vector]:
    """Cost of all that is left, before each run and at the end."""
    out = [end]
    for symbol, length in reversed(runs):
        v = out[-1]
        for m in powers(symbol, length):
            v = advance(m, v)
        out.append(v)
    return out[::-1]


def unroll(runs: list[tuple[int, int]], end: Vector, state: int, last: bool) -> tuple[list[list[str]], int]:
    """Letters of each row of each run (inserts before a row stand with it), and the state after them.

    Of the cheapest choices the one of the least letter is taken; the empty end is less than any letter.
    """
    left, out = costs(runs, end), []
    for (symbol, length), after in zip(runs, left[1:], strict=True):
        # Costs before each row of this run, from its end.
        within, one = [after], power(symbol, 0)
        for _ in range(length):
            within.append(advance(one, within[-1]))
        letters = []
        for k in range(length, 0, -1):
            here, then, done = within[k], within[k - 1], ""
            while True:
                ways = [(x, c + then[to], to) for x, c, to in choices(symbol, state)] + [("I", INSERT + here[NEXT[state]], NEXT[state])]
                letter, _, state = min(w for w in ways if w[1] == here[state])
                done += letter
                if letter != "I":
                    break
            letters.append(done)
        out.append(letters)
    if last:
        while state not in ENDS:
            out[-1][-1] += "I"
            state = NEXT[state]
    return out, state


def sorted_rows(rows: DataFrame) -> DataFrame:
    """The written rows with their place: (part, segment, at), segments of a conversation in a row."""
    most = SEGMENT

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, segment, at = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            segments, places = [], []
            for one in batch.column("conv").to_pylist():
                at += 1
                if one != conv:
                    conv, segment, at = one, 0, 0
                elif at == most:
                    segment, at = segment + 1, 0
                segments.append(segment)
                places.append(at)
            new = [pa.array([part] * len(batch), pa.int64()), pa.array(segments, pa.int64()), pa.array(places, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "part", "segment", "at"])

    order = ["conv", "turn", "role", "text"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = ", ".join(f"{n} {k}" for n, k in ranged.dtypes)
    return materialise(ranged.mapInArrow(place, f"{kinds}, part long, segment long, at int"), "rows")


def run_list(rows: list[dict]) -> list[tuple[int, int]]:
    """Runs of equal symbols of a segment's rows."""
    out: list[tuple[int, int]] = []
    for r in rows:
        for symbol, length in ((r["first"], 1), (r["again"], r["times"] - 1)):
            if length and out and out[-1][0] == symbol:
                out[-1] = (symbol, out[-1][1] + length)
            elif length:
                out.append((symbol, length))
    return out


def per_batch(df: DataFrame, schema: str, work) -> DataFrame:
    """Rows that ``work`` makes of each row, as dicts."""
    names = [x.split()[0] for x in schema.split("; ")]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [x for r in batch.to_pylist() for x in work(r)]
            yield pa.RecordBatch.from_arrays([pa.array([m[n] for m in made], k) for n, k in zip(names, kinds, strict=True)], names)

    kinds = [ARROW[x.split()[1]] for x in schema.split("; ")]
    return df.mapInArrow(task, schema.replace(";", ","))


ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
PLACE = "conv string; part long; segment long"


def repaired(placed: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256, cost) of the conversations whose rows and segments these are."""
    key = ["conv", "part", "segment"]
    several = segments.where("of > 1")
    end = F.array(*[F.lit(x).cast("long") for x in after_last()])

    # Costs of what is left go backwards through the segments of a conversation.
    tables = per_batch(several.select(*key, "rows", (F.col("of") - 1 - F.col("nth")).alias("back")), f"{PLACE}; back long; matrix array<long>", lambda r: [r | {"matrix": sum(product(run_list(r["rows"])), ())}])
    entry = lambda m, i, j: F.get(m, i * 4 + j)
    times = lambda a, b: F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.least(F.lit(NEVER), F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda x: F.get(a, F.floor(k / 4).cast("int") * 4 + x) + F.get(b, x * 4 + k % 4)))))
    on = lambda m, v: F.array(*[F.array_min(F.array(*[entry(m, F.lit(i), F.lit(j)) + F.get(v, F.lit(j)) for j in range(4)])) for i in range(4)])
    # Neighbours come in backward order, so the later one in the tree is the left factor.
    left = entry_states(tables, ["conv"], "back", "matrix", end, on, lambda one, two: times(two, one)).withColumnRenamed("state", "end")
    with_end = several.withColumn("back", F.col("of") - 1 - F.col("nth")).join(left, ["conv", "back"]).select(*key, "rows", "nth", "of", "end")

    # States go forwards, each segment saying where it leads from every state.
    maps = per_batch(with_end, f"{PLACE}; nth long; leads array<int>", lambda r: [r | {"leads": [unroll(run_list(r["rows"]), tuple(r["end"]), s, False)[1] for s in range(4)]}])
    entered = entry_states(maps, ["conv"], "nth", "leads", F.lit(0), lambda m, s: F.get(m, s), lambda one, two: F.transform(one, lambda s: F.get(two, s)))
    whole = segments.where("of = 1").select(*key, "rows", "nth", "of", end.alias("end"), F.lit(0).alias("state"))
    ready = whole.unionByName(with_end.join(entered, ["conv", "nth"]).select(*key, "rows", "nth", "of", "end", "state"))

    def edits(r: dict) -> list[dict]:
        runs = run_list(r["rows"])
        letters, _ = unroll(runs, tuple(r["end"]), r["state"], r["nth"] == r["of"] - 1)
        flat = [x for run in letters for x in run]
        cost, at, out, state = costs(runs, tuple(r["end"]))[0][0] if r["nth"] == 0 else 0, 0, [], r["state"]
        for row in r["rows"]:
            mine = "".join(flat[at : at + row["times"]])
            out.append({k: r[k] for k in ("conv", "part", "segment")} | {"at": row["at"], "edits": mine, "state": state, "cost": cost})
            for x in mine:
                state = state if x == "D" else 1 if x == "K" and state == 0 and row["first"] // 3 == 0 else NEXT[state]
            at, cost = at + row["times"], 0
        return out

    chosen = per_batch(ready, f"{PLACE}; at int; edits string; state int; cost long", edits)
    lines = placed.select(*key, "at", "role", "text").join(chosen, [*key, "at"])
    return lines.repartition("conv").sortWithinPartitions(*key, "at").select("conv", "role", "text", "edits", "state", "cost").mapInArrow(digests, "conv string, audit string, repaired_sha256 string, cost long")


def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation from its sorted rows, read once; the audit is its longest value."""
    names = ["conv", "audit", "repaired_sha256", "cost"]
    conv, audit, sha, lines, cost = None, [], hashlib.sha256(), 0, 0

    def add(role: str, text: str) -> None:
        nonlocal lines
        sha.update((("\n" if lines else "") + role + ":" + text).encode())
        lines += 1

    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if r["conv"] != conv:
                if conv is not None:
                    done.append((conv, "".join(audit), sha.hexdigest(), cost))
                conv, audit, sha, lines, cost = r["conv"], [], hashlib.sha256(), 0, 0
            audit.append(r["edits"])
            cost += r["cost"]
            state = r["state"]
            for x in r["edits"]:
                if x == "D":
                    continue
                after = NEXT[state]
                role = "user" if after == 2 else "assistant"
                if x == "K":
                    role = r["role"]
                    after = 1 if state == 0 and role[0] == "s" else after
                add(role, "" if x == "I" else r["text"])
                state = after
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names)
    if conv is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (conv, "".join(audit), sha.hexdigest(), cost)], names)


def tally(placed: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal) from the rows with their place and their segments."""
    counts = {
        "blank": F.when(F.col("blank"), F.col("times")),
        "duplicate": F.when(~F.col("blank"), F.col("times") - F.col("opens").cast("int")),
        "truncated": F.when(F.col("first") % 3 == CUT, 1),
    }
    # Turns first: a turn counts once however many rows it has.
    turns = placed.groupBy("conv", "turn").agg(*[F.sum(F.coalesce(v, F.lit(0))).alias(k) for k, v in counts.items()])
    faults = turns.groupBy("conv").agg(*[F.sum(c).alias(c) for c in counts], (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    kind = lambda r: F.floor(r["first"] / 3)
    legal = lambda a, b: ((a < 2) & (b == a + 1)) | ((a == 2) & (b == 1))  # noqa: E731  su, ua, au
    start = F.struct(F.lit(None).cast("long").alias("kind"), F.lit(0).cast("long").alias("n"))
    step = lambda s, r: F.struct(kind(r).alias("kind"), (s["n"] + r["times"] - 1 + F.when(legal(s["kind"], kind(r)), 0).when(s["kind"].isNull(), 0).otherwise(1)).alias("n"))
    inside = segments.select("conv", "part", "segment", kind(F.get("rows", F.lit(0))).alias("head"), kind(F.element_at("rows", -1)).alias("tail"), F.aggregate("rows", start, step)["n"].alias("n"))
    before = F.lag("tail").over(Window.partitionBy("conv").orderBy("part", "segment"))
    joints = inside.withColumn("before", before).withColumn("n", F.col("n") + F.when(F.col("before").isNull() | legal(F.col("before"), F.col("head")), 0).otherwise(1))
    return faults.join(joints.groupBy("conv").agg(F.sum("n").alias("illegal")), "conv")


def repair(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for the conversations that have
    rows (conv_id, turn, role, text, times); ``conv`` is the id as text, empty for null."""
    placed = sorted_rows(symbols(rows))
    key = ["conv", "part", "segment"]
    narrow = placed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("at", "first", "again", "times"))).alias("rows"))
    of_conv = Window.partitionBy("conv")
    order = placed.where("at = 0").select(*key)
    order = order.select(*key, (F.row_number().over(of_conv.orderBy("part", "segment")) - 1).cast("long").alias("nth"), F.count(F.lit(1)).over(of_conv).alias("of"))
    segments = materialise(narrow.join(order, key), "segments")
    return tally(placed, segments).join(repaired(placed, segments), "conv")


def report(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: its faults after the damage and its cheapest repair."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    ids = conversations.select("conv_id").distinct().withColumn("conv", key)
    out = ids.join(repair(damaged(conversations)), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    numbers = [zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
