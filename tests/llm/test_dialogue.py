"""Conversation repair against a plain search for the cheapest, ASCII-least edits."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from docsynth.llm import dialogue, queries
from docsynth.operators import ordered

PATTERN = re.compile(r"(s?(ua)+)?")
INK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        told = [" " if x is None else x for x in (conv, turn, role, text)]
        sort = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        role, text = ("user" if sort == 4 else told[2]), ("" if sort == 1 else re.sub("[.!?]", "", told[3]) if sort == 2 else told[3])
        out[conv] += [(turn, role, text)] * (0 if sort == 0 else 2 if sort == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def cheapest(rows):
    """(cost, audit, lines) of the cheapest edits: costs from the end over all states, each with its least audit."""
    seen, faults = set(), []
    for _, role, text in rows:
        ink = INK.findall(text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    then = {"": (0, ""), "s": None, "u": None, "a": (0, "")}
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(5):
            for s in after:
                if best[after[s]]:
                    way = (best[after[s]][0] + 5, "I" + best[after[s]][1])
                    best[s] = min(filter(None, (best[s], way)))
        return best

    then = inserted(then)
    for (_, role, _), fault in zip(reversed(rows), reversed(faults), strict=True):
        best = {}
        for s in after:
            ways = [(2, "D", s)]
            if fault not in ("blank", "duplicate"):
                cut = 5 if fault == "truncated" else 0
                ways.append((1 + cut, "R", after[s]))
                if role[:1] == after[s]:
                    ways.append((cut, "K", after[s]))
                elif role[:1] == "s" and s == "":
                    ways.append((cut, "K", "s"))
            best[s] = min(((c + then[to][0], x + then[to][1]) for c, x, to in ways), default=None)
        then = inserted(best)
    cost, audit = then[""]
    state, lines, at = "", [], 0
    for x in audit:
        if x == "I":
            state = after[state]
            lines.append(("user" if state == "u" else "assistant") + ":")
            continue
        _, role, text = rows[at]
        at += 1
        if x == "D":
            continue
        state = "s" if x == "K" and state == "" and role[0] == "s" else after[state]
        lines.append((role if x == "K" else "user" if state == "u" else "assistant") + ":" + text)
    assert PATTERN.fullmatch("".join(x[0] for x in lines))
    return cost, audit, lines, faults


def plain(rows):
    out = []
    for conv, told in damage(rows).items():
        cost, audit, lines, faults = cheapest(told)
        turns = [t for t, _, _ in told if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), pairs, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def told(df):
    got = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert [k for _, k in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    return sorted(map(tuple, got.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string, part int, at int, rows string")


def random_rows(seed, convs=120, most=14):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "agent", None]
    texts = ["Yes.", "No", "  ", "", "Why? \n", "é!", "a. b", None, "x…", "So it is.\t "]
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, most)):
            role = ("user", "assistant")[t % 2] if r.random() < 0.6 else r.choice(roles)
            text = f"Row {r.randrange(4)}." if r.random() < 0.5 else r.choice(texts)
            rows.append((c if c else None, None if r.random() < 0.03 else t + (r.random() < 0.1), role, text))
            if r.random() < 0.05:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize(("segment", "run"), [(4096, 64), (3, 2), (1, 3)])
def test_repair_is_the_cheapest(spark, monkeypatch, segment, run):
    monkeypatch.setattr(dialogue, "SEGMENT", segment)
    monkeypatch.setattr(ordered, "RUN", run)
    rows = random_rows(segment) + [(777, 3, "user", "the same.")] * 9 + [(778, None, "user", "a")] * 3
    assert told(dialogue.report(table(spark, rows))) == plain(rows)


def test_one_long_conversation(spark, monkeypatch):
    """Many segments of one conversation, long runs of one symbol, long texts."""
    monkeypatch.setattr(dialogue, "SEGMENT", 50)
    monkeypatch.setattr(ordered, "RUN", 4)
    rows = [(1, i, "user" if i % 700 < 500 else "assistant", f"{i}." if i % 3 else "x" * 3000) for i in range(2500)]
    rows += [(2, i, ("user", "assistant")[i % 2], f"{i}?") for i in range(40)]
    assert told(dialogue.report(table(spark, rows))) == plain(rows)


def test_powers_are_steps():
    r = random.Random(4)
    for _ in range(200):
        runs = [(r.randrange(12), r.randrange(1, 40)) for _ in range(r.randrange(1, 6))]
        v = dialogue.after_last()
        for symbol, length in reversed(runs):
            for _ in range(length):
                v = dialogue.advance(dialogue.power(symbol, 0), v)
        assert v == dialogue.costs(runs, dialogue.after_last())[0] == dialogue.advance(dialogue.product(runs), dialogue.after_last())


def test_nothing_left(spark):
    assert told(dialogue.report(table(spark, []))) == []
    lost = [(c, t, "user", "x.") for c in range(60) for t in [1] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert lost and {r[1:] for r in told(dialogue.report(table(spark, lost)))} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_conversations(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.QUERIES["op12_conversation_repair"](spark, path)) == plain(rows)
