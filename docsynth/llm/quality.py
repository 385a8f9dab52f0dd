"""Quality rules with cutoffs chosen under a bound on false rejections.

Signals of each text are counted over its whole length. For every signal and stratum (language), labelled documents
of a holdout are set against a grid of cutoffs, strictest first. A cutoff is taken if the exact binomial test rules
out, at a level shared by all tests (Bonferroni), that it rejects more than ALPHA of the good documents. A document is
kept if it passes the fixed base rules and no chosen cutoff rejects it.

Defined cases: a null or empty text has no words and fails the base rules. A stratum without enough good labels gets no
cutoff, so nothing is rejected there. Repeated label rows of a document count once, as good if any says so. Documents
without a label are judged like all others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.llm.arrays import map_text, windows, words_of
from docsynth.session import materialise

#: Share of a stratum's good documents that all its cutoffs together may reject, and the chance that any stratum breaks this.
ALPHA, DELTA = 0.05, 0.05
#: Base rules: least words, most words in repeated windows (percent), words a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"

#: Signals by name: share of what, as SQL; and their cutoffs, strictest first (above is rejected).
SIGNALS = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", [x / 1000 for x in (2, 5, 10, 20, 30, 50, 75, 100, 150, 200, 300, 500)]),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", [x / 100 for x in (2, 5, 10, 15, 20, 25, 30, 40, 50, 60, 70, 80, 90)]),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", [x / 1000 for x in (5, 10, 20, 30, 50, 75, 100, 125, 150, 175, 200)]),
    "long_word": ("word_chars / greatest(n_words, 1)", [4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 9, 10, 12, 15, 20, 30]),
    "short_word": ("n_words / greatest(word_chars, 1)", [1 / x for x in (8, 7, 6, 5.5, 5, 4.5, 4, 3.5, 3, 2.5, 2, 1.5)]),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows whose words stand in the text at least twice."""
    found = windows(hashes, WINDOW)
    if len(found) < 2:
        return 0
    _, back, times = np.unique(found, return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[back] > 1)
    if not len(at):
        return 0
    step = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def measure(docs: DataFrame, text: str = "text", keep: bool = True) -> DataFrame:
    """Adds the counts of COUNTS for each whole text."""

    def work(col: pa.Array) -> list:
        w = words_of(col)
        n, owner, hashes = len(col), w.owner(), w.hashes()
        letters = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
        chars = np.bincount(owner, letters[w.ends] - letters[w.starts], n).astype(np.int64)
        signs = np.concatenate([[0], np.cumsum(_IS_SYMBOL[w.data])])
        raw = w.data.tobytes()
        lines = [dup_lines(raw[a:b]) for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)]
        repeats = [repeated_words(hashes[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        return [w.counts().astype(np.int64), chars, np.diff(signs[w.offsets]).astype(np.int64), [d for _, d in lines], repeats, [k for k, _ in lines]]

    return map_text(docs, text, [T.StructField(c, T.LongType()) for c in COUNTS], work, keep)


def failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def level(name: str) -> Column:
    """Number of the strictest cutoffs that reject the document."""
    signal, cutoffs = SIGNALS[name]
    value = F.expr(f"CAST({signal} AS DOUBLE)")
    return sum(((value > c).cast("int") for c in cutoffs), F.lit(0)).alias(name)


def tail(k: int, n: int, p: float) -> float:
    """Chance of at most k in n trials of chance p, summed exactly."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return math.exp(top) * math.fsum(math.exp(x - top) for x in logs)


def choose(rows: list[tuple[str, dict[str, list[int]]]], alpha: float = ALPHA, delta: float = DELTA) -> dict[str, dict[str, int]]:
    """Place of the chosen cutoff for each stratum and signal.

    Each signal gets an equal share of ``alpha``, so a stratum's cutoffs reject ``alpha`` together at most; ``delta`` is
    shared over all tests.

    ``rows``: for each stratum and signal the number of good documents by how many cutoffs reject them.
    """
    tests = sum(len(SIGNALS[s][1]) for _, found in rows for s in found)
    out: dict[str, dict[str, int]] = {}
    for stratum, found in rows:
        for signal, counts in found.items():
            n = sum(counts)
            for place in range(len(SIGNALS[signal][1])):
                if n and tail(sum(counts[place + 1 :]), n, alpha / len(SIGNALS)) <= delta / tests:
                    out.setdefault(stratum, {})[signal] = place
                    break
    return out


def holdout(measured: DataFrame, labels: DataFrame) -> list[tuple[str, dict[str, list[int]]]]:
    """Good documents that pass the base rules, counted by stratum, signal and level: a few hundred numbers a stratum."""
    good = labels.where("quality = 1").select("doc_id").where("doc_id IS NOT NULL").distinct()
    rows = measured.where(~failed()).join(good, "doc_id", "left_semi")
    levels = F.array(*[F.struct(F.lit(s).alias("signal"), level(s).alias("level")) for s in SIGNALS])
    counts = rows.select(F.coalesce("lang", F.lit("")).alias("stratum"), F.explode(levels).alias("x")).groupBy("stratum", "x.signal", "x.level").count()
    found: dict[str, dict[str, list[int]]] = {}
    for r in counts.orderBy("stratum", "signal", "level").collect():
        found.setdefault(r["stratum"], {}).setdefault(r["signal"], [0] * (len(SIGNALS[r["signal"]][1]) + 1))[r["level"]] = r["count"]
    return sorted(found.items())


def verdict(chosen: dict[str, dict[str, int]]) -> Column:
    """True where no chosen cutoff of the document's stratum rejects it."""
    ok = F.lit(True)
    for stratum, cuts in chosen.items():
        reject = F.lit(False)
        for signal, place in cuts.items():
            reject = reject | (level(signal) > place)
        ok = F.when(F.coalesce("lang", F.lit("")) == stratum, ~reject).otherwise(ok)
    return ok


def rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: counts, base rules, and whether it is kept."""
    # Read twice, by the choice of cutoffs and by the verdict: written once, a few numbers a row.
    measured = materialise(measure(docs.select("doc_id", "lang", "text"), keep=False), "measured")
    chosen = choose(holdout(measured, labels), alpha, delta)
    return measured.select("doc_id", *COUNTS[:5], failed().alias("base_failed"), (~failed() & verdict(chosen)).alias("kept"))
