"""Vocabularies, word picks and look-alike text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.functions.text import date_like_digits
from docsynth.operators.ordered import number_rows, scan
from docsynth.rng import draw
from docsynth.session import materialise

#: A length with few words is offered under this many keys at least, so that no word is joined by all who want it.
SALTS = 64
#: Words broadcast by word_like and sentence_like; a word counts for 32 bytes and four for each of its letters.
NEAR_BYTES = 64 << 20
#: A word in any script: letters with their marks.
WORD = r"\p{L}[\p{L}\p{M}]*"


def token_counts(tokens: DataFrame, *keys: str) -> DataFrame:
    return tokens.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def classify_corpus(counts: DataFrame, word: str = "word", threshold: Column | None = None) -> DataFrame:
    """Key if frequent and without digits; else value if it has a digit, long text if longer than 10, else value.

    The default threshold is half the highest count (floored), a scalar subquery.
    """
    if threshold is None:
        threshold = counts.select(F.floor(F.max("cnt") / 2)).scalar()
    w = F.col(word)
    has_digit = w.rlike("[0-9]")
    kind = (
        F.when((F.col("cnt") > threshold) & ~has_digit, "key")
        .when(has_digit, "value")
        .when(F.length(w) > 10, "text")
        .otherwise("value")
    )
    return counts.withColumn("kind", kind)


def distinct_words(tokens: DataFrame) -> DataFrame:
    """Distinct words per language with their length, written once: they are read twice to be numbered, the tokens once."""
    distinct = tokens.select("lang", "word").distinct()
    return materialise(distinct.withColumn("n_chars", F.length("word").cast("bigint")), "distinct-words")


def vocab_by_length(tokens: DataFrame) -> DataFrame:
    """Distinct words per language with their length and 0-based place in the (language, length) bucket."""
    distinct = distinct_words(tokens)
    placed = number_rows(distinct, ["lang", "n_chars"], {"head": F.substring("word", 1, 2)}, ["word"], "idx")
    return placed.withColumn("idx", F.col("idx") - 1)


def number_words(tokens: DataFrame) -> DataFrame:
    """Distinct words per language with their 0-based place in the whole language (shorter words first)."""
    distinct = distinct_words(tokens)
    placed = number_rows(distinct, ["lang"], {"n": F.col("n_chars"), "head": F.substring("word", 1, 2)}, ["n_chars", "word"], "idx")
    return placed.withColumn("idx", F.col("idx") - 1)


def match_case(word: Column, like: Column) -> Column:
    """Title, upper or lower case of ``like``; anything else leaves the word as it is."""
    head, tail = F.substring(like, 1, 1), F.substring(like, 2, 2147483647)
    title = (head == F.upper(head)) & (F.upper(head) != F.lower(head)) & (tail == F.lower(tail))
    cased = F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 2147483647)))
    # Most words are lower case, which excludes the two others: asked first.
    return (
        F.when((like == F.lower(like)) & (like != F.upper(like)), F.lower(word))
        .when(title, cased)
        .when((like == F.upper(like)) & (like != F.lower(like)), F.upper(word))
        .otherwise(word)
    )


def copies_of(size: Column) -> Column:
    """Keys each word of a length with ``size`` words is offered under: one, unless there are few words."""
    return F.greatest(F.ceil(F.lit(SALTS) / size), F.lit(1)).cast("bigint")


def offered(vocab: DataFrame, sizes: DataFrame) -> DataFrame:
    """``vocab`` with ``__salt``; ``sizes(lang, n_chars, size)``. Only words of short lists are repeated, so it stays as large as it is."""
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), copies_of(F.col("size")) - 1)).alias("__salt")
    return vocab.join(sizes, ["lang", "n_chars"]).select(*vocab.columns, salts)


def word_lists(vocab: DataFrame) -> DataFrame:
    """One row per language and length: ``__size``, ``__start``, the number of its first word, and ``__near``.

    Words are numbered through all lists, those of a language one after another and shorter ones first. Near are the
    smallest lists, as many as ``NEAR_BYTES`` hold. The lists are few: one per length that occurs.
    """
    sizes = vocab.groupBy("lang", F.col("n_chars").alias("__n")).agg(F.count(F.lit(1)).alias("__size"))
    cost = F.col("__size") * (F.col("__n") * 4 + 32)
    before = Window.orderBy("lang", "__n").rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.orderBy(cost, "lang", "__n").rowsBetween(Window.unboundedPreceding, 0)
    placed = {"__start": F.coalesce(F.sum("__size").over(before), F.lit(0).cast("bigint")), "__near": F.sum(cost).over(smaller) <= NEAR_BYTES}
    return materialise(sizes.withColumns(placed), "lists")


def picks(tokens: DataFrame, vocab: DataFrame, ident: Column, salt: int, exact: bool, chosen: Column) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Tokens with ``__num``, the number of the word picked, and ``__away`` if its list may not be near; near words; all words.

    All words are left out where every list is near. Nothing is shuffled here: the lists are broadcast. A token that stays
    as it is has no number.
    """
    lists = word_lists(vocab)
    langs = lists.groupBy("lang").agg(F.min("__start").alias("__base"), F.sum("__size").alias("__all"))
    words = vocab.withColumnRenamed("n_chars", "__n").join(F.broadcast(lists), ["lang", "__n"])
    words = words.select((F.col("__start") + F.col("idx")).alias("__num"), F.col("word").alias("__word"), "__near")
    near = materialise(words.where("__near").drop("__near"), "near-words")
    spread = not lists.where(~F.col("__near")).isEmpty()
    n = F.length("word").cast("bigint")
    if not exact:
        n = F.when(n <= 4, n).otherwise(n - draw(ident, salt + 1) % 3)
    # A length without words takes any of the language: the numbers of a language follow one another.
    num = F.when(chosen, F.coalesce("__start", "__base") + draw(ident, salt) % F.coalesce("__size", "__all"))
    away = (F.col("__num").isNotNull() & ~F.coalesce("__near", F.lit(False))) if spread else F.lit(False)
    want = tokens.withColumn("__n", n).join(F.broadcast(lists), ["lang", "__n"], "left").join(F.broadcast(langs), "lang", "left")
    want = want.select(*tokens.columns, "__near", num.alias("__num")).withColumn("__away", away).drop("__near")
    return want, near, words.drop("__near") if spread else None


def far_words(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``__word`` by ``__num``, for the tokens whose list is not near: the only ones that are shuffled, with each word once.

    Lists that are not near are long, so no word is wanted by many; the words of a partition are hashed, and the tokens,
    which are many more, need not be sorted.
    """
    return tokens.join(words.hint("shuffle_hash"), "__num", "left")


def word_like(tokens: DataFrame, vocab: DataFrame, ident: Column, salt: int = 30, exact: bool = True, only: Column | None = None) -> DataFrame:
    """Add ``fake``: a vocabulary word of the same language, length and letter case.

    ``exact=False`` lets words longer than four be replaced by one up to two letters shorter. A bucket with no words
    takes any word of the language. Words of short lists are broadcast up to ``NEAR_BYTES``, tokens that want another one
    are shuffled. Tokens for which ``only`` does not hold stay as they are. ``vocab`` and ``tokens`` are read more than
    once: write them once where they are dear.
    """
    want, near, words = picks(tokens, vocab, ident, salt, exact, F.lit(True) if only is None else only)
    found = want.where(~F.col("__away")).join(F.broadcast(near), "__num", "left")
    if words is not None:
        found = found.unionByName(far_words(want.where("__away"), words))
    fake = F.coalesce(match_case(F.col("__word"), F.col("word")), F.col("word"))
    return found.withColumn("fake", fake).drop("__num", "__away", "__word")


def join_runs() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Neighbouring runs of a document as one, but for those that still want a word (``__num``) or stand alone (``__alone``).

    A function made here goes to the workers with its code, so they need not have this package.
    """

    def task(batches):
        for b in batches:
            if not b.num_rows:
                continue
            doc, pos, text, num = (b.column(c) for c in ("doc_id", "pos", "text", "__num"))
            at, single = pos.to_numpy(), num.is_valid().to_numpy(zero_copy_only=False)
            if "__alone" in b.schema.names:
                single = single | b.column("__alone").is_valid().to_numpy(zero_copy_only=False)
            same = pc.fill_null(pc.equal(doc[1:], doc[:-1]), False).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.append(True, ~same | (at[1:] != at[:-1] + 1) | single[1:] | single[:-1]))
            # The text of neighbours is contiguous: only the offsets between them go.
            _, offsets, data = text.buffers()
            width = np.int64 if pa.types.is_large_string(text.type) else np.int32
            ends = np.frombuffer(offsets, width)[text.offset : text.offset + b.num_rows + 1]
            joined = pa.Array.from_buffers(text.type, len(first), [None, pa.py_buffer(np.append(ends[first], ends[-1])), data or pa.py_buffer(b"")])
            kept = pa.array(first)
            yield pa.RecordBatch.from_arrays([doc.take(kept), pos.take(kept), joined, num.take(kept)], ["doc_id", "pos", "text", "__num"])

    return task


def sentence_like(docs: DataFrame, vocab: DataFrame, keep_ascii: bool = False) -> DataFrame:
    """Rewrite ``text``: signs and spaces stay, digits look like digits, every word run is replaced by one alike.

    ``docs(doc_id, lang, text)``; one document is one group again at the end, never more than it was as a row. Runs that
    are settled where the document is read are joined there again, so a document is shuffled in few pieces. ``docs`` is
    read more than once: write it once where it is dear.
    """
    docs = docs.select("doc_id", "lang", "text")
    # Runs of documents that share an id are put in one order, so theirs are not joined.
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"), F.lit(True).alias("__alone"))
    shared = materialise(shared, "shared-ids")
    alone = [] if shared.isEmpty() else ["__alone"]
    if alone:
        docs = docs.join(shared, F.col("doc_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    runs = F.regexp_extract_all("text", F.lit(WORD + r"|[0-9]+|[^\p{L}0-9]+"), F.lit(0))
    tokens = docs.select("doc_id", "lang", *alone, F.posexplode_outer(runs).alias("pos", "word"))
    # A document without text is one empty run, so it stays.
    tokens = tokens.withColumns({"pos": F.coalesce("pos", F.lit(0)), "word": F.coalesce("word", F.lit(""))})
    ident = F.col("doc_id") * 100003 + F.col("pos")
    # Worked out ahead of the joins: in one step with the letter case the code is too long to be compiled by the JVM.
    is_number = F.substring("word", 1, 1).between("0", "9")
    digits = F.when(is_number, F.coalesce(date_like_digits(F.col("word"), ident), F.col("word"))).otherwise(F.col("word"))
    tokens = tokens.withColumns({"__plain": digits, "__chosen": F.col("word").rlike(r"^\p{L}") & F.lit(not keep_ascii)})
    want, near, words = picks(tokens, vocab, ident, 30, True, F.col("__chosen"))
    own = want.withColumn("__own", F.when(~F.col("__away"), F.col("__num"))).join(F.broadcast(near.withColumnRenamed("__num", "__own")), "__own", "left")
    text = F.when(F.col("__word").isNotNull(), match_case(F.col("__word"), F.col("word"))).otherwise(F.col("__plain"))
    parts = own.select("doc_id", "pos", text.alias("text"), F.when(F.col("__away"), F.col("__num")).alias("__num"), *alone)
    parts = parts.mapInArrow(join_runs(), parts.drop(*alone).schema)
    if words is not None:
        parts = materialise(parts, "runs")
        wanted = far_words(parts.where(F.col("__num").isNotNull()), words)
        parts = parts.where(F.col("__num").isNull()).unionByName(wanted.withColumn("text", F.coalesce(match_case(F.col("__word"), F.col("text")), F.col("text"))).drop("__word"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text"))


def longest_word_that_fits(slots: DataFrame, vocab: DataFrame, char_width: int, ident: Column, salt: int = 32) -> DataFrame:
    """For ``slots(lang, budget, ..)`` add a word of the longest length that fits, or of the shortest if none does."""
    sizes = materialise(vocab.groupBy("lang", "n_chars").agg(F.count(F.lit(1)).alias("size")), "sizes")
    lengths = materialise(sizes.groupBy("lang").agg(F.collect_list(F.struct("n_chars", "size")).alias("__lengths")), "lengths")
    fits = F.array_max(F.filter("__lengths", lambda s: s["n_chars"] * char_width <= F.col("budget")))
    best = F.coalesce(fits, F.array_min("__lengths"))
    want = slots.join(lengths, "lang").withColumn("__b", best)
    drawn, size = draw(ident, salt), F.col("__b.size")
    # A wide budget always lands in the few longest words, so the pick is salted.
    want = want.withColumns({"n_chars": F.col("__b.n_chars"), "idx": drawn % size, "__salt": drawn % 997 % copies_of(size)})
    return want.drop("__lengths", "__b").join(offered(vocab, sizes), ["lang", "n_chars", "idx", "__salt"]).drop("idx", "__salt")


def fill_width(slots: DataFrame, numbered: DataFrame, salt: int = 34) -> DataFrame:
    """Fill ``slots(slot_id, lang, chars)`` with random words; the last one is cut so that the text fits.

    ``numbered`` comes from :func:`number_words`. A slot takes at most one word per two signs, so the running width
    window is bounded by the slot.
    """
    sizes = materialise(numbered.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "sizes")
    tries = slots.select("slot_id", "lang", "chars", F.explode_outer(F.sequence(F.lit(0), F.floor(F.col("chars") / 2).cast("int"))).alias("k"))
    picked = (
        tries.join(sizes, "lang")
        .withColumn("idx", draw(F.col("slot_id") * 1009 + F.col("k"), salt) % F.col("size"))
        .join(numbered, ["lang", "idx"])
    )
    before = Window.partitionBy("slot_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("chars") - F.coalesce(F.sum(F.col("n_chars") + 1).over(before), F.lit(0))
    used = picked.withColumn("left", left).where(F.when(F.col("k") == 0, F.col("left") >= 2).otherwise(F.col("left") >= 4))
    piece = F.struct("k", F.substring(F.col("word"), F.lit(1), F.col("left").cast("int")).alias("w"))
    return used.groupBy("slot_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["w"]), " ").alias("text")
    )


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, salt: Column, salts: int = 64) -> DataFrame:
    """First n rows of every group in two steps: inside (group, salt), then over the survivors of a group."""
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    w2 = Window.partitionBy(*group).orderBy(*order)
    near = df.withColumn("__salt", F.pmod(salt, F.lit(salts))).withColumn("rn", F.row_number().over(w1)).where(F.col("rn") <= n)
    return near.drop("__salt").withColumn("rn", F.row_number().over(w2)).where(F.col("rn") <= n)


#: Rows of a range of the random order.
RANGE_ROWS = 1_000_000


def shuffle(df: DataFrame, ident: str, salt: int = 36) -> DataFrame:
    """Random order as a 1-based position, the same on every run.

    Rows are dealt out by ranges of their draw, as many ranges as the table needs, and written in order; a row's position
    is its place in its range and the sizes of the ranges before, of which there is one number each.
    """
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    keyed = df.withColumn("__draw", draw(F.col(ident), salt)).repartitionByRange(ranges, "__draw", ident).sortWithinPartitions("__draw", ident)
    # The upper bits of the number are the range, the lower 33 the place in it.
    placed = materialise(keyed.withColumns({"__range": F.spark_partition_id(), "__place": F.monotonically_increasing_id() % (1 << 33)}), "shuffled")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    out = placed.join(starts, "__range")
    return out.select(*df.columns, (F.col("__start") + F.col("__place") + 1).alias("position"))


def sample_with_replacement(df: DataFrame, group: str, ident: str, n: int, salt: int = 38) -> DataFrame:
    """n draws per group; a row may come more than once."""
    placed = number_rows(df, [group], {"band": F.floor(F.col(ident) / 4096)}, [ident], "idx")
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("size"), F.min(ident).alias("__seed"))
    k = F.explode_outer(F.sequence(F.lit(1), F.lit(n))).alias("draw_no")
    draws = sizes.select(group, "size", "__seed", k).withColumn(
        "idx", draw(F.col("__seed") * 101 + F.col("draw_no"), salt) % F.col("size") + 1
    )
    return draws.drop("size", "__seed").join(placed, [group, "idx"]).drop("idx")


__all__ = [
    "classify_corpus", "fill_width", "longest_word_that_fits", "match_case", "number_words", "offered", "sample_with_replacement",
    "scan", "sentence_like", "shuffle", "token_counts", "top_n", "vocab_by_length", "word_like",
]
