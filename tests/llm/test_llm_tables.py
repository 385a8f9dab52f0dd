"""Operators over many rows: joins, passages, neighbours, archives, mixing and the pipeline, against plain versions."""

import math
import hashlib
import random

import helpers
import numpy as np
import pyarrow as pa
import pytest
from docsynth.llm import components, jaccard, keys, mixing, neighbours, queries, sift, substring, warc
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
EDGES = [(1000, None, "en", "n"), (1001, "", "en", None), (1002, "a b", "en", "n"), (1003, "A  b", "en", "n"), (None, "a b", "en", "n"), (None, "zz", "en", "n"), (1002, "a b", "en", "n"), (1005, " \n", "en", "n"), (1006, "q", None, "n")]


def near_copies(seed, n=160):
    rng = random.Random(seed)
    base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(300)) for _ in range(120)]
    rows = []
    for i in range(n):
        w = base[:]
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = str(rng.random())
        if rng.random() < 0.3:
            w = w[: rng.randrange(60, 120)]
        rows.append((i, " ".join(w), "en", "s"))
    return rows


@pytest.mark.parametrize(("few", "grams"), [(48, 1_500_000), (4, 4_000), (2, 1_500_000)])
def test_jaccard_near_copies(spark, tmp_path, monkeypatch, few, grams):
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", grams)
    rows = near_copies(few) + EDGES
    got = [tuple(r) for r in jaccard.join(helpers.docs(spark, tmp_path, rows)).drop("row").collect()]
    assert helpers.by_key(got) == helpers.by_key(helpers.jaccard([r[:2] for r in rows]))


def test_jaccard_pairs_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", 3)
    rng = np.random.default_rng(3)
    rows = sorted((int(g), int(i), 20) for g, i in zip(rng.zipf(1.5, 400) % 40 - 5, rng.integers(0, 60, 400), strict=True))
    want = None
    for size in (1, 2, 3, 7, 50, 400):
        cut = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + size], strict=True), (pa.int64(), pa.int64(), pa.int32()), strict=True)], ["gram", "set", "n"]) for i in range(0, len(rows), size)]
        got = [r for b in jaccard.candidate_batches(cut) for r in b.to_pylist()]
        pairs = sorted((r["a"], r["b"]) for r in got if r["need"] is not None)
        ties = {(r["a"], r["b"]) for r in got if r["need"] is None and r["a"] != r["b"]}
        assert want is None or want == (pairs, ties)
        want = (pairs, ties)
    assert want[0] and want[1]


def test_jaccard_sets_that_share_little_with_many_are_no_candidates(spark, tmp_path, monkeypatch):
    """A passage that many quote ties no sets that cannot be linked, also where it was not found to be frequent."""
    monkeypatch.setattr(jaccard, "FREQUENT", 10**9)
    real, members = jaccard.materialise, []

    def written(df, name):
        out = real(df, name)
        if name == "members":
            members.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialise", written)
    rows = [(i, " ".join([*(f"w{i}x{k}" for k in range(200)), *"a passage of twelve words that all of these texts quote here".split()]), "en", "s") for i in range(60)]
    rows.append((70, " ".join(map(str, range(1_200_000))), "en", "s"))  # so no word of the passage is common
    copies = [(100 + i, " ".join([*(f"v{k}" for k in range(100)), f"end{i}"]), "en", "s") for i in range(12)]
    got = {r.doc_id: (r.component_id, r.n_links) for r in jaccard.join(helpers.docs(spark, tmp_path, rows + copies)).collect()}
    assert got == {i: (i, 0) for i in [*range(60), 70]} | {100 + i: (100, 11) for i in range(12)}
    assert members == [12]


def test_jaccard_levels_of_common_words(spark, tmp_path):
    """n-grams of the most common words come last, not just after those without common words."""
    rows = [(0, "the " * 4000 + "less " * 100 + " ".join(f"w{i}" for i in range(40_000)), "en", "s")]
    table = jaccard.common_words(helpers.docs(spark, tmp_path, rows))
    the, less = (int(jaccard.gram_sets(pa.array([t]), table)[0][0] >> np.uint64(64 - jaccard.RANK)) for t in ("the the the the the", "less less less less less"))
    assert the > less > 0
    assert len(jaccard.gram_sets(pa.array(["the " * 9]), np.full(1 << jaccard.TABLE, jaccard.LEVELS, np.uint8))[0]) == 1


def test_jaccard_packed_grams(monkeypatch):
    """What more than one row holds comes out sorted, in whatever pieces; n-grams of a single row stay out."""
    rng = np.random.default_rng(8)
    gram = rng.integers(0, 2**64, 3000, np.uint64)
    gram[:500], gram[500:900] = gram[1000:1500], gram[2000]
    ident, n = rng.integers(-(2**62), 2**62, 3000), rng.integers(1, 70_000, 3000).astype(np.int32)
    key, of, times = np.unique(jaccard.stir(gram), return_inverse=True, return_counts=True)
    want = sorted(zip(key[of].tolist(), ident.tolist(), n.tolist(), times[of].tolist(), strict=True))
    rows = pa.Table.from_batches([jaccard.packed(*(x[k::4].copy() for x in (gram, ident, n)), 5) for k in range(4)]).sort_by("part")
    for most in (10**6, 200, 1):
        monkeypatch.setattr(jaccard, "UNPACK", most)
        for size in (1, 3, 100):
            out = pa.Table.from_batches(list(jaccard.unpacked_batches(rows.to_batches(max_chunksize=size))))
            got = list(zip((out["gram"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)).tolist(), out["set"].to_pylist(), out["n"].to_pylist(), strict=True))
            assert [x[0] for x in got] == sorted(x[0] for x in got)
            assert {x[:3] for x in want if x[3] > 1} <= set(got) <= {x[:3] for x in want} and len(set(got)) == len(got)
            if most == 10**6:
                assert set(got) == {x[:3] for x in want if x[3] > 1}


def test_passages_do_not_depend_on_batches():
    rng = np.random.default_rng(4)
    value = np.sort(rng.zipf(1.3, 300) % 90)
    rows = [(int(v), int(v), 0, None if rng.random() < 0.1 else i, i, bool(rng.random() < 0.1)) for i, v in enumerate(value)]
    rows = [(*r[:3], r[3], r[4], r[5] or r[3] is None) for r in rows]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_())
    of = {}
    for r in rows:
        of.setdefault(r[0], []).append(r)
    want = sorted(r[3] for g in of.values() for r in g if r[3] is not None and (len(g) > 1 or g[0][5]))
    for size in (1, 2, 3, 10, 300):
        cut = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + size], strict=True), kinds, strict=True)], ["way", "value", "check", "row", "at", "twice"]) for i in range(0, len(rows), size)]
        assert sorted(r["row"] for b in substring.repeated_batches(cut) for r in b.to_pylist()) == want


def test_jaccard_exactly_at_the_limit(spark, tmp_path):
    words = [str(i) for i in range(104)]  # 100 n-grams
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join(words[:79]), "en", "s"), (3, " ".join(words[:78]), "en", "s")]  # 75 and 74 of them
    got = {r.doc_id: r.component_id for r in jaccard.join(helpers.docs(spark, tmp_path, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}
    got = {r.doc_id: r.n_links for r in jaccard.join(helpers.docs(spark, tmp_path, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_jaccard_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = [tuple(r) for r in queries.QUERIES["op4_jaccard_join"](spark, SMALL).collect()]
    assert helpers.by_key(got) == helpers.by_key(helpers.jaccard([tuple(r) for r in docs.select("doc_id", "text").collect()]))


def test_jaccard_one_of_each_group(spark, tmp_path):
    rows = near_copies(9, 40) + EDGES
    kept = jaccard.representatives(helpers.docs(spark, tmp_path, rows))
    assert kept.columns == helpers.docs(spark, tmp_path, []).columns
    want = {c for d, n, c, _ in helpers.jaccard([r[:2] for r in rows]) if n} | {d for d, n, _, _ in helpers.jaccard([r[:2] for r in rows]) if not n}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((d is None, d or 0) for d in want)


def test_jaccard_groups_are_not_told_by_ids(spark, tmp_path):
    rows = [(None, "one text without id", "en", "s"), (None, "another that has none", "en", "s"), (7, "first of id seven", "en", "s"), (7, "second of id seven", "en", "s")]
    rows += [(None, "copies without id", "en", "s")] * 2 + [(7, "copies of id seven", "en", "s")] * 2
    kept = jaccard.representatives(helpers.docs(spark, tmp_path, rows)).collect()
    assert helpers.by_key((r.doc_id, r.text) for r in kept) == helpers.by_key({r[:2] for r in rows})


@pytest.fixture
def moving_splits(spark, monkeypatch):
    """Each table that is written changes how the files of later jobs are split."""
    name, turn = "spark.sql.files.minPartitionNum", [0]

    def moved(module):
        real = module.materialise

        def written(df, of):
            out = real(df, of)
            turn[0] += 1
            spark.conf.set(name, "18"[turn[0] % 2])
            return out

        monkeypatch.setattr(module, "materialise", written)

    spark.conf.set(name, "8")
    yield moved
    spark.conf.unset(name)


def in_files(spark, tmp_path, rows):
    path = str(tmp_path / "many_files")
    helpers.docs(spark, tmp_path, rows).repartition(7).write.parquet(path)
    return spark.read.parquet(path)


def test_rows_keep_their_numbers(spark, tmp_path):
    table = in_files(spark, tmp_path, [(i, f"t {i}", "en", "s") for i in range(90)])
    seen = []
    for splits in ("1", "8"):
        spark.conf.set("spark.sql.files.minPartitionNum", splits)
        seen.append({r.doc_id: r.k for r in keys.numbered(table, "k").collect()})
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert seen[0] == seen[1] and len(set(seen[0].values())) == 90 and None not in seen[0].values()
    twice = spark.read.parquet(*table.inputFiles(), *table.inputFiles())
    for made in (table.union(table), twice, table.where("doc_id > 3"), spark.range(5).select(F.lit("x").alias("text"))):
        got = keys.numbered(made, "k", ["text"])
        assert got.columns == ["text", "k"] and got.select("k").distinct().count() == got.where("k IS NOT NULL").count() == made.count()


def test_jaccard_while_splits_change(spark, tmp_path, moving_splits):
    rows = near_copies(21, 60) + EDGES
    moving_splits(jaccard)
    want = helpers.jaccard([r[:2] for r in rows])
    got = [tuple(r) for r in jaccard.join(in_files(spark, tmp_path, rows)).drop("row").collect()]
    assert helpers.by_key(got) == helpers.by_key(want)


def test_representatives_while_splits_change(spark, tmp_path, moving_splits):
    rows = [(i, f"text number {i // 2} of these", "en", "s") for i in range(60)]
    moving_splits(jaccard)
    assert sorted(r.doc_id for r in jaccard.representatives(in_files(spark, tmp_path, rows)).collect()) == list(range(0, 60, 2))


def test_passages_while_splits_change(spark, tmp_path, moving_splits):
    rows = [(i, f"start {i} " + " ".join(f"w{i // 3}x{k}" for k in range(40 + i % 3)), "en", "s") for i in range(60)]
    moving_splits(substring)
    got = [tuple(r) for r in substring.report(in_files(spark, tmp_path, rows)).collect()]
    assert helpers.by_key(got) == helpers.by_key(helpers.passages([r[:2] for r in rows]))


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    top = {x: x for pair in links for x in pair}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        top[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_sift_keeps_every_row_that_joins(spark):
    rows = spark.range(50_000).select(F.col("id").alias("row"), F.lit("x").alias("text"))
    keys = spark.range(0, 50_000, 17).select(F.col("id").alias("row"))
    left = sift.sifted(rows, keys, "row")
    assert left.columns == ["row", "text"] and left.join(keys, "row").count() == keys.count() <= left.count() < 4_000
    assert sift.sifted(rows, keys.limit(0), "row").count() == 0
    assert sorted(r.row for r in sift.without(rows, keys, "row").collect()) == [i for i in range(50_000) if i % 17]
    assert sift.without(rows, keys.limit(0), "row").count() == 50_000


def test_passages_made(spark, tmp_path):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randrange(30, 60))] for _ in range(12)]
    rows = []
    for i in range(200):
        w = []
        for _ in range(rng.randrange(6)):
            w += [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
            if rng.random() < 0.6:
                p, a = rng.choice(shared), rng.randrange(8)
                w += p[a : len(p) - rng.randrange(8)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w), "en", "s"))
    rows += [(900, None, None, None), (901, "", None, None), (902, "a " * 100, "en", "s"), (903, "b " * 35, "en", "s"), (904, "c " * 36, "en", "s"), (None, rows[3][1], "en", "s"), (5, rows[5][1], "en", "s"), (906, " \n ", "en", "s")]
    got = [tuple(r) for r in substring.report(helpers.docs(spark, tmp_path, rows)).collect()]
    assert helpers.by_key(got) == helpers.by_key(helpers.passages([r[:2] for r in rows]))


def test_passages_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = [tuple(r) for r in queries.QUERIES["op5_substring_dedup"](spark, SMALL).collect()]
    assert helpers.by_key(got) == helpers.by_key(helpers.passages([tuple(r) for r in docs.select("doc_id", "text").collect()]))


def test_cover_has_every_difference():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def test_neighbours_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, [0.0] * 8), (203, None), (204, [1.0, None] * 4), (205, [math.nan] * 8), (206, [math.inf] * 8), (None, [1.0] * 8), (208, [1.0, 2.0]), (220, [3.0, 1.0]), (240, []), (260, [1e200] * 8), (280, [1e-200] * 8)]
    rows += [rows[4], (40, rows[7][1]), (4, rows[9][1])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=5).collect()
    good = [(i, v) for i, v in rows if i is not None and v and any(v) and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for a, (q, u) in enumerate(good):
        if q % 20 == 0:
            scores = []
            for b, (c, v) in enumerate(good):
                if a != b and len(u) == len(v):
                    s = 0.0
                    for x, y in zip(u, v, strict=True):
                        s += x * y
                    scores.append((-s, c))
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(sorted(scores)[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_neighbours_that_share_an_id(spark):
    """Rows of one id are candidates of their own, of each other too, and ranked apart as queries."""
    rows = [(1, [0.5, 0.0], "a"), (1, [0.9, 0.1], "b"), (20, [1.0, 0.0], "c"), (20, [0.0, 2.0], "d")]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string"), F.col("id") % 20 == 0, k=3).collect()
    want = [(20, 1, 1, 0.9), (20, 2, 1, 0.5), (20, 3, 20, 0.0), (20, 1, 1, 0.2), (20, 2, 1, 0.0), (20, 3, 20, 0.0)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_neighbours_small_blocks(spark, monkeypatch):
    for name, value in (("QUERIES", 7), ("CANDIDATES", 11), ("STEP", 8)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(90)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=20).collect()
    good = [(i, np.array(v)) for i, v in rows if any(v)]
    want = [(q, k + 1, c, -s) for q, u in good if q % 20 == 0 for k, (s, c) in enumerate(sorted((-float(u @ v), c) for c, v in good if c != q)[:20])]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_neighbours_empty(spark):
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 20 == 0).collect() == []


PAGE = "page_id long, url string, html string, file string"


def test_warc_finds_exactly_the_damage(spark):
    rows = [(i, f"http://h/{i}", "<p>" + "é" * (i % 300) + "</p>", "f") for i in range(3000)] + [(None, "u", "x", "f"), (None, "u", "x", "f"), (5000, None, None, "f"), (5001, "", "", "f"), (5002, "big", "y" * 300_000, "f"), (7, "http://h/7", "again", "f")]
    pages = spark.createDataFrame(rows, PAGE)
    copy = F.when(F.col("page_id") == 17, "other").when(F.col("page_id") == 2999, F.lit(None)).otherwise(F.coalesce("html", F.lit("")))
    got = warc.report(pages, copy).collect()
    assert len(got) == len(rows) and sorted(r.page_id for r in got if r.damaged) == [17, 2999]
    for file in {r.file for r in got}:
        at = 0
        for r in sorted((r for r in got if r.file == file), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    assert not any(r.damaged for r in warc.report(pages, F.coalesce("html", F.lit(""))).collect())


def test_warc_record_can_be_read(spark):
    made = spark.createDataFrame([(1, "http://a", "<é>", "f")], PAGE).select(warc.record(F.col("page_id"), F.col("url"), F.col("html")).alias("r")).first().r
    head, body = made.split("\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
    assert head.startswith("WARC/1.0") and fields["Content-Length"] == "4" and body == "<é>\r\n\r\n" and fields["WARC-Target-URI"] == "http://a"


def warc_folders(spark, tmp_path):
    """Two equal folders of WARC files, the pages they hold, and the bytes of each file."""
    rows = [(i, f"http://h/{i}", "<p>" + "é" * (i % 300) + "</p>", "f") for i in range(2300)]
    rows += [(None, "u", "x", "f"), (None, "u", "x", "f"), (5000, None, None, "f"), (5001, "", "a\r\n\r\nWARC/1.0\r\nb", "f"), (5002, "big", "y" * 3_000_000, "f"), (7, "http://h/7", "again", "f"), (8, "http://h/8", rows[8][2], "f")]
    pages = spark.createDataFrame(rows, PAGE)
    folders = [str(tmp_path / x) for x in ("left", "right")]
    for folder in folders:
        warc.write(pages, folder)
    return pages, folders


def test_warc_files_hold_the_manifest(spark, tmp_path):
    pages, (folder, _) = warc_folders(spark, tmp_path)
    want = sorted((f"{r.file}.warc", r.offset, r.length, r.digest) for r in warc.manifest(pages).collect())
    got = [tuple(r) for r in warc.scan(spark, folder).select("file", "offset", "length", "digest").collect()]
    assert sorted(got) == want
    assert not list((tmp_path / "left").glob("*.part"))
    for r in spark.read.parquet(f"{folder}/manifest").collect():
        data = (tmp_path / "left" / f"{r.file}.warc").read_bytes()
        assert (r.length, r.sha256) == (len(data), hashlib.sha256(data).hexdigest())


def test_warc_replicas_with_damage_in_their_bytes(spark, tmp_path):
    _, folders = warc_folders(spark, tmp_path)
    assert warc.compare(spark, *folders).collect() == []
    at = {(r.file, r.offset): r for r in warc.scan(spark, folders[0]).collect()}
    of = lambda file: sorted(r.offset for r in at.values() if r.file == file)
    right = tmp_path / "right"

    def edit(name, change):
        (right / name).write_bytes(change((right / name).read_bytes()))

    body = at["0.warc", of("0.warc")[500]]
    header = at["0.warc", of("0.warc")[700]]
    edit("0.warc", lambda d: d[: body.offset + body.length - 6] + b"?" + d[body.offset + body.length - 5 :])
    edit("0.warc", lambda d: d[: header.offset + 3] + b"?" + d[header.offset + 4 :])
    gone = at["1.warc", of("1.warc")[990]]
    edit("1.warc", lambda d: d[: gone.offset] + d[gone.offset + gone.length :])
    length = at["2.warc", of("2.warc")[3]]
    edit("2.warc", lambda d: d[: length.offset] + d[length.offset :].replace(b"Content-Length: ", b"Content-Length: 9", 1))
    (right / "5.warc").unlink()
    want = {("0.warc", "damaged", x.offset, x.offset) for x in (body, header)} | {("2.warc", "damaged", length.offset, length.offset), ("1.warc", "missing", gone.offset, None)}
    want |= {("1.warc", "moved", x, x - gone.length) for x in of("1.warc") if x > gone.offset} | {("2.warc", "moved", x, x + 1) for x in of("2.warc") if x > length.offset}
    want |= {("5.warc", "missing", x, None) for x in of("5.warc")}
    got = [(r.file, r.state, r.offset, r.copy_offset) for r in warc.compare(spark, *folders).collect()]
    assert len(got) == len(want) and set(got) == want
    assert {(r.file, r.state) for r in warc.compare(spark, *folders[::-1]).where("file = '5.warc'").collect()} == {("5.warc", "extra")}


def test_warc_folders_without_records(spark, tmp_path):
    folders = [str(tmp_path / x) for x in ("left", "right")]
    for folder in folders:
        assert warc.write(spark.createDataFrame([], PAGE), folder).collect() == []
    (tmp_path / "right" / "0.warc").write_bytes(b"")
    assert warc.scan(spark, folders[1]).collect() == [] and warc.compare(spark, *folders).collect() == []
    (tmp_path / "right" / "1.warc").write_bytes(b"no archive")
    assert [(r.file, r.record_id, r.state, r.copy_offset) for r in warc.compare(spark, *folders).collect()] == [("1.warc", None, "extra", 0)]


def test_warc_empty(spark):
    assert warc.report(spark.createDataFrame([], PAGE), F.col("html")).collect() == []


def plain_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Share by weight, cap, share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        rest = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > repeats * sizes[s]]
        if not above:
            return full | share
        full |= {s: repeats * sizes[s] for s in above}


def test_mixing_targets_and_words(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(60), "en", rng.choice(["a", "b", "B", "é", None, "z"] + ["hot"] * 6)) for i in range(400)]
    rows += [(None, "x y", "en", "a"), (None, "x y", "en", "a"), (7, "q r s", "en", "z"), (900, None, "en", "empty"), (901, "", "en", "empty"), (902, "one two", "en", "tiny"), (903, "v " * 3000, "en", "long")]
    table = helpers.docs(spark, tmp_path, rows)
    got = mixing.report(table).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(helpers.words(t))
    want = plain_targets(sizes)
    by_size = {}
    for r in got:
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    for s, n in sizes.items():
        assert any(n == size and abs(target - want[s]) < 1e-5 for size, target in by_size)
    assert sum(r.taken for r in got) == pytest.approx(sum(sizes.values()), abs=len(sizes))
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    for (_, target), of in by_size.items():
        if len({r.source_size for r in of}) == 1 and sum(r.size for r in of) == of[0].source_size:
            assert abs(sum(r.taken for r in of) - target) <= 0.5
    again = mixing.report(table).collect()
    assert helpers.by_key(map(tuple, got)) == helpers.by_key(map(tuple, again))


def test_mixing_curriculum(spark, tmp_path):
    rows = [(i, f"w{i} " * (i % 9), "en", "ab"[i % 2]) for i in range(80)] + [(None, None, None, None)]
    table = helpers.docs(spark, tmp_path, rows)
    taken = {r.doc_id: r.taken for r in mixing.report(table).collect()}
    out = mixing.curriculum(table, "when").collect()
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(helpers.words(r.text))
        assert r.n_chars == len(r.text)
    assert words == {d: n for d, n in taken.items() if n}
    times = [r.when for r in out]
    assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1
    assert mixing.curriculum(table).columns == table.columns


def test_mixing_time_is_the_inverse_of_demand(spark):
    rows = [(p, total, d) for p in range(3) for total in (10, 1000) for d in range(0, total, max(1, total // 20))]
    made = spark.createDataFrame(rows, "place long, total long, demand long").withColumn("t", mixing.time_of(F.col("demand"))).collect()
    for r in made:
        s = mixing.SLOPES[r.place]
        assert abs(((1 - s) * r.t + s * r.t**2) * r.total - r.demand) < 1e-6


def test_mixing_empty(spark, tmp_path):
    assert mixing.report(helpers.docs(spark, tmp_path, [])).collect() == []
    assert mixing.curriculum(helpers.docs(spark, tmp_path, [])).collect() == []
    assert [r.taken for r in mixing.report(helpers.docs(spark, tmp_path, [(1, None, None, None)])).collect()] == [0]


def test_empty_joins(spark, tmp_path):
    table = helpers.docs(spark, tmp_path, [])
    assert jaccard.join(table).collect() == [] and substring.report(table).collect() == []


def test_pipeline_stages(spark, tmp_path):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text", "lang", "source").collect()]
    secret = "the cat is in the house and password=hunter22abc is what they said about it all day long"
    rows += [(90_000, secret, "en", "src0"), (90_001, secret, "en", "src0"), (90_002, None, None, None), (90_003, "", "en", "src1"), (None, "und der Hund ist in dem Haus mit der Katze " * 4, "de", None)]
    docs = helpers.docs(spark, tmp_path, rows)
    columns = docs.columns
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SMALL)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == columns, name
            assert [f.dataType for f in made.schema] == [f.dataType for f in docs.schema], name
        path = str(tmp_path / name)
        made.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen.append((before, docs))
    texts = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d, _ in seen]
    assert 90_002 not in texts[1] and 90_003 not in texts[1] and 90_000 in texts[1] and len(texts[1]) > 0.9 * len(texts[0])
    assert 90_001 not in texts[2] and "hunter22abc" in texts[2][90_000]
    linked = helpers.jaccard([(r.doc_id, r.text) for r in seen[1][0].collect()])
    assert set(texts[2]) == {c for _, n, c, _ in linked if n} | {d for d, n, _, _ in linked if not n}
    assert set(texts[3]) == set(texts[2]) and "hunter22abc" not in texts[3][90_000] and "[ASSIGN]" in texts[3][90_000]
    assert set(texts[4]) <= set(texts[3])
    assert seen[4][1].count() == seen[4][0].count()
