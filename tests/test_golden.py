"""Hand-worked values and brute-force twins for what SQL does not check."""

import itertools
import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsynth import rng
from docsynth.functions import geometry as g
from docsynth.functions import text
from docsynth.operators import annotations as ann
from docsynth.operators import corpus, curate, ordered, overlap, pixels, records, spatial, structure, tables, web
from docsynth.operators.ordered import scan
from docsynth.plans import forms, recovery
from docsynth.sources import dataset, labels, markup
from docsynth.streaming import jobs


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


def test_rmb_upper(spark):
    want = {
        10000: "壹百元整", 123456: "壹千贰百叁拾肆元伍角陆分", 5: "零元零伍分", 50: "零元伍角整", 0: "零元整",
        10005: "壹百元零伍分", 10110: "壹百零壹元壹角整", 1000000000: "壹千万元整", 100050000: "壹百万零伍百元整",
    }
    for cents, words in want.items():
        assert one(spark, text.rmb_upper(F.col("c")), c=cents) == words


def test_minimal_period(spark):
    assert one(spark, text.minimal_period(F.col("t")), t="abab") == "ab"
    assert one(spark, text.minimal_period(F.col("t")), t="abc") == "abc"


def test_wide_text(spark):
    assert one(spark, text.display_width(F.col("t")), t="户名ab") == 6
    assert one(spark, text.display_width(F.col("t")), t="\x1b[1mab\x1b[0mé") == 3
    assert one(spark, text.wrap_chars(F.col("t"), 5), t="户名ab户名") == ["户名a", "b户名"]
    assert one(spark, text.wrap_words(F.col("t"), 6), t="ab cd efghijklm") == ["ab cd", "efghij", "klm"]
    assert one(spark, text.remove_marks(F.col("t")), t="éa") == "ea"
    assert one(spark, text.remove_invisible(F.col("t")), t="a​\tb\nc") == "ab\nc"


def test_justify(spark):
    assert one(spark, text.justify_line(F.col("t"), 11, F.lit(False)), t="ab cd ef") == "ab   cd  ef"
    placed = one(spark, text.justify_words(F.col("t"), 100, 8), t="ab cd ef")
    assert [(p["word"], p["x"]) for p in placed] == [("ab", 0), ("cd", 42), ("ef", 84)]


def test_shuangpin(spark):
    cases = {"zhong1": "vs", "ang1": "ah", "a1": "a1", "li4": "li", "x": "xx", "gzz1": "gzz1"}
    for syllable, code in cases.items():
        assert one(spark, text.shuangpin(F.col("t")), t=syllable) == code


def test_order_clockwise(spark):
    pts = F.array(*[g.point(F.lit(x), F.lit(y)) for x, y in ((10, 10), (0, 10), (10, 0), (0, 0))])
    got = [(p["x"], p["y"]) for p in one(spark, g.order_clockwise(pts))]
    assert got == [(0, 0), (10, 0), (10, 10), (0, 10)]


def test_homography_takes_corners(spark):
    src, dst = [(0.0, 0.0), (10.0, 0.0), (10.0, 20.0), (0.0, 20.0)], [(1.0, 2.0), (9.0, 1.0), (12.0, 25.0), (-1.0, 22.0)]
    m = [F.lit(v) for v in g.homography(src, dst)]
    q = F.array(*[g.point(F.lit(x), F.lit(y)) for x, y in src])
    for p, (u, v) in zip(one(spark, g.warp_points(q, m)), dst):
        assert math.isclose(p["x"], u, abs_tol=1e-9) and math.isclose(p["y"], v, abs_tol=1e-9)


def test_arc_outline(spark):
    n, size, radius = 5, 20, 180
    df = spark.createDataFrame([(n, size, radius)], ["n", "size", "radius"])
    got = [(p["x"], p["y"]) for p in ann.arc_outlines(df, "n", "size", "radius").first()["outline"]]
    d = 2 * math.asin(0.7 * size * 2**0.5 / 2 / radius)
    turn = -d * (n - 1) / 2

    def vertex(theta, off):
        dx, dy = (radius + off) * math.sin(theta), radius - (radius + off) * math.cos(theta)
        if dx == 0:
            return 0, int(dy)
        return int(dx * math.cos(turn) - dy * math.sin(turn)), int(dx * math.sin(turn) + dy * math.cos(turn))

    angles = [-d / 2] + [i * d for i in range(n)] + [(n - 1) * d + d / 2]
    want = [vertex(a, size / 2) for a in angles] + [vertex(a, -size / 2) for a in reversed(angles)]
    left, top = min(x for x, _ in want), min(y for _, y in want)
    assert got == [(x - left, y - top) for x, y in want]
    assert len(got) == 2 * (n + 2)


def boxes_frame(spark, rows):
    return spark.createDataFrame(rows, "image_id BIGINT, ann_id STRING, l BIGINT, t BIGINT, r BIGINT, b BIGINT, content STRING")


def random_boxes(seed, n, span=60):
    r = random.Random(seed)
    out = []
    for i in range(n):
        l, t = r.randrange(span), r.randrange(span)
        out.append((seed, f"a{i:03d}", l, t, l + r.randrange(5, 20), t + r.randrange(5, 20), "x"))
    return out


def test_row_clusters(spark):
    rows = [(1, "a", 0, 0, 5, 10, "x"), (1, "b", 10, 4, 15, 14, "x"), (1, "c", 0, 20, 5, 30, "x")]
    got = structure.row_clusters(boxes_frame(spark, rows)).orderBy("ann_id").collect()
    assert [r["row_no"] for r in got] == [1, 1, 2]


def test_row_clusters_over_chunk_borders(spark, monkeypatch):
    """One hot image over many bands gives what a plain loop gives."""
    monkeypatch.setattr(structure, "BAND", 16)
    rows = random_boxes(3, 200, 400)
    small = structure.islands(
        boxes_frame(spark, rows), ["image_id"], structure.band("t", 16), structure.READING,
        {"t": F.col("t"), "b": F.col("b")}, structure.same_row, "row_no",
    )
    got = {r["ann_id"]: r["row_no"] for r in small.collect()}
    last, no = None, 0
    for _, a, l, t, r, b, _ in sorted(rows, key=lambda x: (x[3], x[2], x[1])):
        same = last and (t <= (last[0] + last[1]) // 2 <= b or last[0] <= (t + b) // 2 <= last[1])
        no += 0 if same else 1
        last = (t, b)
        assert got[a] == no


def test_scan_equals_plain_loop(spark):
    """Totals, neighbours, running extremes of a hot group that spans many chunks."""
    r = random.Random(5)
    rows = [(0 if r.random() < 0.5 else r.randrange(4), i, r.randrange(100)) for i in range(300)]
    df = spark.createDataFrame(rows, "g BIGINT, o BIGINT, v BIGINT")
    c = F.col("v")
    odd = F.when(c % 2 == 1, c)
    got = scan(
        df, ["g"], {"c": F.floor(F.col("o") / 10)}, ["o"],
        sums={"total": c}, prev={"before": c}, next={"after": c}, highs={"high": odd}, lows={"low": odd},
    )
    found = {(x["g"], x["o"]): (x["total"], x["before"], x["after"], x["high"], x["low"]) for x in got.collect()}
    for k in range(4):
        vs = [(o, v) for gk, o, v in rows if gk == k]
        for i, (o, v) in enumerate(vs):
            head, tail = [x for _, x in vs[: i + 1] if x % 2], [x for _, x in vs[i:] if x % 2]
            want = (
                sum(x for _, x in vs[: i + 1]), vs[i - 1][1] if i else None, vs[i + 1][1] if i + 1 < len(vs) else None,
                max(head, default=None), min(tail, default=None),
            )
            assert found[(k, o)] == want


def crosses(a, b):
    return a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3]


def test_dedupe_is_greedy(spark):
    rows = [x for s in range(4) for x in random_boxes(s, 40)]
    rows += [(0, "zz", *rows[0][2:6], "x")]
    got = {(r["image_id"], r["ann_id"]) for r in overlap.dedupe_boxes(boxes_frame(spark, rows).drop("content"), ["t", "l"]).collect()}
    want = set()
    for image in range(4):
        kept = []
        for r in sorted((x for x in rows if x[0] == image), key=lambda x: (x[3], x[2], x[1])):
            box = r[2:6]
            area = (box[2] - box[0]) * (box[3] - box[1])

            def rival(k, box=box, area=area):
                other = (k[2] - k[0]) * (k[3] - k[1])
                return crosses(box, k) and abs(area - other) <= 0.1 * max(area, other)

            if box not in kept and not any(rival(k) for k in kept):
                kept.append(box)
                want.add((image, r[1]))
    assert got == want


def test_dedupe_chain_ends_in_few_rounds(spark, monkeypatch):
    """Each box crosses the one before it: every second one stays, found in rounds that grow like the logarithm."""
    rows = [(0, f"{i:04d}", 0, 10 * i, 20, 10 * i + 14, "x") for i in range(600)] + [(1, "a", 0, 0, 5, 5, "x")]
    rounds, real = [], overlap.materialise
    monkeypatch.setattr(overlap, "materialise", lambda df, name: rounds.append(name) or real(df, name))
    got = {(r["image_id"], r["ann_id"]) for r in overlap.dedupe_boxes(boxes_frame(spark, rows).drop("content"), ["t", "l"]).collect()}
    assert got == {(0, f"{i:04d}") for i in range(0, 600, 2)} | {(1, "a")}
    assert rounds.count("dedupe-step") <= 13


def test_overlaps_of_boxes_of_all_sizes(spark):
    """Page-wide boxes beside small ones, touching and nested ones, lines and points."""
    r = random.Random(11)
    rows = []
    for i in range(150):
        w, h = (r.choice([0, 1, 3, 16, 64, 700, 100_000]) for _ in range(2))
        l, t = r.randrange(-50, 900), r.randrange(900)
        rows.append((i % 2, f"a{i}", l, t, l + w, t + h, "x"))
    rows.append((0, "twin", *rows[0][2:6], "x"))
    got = {(x["image_id"], x["l"], x["t"], x["r"], x["b"]): (x["any"], x["similar"], x["nested"]) for x in overlap.overlaps(boxes_frame(spark, rows)).collect()}
    for image in range(2):
        boxes = [x[2:6] for x in rows if x[0] == image]
        for box in set(boxes):
            others = [o for o in set(boxes) if o != box]
            hits = [o for o in others if crosses(box, o)]
            area = lambda q: (q[2] - q[0]) * (q[3] - q[1])
            like = [o for o in hits if abs(area(o) - area(box)) <= 0.1 * max(area(o), area(box))]
            holds = lambda a, b: a[0] <= b[0] and a[2] >= b[2] and a[1] <= b[1] and a[3] >= b[3]
            within = [o for o in others if o in hits or holds(o, box) or holds(box, o)]
            twin = boxes.count(box) > 1
            assert got[(image, *box)] == (twin or bool(hits), twin or bool(like), twin or bool(within))


def test_page_wide_box_is_a_few_rows(spark):
    rows = [(0, "wide", 0, 0, 100_000, 100_000, "x")] + [(0, f"s{i}", 7 * i, 7 * i, 7 * i + 5, 7 * i + 5, "x") for i in range(50)]
    frame = boxes_frame(spark, rows).withColumn("level", overlap.level_of())
    assert overlap.cells(frame, "level").groupBy("ann_id").count().agg(F.max("count")).first()[0] <= 4


@pytest.mark.parametrize("edges", [64, 3])
def test_largest_gap_brute_force(spark, monkeypatch, edges):
    monkeypatch.setattr(overlap, "EDGES", edges)
    rows = [x for s in range(6) for x in random_boxes(s, 7, 40)]
    rows += [(6, "line", 0, 5, 30, 5, "x"), (6, "post", 9, 0, 9, 40, "x"), (6, "dot", 20, 20, 20, 20, "x"), (7, "one", 1, 1, 9, 9, "x")]
    got = {r["image_id"]: (r["l"], r["t"], r["r"], r["b"]) for r in overlap.largest_gap(boxes_frame(spark, rows)).collect()}
    for image in range(8):
        rects = [x[2:6] for x in rows if x[0] == image]
        xs = sorted({v for q in rects for v in (q[0], q[2])})
        ys = sorted({v for q in rects for v in (q[1], q[3])})
        best, size = None, 0
        for l, r in itertools.combinations(xs, 2):
            for t, b in itertools.combinations(ys, 2):
                area = (r - l) * (b - t)
                if area >= size and not any(crosses((l, t, r, b), q) for q in rects):
                    best, size = (l, t, r, b), area
        assert got.get(image) == best


@pytest.mark.parametrize(("block", "run"), [(8, 64), (1, 3), (5, 2)])
def test_paginate_many_blocks(spark, monkeypatch, block, run):
    monkeypatch.setattr(tables, "LINE_BLOCK", block)
    monkeypatch.setattr(ordered, "RUN", run)
    r = random.Random(2)
    rows = [(k, i, r.randrange(1, 4)) for k, n in enumerate((70, 4, 25)) for i in range(1, n)]
    df = spark.createDataFrame(rows, "table_id BIGINT, row_no BIGINT, height BIGINT")
    got = {(x["table_id"], x["row_no"]): x["page"] for x in tables.paginate(df, 9).collect()}
    for k in range(3):
        fill, page = 0, 1
        for _, i, h in (x for x in rows if x[0] == k):
            if fill >= 9:
                page, fill = page + 1, 0
            fill += h
            assert got[(k, i)] == page


def test_double_column(spark):
    df = spark.createDataFrame([(1, i, f"r{i}") for i in range(1, 7)], "table_id BIGINT, rn BIGINT, item STRING")
    pairs = sorted((r["left"], r["right"]) for r in tables.double_column(df, lossless=False).collect())
    assert pairs == [("r1", "r4"), ("r2", "r5")]
    kept = sorted((r["left"], r["right"]) for r in tables.double_column(df).collect())
    assert kept == [("r1", "r4"), ("r2", "r5"), ("r3", "r6")]


def test_titles_on_every_side(spark):
    lines = spark.createDataFrame([(1, i, "║ab║") for i in range(1, 6)], "table_id BIGINT, line_no BIGINT, line STRING")
    title = spark.createDataFrame([(1, "XY")], "table_id BIGINT, title STRING")
    shown = {s: [r["line"] for r in tables.titled(lines, title, s).orderBy("line_no").collect()] for s in "tblr"}
    assert shown["t"][0] == " XY" and shown["b"][-1] == " XY"
    assert [x[0] for x in shown["l"]] == [" ", "X", "Y", " ", " "]
    assert [x[-1] for x in shown["r"]] == [" ", "X", "Y", " ", " "]


def test_label_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a.jpg;0;0;9;0;9;5;0;5;text@x@y\nnoise\na.jpg;0;0;9;0;9;5;0;5;cell@\n", "utf-8")
    got = labels.read_labels(spark, str(tmp_path)).orderBy("kind").collect()
    assert [(r["kind"], r["content"], r["role"]) for r in got] == [("cell", "", "cell"), ("text", "x@y", "text")]
    assert all(r["file"].endswith("a.txt") for r in got)
    assert labels.require_labels(spark, str(tmp_path)).first()["n"] == 2
    (tmp_path / "b.txt").write_text("noise\n")
    with pytest.raises(Exception, match="no label line"):
        labels.require_labels(spark, str(tmp_path)).collect()


def test_gbk_corpus(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("a;1;text@户名\nb;text@x\nc;key@金额@张三\n".encode("gbk"))
    assert sorted(r["word"] for r in labels.read_corpus(spark, str(tmp_path)).collect()) == ["张三", "户名"]


def test_arc_label_line(spark):
    q = F.array(*[g.point(F.lit(x + 0.9), F.lit(-0.9)) for x in range(5)])
    line = one(spark, labels.label_line(F.lit("n"), q, F.lit("arc@t")))
    assert line == "n;0;0;1;0;2;0;3;0;4;0;arc@t"


def test_slice_html_mismatch(spark):
    df = spark.createDataFrame([("status='a' status='b'",)], ["html"])
    with pytest.raises(Exception, match="differ in number"):
        markup.slice_html(df, "html").collect()


def test_labelme_multiline(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"imagePath": "p.jpg",\n "shapes": [{"label": "plain", "points": [[1, 2], [3.5, 4]]}]}')
    r = markup.read_labelme(spark, str(tmp_path)).first()
    assert tuple(r) == ("p.jpg", "plain", 1, 2, 3, 4)


def test_hierarchy_yaml(spark, tmp_path):
    from docsynth.sources.hierarchy import read_hierarchy

    (tmp_path / "h.yaml").write_text("balance:\n  assets:\n    - cash\n    - stock\n  empty:\ncash flow:\n  ops:\n    - x\n", "utf-8")
    rows = read_hierarchy(spark, str(tmp_path / "h.yaml")).orderBy("statement_no", "section_no", "item_no").collect()
    assert [(r["statement"], r["section"], r["item"]) for r in rows] == [
        ("balance", "assets", "cash"), ("balance", "assets", "stock"), ("balance", "empty", None), ("cash flow", "ops", "x"),
    ]
    assert read_hierarchy(spark, str(tmp_path / "h.yaml"), only="flow").count() == 1


def test_strict_lookup(spark):
    df = spark.createDataFrame([("A",), ("Z",)], ["k"])
    assert sorted(r["v"] for r in curate.dictionary_lookup(df, "k", {"A": "1"}, "v").collect()) == ["1", "Z"]
    with pytest.raises(Exception, match="no entry for Z"):
        curate.dictionary_lookup(df, "k", {"A": "1"}, "v", strict=True).collect()


def test_top_n_salted(spark):
    rows = [("hot", i) for i in range(200)] + [("cold", i) for i in range(3)]
    df = spark.createDataFrame(rows, "g STRING, v BIGINT")
    got = corpus.top_n(df, ["g"], [F.col("v").desc()], 4, F.col("v"), salts=8).collect()
    assert sorted((r["g"], r["v"], r["rn"]) for r in got) == [
        ("cold", 0, 3), ("cold", 1, 2), ("cold", 2, 1), ("hot", 196, 4), ("hot", 197, 3), ("hot", 198, 2), ("hot", 199, 1),
    ]


def test_word_like_keeps_shape(spark):
    tokens = spark.createDataFrame([("en", w) for w in ("The", "and", "cat", "NASA", "dog", "Zürich9")], "lang STRING, word STRING")
    tokens = tokens.withColumn("i", F.monotonically_increasing_id())
    vocab = corpus.vocab_by_length(tokens)
    for exact in (True, False):
        for r in corpus.word_like(tokens, vocab, F.col("i"), exact=exact).collect():
            assert len(r["fake"]) == len(r["word"]) if exact or len(r["word"]) <= 4 else len(r["word"]) - 2 <= len(r["fake"])
            assert r["fake"].istitle() == r["word"].istitle() and r["fake"].isupper() == r["word"].isupper()


def test_rng(spark):
    us = [r[0] for r in spark.range(20000).select(rng.uniform(F.col("id"), 3)).collect()]
    assert abs(sum(us) / len(us) - 0.5) < 0.01 and 0 <= min(us) and max(us) < 1
    far = spark.createDataFrame([(10**15,), (10**15 + rng.M,)], "id BIGINT").select(rng.draw(F.col("id"), 1)).collect()
    assert far[0] != far[1]


def test_page_layout(spark):
    rows = forms.page_layout(spark.range(40)).collect()
    cols = {}
    for r in rows:
        cols.setdefault((r["id"], r["col_no"]), []).append(r)
    for blocks in cols.values():
        blocks.sort(key=lambda r: r["pos"])
        assert blocks[-1]["kind"] != "title"
        assert blocks[-1]["top"] + blocks[-1]["height"] <= forms.PAGE_HEIGHT
        for a, b in zip(blocks, blocks[1:]):
            assert b["top"] >= a["top"] + a["height"] + forms.PAGE_GAP


def test_block_lines(spark):
    rows = forms.block_lines(forms.form_blocks(spark.range(60))).collect()
    assert {r["kind"] for r in rows} == {b[0] for b in forms.BLOCKS}
    assert all("[x]" in r["line"] for r in rows if r["kind"] == "options")
    assert all(r["line"].count("|") == 3 for r in rows if r["kind"] in ("grid", "nested", "pairs"))


def test_running_and_advancing(spark):
    assert one(spark, records.running(F.lit(10), F.array(F.lit(1), F.lit(-3)))) == [11, 8]
    steps = one(spark, records.advancing(F.lit(5), 1, 6, F.lit(0), 2, 5))
    assert len(steps) == 6 and all(2 <= b - a <= 5 for a, b in zip(steps, steps[1:]))


def test_kmeans_palette(spark):
    rows = [(1, 0, i, *c) for i, c in enumerate([(0, 0, 0)] * 5 + [(250, 0, 0)] * 3 + [(0, 250, 0)] * 2)]
    df = spark.createDataFrame(rows, "image_id BIGINT, y BIGINT, x BIGINT, red BIGINT, green BIGINT, blue BIGINT")
    got = sorted((round(r["red"]), round(r["green"]), r["n"]) for r in pixels.dominant_colours(df, 3).collect())
    assert got == [(0, 0, 5), (0, 250, 2), (250, 0, 3)]


def test_gauss_noise_bounds(spark):
    df = spark.createDataFrame([(1, 0, i, 0, 128, 255) for i in range(500)], "image_id BIGINT, y BIGINT, x BIGINT, red BIGINT, green BIGINT, blue BIGINT")
    got = pixels.gauss_noise(df, 0.0, 0.01, F.col("x"), 3).collect()
    assert sorted(got) == sorted(pixels.gauss_noise(df.repartition(7), 0.0, 0.01, F.col("x"), 3).collect())
    assert all(0 <= r[c] <= 255 for r in got for c in ("red", "green", "blue"))
    assert abs(sum(r["green"] for r in got) / 500 - 128) < 5


def test_dataset_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.createDataFrame([("m", "en", "a"), ("m", "fr", "b")], "mode STRING, lang STRING, name STRING")
    dataset.write_dataset(rows, path)
    dataset.write_dataset(rows.where("lang = 'fr'").withColumn("name", F.lit("c")), path)
    assert sorted(r["name"] for r in spark.read.parquet(path).collect()) == ["a", "c"]


def test_sample_source(spark):
    spark.dataSource.register(dataset.SampleSource)
    df = spark.read.format("docsynth").option("n", 10).option("parts", 3).option("langs", "en,fr").load()
    assert df.rdd.getNumPartitions() == 3
    assert sorted((r["index"], r["lang"]) for r in df.collect()) == [(i, x) for i in range(10) for x in ("en", "fr")]


def test_sample_source_takes_filters(spark):
    offered = dataset.samples(spark, 5, 60, ["en", "fr", "km"])
    kept = offered.where((F.col("index") >= 20) & (F.col("index") < 23) & F.col("lang").isin("fr", "km"))
    assert sorted((r["index"], r["lang"]) for r in kept.collect()) == [(i, x) for i in (20, 21, 22) for x in ("fr", "km")]
    assert "Filter (" not in kept._jdf.queryExecution().executedPlan().toString()
    assert offered.where("index = 7 AND lang <> 'en'").count() == 2
    assert dataset.samples(spark, 0, -1, ["en"]).count() == 0


def test_list_by_extension(spark, tmp_path):
    for n in ("a.txt", "b.jpg", "c.txt"):
        (tmp_path / n).write_text("x")
    assert sorted(r["stem"] for r in dataset.list_by_extension(spark, str(tmp_path), "txt").collect()) == ["a", "c"]


def test_sample_stream(spark, tmp_path):
    stream = jobs.online_samples(jobs.sample_stream(spark, 5), "bank", "zh")
    seen = []
    query = stream.writeStream.foreachBatch(lambda df, _: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        while len(seen) < 10:
            query.awaitTermination(0.5)
    finally:
        query.stop()
    assert seen[0]["name"].startswith("bank_zh_0000")


def test_resume(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))

    def run():
        names = jobs.new_names(spark.readStream.schema("name STRING").parquet(src))
        jobs.append_available(names, out, cp)
        return sorted(r["name"] for r in spark.read.schema("name STRING").parquet(out).collect())

    spark.createDataFrame([("a",), ("b",), ("a",)], ["name"]).write.mode("append").parquet(src)
    assert run() == ["a", "b"]
    spark.createDataFrame([("b",), ("c",)], ["name"]).write.mode("append").parquet(src)
    assert run() == ["a", "b", "c"]


def test_words_of_every_script_keep_their_shape(spark):
    docs = spark.createDataFrame([(1, "de", "für die Straße im Café, 12!"), (2, "de", None), (3, "de", ""), (4, "el", "καλημέρα κόσμε"), (5, "ne", "नमस्ते संसार")], "doc_id BIGINT, lang STRING, text STRING")
    tokens = docs.select("lang", F.explode(F.regexp_extract_all("text", F.lit(corpus.WORD), F.lit(0))).alias("word"))
    got = {r["doc_id"]: r["text"] for r in corpus.sentence_like(docs, corpus.vocab_by_length(tokens)).collect()}
    assert got[2] == got[3] == "" and len(got) == 5
    shape = re.compile(r"[^\W\d_]+")
    assert [len(w) for w in shape.findall(got[1])] == [3, 3, 6, 2, 4] and shape.sub("", got[1])[:8] == "    , " + got[1][-3:-1]
    assert [len(w) for w in shape.findall(got[4])] == [8, 5]


def test_word_without_bucket_takes_any_word(spark):
    tokens = spark.createDataFrame([("en", "abcdefgh", 1), ("xx", "abc", 2)], "lang STRING, word STRING, i BIGINT")
    vocab = corpus.vocab_by_length(spark.createDataFrame([("en", "one")], "lang STRING, word STRING"))
    assert {r["word"]: r["fake"] for r in corpus.word_like(tokens, vocab, F.col("i")).collect()} == {"abcdefgh": "one", "abc": "abc"}


def test_wrapping_keeps_other_line_ends(spark):
    line = "ab\rcd\u2028ef\x85gh"
    row = spark.createDataFrame([(line,)], "line STRING").select(text.wrap_chars(F.col("line"), 40).alias("c"), text.wrap_words(F.col("line"), 40).alias("w")).first()
    assert row["c"] == [line] and row["w"] == [line]


def test_label_with_line_separator_is_read(spark):
    df = spark.createDataFrame([("a;0;0;1;0;1;1;0;1;text@x\u2028y",)], "value STRING")
    assert labels.parse_label_lines(df).first()["content"] == "x\u2028y"


def test_wide_cells_are_drawn_whole(spark):
    rows = spark.createDataFrame([(1, 1, ["x" * 1500, "b"])], "table_id BIGINT, row_no BIGINT, cells ARRAY<STRING>")
    assert sorted(r["width"] for r in tables.column_widths(rows).collect()) == [1, 1500]


def test_side_by_side_keeps_long_lines(spark):
    a = spark.createDataFrame([(1, 1, "n" * 30), (1, 2, "m")], "table_id BIGINT, line_no BIGINT, line STRING")
    b = spark.createDataFrame([(1, 1, "xy")], "table_id BIGINT, line_no BIGINT, line STRING")
    assert sorted(r["line"] for r in tables.side_by_side(a, b).collect()) == ["m" + " " * 31, "n" * 30 + "xy"]


def test_article_paragraphs_and_entities(spark):
    html = "<body>nav<article><h1>Head</h1><p>a &amp; <b>b</b>&lt;x&gt;<p class='q'>c&#233;&#x4e2d;</p><div>ad</div></article></body>"
    pages = [(html,), ("<article><div>only &amp;amp; text</div></article>",), ("<body>plain</body>",)]
    got = [r[0] for r in spark.createDataFrame(pages, "html STRING").select(web.article_text(F.col("html"))).collect()]
    assert got == ["a & b <x>\nc\u00e9\u4e2d", "only &amp; text", "plain"]


def test_numeric_entities_of_every_plane(spark):
    text = "&#128512;&#70000;&#x1F600; &#xD800; &#0; &#65;&#x41; &amp;#66; &#99999999; &#x10FFFF;&#0000000065;"
    assert one(spark, web.unescape(F.col("t")), t=text) == "\U0001f600\U00011170\U0001f600 &#xD800; &#0; AA &#66; &#99999999; \U0010ffffA"


def hyphenated(words, width):
    """Letter by letter, as a typesetter would go along."""
    lines, line = [], ""
    for word in words:
        while len(line) + len(word) > width:
            kept = ""
            while len(line) + len(kept) + 1 < width - 1 and len(kept) < len(word):
                kept += word[len(kept)]
            lines.append(line + kept + ("-" if kept else ""))
            line, word = "", word[len(kept) :]
        if len(line) + len(word) == width:
            lines.append(line + word)
            line = ""
        else:
            line += word + " "
    return [x.rstrip() for x in lines + [line] if x.strip()]


def squeezed(words, slot, char):
    """Positions of the words of each line."""
    lines, line, used = [], [], 0
    for w in words:
        size = len(w) * char
        if used + size <= slot:
            line, used = line + [w], used + size + char
        elif line and used + size - slot <= len(line) * char / 10:
            lines.append((line + [w], slot - used - size))
            line, used = [], 0
        else:
            lines += [(line, slot - used + char)] if line else []
            line, used = [w], size + char
    out = []
    for ws, extra in lines + ([(line, 0)] if line else []):
        x, placed = 0, []
        n, m = divmod(abs(extra), len(ws) - 1) if len(ws) > 1 else (0, 0)
        for i, w in enumerate(ws):
            placed.append((w, x))
            x += len(w) * char + char + (1 if extra > 0 else -1) * (n + (i < m))
        out.append(placed)
    return out


@pytest.mark.parametrize("width", [4, 9, 24])
def test_hyphens_and_squeezed_lines(spark, width):
    r = random.Random(width)
    texts = [" ".join("".join(r.choice("abcde") for _ in range(r.choice([1, 2, 3, 5, 8, width - 1, width, width + 1, 2 * width - 2, 70]))) for _ in range(r.randrange(0, 40))) for _ in range(60)]
    texts += ["", "  ", "a" * width, "\t two  words ", "x " * 400]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", text.wrap_hyphens(F.col("t"), width).alias("h"), text.justify_squeezed(F.col("t"), 8 * width + 3, 8).alias("s")).collect()
    for x in got:
        assert x["h"] == hyphenated(x["t"].split(), width)
        assert [[tuple(w) for w in line] for line in x["s"]] == squeezed(x["t"].split(), 8 * width + 3, 8)
    full = [line for x in got for line in x["s"][:-1] if len(line) > 1]
    assert full and all(line[-1]["x"] + 8 * len(line[-1]["word"]) == 8 * width + 3 for line in full)


def test_table_edits(spark):
    drawn = ["╔════╦═══╗", "║ab  ║xyz║", "╠════╬═══╣", "║abcd║x  ║", "╚════╩═══╝"]
    df = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(drawn)], "table_id BIGINT, line_no BIGINT, line STRING")
    of = lambda frame: [x["line"] for x in frame.orderBy("line_no").collect()]
    line = F.col("line")
    assert of(df.withColumn("line", tables.align_column(line, 0, "r")))[1::2] == ["║ ab ║xyz║", "║abcd║x  ║"]
    assert of(df.withColumn("line", tables.align_column(line, 1, "c")))[1::2] == ["║ab  ║xyz║", "║abcd║ x ║"]
    assert of(df.withColumn("line", tables.widen(line, 3, "m"))) == ["╔════╦══════╗", "║ab  ║ xyz  ║", "╠════╬══════╣", "║abcd║ x    ║", "╚════╩══════╝"]
    blank = "║    ║   ║"
    assert of(tables.heighten(df, 2, "t")) == [*drawn[:4], blank, blank, drawn[4]]
    assert of(tables.heighten(df, 1, "b")) == [drawn[0], blank, *drawn[1:]]


def test_warp_of_each_scene(spark):
    """The closed form equals the solved system, and takes the page's corners to the scene's."""
    r = random.Random(7)
    scenes = [[(x + r.random() * 90, y + r.random() * 90) for x, y in ((50, 40), (400, 60), (430, 700), (20, 720))] for _ in range(20)]
    rows = spark.createDataFrame([tuple(v for p in s for v in p) for s in scenes], [f"{a}{i}" for i in range(4) for a in "xy"])
    warp = g.rectangle_to_quad(F.lit(420.0), F.lit(760.0), [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)])
    page = [(0.0, 0.0), (420.0, 0.0), (420.0, 760.0), (0.0, 760.0)]
    for found, scene in zip(rows.select(F.array(*warp).alias("m")).collect(), scenes, strict=True):
        assert found["m"] == pytest.approx(g.homography(page, scene), rel=1e-9, abs=1e-12)


def test_shuffle_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(corpus, "RANGE_ROWS", 40)
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    got = {x["k"]: (x["v"], x["position"]) for x in corpus.shuffle(df, "k").collect()}
    drawn = {x["k"]: x["d"] for x in df.select("k", rng.draw(F.col("k"), 36).alias("d")).collect()}
    order = sorted(drawn, key=lambda k: (drawn[k], k))
    assert got == {k: (3 * k, i + 1) for i, k in enumerate(order)}


def test_optional_columns_by_row(spark):
    names = records.OPTIONAL
    rows = spark.createDataFrame([(k,) for k in range(len(names) + 1)], "k int")
    record = F.create_map(*[F.lit(c) for c in names for c in (c, c)], F.lit("x"), F.lit("y"))
    for x in rows.select("k", records.drop_optional_columns(record, F.col("k")).alias("r")).collect():
        assert set(x["r"]) == {*names[: len(names) - x["k"]], "x"}


def test_repeated_batch_stands_once(spark, tmp_path):
    """Killed after a batch was written and before it was noted as done: the batch is made again over itself."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    samples = jobs.online_samples(jobs.sample_stream(spark, 7), "bank", "zh")
    jobs.keep_batches(samples, out, state)
    jobs.keep_batches(samples, out, state)
    for f in [*(tmp_path / "state/commits").glob("1"), *(tmp_path / "state/commits").glob(".1.crc")]:
        f.unlink()
    jobs.keep_batches(samples, out, state)
    seen = sorted(r["index"] for r in spark.read.parquet(out).collect())
    assert seen == list(range(len(seen))) and len(seen) >= 14


def test_offered_words_stay_as_many_as_the_vocabulary(spark):
    words = [("en", f"w{i:04d}") for i in range(500)] + [("en", "ab"), ("en", "cd")]
    vocab = corpus.vocab_by_length(spark.createDataFrame(words, "lang STRING, word STRING"))
    sizes = vocab.groupBy("lang", "n_chars").agg(F.count(F.lit(1)).alias("size"))
    got = {r["n_chars"]: r["n"] for r in corpus.offered(vocab, sizes).groupBy("n_chars").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {5: 500, 2: 64}


def test_word_of_an_unknown_length_is_drawn_from_the_whole_language(spark):
    words = sorted((f"{'x' * n}{c}" for n in (1, 3, 6) for c in "abcdefg"[: n + 1]), key=lambda w: (len(w), w))
    vocab = corpus.vocab_by_length(spark.createDataFrame([("en", w) for w in words], "lang STRING, word STRING"))
    tokens = spark.range(200).select(F.lit("en").alias("lang"), F.lit("unknown length").alias("word"), "id")
    got = corpus.word_like(tokens, vocab, F.col("id")).select("fake", rng.draw(F.col("id"), 30).alias("d")).collect()
    assert len(got) == 200 and all(r["fake"] == words[r["d"] % len(words)] for r in got)


def test_page_layout_is_dealt_out(spark):
    pages = forms.page_layout(spark.range(0, 100, 1, 1))
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    kinds = {(r["id"] % 5, r["col_no"]): r["kind"] for r in pages.where("pos = 0").collect()}
    assert kinds == {(mode, c): names[0] for mode, columns in enumerate(forms.PAGES) for c, names in enumerate(columns)}


def test_rule_segments_are_merged_in_as_many_parts_as_the_boxes_need(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_BOXES", 10)
    rows = [(i % 3, f"{i}", 10 * (i % 7), 5, 10 * (i % 7) + 10, 9, "x") for i in range(90)]
    got = ann.rule_segments(boxes_frame(spark, rows), F.lit("all"))
    spread = got.select(F.spark_partition_id().alias("p")).distinct().count()
    want = {(g, *e) for g, _, l, t, r, b, _ in rows for e in (("h", l, t, r, t), ("h", l, b, r, b), ("v", l, t, l, b), ("v", r, t, r, b))}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and spread > 4


def test_words_that_fit_are_not_broken(spark):
    plan = spark.range(1).select(text.wrap_hyphens(F.lit("a b"), 24).alias("x"), text.justify_squeezed(F.lit("a b"), 600, 8).alias("y"))._jdf.queryExecution().analyzed().toString()
    # The remainder of a word is worked out in the last branch only, and the words of a line are folded once.
    assert plan.count("aggregate(") <= 3


def test_recovery_deals_small_pages_out_once(spark, monkeypatch):
    r = random.Random(5)
    rows = [(i, f"{i}-{k:03d}", 100 * (k % 4) + r.randrange(7), 40 * (k // 4) + r.randrange(5), 100 * (k % 4) + 50 + r.randrange(40), 40 * (k // 4) + 20 + r.randrange(5), f"c{k % 3}")
            for i in range(8) for k in range(12 + 10 * i) if r.random() < 0.9]
    boxes = boxes_frame(spark, rows)
    steps = {
        "table": lambda p: p.table,
        "outside": lambda p: structure.texts_outside_cells(p.boxes, p.full_cells, p.whole).select("image_id", "ann_id"),
        "lines": lambda p: structure.cells_to_rows_text(p.full_cells, p.assigned, p.boxes, p.whole),
        "cells": lambda p: structure.cell_texts(p.assigned, p.boxes, p.whole).select("image_id", "ann_id", "row_no", "col_no", "line_no"),
    }
    got = {}
    for most in (0, 45):
        monkeypatch.setattr(spatial, "PAGE_BOXES", most)
        for name, step in steps.items():
            df = recovery.over_pages(boxes, step)
            got[name, most] = sorted((tuple(x) for x in df.select(sorted(df.columns)).collect()), key=repr)
    for name in steps:
        assert got[name, 0] == got[name, 45] and got[name, 0]
    page = recovery.Recovery(boxes, True)
    for df in (page.column_texts, page.padded_columns, page.final_rows, page.table):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_of_small_and_large_pages(spark, monkeypatch):
    rows = [(i, f"{k:03d}", *box, "x") for i in (1, 2) for k, box in enumerate(x[2:6] for x in random_boxes(i, 30 * i))]
    boxes, got, near_pairs = boxes_frame(spark, rows).drop("content"), {}, overlap.near_pairs
    for most in (0, 40, 4096):
        monkeypatch.setattr(spatial, "PAGE_BOXES", most)
        pairs = []
        monkeypatch.setattr(overlap, "near_pairs", lambda x, near=near_pairs, pairs=pairs: (pairs.append(x), near(x))[1])
        got[most] = sorted(tuple(x) for x in overlap.dedupe_boxes(boxes, ["t", "l"]).collect())
        assert bool(pairs) == (most < 4096)
    assert got[0] == got[40] == got[4096] and got[0]


def test_near_words_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        vocab = corpus.vocab_by_length(spark.createDataFrame([("en", "one"), ("en", "three")], "lang STRING, word STRING"))
        tokens = spark.range(50).select(F.lit("en").alias("lang"), F.lit("Two").alias("word"), "id")
        got = corpus.word_like(tokens, vocab, F.col("id"))
        assert {r["fake"] for r in got.collect()} == {"One"}
        assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_words_near_and_far_are_the_same(spark, monkeypatch):
    r = random.Random(9)
    words = ["".join(r.choice("abcdeß") for _ in range(r.randrange(1, 9))) for _ in range(400)]
    text = [" ".join(r.choice([w, w.title(), w.upper(), "2024-05", "élan", "Unknownlength"]) for w in r.sample(words, 40)) for _ in range(12)]
    rows = [(i if i < 10 else None, r.choice(["en", "de", "xx", None]), x) for i, x in enumerate(text)] + [(3, "en", "ab 77 Cd."), (20, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, lang STRING, text STRING")
    vocab = corpus.vocab_by_length(spark.createDataFrame([(k, w) for k in ("en", "de") for w in words[:: 2 - (k == "en")]], "lang STRING, word STRING"))
    tokens = docs.where("text IS NOT NULL").select("lang", F.posexplode(F.split("text", " ")).alias("id", "word"))
    got = {}
    for most in (0, 9000, 64 << 20):
        monkeypatch.setattr(corpus, "NEAR_BYTES", most)
        got["text", most] = sorted((tuple(x) for x in corpus.sentence_like(docs, vocab).collect()), key=repr)
        got["word", most] = sorted((tuple(x) for x in corpus.word_like(tokens, vocab, F.col("id"), exact=False).select("lang", "id", "word", "fake").collect()), key=repr)
        sizes = [x["__near"] for x in corpus.word_lists(vocab).collect()]
        assert all(sizes) == (most > 9000) and any(sizes) == (most > 0)
    for kind in ("text", "word"):
        assert got[kind, 0] == got[kind, 9000] == got[kind, 64 << 20] and got[kind, 0]
    assert len(got["text", 0]) == 12


def test_runs_are_joined_where_a_document_is_read(spark):
    names = ["doc_id", "pos", "text", "__num"]
    rows = [(1, 0, "ab", None), (1, 1, " ", None), (1, 2, "far", 7), (1, 3, "-", None), (1, 4, "ü", None), (1, 6, "x", None), (2, 0, "", None), (2, 1, "y", None), (None, 0, "n", None), (None, 1, "m", None)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.string(), pa.int64()), strict=True)], names)
    for b in (batch, batch.slice(1)):
        got = [tuple(x.values()) for x in next(corpus.join_runs()(iter([b]))).to_pylist()]
        head = [(1, 0, "ab ", None)] if b is batch else [(1, 1, " ", None)]
        assert got == head + [(1, 2, "far", 7), (1, 3, "-ü", None), (1, 6, "x", None), (2, 0, "y", None), (None, 0, "n", None), (None, 1, "m", None)]
    docs = spark.createDataFrame([(1, "en", "ab cd"), (1, "en", "xy-zw"), (2, "en", "one 2")], "doc_id BIGINT, lang STRING, text STRING")
    vocab = corpus.vocab_by_length(spark.createDataFrame([("en", "ab")], "lang STRING, word STRING"))
    got = {x["doc_id"]: x["text"] for x in corpus.sentence_like(docs.where("doc_id = 1").unionByName(docs.where("doc_id = 2")), vocab, keep_ascii=True).collect()}
    assert got[1] == "abxy -cdzw" and got[2][:4] == "one "


def test_polygons_are_made_after_their_rows_are_dealt(spark):
    rows = [(i % 3, i, i % 5) for i in range(30)]
    df = spark.createDataFrame(rows, "image_id BIGINT, ann_id BIGINT, n INT")
    polygon = F.transform(F.sequence(F.lit(0), F.col("n")), lambda k: F.struct((F.col("ann_id") + k).alias("x"), k.alias("y")))
    got = {}
    for kind, quad, src in (("made", polygon, df), ("given", "quad", df.withColumn("quad", polygon))):
        padded = ann.pad_polygons(src, "image_id", quad)
        got[kind] = {r["ann_id"]: [tuple(p) for p in r["quad"]] for r in padded.collect()}
    longest = {g: max(n for k, _, n in rows if k == g) for g in range(3)}
    want = {i: [(i + min(k, n), min(k, n)) for k in range(longest[g] + 1)] for g, i, n in rows}
    assert got["made"] == got["given"] == want
    plan = ann.pad_polygons(df, "image_id", polygon, corners=F.col("n") + 1)._jdf.queryExecution().optimizedPlan().toString()
    # Below the join there are only the columns a polygon is made of.
    assert "transform(" in plan.split("Join")[0] and "transform(" not in plan.split("Join")[1]
