"""Hard negatives against a search of all pairs, and the parts the search is made of."""

import itertools

import numpy as np
import pytest
from docsynth.llm import negatives, queries
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, label int, embedding array<float>, key string, dim string, block string, rank string, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, lab, None if v is None else [None if x is None else float(x) for x in v], "k", "d", "b", "r", "v") for i, lab, v in rows], SCHEMA)


def plain(rows, anchors):
    """(anchor, positive, rank, negative, scores) over all pairs; ids None come last among ties."""
    live = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(live):
        if i is None or i % anchors:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), j is None, j or 0, m) for b, (j, m, w) in enumerate(live) if b != a and len(w) == len(v)]
        scored.sort(key=lambda r: r[:3])
        for p in [r for r in scored if r[3] == lab][:5]:
            near = [r for r in scored if r[3] != lab and 30 * -p[0] <= 100 * -r[0] <= 90 * -p[0]]
            out += [(i, None if p[1] else p[2], k + 1, None if r[1] else r[2], -p[0], -r[0]) for k, r in enumerate(near[:10])]
    return sorted(out, key=repr)


def mined(df, anchors):
    got = negatives.mine(df, F.col("id") % anchors == 0)
    return sorted((tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def sample(seed, n=260, dim=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    rows = [(int(i), int(rng.integers(3)), (centres[i % 4] + rng.normal(size=dim) * 0.5).tolist()) for i in range(n)]
    rows += [(n + i, i % 2, rows[0][2]) for i in range(60)]  # one vector many times
    rows += [(5, 1, rows[5][2]), (5, 0, [0.5] * dim), (10, 2, [0.0] * dim), (None, 0, rows[1][2]), (None, 1, rows[2][2])]
    rows += [(1000, None, [1.0] * dim), (1001, 1, None), (1002, 1, [None] * dim), (1003, 1, [float("nan")] * dim), (1004, 1, [float("inf")] * dim)]
    rows += [(1005, 0, [1.0, 2.0]), (1010, 0, [2.0, 2.0]), (1006, 1, [1.0, 1.0]), (1015, 0, []), (1016, 1, [])]
    return rows


@pytest.mark.parametrize(("rows", "chunk", "page", "pack"), [(256, 1 << 19, 1 << 24, 512), (7, 500, 900, 9)])
def test_every_window_is_found(spark, monkeypatch, rows, chunk, page, pack):
    for name, value in (("ROWS", rows), ("CHUNK", chunk), ("PAGE", page), ("PACK", pack)):
        monkeypatch.setattr(negatives, name, value)
    data = sample(rows)
    want = plain(data, 5)
    assert len(want) > 500
    assert mined(table(spark, data), 5) == want


def test_zone_maps_leave_blocks_out(spark, monkeypatch):
    """Two far clusters: an anchor's windows need not read the blocks of the other one."""
    monkeypatch.setattr(negatives, "ROWS", 16)
    rng = np.random.default_rng(1)
    data = [(i, i % 2, (np.array([3, 3, 0, 0] if i < 200 else [0, 0, 3, 3]) + rng.normal(size=4) * 0.1).tolist()) for i in range(400)]
    index = negatives.indexed(negatives.usable(table(spark, data), "vec_id", F.col("label"), "embedding"), F.col("id") % 50 == 0, 5)
    zones = index.collect()
    assert sum(z.n for z in zones) == 400 and all(len(z.low) == len(z.high) == 4 for z in zones)
    a = negatives.whole(np.array([[3.0, 3.0, 0.0, 0.0]])).astype(np.int64)
    least, most = negatives.zone_bounds(a, np.array([z.low for z in zones]), np.array([z.high for z in zones]))
    near = most[0] >= 256 * 256 * 9
    assert 0 < near.sum() <= 0.6 * len(zones)
    for z, lo, hi in zip(zones, least[0], most[0], strict=True):
        scores = np.array(z.v).reshape(z.n, -1) @ a[0]
        assert lo <= scores.min() and scores.max() <= hi
    assert mined(table(spark, data), 50) == plain(data, 50)


@pytest.mark.parametrize(("dim", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dim, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dim)))
    index = negatives.hilbert(cells, bits) @ (1 << np.arange(dim * bits - 1, -1, -1))
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_no_rows_and_huge_numbers(spark):
    assert mined(table(spark, []), 1) == []
    assert mined(table(spark, [(1, 1, None), (2, None, [1.0])]), 1) == []
    got = mined(table(spark, [(0, 1, [1e30, 1.0]), (1, 1, [1e30, 2.0]), (2, 2, [3e37, -3e37]), (3, 2, [1e4, 0.0])]), 100)
    top = min(negatives.largest(2), 2**31 - 1)
    assert got == [(0, 1, 1, 3, top * top + 256 * 512, top * 2560000)] or [r[3] for r in got] == []


def test_embeddings(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = queries.QUERIES["op11_hard_negatives"](spark, path).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 100)
