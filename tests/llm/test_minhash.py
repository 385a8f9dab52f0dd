"""Near-duplicate groups against all pairs, the estimate, and word hashes without known collisions."""

import collections
import random
import re

import helpers
import numpy as np
import pyarrow as pa
import pytest
from docsynth.llm import arrays, jaccard, minhash, queries, substring

SMALL = "/root/testdata/sf0.001"
EDGES = [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b"), (None, "a b"), (None, "zz"), (1002, "a b"), (1005, " \n"), (1006, "q"), (None, "p q r s t"), (None, "p q r s t"), (1007, "x " * 30_000 + "end")]


def plain(rows, k=4):
    sets = []
    for _, text in rows:
        w = helpers.words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                top[max(find(i), find(j))] = min(find(i), find(j))
    members = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    names = [min((d for d in members[find(i)] if d is not None), default=None) for i in range(len(rows))]
    return helpers.by_key((rows[i][0], len(sets[i]), names[i], rows[i][0] == names[i]) for i in range(len(rows)))


def grouped(spark, tmp_path, rows):
    df = minhash.groups(helpers.docs(spark, tmp_path, [(d, t, "en", "s") for d, t in rows]))
    assert df.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    return helpers.by_key(tuple(r) for r in df.collect())


def copies(seed, n, words=120, edits=5):
    """Copies of copies, so that groups have chains and strays near the limit."""
    r = random.Random(seed)
    texts = [[f"{r.choice('abcdefgh')}{r.randrange(300)}" for _ in range(words)]]
    for _ in range(n):
        w = r.choice(texts)[:]
        for _ in range(r.randrange(1, edits)):
            w[r.randrange(len(w))] = f"z{r.random()}"
        texts.append(w[: r.randrange(words - 20, words)] if r.random() < 0.2 else w)
    return [(100 * seed + i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize(("piece", "grams"), [(4096, 1_500_000), (5, 700)])
def test_groups(spark, tmp_path, monkeypatch, piece, grams):
    monkeypatch.setattr(minhash, "PIECE", piece)
    monkeypatch.setattr(minhash, "BLOCK_GRAMS", grams)
    rows = copies(1, 90, edits=7) + copies(2, 60, edits=4) + copies(3, 5, words=8) + EDGES
    want = plain(rows)
    sizes = collections.Counter(w[2] for w in want)
    assert max(sizes.values()) > 20 and len(sizes) > 20
    assert grouped(spark, tmp_path, rows) == want


def test_exactly_at_the_limit(spark, tmp_path):
    words = [str(i) for i in range(103)]  # 100 n-grams
    rows = [(1, " ".join(words)), (2, " ".join(words[:83])), (5, " ".join(f"w{w}" for w in words)), (4, " ".join(f"w{w}" for w in words[:82]))]  # 80 and 79
    assert grouped(spark, tmp_path, rows) == plain(rows) == helpers.by_key([(1, 100, 1, True), (2, 80, 1, False), (5, 100, 5, True), (4, 79, 4, True)])


def test_nothing(spark, tmp_path):
    assert grouped(spark, tmp_path, []) == []
    assert grouped(spark, tmp_path, [(3, None), (None, "")]) == helpers.by_key([(3, 0, 3, True), (None, 0, None, True)])


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_minhash"](spark, SMALL)
    assert helpers.by_key(map(tuple, got.collect())) == plain(rows)


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(5)
    for share in (0.0, 0.3, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, int(400 * share), dtype=np.uint64)
            sets = [np.unique(np.concatenate([both, rng.integers(0, 1 << 63, (400 - len(both)) // 2, dtype=np.uint64)])) for _ in range(2)]
            least = minhash.minima(sets)
            planes = minhash.signature(least).view(np.uint64).reshape(2, minhash.BITS, -1)
            equal = minhash.equal_minima(planes[0], planes[1:])
            low = arrays.stir(least.copy()) & np.uint64((1 << minhash.BITS) - 1)
            assert equal[0] == (low[0] == low[1]).sum()
            errors.append(minhash.similarity(equal)[0] - len(both) / len(np.union1d(*sets)))
        assert abs(np.mean(errors)) < 0.02


def test_forest_joins_what_pairs_join():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, (4, 300), dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(300) < rng.random() * 0.3, rng.integers(0, 1 << 62, 300, dtype=np.uint64), base[i % 4])) for i in range(80)]
    n, planes = np.array([len(s) for s in sets]), minhash.signature(minhash.minima(sets)).view(np.uint64).reshape(len(sets), minhash.BITS, -1)
    top = list(range(80))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(80):
        for j in np.flatnonzero((minhash.equal_minima(planes[i], planes) >= minhash.LEAST_EQUAL) & minhash.sizes_allow(n, n[i])).tolist():
            top[max(find(i), find(j))] = min(find(i), find(j))
    found = list(minhash.forest(np.arange(80), n, planes))
    assert len(found) == 80 - len({find(i) for i in range(80)}) and all(find(a) == find(b) for a, b, _ in found)


def thue_morse():
    word = "0"
    while len(word) < 2048:
        word += word.translate(str.maketrans("01", "10"))
    return word.translate(str.maketrans("01", "ab")), word.translate(str.maketrans("01", "ba"))


def test_words_that_differ_have_other_hashes(spark, tmp_path):
    """A word and its complement in the Thue-Morse order collide under any polynomial modulo a power of two."""
    a, b = thue_morse()
    rest = [f"w{i}" for i in range(34)]
    texts = [" ".join([x, *rest]) for x in (a, b)]
    for of in (lambda c: jaccard.gram_sets(c, np.zeros(1 << jaccard.TABLE, bool)), minhash.gram_sets):
        one, two = of(pa.array([a, b]))
        assert one.tolist() != two.tolist()
    got = substring.report(helpers.docs(spark, tmp_path, [(i, t, "en", "s") for i, t in enumerate(texts)])).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (1, 0)]


def test_word_hashes_follow_the_bytes():
    r = random.Random(8)
    words = [bytes(r.choice(b"abAB\xc3") for _ in range(r.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200]))) for _ in range(4000)]
    words += [w[:-1] + b"c" for w in words] + [w + b"a" for w in words]
    text = pa.array([b" ".join(words)]).cast(pa.large_binary())
    col = pa.LargeStringArray.from_buffers(1, text.buffers()[1], text.buffers()[2])
    for lower in (False, True):
        of = dict()
        for w, h in zip(words, arrays.words_of(col).hashes(lower).tolist(), strict=True):
            assert of.setdefault(w.lower() if lower else w, h) == h
        assert len(set(of.values())) == len(of)


def test_sets_that_share_half_of_a_digest(spark, tmp_path, monkeypatch):
    """Where first halves are equal, sets are told apart by the second."""
    rows = spark.createDataFrame([(5, 1), (5, 1), (6, 2), (6, 3), (7, 4)], "set long, check long")
    assert jaccard.shared_ids(rows) == frozenset([6])
    g = np.arange(3, dtype=np.uint64)
    first, second = jaccard.set_ids(g)
    assert (jaccard.set_id(g, frozenset()), jaccard.set_id(g, frozenset([first]))) == (first, second)
