"""Encoding, language, secrets, quality and packing: one text at a time, against plain versions and round trips."""

import base64
import bz2
import functools
import gzip
import hashlib
import lzma
import random
import re
import subprocess
import sys
import urllib.parse
import zlib

import helpers
import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from docsynth.llm import arrays, bpe, langid, packing, quality, secretscan
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (1, "Hello WORLD's <|endoftext|> café ΣΑΣ ² 12 don't 'start", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (4, " \n\t", None, "b"),
    (None, "no id here", "fr", None), (5, "x" * 50_000, "en", "a"), (6, "zq" * 300 + "é" * 99, "de", "a"), (6, "zq" * 300 + "é" * 99, "de", "a"), (7, "中文 नमस्ते ไทย 😀!!", "en", "c"),
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_rows(spark, tmp_path, library):
    got = {(r[0], r[1], r[2], r[3]) for r in bpe.digest(helpers.docs(spark, tmp_path, ROWS), PATH).collect()}
    want = set()
    for d, t, _, _ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), helpers.sha(library.decode(ids, skip_special_tokens=False))))
    assert got == want


def test_bpe_decode_of_stored_ids(spark, tmp_path, library):
    coded = bpe.encode(helpers.docs(spark, tmp_path, ROWS[:3]), PATH)
    assert [r.decoded for r in bpe.decode(coded, PATH).orderBy("doc_id").collect()] == [library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t, _, _ in ROWS[:3]]


@functools.cache
def plain_library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=60))
def test_bpe_any_latin_text(text):
    library = plain_library()
    assert np.frombuffer(bpe.loaded(PATH).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_any_plane(library):
    """Random strings of every script and plane, unassigned code points and marks in any order too."""
    r = random.Random(12)
    marks = [*range(0x300, 0x370), *range(0x1DC0, 0x1E00), *range(0x8D0, 0x900), 0x708, 0x1DCC, 0x1DF8]
    odd = [0x558, 0x58B, 0xC5C, 0x3A3, 0x130, 0x1E9E, 0xFB01, 0x2126, 0x212B, 0x1F600, 0x2028, 0x3000, 0xFEFF, 0x200D]
    picks = [lambda: r.randrange(0x20, 0x250), lambda: r.randrange(0x250, 0x3000), lambda: r.randrange(0x3000, 0xD800), lambda: r.randrange(0xE000, 0x110000), lambda: r.choice(marks), lambda: r.choice(odd)]
    coder = bpe.loaded(PATH)
    for _ in range(4000):
        text = "".join(chr(r.choice(picks)()) for _ in range(r.randrange(1, 14)))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    for start in range(0, 0x110000, 64):
        text = " ".join(chr(c) + "a" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_bpe_cuts_are_certain():
    coder = bpe.loaded(PATH)
    assert coder.cut("abzqcd") == ["abz", "qcd"]
    assert coder.cut("hello") == ["hello"]


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = langid.predict(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out").collect()
    right = [r.lang_pred == r.lang for r in made if r.n_chars >= 200]
    assert len(right) > 200 and sum(right) / len(right) > 0.95
    assert sum(r.rejected for r in made) / len(made) < 0.03
    assert all(0 <= r.score <= 1 for r in made)


def test_language_rows(spark, tmp_path):
    rows = [(i, "the cat and the dog are in the house " * 3, "en", "a") for i in range(30)] + [(i, "le chat et le chien sont dans la maison " * 3, "fr", "a") for i in range(30, 60)]
    rows += [(100, None, "en", "a"), (101, "123 456", "en", "a"), (102, "", None, None), (103, "le chien et la maison", None, None), (None, "the house and the dog", None, None)]
    got = {r.doc_id: r for r in langid.predict(helpers.docs(spark, tmp_path, rows)).collect()}
    assert [got[d].lang_pred for d in (100, 101, 102, 103, None)] == ["und", "und", "und", "fr", "en"]
    assert got[100].score == 0 and got[100].rejected and not got[None].held_out
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got if d is not None)


def plain_languages(rows):
    """(doc_id, language, score) of each (doc_id, text, lang): dictionaries from texts of smallest hash, all pieces compressed."""
    best = {}
    for d, text, lang in rows:
        if text is None or lang is None or (d is not None and zlib.crc32(str(d).encode()) % 3 == 1):
            continue
        order = xxhash.xxh64(text.encode(), seed=42).intdigest()
        order -= (order >> 63) << 64
        at, mine = (lang, (order >> 20) % langid.SAMPLE_ROWS), (len(text) > langid.SAMPLE_CHARS, order, text[: langid.SAMPLE_CHARS])
        best[at] = min(best.get(at, mine), mine)
    content = {}
    for (lang, _), (_, _, text) in sorted(best.items()):
        content[lang] = content[lang] + "\n" + text if lang in content else text
    coders = {}
    for lang, text in sorted(content.items()):
        d = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=langid.LEVEL)
        coders[lang] = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
    out = []
    for d, text, _ in rows:
        low = (text or "").lower()
        if not re.search(r"[^\W\d_]", low):
            out.append((d, "und", 0.0))
            continue
        sizes = sorted((sum(len(c.compress(low[i : i + langid.PIECE].encode())) for i in range(0, len(low), langid.PIECE)), lang) for lang, c in coders.items())
        out.append((d, sizes[0][1], round((sizes[1][0] - sizes[0][0]) / sizes[1][0], 12)))
    return out


def test_language_as_in_plain_version(spark, tmp_path):
    table = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    long = " ".join(t for _, t, lang in table if lang == table[0][2] and t)[:300_000]
    table += [(None, table[0][1], table[0][2]), (90_000, long, table[0][2]), (90_001, None, "en"), (90_002, "", "en"), (90_003, "12 3", None), table[1], table[1]]
    docs = helpers.docs(spark, tmp_path, [(d, t, lang, "s") for d, t, lang in table])
    got = [(r.doc_id, r.lang_pred, round(r.score, 12)) for r in langid.predict(docs).collect()]
    assert helpers.by_key(got) == helpers.by_key(plain_languages(table))


def test_language_does_not_learn_from_ids(spark, tmp_path):
    rows = [(3 * i, f"text {i} of the house" if i % 2 else f"texte {i} de la maison", "en" if i % 2 else "fr", "s") for i in range(400)]
    other = [(7 * d + 5, t, lang, "z") for d, t, lang, _ in rows[::-1]]
    assert langid.fit(helpers.docs(spark, tmp_path, rows)) == langid.fit(helpers.docs(spark, tmp_path, other + other[:50]))


def test_language_learns_nothing(spark, tmp_path):
    made = langid.predict(helpers.docs(spark, tmp_path, [(1, "some text", None, "a")])).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in made] == [("und", 0.0, True)]


SECRET = 'api_key = "abcdef123456"'


@pytest.mark.parametrize(
    "inside",
    [
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: urllib.parse.quote(s),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
        lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
        lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
        lambda s: base64.b64encode(zstandard.compress(s.encode())).decode(),
        lambda s: base64.b64encode(urllib.parse.quote(base64.b64encode(s.encode()).decode()).encode()).decode(),
    ],
)
def test_secret_in_layers(inside):
    text = "é words before " + inside(SECRET) + " and after"
    base, spans = secretscan.scan(text)
    assert not base and spans
    assert all(len("é words before ") <= a < b <= len(text) - len(" and after") for a, _, b in spans)
    assert inside(SECRET)[2:10] not in secretscan.covered(text)


def test_secret_spans_of_escapes_are_exact():
    text = "x api%5Fkey%3Dabcdef123 y"
    assert secretscan.scan(text) == ([], [(2, 0, 23)])


def test_secret_repeated_layer_is_found_at_each_place():
    code = base64.b64encode(b"token: abcdefgh").decode()
    assert len(secretscan.scan(f"{code} and {code}")[1]) == 2


def test_secret_in_compressed_copies_is_found_at_each_place():
    inner = base64.b64encode(gzip.compress(b"words and words " * 200 + SECRET.encode())).decode()
    for code in (inner, urllib.parse.quote(inner, safe=""), base64.b64encode(inner.encode()).decode()):
        text = f"{code} and {code} and {code}"
        spans = secretscan.scan(text)[1]
        assert [(a // (len(code) + 5), b <= a // (len(code) + 5) * (len(code) + 5) + len(code)) for a, _, b in spans] == [(0, True), (1, True), (2, True)]


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize(
    "inside",
    [
        lambda s: b64(gzip.compress(zlib.compress(s))),
        lambda s: b64(gzip.compress(gzip.compress(bz2.compress(zstandard.compress(lzma.compress(s)))))),
        lambda s: b64(gzip.compress(b"first part\n") + gzip.compress(s)),
        lambda s: b64(b"head" + zlib.compress(s) + b"tail"),
        lambda s: "data=" + urllib.parse.quote(gzip.compress(s)),
        lambda s: "".join(f"\\x{c:02x}" for c in zlib.compress(s)),
        lambda s: b64(b"\0\x1b[1m" + s + b"\x7f"),
        lambda s: b64(b"\xff\xfe" + s),
        lambda s: base64.encodebytes(b"filler to the end of the line, as long as it must be" + s).decode(),
        lambda s: base64.encodebytes(gzip.compress(random.Random(1).randbytes(300) + s)).decode().replace("\n", "\r\n> "),
        lambda s: base64.encodebytes(gzip.compress(random.Random(1).randbytes(300) + s)).decode().replace("\n", "\\n"),
        *(lambda s, k=k: "http://h/" + "com/cb/x"[:k] + "/" + b64(gzip.compress(s)) for k in range(4, 8)),
        *(lambda s, k=k: "a-b_c"[:k] + "-" + base64.urlsafe_b64encode(s * 2).decode().rstrip("=") + "_end" for k in range(1, 5)),
    ],
)
def test_secret_unwrapped_to_the_end(inside):
    code = inside(SECRET.encode())
    base, spans = secretscan.scan(f"é {code} z")
    assert not base and spans and all(2 <= a < b <= 2 + len(code) for a, _, b in spans)
    assert not secretscan.scan(secretscan.covered(f"é {code} z"))[1]


def test_secret_layers_end():
    quine = bytes.fromhex("1f8b080000000000000372656375727365")  # cut short: no layer
    assert secretscan.scan(b64(quine))[1] == []
    deep = SECRET.encode()
    for _ in range(12):
        deep = base64.b64encode(gzip.compress(deep)) + b" " + base64.b64encode(gzip.compress(deep))
    assert len(secretscan.scan(deep.decode())[1]) == 2


@pytest.mark.parametrize("text", ['"api_key": "\\u0061bcdef12"', '"pass\\u0077ord": "hunter22"', "token: %61bcdefgh", "%73ecret = \\x61bcdefgh", "secret%20= abcdefgh"])
def test_secret_key_and_value_in_two_runs(text):
    base, spans = secretscan.scan(f"é x {text} y")
    assert not base and [(k, b) for _, k, b in spans] == [(0, 4 + len(text.rstrip('"')))]
    assert spans[0][0] == 4 + text.startswith('"')


def plain_spans(text):
    found = []
    for kind, pattern, keep in (
        (0, re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        (1, re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        (2, re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if keep(m)]
    return sorted(found)


@functools.cache
def plain_library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "API_KEY", "passwd", "=", ":", " ", '"', "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "%20", "\\u0041", "\n"]), max_size=25).map("".join))
def test_secret_base(text):
    base, spans = secretscan.scan(text)
    assert base == plain_spans(text) and set(base) <= set(spans)


def test_secret_rows(spark, tmp_path):
    rows = [(1, f"a {SECRET} b", "en", "a"), (2, None, None, None), (3, "", None, None), (None, "0" * 24, None, None), (4, "f" * 100_000 + " secret: abcdefg", "en", "a"), (1, f"a {SECRET} b", "en", "a")]
    table = helpers.docs(spark, tmp_path, rows)
    got = helpers.by_key(tuple(r)[:5] for r in secretscan.report(table).collect())
    names = secretscan.KINDS
    want = []
    for d, t, _, _ in rows:
        spans = plain_spans(t or "")
        want.append((d, *[sum(k == n for _, k, _ in spans) for n in range(3)], helpers.sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans))))
    assert got == helpers.by_key(want)
    clean = {r.doc_id: r for r in secretscan.redact(table, chars="n_chars").collect()}
    assert clean[1].text == 'a [ASSIGN]" b' and clean[1].n_chars == len(clean[1].text) and clean[2].text is None and clean[2].n_chars is None


def test_quality_counts(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "bé", "c#", "$", "d\n", "\n", "x y z", "\x85", "\x1c"]) for _ in range(rng.randrange(80))) for _ in range(200)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(900, None, None, None), (901, "", "en", "a"), (902, "w " * 40_000, "en", "a"), (None, "a b c", "en", "a"), (1, texts[1], "en", "a")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words): r for r in quality.rules(helpers.docs(spark, tmp_path, rows), labels).collect()}
    assert set(got) == {(d, *helpers.quality(t)) for d, t, _, _ in rows}
    for (_, n, *_, again), r in got.items():
        assert r.base_failed == (n < 10 or 100 * again > 20 * n)
        assert not (r.kept and r.base_failed)


def spans_of(text):
    return {(k, a, b) for a, k, b in secretscan.scan(text)[1]}


@pytest.mark.parametrize("window", range(9, 16))
def test_secret_in_zlib_of_any_window(window):
    for level in (1, 6, 9):
        maker = zlib.compressobj(level, zlib.DEFLATED, window)
        packed = base64.b64encode(maker.compress(b"some text and api_key = abcdef123 and more") + maker.flush()).decode()
        assert spans_of(f"x {packed} y") == {(0, 2, 2 + len(packed))}


def test_secret_in_other_wrappings():
    raw = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = base64.b64encode(raw.compress(b"words, password: hunter2222 words") + raw.flush()).decode()
    assert spans_of(f"a {packed} z") == {(0, 2, 2 + len(packed))}
    for kind in ("utf-16-le", "utf-16-be", "utf-16"):
        wide = base64.b64encode("my secret = abcdefgh now".encode(kind)).decode()
        assert {k for k, _, _ in spans_of(f"a {wide} z")} == {0}
    assert spans_of(r"\u{74}oken=abcdefg") == {(0, 0, 18)}


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, zstandard.compress, lambda d: lzma.compress(d, preset=0)])
def test_secret_in_much_inflated_data(pack):
    """What inflates to far more than may be held is read as a stream, also where a secret lies across its steps."""
    body = bytearray(b"no thing here, " * 1_000_000)
    assigned = lambda t: {x for x in spans_of(t) if x[0] == 0}
    for at in (len(body) - 40, secretscan.WHOLE + 5 * secretscan.STEP - 11):
        data = bytearray(body)
        data[at : at + 23] = b" password = hunter2222 "
        packed = base64.b64encode(pack(bytes(data))).decode()
        assert (0, 2, 2 + len(packed)) in assigned(f"x {packed} y")
    packed = base64.b64encode(pack(bytes(body))).decode()
    assert assigned(f"x {packed} y") == set()
    inner = base64.b64encode(b"token: abcdefgh")
    both = base64.b64encode(pack(bytes(body) + pack(bytes(body[:3_000_000]) + inner + b" " * 10_000_000) + bytes(body[:1000]))).decode()
    assert (0, 2, 2 + len(both)) in assigned(f"x {both} y")


def test_inflated_data_take_little_memory():
    """About 200 MB of inflated text from less than 1 MB of base64."""
    script = """
import base64, resource, zlib
from docsynth.llm import secretscan
maker = zlib.compressobj(9)
block = b"some words, " * 80_000 + b"\\n"
packed = b"".join(maker.compress(block) for _ in range(200)) + maker.compress(b" token = abcdefghij ") + maker.flush()
text = base64.b64encode(packed).decode()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert (0, 0, len(text)) in secretscan.scan(text)[1]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=str(arrays.ROOT), timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) < 120


def test_quality_cutoffs_keep_their_promise():
    grid = len(quality.SIGNALS["symbol_share"][1])
    # 2000 good documents, 10 above the first cutoff: the bound rules out a share above 1%.
    chosen = quality.choose([("en", {"symbol_share": [1990, 10, *[0] * (grid - 1)]})])
    assert chosen == {"en": {"symbol_share": 1}} or chosen == {"en": {"symbol_share": 0}}
    assert quality.tail(10, 2000, quality.ALPHA) <= quality.DELTA / grid or chosen["en"]["symbol_share"] == 1
    assert quality.choose([("en", {"symbol_share": [50, *[0] * grid]})]) == {}
    assert abs(quality.tail(2, 10, 0.3) - sum(c * 0.3**k * 0.7 ** (10 - k) for k, c in enumerate((1, 10, 45)))) < 1e-12


def test_quality_without_labels(spark, tmp_path):
    table = helpers.docs(spark, tmp_path, [(1, "one two three four five six seven eight nine ten", "en", "a")])
    assert [r.kept for r in quality.rules(table, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()] == [True]


def test_best_fit_equals_plain_search():
    rng = random.Random(1)
    for row in (1, 2, 7, 64, 100):
        for _ in range(40):
            lengths = [rng.randrange(1, row + 1) for _ in range(rng.randrange(60))]
            room, bins = [], []
            for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
                fits = [(r, b) for b, r in enumerate(room) if r >= lengths[i]]
                b = min(fits)[1] if fits else len(room)
                if not fits:
                    room.append(row)
                    bins.append([])
                room[b] -= lengths[i]
                bins[b].append(i)
            got = packing.best_fit(lengths, row)
            assert sorted(i for r in got for i in r) == list(range(len(lengths)))
            assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(sum(lengths[i] for i in r) for r in bins)


def test_packing_round_trip(spark, tmp_path):
    rows = [*ROWS, *[(100 + i, "word " * (i * 7 % 300), "en", "a") for i in range(60)]]
    table = helpers.docs(spark, tmp_path, rows)
    coder, parts = bpe.loaded(PATH), {}
    for r in packing.pack(table, PATH, row=128, shard=2000).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 128 and r.cumulative[0] == 0 and r.cumulative[-1] == r.n_tokens and r.position_resets == r.cumulative[:-1]
        assert (ids[r.n_tokens :] == packing.PAD).all()
        for d, s, a, b in zip(r.doc_ids, r.doc_starts, r.cumulative, r.cumulative[1:], strict=False):
            parts.setdefault((d, s), []).append(ids[a:b].tolist())
    for d, t, _, _ in rows:
        want, at = np.frombuffer(coder.encode(t or ""), "<u4").tolist(), 0
        while at < len(want):
            piece = parts[d, at].pop()
            assert piece == want[at : at + len(piece)]
            at += len(piece)
    assert not any(parts.values())


def test_packing_files(spark, tmp_path):
    rows = [*ROWS, (8, "many words " * 9_000, "en", "a"), *[(100 + i, "word " * (i * 7 % 300), "en", "a") for i in range(60)]]
    table, folder = helpers.docs(spark, tmp_path, rows), str(tmp_path / "packed")
    manifest = packing.write(table, PATH, folder, row=128, shard=2000).collect()
    want = {(r.shard, r.row): r for r in packing.pack(table, PATH, row=128, shard=2000).collect()}
    got = packing.read(spark, folder).collect()
    assert len(got) == len(want) and {(r.shard, r.row): r for r in got} == want
    assert sum(m.n_tokens for m in manifest) == sum(r.n_tokens for r in got) and sum(m.n_segments for m in manifest) == sum(len(r.doc_ids) for r in got)
    # Another program maps the matrix into memory, without Spark.
    for m in manifest:
        matrix = np.memmap(f"{folder}/shards/{m.name}.ids", "<u4", "r").reshape(m.n_rows, m.row_tokens)
        for k in (0, m.n_rows - 1):
            assert matrix[k].tobytes() == want[m.shard, k].ids
    assert sorted(p.name for p in (tmp_path / "packed/shards").iterdir()) == sorted(f"{m.name}.{x}" for m in manifest for x in ("ids", "segments"))
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        packing.write(table, PATH, folder)
    changed = tmp_path / f"packed/shards/{manifest[0].name}.ids"
    changed.write_bytes(b"\1\2\3\4" + changed.read_bytes()[4:])
    with pytest.raises(Exception, match="is not as it was written"):
        packing.read(spark, folder).collect()


def test_packing_files_written_again_and_cut_off(tmp_path):
    """A task that dies leaves no file under a name; the one that runs again takes its place."""
    where, folder = packing.place_of(f"file:{tmp_path}")
    row = lambda k: {"row": k, "n_tokens": 2, "ids": b"\0" * 8, "cumulative": [0, 2], "position_resets": [0], "doc_ids": [None], "doc_starts": [0]}

    def dying():
        yield row(0)
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        packing.store(where, folder, 5, dying())
    assert not (tmp_path / f"{5:016x}.ids").exists()
    first = packing.store(where, folder, 5, [row(0), row(1)])
    assert packing.store(where, folder, 5, [row(0), row(1)]) == first
    assert (tmp_path / f"{5:016x}.ids").stat().st_size == 16


def test_packing_files_of_nothing(spark, tmp_path):
    for k, rows in enumerate(([], [(1, None, "en", "a"), (2, "", "en", "a")])):
        folder = str(tmp_path / f"none{k}")
        assert packing.write(helpers.docs(spark, tmp_path, rows), PATH, folder).collect() == []
        assert packing.read(spark, folder).collect() == []


@pytest.mark.parametrize("make", [lambda d: bpe.digest(d, PATH), langid.predict, secretscan.report, lambda d: packing.pack(d, PATH)])
def test_empty_table(spark, tmp_path, make):
    assert make(helpers.docs(spark, tmp_path, [])).collect() == []


def test_words_of_sliced_and_joined_texts():
    import pyarrow as pa

    texts = ["a b", "c", "", " d", "e ", "f\x0bg", None, "é\x85h"]
    w = arrays.words_of(pa.array(["skip", *texts]).slice(1).fill_null(""))
    assert w.counts().tolist() == [len(helpers.words(t)) for t in texts]
    assert len(set(w.hashes().tolist())) == len({x for t in texts for x in helpers.words(t)})
    long = arrays.words_of(pa.array(["ab " * 200_000 + "c" * 300_000 + " ab"]))
    assert len(set(long.hashes().tolist())) == 2
