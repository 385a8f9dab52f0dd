"""Plain versions of the operators, row by row, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, row string, hits int, row_key string, place int, maybe string, mix string, _row int"


def docs(spark, tmp_path, rows):
    """A documents table with columns of clashing names, read back from a file as the operators expect."""
    full = [(d, t, lang, source, None if t is None else len(t), "x", "y", 1, "k", 2, "m", "x", 3) for d, t, lang, source in rows]
    path = str(tmp_path / f"docs{len(list(tmp_path.iterdir()))}")
    spark.createDataFrame(full, DOCS).write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_key(rows):
    return sorted(rows, key=repr)


def jaccard(rows):
    """(doc_id, set size, component, links) of each (doc_id, text)."""
    sets = []
    for _, text in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                top[max(find(i), find(j))] = min(find(i), find(j))
    members = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    return [(rows[i][0], len(sets[i]), min((d for d in members[find(i)] if d is not None), default=None), links[i]) for i in range(len(rows))]


def passages(rows):
    """(doc_id, words, removed, digest of the rest) with windows of 35 words that stand anywhere else removed."""
    texts = [words(t) for _, t in rows]
    times = collections.Counter(tuple(w[i : i + 35]) for w in texts for i in range(len(w) - 34))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = {k for i in range(len(w) - 34) if times[tuple(w[i : i + 35])] > 1 for k in range(i, i + 35)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def quality(text):
    """(words, characters in words, symbols, repeated lines, words in repeated windows)."""
    text = text or ""
    w = words(text)
    times = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {k for i in range(len(w) - 4) if times[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(again)
