"""Plain Python versions of the operators, for small tables."""

import collections
import hashlib
import re

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_table(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def docs_rows(docs_table):
    return [(r["doc_id"], r["text"]) for r in docs_table.select("doc_id", "text").collect()]


WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").encode().lower())


def line_dedup(docs, min_chars=40, min_docs=5):
    """docs: [(doc_id, text)] -> [(doc_id, kept text, lines, dropped)]."""
    held = collections.defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t in docs]

    def key(line):
        return line.strip(BLANKS).translate(LOWER)

    for i, lines in split:
        for line in lines:
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    keeper = {k: max(s) for k, s in held.items() if len(s) >= min_docs}
    out = []
    for i, lines in split:
        kept = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    run = min(size, len(w))
    return frozenset(tuple(w[i : i + run]) for i in range(len(w) - run + 1))


def classes(docs, p=4, q=5):
    """{doc_id: (class, links)} by comparing all pairs; links of Jaccard p / q or more."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    top = {i: i for i in sets}
    links = collections.Counter()

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            met = len(sets[i] & sets[j])
            if met and q * met >= p * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (find(i), links[i]) for i in ids}


def contamination(docs, items, size=10):
    """[(doc_id, words, hit words, sorted item ids)]."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def numbers(text):
    """The base numbers of the quality rules, and those that the votes need besides."""
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {k + d for k, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if seen[x] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(x) for x in "#*$%&|<>"), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "n_lines": len(lines), "n_ends": sum(text.count(x) for x in ".!?"), "w": w, "text": text}


def quality(docs):
    """[kept] for [(doc_id, text)]: the votes from plain numbers, the model by ``estimate`` over their counts."""
    import unicodedata

    from starfold.llm.quality import COMMON, RULES, estimate

    def vote(bad, good=False):
        return -1 if bad else 1 if good else 0

    def votes(x):
        n, c = max(1, x["n_words"]), max(1, x["word_chars"])
        upper = sum(unicodedata.category(a) == "Lu" for a in x["text"]) / c
        common = sum(a in COMMON for a in x["w"]) / n
        per = x["n_words"] / max(1, x["n_ends"])
        dup = x["n_dup_lines"] / max(1, x["n_lines"])
        length, repeat = x["word_chars"] / n, x["n_repeat_words"] / n
        return (vote(x["n_symbols"] / n > 0.2), vote(upper > 0.3), vote(common < 0.02, common > 0.08), vote(repeat > 0.4), vote(length < 2 or length > 12), vote(per < 2 or x["n_ends"] == 0, 3 <= per <= 60), vote(dup > 0.4))

    import math

    every = [numbers(t) for _, t in docs]
    patterns = [votes(x) for x in every]
    model = estimate(collections.Counter(patterns))
    out = []
    for x, p in zip(every, patterns, strict=True):
        odds = math.log(model.prior / (1 - model.prior)) + sum(model.weight(r, v) for r, v in zip(RULES, p, strict=True))
        failed = x["n_words"] < 50 or 100 * x["n_repeat_words"] > 50 * x["n_words"]
        out.append(not failed and odds >= 0)
    return out
