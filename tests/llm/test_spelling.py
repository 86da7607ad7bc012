"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

from tollgate.llm import spelling
from tollgate.sources.tables import table

SF = "/root/testdata/sf0.001"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for m in (-1, 0, 1) for v in by_length.get(len(w) + m, []) if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_given_documents(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = result(spark, rows)
    assert got == brute(rows)
    assert sum(r[4] for r in got) > 0


def test_edits_everywhere(spark):
    """Each kind of edit at each position, chains of forms, and words that share a half with very many others."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéß×"
    counts = Counter()
    for length in (6, 7, 8, 13):
        w = "".join(rng.choices(letters, k=length))
        counts[w] += 3000
        for i in range(length):
            counts[w[:i] + w[i + 1:]] += 5
            counts[w[:i] + "z" + w[i:]] += 600
            counts[w[:i] + "q" + w[i + 1:]] += 30
        counts[w + "yy"] += 9
    for end in ("ction", "graphically"):
        for a in "abcdefghijklmn":
            for b in "abcdefghijklmn":
                counts[a + b + end] += 5 + ord(b) % 3
                counts[end + a + b] += 5
    rows = [(i % 50, f"{w.upper() if i % 3 == 0 else w}, ") for i, w in enumerate(counts.elements())]
    texts = {}
    for d, t in rows:
        texts[d] = texts.get(d, "") + t
    got = result(spark, list(texts.items()))
    assert got == brute(list(texts.items()))
    assert any(r[1] and r[2] != r[1] for r in got)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "Letter letter " * 9), (5, "abcdef " * 5), (5, "abcdef " * 5), (6, "abcdeg-abcdeg_" * 12), (7, "x" * 50_000 + " "),
            (8, ("y" * 5_000 + " ") * 5), (8, ("y" * 5_001 + " ") * 30), (9, "Éclair éclair " * 20), (10, "short " * 100)]
    assert result(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "'r' as root")
    assert sorted(map(tuple, spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())) == brute(rows)
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_blocks_cut_no_run(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 7)
    text = "Straße éclairée mañana, x2y longerword中nextword " * 3
    whole = Counter(spelling.RUN.findall(text))
    assert sum((Counter(spelling.RUN.findall(b)) for b in spelling._blocks(text.encode())), Counter()) == whole
