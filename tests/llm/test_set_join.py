"""The Jaccard join against all pairs."""

import random

import pytest
from tollgate.llm import setjoin
from tollgate.sources.tables import table

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and rows[i][0] is not None and rows[j][0] is not None and 100 * inter >= 90 * (len(sets[i]) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least[find(i)] if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, setjoin.jaccard_classes(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(rng, words, n):
    w = list(words)
    for i in rng.sample(range(len(w)), n):
        w[i] = rng.choice([f"new{rng.randrange(10**9)}", f"old{rng.randrange(4)}"])
    return w


def families(rng):
    """Bases with near and far copies, copies of far copies, a large variant, cut copies and shared passages."""
    rows = []
    for _ in range(2):
        base = [f"w{rng.randrange(5000)}" for _ in range(150)]
        variant = base[:60] + [f"v{rng.randrange(5000)}" for _ in range(14)] + base[74:]
        texts = [base]
        for b in (base, variant):
            texts += [edited(rng, b, k) for k in (0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 6, 7) for _ in range(2)]
            for k in (3, 4, 5):
                far = edited(rng, b, k)
                texts += [edited(rng, far, j) for j in (0, 1, 2, 2)]
        texts += [base[a:b] for a, b in ((0, 136), (0, 130), (8, 150), (14, 150), (20, 150), (0, 60), (5, 62))]
        texts += [base[:100] + [f"x{rng.randrange(10**9)}" for _ in range(30)] for _ in range(8)]
        rows += [(rng.randrange(10**6), " ".join(t)) for t in texts]
    rng.shuffle(rows)
    return rows


def test_given_documents(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize(("hot", "levels"), [(64, 4), (4, 4), (1, 2)])
def test_families(spark, monkeypatch, hot, levels):
    monkeypatch.setattr(setjoin, "HOT", hot)
    monkeypatch.setattr(setjoin, "LEVELS", levels)
    rows = families(random.Random(hot))
    got = result(spark, rows)
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(got) - 20


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
            (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z aa"), (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (9, "É b c d e"), (10, "é b c d e"), (11, "x " * 50_000),
            (None, "a b c d"), (None, "a b c d"), (20, "a b c d"), (-5, "a b\x0bc d"), (20, "a b c d")]
    assert result(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as node", "3 as component_id")
    assert sorted(map(tuple, setjoin.jaccard_classes(df).select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows)
    assert setjoin.jaccard_classes(df.limit(0)).count() == 0
