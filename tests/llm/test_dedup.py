"""Near duplicates against all pairs."""

import random

from tollgate.llm import minhash
from tollgate.sources.tables import table

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


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
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, minhash.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()))


def edited(rng, words, n):
    w = list(words)
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.randrange(10**9)}"
    return " ".join(w)


def test_given_documents(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert result(spark, rows) == brute(rows)


def test_star_misses_are_found(spark):
    """A base with copies of any distance, copies of far copies, cut copies and chains."""
    rng = random.Random(5)
    rows = []
    for _ in range(3):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        far = [edited(rng, base, k).split() for k in (4, 5, 6, 7, 8, 9)]
        texts = [" ".join(base)] + [edited(rng, base, k) for k in (1, 2, 3, 3, 4, 4, 5, 6)]
        texts += [edited(rng, f, k) for f in far for k in (0, 1, 2)]
        texts += [" ".join(base[a:b]) for a, b in ((0, 60), (5, 62), (8, 70), (60, 120), (58, 118), (0, 100), (20, 120))]
        rows += [(rng.randrange(10**6), t) for t in texts]
    rng.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "a b c d e f g h i j k l"),
            (8, "a b c d e f g h i j k l m"), (8, "a b c d e f g h i j k l"), (9, "É b c d e"), (10, "é b c d e"), (11, "x " * 50_000)]
    assert result(spark, rows) == brute(rows)
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df.selectExpr("*", "1 as kept", "2 as node")).collect()), key=str)
    assert got == [(3, 2, 3, True), (3, 2, 3, True), (None, 2, None, True), (None, 2, None, True)]
    assert len(minhash.one_of_each(df).collect()) == 3
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_loose_group_is_no_square(spark, monkeypatch):
    """Documents of one template, too different to be linked: the rows joined do not grow with the square of the group."""
    rng = random.Random(3)
    frame = [f"t{i}" for i in range(100)]
    rows = [(i, " ".join([f"o{i}x{k}" for k in range(10)] + frame + [f"p{i}x{k}" for k in range(14)])) for i in range(400)]
    rows += [(1000 + i, rows[i][1].replace("t50", f"z{rng.randrange(9)}")) for i in range(0, 60, 3)]
    met = []
    rarest = minhash._rarest

    def counted(*args):
        rare = rarest(*args)
        met.append(rare.groupBy("hub", "shingle").count().selectExpr("sum(count * count)").first()[0] or 0)
        return rare

    monkeypatch.setattr(minhash, "_rarest", counted)
    assert result(spark, rows) == brute(rows)
    assert sum(met) <= 20 * len(rows)
