"""Hard negatives against a comparison with every row."""

import math
import random

import numpy as np
import pytest
from tollgate.llm import hardneg
from tollgate.sources.tables import table

SF = "/root/testdata/sf0.01"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * float(np.float32(x))) for x in v]
        while w and w[-1] == 0:
            w.pop()
        kept[i, (label + 1) % 10 if i % 7 == 0 else label, tuple(w)] = None
    out = []
    for a, la, va in kept:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, label) for i, label, v in kept if i != a)
        for ps, p, _ in [s for s in scored if s[2] == la][:5]:
            ps = -ps
            fits = [(i, -s) for s, i, label in scored if label != la and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, k + 1, n, ps, s) for k, (n, s) in enumerate(fits)]
    return sorted(out)


def result(spark, rows, schema=SCHEMA):
    return sorted(map(tuple, hardneg.hard_negatives(spark.createDataFrame(rows, schema)).select(*COLUMNS).collect()))


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(hardneg, "TILE", 40)
    monkeypatch.setattr(hardneg, "LEAF", 4)
    monkeypatch.setattr(hardneg, "QUERIES_A_TASK", 1)


def test_given_embeddings(spark, small_tiles):
    df = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = sorted(map(tuple, hardneg.hard_negatives(df).select(*COLUMNS).collect()))
    assert got == brute(rows) and got


def test_ties_and_hot_vectors(spark, small_tiles):
    """Few different vectors, a third of all rows the same, clusters that boxes can tell apart."""
    rng = random.Random(2)
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(8)]
    rows = [(100 * i if i % 9 == 0 else 1000 + i * 3, [0.5, 0.25, 0.0, 0.5, -0.5, 0.25], i % 3) for i in range(150)]
    rows += [(50_000 + i * 4, [c + rng.choice([0, 0, 1 / 256, 0.05]) for c in rng.choice(centres)], rng.randrange(4)) for i in range(300)]
    rows = list({r[0]: r for r in rows}.values())
    assert result(spark, rows) == brute(rows)


def test_boxes_are_pruned():
    """Far clusters are not looked at; every entry's product lies in its box's interval."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(0, 4, (400, 5)) + 200, rng.integers(0, 4, (400, 5)) - 200]).astype(np.float64)
    tile = hardneg.Tile(list(x), np.zeros(800), [[i] for i in range(800)], np.float64, 5)
    q = np.array([1.0, 2, -1, 3, 1])
    low, high = tile.boxes.intervals(q[None])
    for b, lo, hi in zip(tile.x, low[0], high[0], strict=True):
        assert (b @ q).min() >= lo and (b @ q).max() <= hi
    looked = []
    tile.x = [type("Leaf", (), {"__matmul__": lambda self, o, b=b: (looked.append(1), b @ o)[1]})() for b in tile.x]
    got = list(tile.search(q, 0, [{"low": None, "high": None, "kth": None}], low[0], high[0], True, 5))
    assert [s for _, _, s in got] == sorted((x @ q).astype(int), reverse=True)[:5] and len(looked) <= len(tile.x) // 2 + 1


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5], 1), (100, [0.5], 1), (3, [0.5, 0.5, 0.0], 1), (4, [0.4, 0.5], 2), (5, None, 1), (6, [0.5, None], 1), (8, [nan, 1.0], 2), (9, [inf, 1.0], 2),
            (10, [0.5, 0.45], None), (None, [0.5, 0.5], 1), (7, [0.5, 0.5], 9), (14, [0.45, 0.5], 1), (11, [], 2), (12, [0.0, -0.0], 3), (200, [], 1), (200, [], 1), (4, [0.4, 0.5], 2),
            (300, [-1.0, -1.0], 3), (13, [-1.0, -0.9], 3)]
    assert result(spark, rows) == brute(rows)
    most = 2**63 - 1
    big = [(0, [1e18, 1.0], 1), (1, [1e18, 2.0], 1), (2, [9e17, 0.5], 2), (3, [-1e18, 1.0], 2), (4, [1.0, 1.0], 2)]
    assert result(spark, big) == [(0, 2, 1, 1, most, most), (0, 4, 1, 1, most, most)]  # row 0 has label 2
    wide = [(0, [2e6, 3e6], 1), (1, [2e6, 3e6 + 1], 1), (2, [2e6 - 8, 3e6], 2), (3, [2e6 - 8, 3e6 - 1], 2)]
    assert result(spark, wide) == brute(wide)
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", "1 as qid", "2 as tile", "3 as v", "'x' as score")
    assert sorted(map(tuple, hardneg.hard_negatives(clash).select(*COLUMNS).collect())) == brute(rows)
    assert hardneg.hard_negatives(df.limit(0)).count() == 0
