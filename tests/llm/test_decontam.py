"""Template decontamination: planted copies and re-parameterised items."""

from tollgate.llm import decontam

ITEM = "A train leaves Berlin at 9 with 120 passengers and travels 300 km before it stops, how many hours does Anna wait if the delay is 15 minutes in total"
COPY = ITEM.replace("Berlin", "Madrid").replace("120", "85").replace("300", "450").replace("Anna", "Julia").replace("15", "20")
FILL = "Some other words stand here and they say nothing of interest at all to anyone."


def found(spark, docs, items=((1, ITEM),), **more):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(list(items), "item_id long, text string")
    return sorted((r["doc_id"], r["item_id"], r["verdict"]) for r in decontam.contamination(d.selectExpr("*", "1 as w", "2 as item_id"), b, **more).collect())


def test_verdicts(spark):
    mixed = "He has 5 red and 5 blue balls and gives away 5 more balls to every child he meets on that day"
    docs = [(1, f"{FILL} {ITEM} {FILL}"), (2, f"{FILL} {COPY}"), (3, FILL), (4, None), (5, ""), (6, ITEM.upper()), (7, f"{COPY}\n{FILL}"),
            (8, mixed.replace("5", "7")), (9, mixed.replace("5 red", "6 red")), (10, ITEM[:40]), (None, ITEM), (1, f"{FILL} {ITEM} {FILL}")]
    items = [(1, ITEM), (2, mixed), (3, None), (4, "too short"), (None, ITEM), (1, ITEM)]
    want = [(1, 1, "copy"), (2, 1, "reparameterised"), (7, 1, "reparameterised"), (8, 2, "reparameterised"), (9, 2, "edited")]
    got = found(spark, docs, items)
    assert [x for x in got if x[0] != 6] == want
    assert found(spark, docs, items, limit=0) == got  # the shuffle join
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_stage_drops_only_the_contaminated(spark):
    d = spark.createDataFrame([(1, f"{FILL} {COPY}"), (2, FILL), (None, FILL)], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted((r[0] for r in decontam.decontaminate(d, b).collect()), key=str) == [2, None]


def test_whole_items_of_the_benchmark(spark):
    from tollgate.sources.tables import table

    b = table(spark, "/root/testdata/sf0.01", "benchmark")
    d = b.selectExpr("item_id as doc_id", f"concat('{FILL} ', text, ' {FILL}') as text")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contamination(d, b).collect()}
    assert {(r[0], r[0]) for r in b.select("item_id").collect()} <= got


def test_runs_on_other_diagonals(spark):
    """An item is found though inserted or removed tokens, or longer names, cut it into runs that are too short alone."""
    words = [f"{a}{b}" for a in ("alba", "bero", "cinu") for b in "abcdefghijklmno"]
    long = " ".join(words)
    runs = [" ".join(words[i:i + 15]) for i in (0, 15, 30)]
    name = "yesterday Anna bought seven green apples at that small market and then Anna gave two rotten ones back to him"
    items = [(1, long), (2, name), (3, f"{long} " + " ".join(f"tail{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)))]
    docs = [(1, f"{FILL} {runs[0]} x y {runs[1]} x y z {runs[2]} {FILL}"), (2, name.replace("Anna", "Anna Maria")), (3, f"{runs[0]} {FILL} {FILL}"),
            (4, f"{' '.join(words[:13])} {' '.join(words[16:29])} {' '.join(words[32:])}"), (5, f"{runs[0]} {FILL * 9} {runs[1]} {FILL * 9} {runs[2]}"),
            (6, f"{runs[0]} x y {runs[1]} {FILL} {long} {FILL}")]
    got = found(spark, docs, items)
    assert got == [(1, 1, "copy"), (1, 3, "copy"), (2, 2, "reparameterised"), (4, 1, "copy"), (4, 3, "copy"), (6, 1, "copy"), (6, 3, "copy")]
    assert found(spark, docs, items, limit=0) == got


def test_values_changed_one_by_one(spark):
    item = "she buys 3 apples and 3 pears at the market and walks home with all of them in one bag"
    assert found(spark, [(1, item.replace("3 apples", "5 apples").replace("3 pears", "7 pears"))], [(1, item)]) == [(1, 1, "reparameterised")]
    assert found(spark, [(6, ITEM.upper())]) == [(6, 1, "copy")]


def test_stage_judges_every_row(spark):
    """Null and shared ids of documents, null ids of items: the text decides."""
    rows = [(None, f"{FILL} {ITEM}"), (None, FILL), (7, f"{COPY} {FILL}"), (7, f"{FILL} {FILL}"), (8, f"{FILL} {ITEM}"), (9, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for item_id in (1, None):
        b = spark.createDataFrame([(item_id, ITEM)], "item_id long, text string")
        assert sorted(map(tuple, decontam.decontaminate(d, b).collect()), key=str) == sorted([rows[1], rows[3], rows[5]], key=str)


def test_long_lines_of_numbers(spark):
    """Repeats of every group of the token pattern, a hundred thousand times."""
    n = 100_000
    docs = [(1, "see " + ",".join(map(str, range(n)))), (2, f"{ITEM} " + "1.2," * n), (3, "\x01a" * n), (4, "%$" * n), (5, "x" * n), (6, "Aé " * n)]
    assert found(spark, docs) == [(2, 1, "copy")]


def test_short_items_are_compared_whole(spark):
    items = [(1, "What is the capital of France?"), (2, "Compute 12 + 45 * 3 - 7 / 2"), (3, "red red red red"), (4, "too short"), (5, "What is the capital of Spain?"), (6, None)]
    docs = [(1, f"{FILL} what is the capital of France? {FILL}"), (2, f"{FILL} What is the capital of Italy?"), (3, f"compute 12+45*3-7/2. {FILL}"),
            (4, "Compute 12 + 45 * 3 - 7 / 3"), (5, f"red red red red too short {FILL}"), (6, "What is the Capital of Spain"), (7, "What is the capital"), (8, "")]
    want = [(1, 1, "copy"), (3, 2, "copy"), (6, 5, "copy")]
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, limit=0) == want


def test_scripts_without_blanks(spark):
    item = "一列火车以每小时六十公里的速度从北京开往上海请问它需要多少个小时才能到达目的地并返回出发的城市"
    thai = "รถไฟออกจากสถานีตอนเช้าและวิ่งด้วยความเร็วคงที่ตลอดเส้นทางจนถึงปลายทาง"
    clean = "今天的天气非常好我们一起去公园散步然后回家吃晚饭并且看了一部关于历史的电影"
    docs = [(1, f"{clean}{item}{clean}"), (2, clean), (3, f"x {thai} y"), (4, item[:12] + clean), (5, item.replace("六十", "八十"))]
    assert [x[:2] for x in found(spark, docs, [(1, item), (2, thai)])] == [(1, 1), (3, 2), (5, 1)]


def test_against_a_plain_matcher(spark):
    """Whole items in random texts: a document is found if and only if it holds all tokens of an item in one run."""
    import random

    rng = random.Random(7)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = {i: words(rng.choice((2, 3, 4, 5, 7, 8, 12, 30))) for i in range(60)}
    docs = {}
    for d in range(300):
        body = words(rng.randint(0, 80))
        if d % 3 == 0:
            at = rng.randint(0, len(body))
            body[at:at] = items[rng.randrange(60)]
        docs[d] = body
    holds = lambda body, item: any(body[k:k + len(item)] == item for k in range(len(body) - len(item) + 1))
    want = {(d, i) for d, body in docs.items() for i, item in items.items() if len(set(item)) >= decontam.MIN_WORDS and holds(body, item)}
    got = {x[:2] for x in found(spark, [(d, " ".join(b)) for d, b in docs.items()], [(i, " ".join(t)) for i, t in items.items()]) if x[2] == "copy"}
    assert got == want and len(want) > 60
