"""Pseudonyms: format, validity, linking, permutation."""

import re

from pyspark.sql import functions as F

from tollgate.llm import pseudonyms as P
from tollgate.sources.tables import table

VALUES = ["4349000490986231", "4111 1111 1111 1111", "+1 (543) 555-9258", "(212) 555-0100", "67.190.110.215", "hnp.46@mail3.example.com",
          "2024-02-29", "31.12.1999", "1/2/2001", "123-45-6789", "+49 30 1234567"]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r[0] for r in P.pseudonymise(df).orderBy("doc_id").select("text").collect()]


def test_format_and_links(spark):
    a = replaced(spark, [f"so {v} it is, {v}." for v in VALUES])
    for v, t in zip(VALUES, a, strict=True):
        one, two = re.fullmatch(r"so (.*) it is, (.*)\.", t).groups()
        assert one == two != v
        if "." not in v or "@" in v:
            assert re.sub(r"\d", "9", re.sub("[a-z]", "a", one)) == re.sub(r"\d", "9", re.sub("[a-z]", "a", v)) or "/" in v
    assert luhn(a[0].split()[1]) and luhn(re.sub(r"\D", "", a[1].split(",")[0]))
    same = replaced(spark, ["4349-0004-9098-6231", "4349000490986231", "543-555-9258", "+1 543-555-9258"])
    assert same[0].replace("-", "") == same[1] and same[3].endswith(same[2])


def test_left_alone(spark):
    clean = ["Licensed under CC BY-NC 4.0.", "version 3.", "4349000490986232", "300.1.1.1 and 1.2.3.4.5", "2023-02-29", "page 12, lines 1-20", "a @ b", None, "", "é" * 1000]
    assert replaced(spark, clean) == clean


def test_permutation(spark):
    df = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    out = df.select(P.feistel(F.col("v"), P.classes_of(F.col("v")), "k").alias("p"))
    assert out.distinct().count() == 10_000 and out.filter("p rlike '^[0-9]{4}$'").count() == 10_000
    days = spark.range(146_097).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("v"))
    got = days.select(P.pseudonym(F.col("v")).alias("p"))
    assert got.distinct().count() == 146_097 and got.agg(F.min("p"), F.max("p")).first() == ("1800-01-01", "2199-12-31")


def test_documents_lose_their_values(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = P.pseudonymise(docs)
    assert out.columns == [*docs.columns, "n_replaced"]
    pattern = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{16}\b")
    before = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    n = 0
    for r in out.select("doc_id", "text", "n_replaced", "n_chars").collect():
        old = pattern.findall(before[r[0]] or "")
        new = pattern.findall(r[1] or "")
        assert len(old) == len(new) and not [x for x, y in zip(old, new, strict=True) if x == y and (len(x) != 16 or luhn(x))]
        assert pattern.sub("_", before[r[0]] or "") == pattern.sub("_", r[1] or "")
        n += len(old)
    assert n > 20


def test_neighbours(spark):
    """Values that stand side by side are all found."""
    a = "+1 (663) 555-6869 4465758382889437 67.190.110.215 hnp.46@mail3.example.com 4465758382889437 +1 (663) 555-6869 2024-02-29"
    out = replaced(spark, [a])[0].split(" ")
    old = a.split(" ")
    assert len(out) == len(old) and [x for x, y in zip(old, out, strict=True) if x == y] == ["+1", "+1"]
    assert out[3] == out[6] and out[1:3] == out[8:10]


def test_long_repeats_of_every_group(spark):
    """No pattern recurses once for each repeat; an address after them is still found."""
    n = 100_000
    parts = ["a@" + "a." * n, "a@" + "a-" * n, "1." * n, "1-" * n, "1/" * n, "+1" * n, "+" + "1 " * n, "(123) " * n, "1234 " * n, "a%" * n + "@", "a@b1." * n]
    df = spark.createDataFrame([(i, f"{p} write to jane.doe@mail.example.org now") for i, p in enumerate(parts)], "doc_id long, text string")
    for r in P.pseudonymise(df).collect():
        assert "jane.doe@" not in r["text"] and r["text"].endswith("example.org now")


def test_key_of_the_session_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "mail a.person@example.org now", "x", "y", 7)], "doc_id long, text string, __found string, __new string, n_replaced long")
    plain = P.pseudonymise(df).collect()[0]
    assert plain["__found"] == "x" and plain["__new"] == "y" and plain["n_replaced"] == 1 and plain.asDict().keys() == set(df.columns)
    spark.conf.set(P.KEY_CONF, "another key")
    try:
        other = P.pseudonymise(df).collect()[0]
    finally:
        spark.conf.unset(P.KEY_CONF)
    assert other["text"] != plain["text"] and other["text"] == P.pseudonymise(df, "another key").collect()[0]["text"]
