"""Separator scan against direct counts; url rules against a plain loop."""

import public_tokenizers
from tokenizers import Tokenizer

from tollgate.llm import tokencounts, urlfilter
from tollgate.llm.common import SharedFolder
from tollgate.sources.tables import table

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_token_counts(spark):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    docs = [(1, None), (2, ""), (3, "<|endoftext|> twice <|endoftext|>"), (4, "long " * 5000), (5, "a"), (5, "a"), (None, "b c")]
    docs += [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as file", "2 as ordinal").repartition(3)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in tokencounts.token_counts(spark, df, PATH).collect()), key=str)
    want = sorted(((d, len(t.encode(x or "", add_special_tokens=False).ids)) for d, x in docs), key=str)
    assert got == want
    assert tokencounts.token_counts(spark, df.limit(0), PATH).count() == 0


def test_scan_across_blocks(spark):
    """Documents over many tiny blocks and groups, no end, ends at block edges, an empty file."""
    import numpy as np
    from pyspark.sql import functions as F

    folder = SharedFolder.new(spark, "tokens")
    sep, files, want = 9, [], set()
    for k, lengths in enumerate([[0, 0, 3, 4, 700, 1, 0, 12], [2000, 5], [7] * 300, [0]]):
        ids = [x for n in lengths for x in [1] * n + [sep]] + [2] * (5 if k == 1 else 0)
        folder.write(f"f{k}", np.array(ids, "<u2").tobytes())
        files.append((f"f{k}", len(ids)))
        at = 0
        for o, n in enumerate(lengths):
            want.add((f"f{k}", o, at, n, True))
            at += n + 1
        if k == 1:
            want.add((f"f{k}", 2, at, 5, False))
    files.append(("none", 0))
    df = spark.createDataFrame(files, "file string, n_ids long")
    old, tokencounts.GROUP = tokencounts.GROUP, 4
    try:
        got = tokencounts.scan(df, folder, sep, 4).select("file", "ordinal", "start", "n_tokens", "closed").collect()
    finally:
        tokencounts.GROUP = old
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert tokencounts.blocks(df, 4).agg(F.sum("n")).first()[0] == sum(n for _, n in files)


def verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))]
    hit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(hit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_rules(spark):
    from tollgate.llm.queries import URL_RULES

    rules = [*URL_RULES, ("a.org", "/x", "block"), ("a.org", "", "allow"), ("", "/", "block")]
    urls = [None, "", "no scheme.net/", "http://", "https://Ex.EXAMPLE.net/en/1?x=http://b.net/q", "http://a?u=http://b.net/de/", "http://net/", "http://net", "http://x.net#top",
            "ftp://a.org/xyz", "http://a.org", "http://b.a.org/X", "http://notnet/", "http://u.example.com/de/x#y", "http://w.org/fr/?q", "http://w.org/fr", "http://..net/", "http://" + "a." * 300 + "net/" + "p/" * 5000,
            "http://é.net/ü\nz"] * 2
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 as host", "2 as digest")
    r = spark.createDataFrame(rules + rules[:2], "host string, path string, verdict string")
    want = {i: verdict(u, rules) for i, u in enumerate(urls)}
    for limit in (10**6, 0):
        assert {x["page_id"]: tuple(x)[1:] for x in urlfilter.url_verdicts(df, r, limit).collect()} == want
    assert urlfilter.url_verdicts(df.limit(0), r).count() == 0
    assert {x["rule"] for x in urlfilter.url_verdicts(df, r.limit(0)).collect()} == {None}
