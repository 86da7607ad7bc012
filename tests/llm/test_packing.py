"""Packing: an exact round trip."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tollgate.llm import packing
from tollgate.llm.common import TokenBytes
from tollgate.sources.tables import table

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, t=Tokenizer.from_file(PATH)):
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, docs, limits=packing.Limits()):
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(ids_of(t))
    for d, versions in want.items():
        own = sorted(pieces.pop(d), key=lambda r: (r["doc_tokens"], r["start"]))
        assert sum(r["length"] for r in own) == sum(map(len, versions))
        for r in own:
            assert any(len(v) == r["doc_tokens"] and zlib.crc32(np.array(v[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for v in versions)
    assert not pieces
    waste = 0
    for own in seqs.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= limits.tokens and len(own) <= limits.segments and sum(r["loss_tokens"] for r in own) <= limits.loss_tokens
        waste += 0 if at & (at - 1) == 0 else limits.tokens - at
    return waste, sum(r["length"] for r in rows)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    waste, total = check(packing.pack(docs, PATH).collect(), [tuple(r) for r in docs.collect()])
    assert waste <= 0.001 * total


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "  \n "), (4, "word " * 9000), (5, "x" * 20_000), (6, "a\tb c<|endoftext|>d é It's"), (7, "A b"), (7, "A b"), (None, "n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as length").repartition(3)
    check(packing.pack(df, PATH).collect(), docs)
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_three_limits(spark):
    limits = packing.Limits(tokens=64, segments=4, loss_tokens=24)
    body = [(i, [("question words here " * (1 + i % 5), False), ("answer word " * (1 + i % 7), True)]) for i in range(60)]
    df = spark.createDataFrame(body, "doc_id long, parts array<struct<text string, loss boolean>>").coalesce(2)
    rows = packing.pack(df, PATH, limits).collect()
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append(r)
    for own in seqs.values():
        assert sum(r["length"] for r in own) <= 64 and len(own) <= 4 and sum(r["loss_tokens"] for r in own) <= 24
    tokens = {i: sum(len(ids_of(t)) - 1 for t, _ in p) + 1 for i, p in body}
    got = defaultdict(int)
    for r in rows:
        got[r["doc_id"]] += r["length"]
    assert got == tokens


def test_ids_equal_the_whole_tokenizers():
    whole = Tokenizer.from_file(PATH)
    texts = ["It's 's a.b \"Foo\" foo's ÀÉ×÷ ǅ İstanbul été 中文, foo_bar A'd\tB\r\nC\x0b d  z ﬁ ªº µ ß SS ÿŸ ...", "", None, " \n ", "'",
             "don't. (can't) !!!word??? $$$ a-b 12ab 3.5% $word$ word", "가 á̧.", "x <|endoftext|> <|startoftext|>x word<|endoftext|>,"]
    tokens = TokenBytes(PATH)
    tokens.LIMIT, tokens.TEXT_CHARS = 8, 60
    assert tokens.merges is not None
    for _ in range(2):
        for text, ids in zip(texts, tokens.encode_all(texts), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_many_empty_texts_need_no_padding(spark):
    """The limit of segments closes such sequences: they end at a power of two."""
    docs = [(i, "" if i % 3 else "some words stand here " * (i % 40)) for i in range(6000)]
    for part in (docs, [(i, None) for i in range(4000)]):
        rows = packing.pack(spark.createDataFrame(part, "doc_id long, text string").repartition(2), PATH).collect()
        waste, total = check(rows, part)
        padded = {r["sequence_id"]: r["padded_to"] for r in rows}
        assert waste == 0 and sum(padded.values()) == total
