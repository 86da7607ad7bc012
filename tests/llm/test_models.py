"""Language id by held-out accuracy; quality rules and the language model against plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from tollgate.llm import kneserney, langid, quality
from tollgate.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    test = [r["lang"] == r["lang_pred"] for r in out if r["held_out"]]
    assert sum(test) >= 0.97 * len(test)


def test_language_edges(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("", "en"), ("12 !?", "en"), ("the dog", None)] * 4)]
    rows += [(None, "und die katze", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as held_out")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    for r in got:
        t = rows[r["doc_id"]][1] if r["doc_id"] is not None else "und die katze"
        assert r["lang_pred"] == ("und" if not t or not any(c.isalpha() for c in t) else "en" if "the" in t else "de")
    assert langid.identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(df.filter("lang is null")).collect()} == {"und"}


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def base(text):
    w = words_of(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hot = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hot), len(w) < 20 or 100 * len(hot) > 30 * len(w))


def test_quality_base(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    rows += [(-1, None, None), (-2, "", "en"), (-3, "a b " * 9, "en"), (-4, "x\ny\nx\n\n \nx y z\x1cq", "xx"), (-5, ("one two three four five six seven eight " * 2 + " ".join(f"w{i}" for i in range(40))), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as n_words", "2 as classes")
    got = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    assert len(got) == len(rows)
    for d, t, _ in rows:
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(t)
        assert not (r["kept"] and r["base_failed"])
    assert len(quality.kept_documents(df).collect()) == sum(r["kept"] for r in got.values())
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_quality_distances(spark):
    """The distances are those of a plain computation; symbol noise and tables go, prose stays."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    out = quality.quality_rules(docs).collect()
    good = [r["kept"] for r in out if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(good) >= 0.99 * len(good)
    texts = {r["doc_id"]: r for r in docs.collect()}
    classes, words = defaultdict(Counter), defaultdict(Counter)
    for r in out:
        if not r["base_failed"]:
            t = texts[r["doc_id"]]
            classes[t["lang"]].update(dict(enumerate(quality.char_classes(t["text"]).tolist())))
            words[t["lang"]].update(x.encode().lower().decode() for x in words_of(t["text"]))

    def jsd(p, q):
        kl = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
        return math.sqrt(max(0, (kl(p, q) + kl(q, p)) / 2))

    for r in out[:100]:
        t = texts[r["doc_id"]]
        if r["char_distance"] is not None:
            ref, own = classes[t["lang"]], quality.char_classes(t["text"])
            assert math.isclose(r["char_distance"], jsd([x / own.sum() for x in own], [ref[i] / ref.total() for i in range(7)]), abs_tol=1e-9)
        if r["word_distance"] is not None:
            ref = words[t["lang"]]
            total = ref.total()
            common = sorted(w for w, n in ref.items() if n >= quality.COMMON_SHARE * total)
            own = Counter(x.encode().lower().decode() for x in words_of(t["text"]))
            h, q = [own[w] for w in common], [ref[w] for w in common]
            h, q = h + [own.total() - sum(h)], q + [total - sum(q)]
            assert math.isclose(r["word_distance"], jsd([x / own.total() for x in h], [x / total for x in q]), abs_tol=1e-9)


def plain_model(texts):
    """Interpolated modified Kneser-Ney of order 2 with dictionaries."""
    pairs, tokens = Counter(), Counter()
    for t in texts:
        w = ["<s>", *words_of((t or "").encode().lower().decode()), "</s>"]
        tokens.update(w[1:])
        pairs.update(zip(w, w[1:]))
    ctx, follow, before = Counter(), defaultdict(Counter), Counter()
    for (h, w), n in pairs.items():
        ctx[h] += n
        follow[h][min(n, 3)] += 1
        before[w] += 1
    d = kneserney.discounts(*(sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)))
    d1 = kneserney.discounts(*(sum(n == k for n in before.values()) for k in (1, 2, 3, 4)))
    kinds = Counter(min(n, 3) for n in before.values())
    rest = sum(d1[k - 1] * kinds[k] for k in (1, 2, 3)) / len(pairs) / (len(tokens) + 1)

    def p(h, w):
        low = (max(before[w] - d1[min(before[w], 3) - 1], 0) if before[w] else 0) / len(pairs) + rest
        if not ctx[h]:
            return low
        n = pairs[h, w]
        gamma = sum(d[k - 1] * follow[h][k] for k in (1, 2, 3)) / ctx[h]
        return (n - d[min(n, 3) - 1] if n else 0) / ctx[h] + gamma * low

    return tokens, p


@pytest.mark.parametrize("shard", [2_000_000, 3000])
def test_kneser_ney(spark, shard):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()] + [(-1, None), (-2, ""), (-2, ""), (None, "The the"), (-3, "of the " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as run").repartition(3)
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    tokens, p = plain_model([t for d, t in rows if not out(d)])
    from tollgate.llm.common import held_out
    model = kneserney.train(df.filter(~held_out(df["doc_id"], 5)), shard)
    got = defaultdict(list)
    for r in kneserney.score(df, model).collect():
        got[r["doc_id"]].append(r)
    n, v = tokens.total(), len(tokens)
    for d, t in rows:
        w = ["<s>", *words_of((t or "").encode().lower().decode()), "</s>"]
        r = got[d][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(d), len(w) - 1, sum(tokens[x] > 0 for x in w[1:]), n)
        assert math.isclose(r["base_score"], sum(math.log10((tokens[x] + .5) / (n + .5 * (v + 1))) for x in w[1:]), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(h, x)) for h, x in zip(w, w[1:])), rel_tol=1e-9)
    assert math.isclose(sum(p("the", w) for w in tokens) + p("the", "never seen"), 1, abs_tol=1e-9)


def test_kneser_ney_empty(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = kneserney.train(df.limit(0))
    assert [tuple(r)[:7] for r in kneserney.score(df, model).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out").collect()] == [(1, 3, 0, 0, 0.0, 0.0, False)]
    assert kneserney.score(df.limit(0), model).count() == 0


def test_kneser_ney_all_counts_equal(spark):
    """Counts of counts of 0: scores are finite, and a word seen scores above one that was not."""
    train = [(i, "a b c") for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1][:6]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    df = spark.createDataFrame([*train, (held[0], "a c b"), (held[1], "zz"), (held[2], "a b c")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in kneserney.score_held_out(df).collect()}
    assert all(math.isfinite(s) for s in got.values()) and got[held[2]] > got[held[0]] and got[held[2]] > -1


def test_language_sample_is_bounded(spark, monkeypatch):
    """A row repeated ten thousand times is one sample; an id with very many texts gives no more than the limit."""
    taken = []
    fit = langid.KernelModel.fit
    monkeypatch.setattr(langid.KernelModel, "fit", classmethod(lambda cls, texts, labels, landmarks: (taken.extend(labels), fit(texts, labels, landmarks))[1]))
    hot = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 3 != 1)
    df = (spark.range(10_000).selectExpr(f"{hot}L as doc_id", "'en' as lang", "'the same words again' as text")
          .union(spark.range(5_000).selectExpr(f"{hot}L", "'de'", "concat('ein satz mit der zahl ', id)"))
          .union(spark.createDataFrame([(200 + i, "fr", f"une phrase {i}") for i in range(30)], "doc_id long, lang string, text string")))
    assert langid.fit(df) is not None
    assert taken.count("en") == 1 and 200 <= taken.count("de") <= langid.TRAIN_PER_LANG and taken.count("fr") >= 10
