"""Quality rules of languages with little text or many languages."""

import random

from tollgate.llm import quality


def prose(rng, mark, n, common=0.45):
    """Natural prose: the common words of a language make up a large share of it."""
    few = [f"{mark}{c}" for c in "abcdefghijklmnopqrst"]
    return " ".join(rng.choice(few) if rng.random() < common else f"{mark}{''.join(rng.choices('aeioulmnrst', k=6))}" for _ in range(n))


def judged(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = {r["doc_id"]: r for r in quality.quality_rules(df, **more).collect()}
    assert {r["doc_id"] for r in quality.kept_documents(df, **more).collect()} == {d for d, r in out.items() if r["kept"]}
    return out


def test_rare_languages_are_kept(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, "q", 120, 0.6), "en") for i in range(100)]
    rows += [(1000 + i, prose(rng, "z", 90), lang) for i, lang in enumerate(["fi"] * 5 + [None])]
    rows += [(2000 + i, " ".join("".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(9)) for _ in range(60)), "zh") for i in range(30)]
    out = judged(spark, rows)
    assert all(r["kept"] for r in out.values())
    assert all((r["char_distance"], r["word_distance"]) == (None, None) for d, r in out.items() if 1000 <= d < 1005)
    assert all(r["char_distance"] is not None and r["word_distance"] is None for d, r in out.items() if d >= 2000)


def test_joined_references_judge_alike(spark):
    rng = random.Random(4)
    rows = [(100 * k + i, prose(rng, mark, 150), mark * 2) for k, mark in enumerate("bcd") for i in range(40)]
    rows += [(1000, " ".join("".join(rng.choices("!?#%&*", k=6)) for _ in range(60)), "dd"), (1001, prose(rng, "b", 60), None), (1002, prose(rng, "d", 60), "x")]
    whole, joined = judged(spark, rows), judged(spark, rows, held=1)
    assert whole.pop(1001)["kept"] and joined.pop(1001)["kept"]  # a null language has the held references alone
    assert whole == joined
    assert not whole[1000]["kept"] and whole[1002]["kept"] and all(whole[100 * k]["word_distance"] is not None for k in range(3))


def test_salad_and_wrong_language_go(spark):
    """On the given documents: texts without common words, identifiers, and texts under another language's name."""
    from tollgate.sources.tables import table

    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    good = [r[0] for r in table(spark, sf, "labels").filter("quality = 1").collect()]
    clean = [tuple(r) for r in docs.filter(docs["doc_id"].isin(good)).collect()]
    rng = random.Random(5)
    bad = [(-1 - i, prose(rng, "q", 60 + 20 * i, 0), "en") for i in range(10)]
    bad += [(-20 - i, " ".join(f"id_{rng.randrange(10**9)}" for _ in range(80)), "de") for i in range(3)]
    # Few and short ones, so that the references stay those of their languages.
    other = [(-1000 - i, t, to) for own, to in (("en", "de"), ("de", "fr")) for i, t in [(i, t) for i, t, lang in clean if lang == own and 100 <= len(t.split()) < 400][:6]]
    out = judged(spark, [tuple(r) for r in docs.collect()] + bad + other)
    assert not any(out[d]["kept"] for d, _, _ in bad)
    wrong = [out[d]["kept"] for d, _, _ in other if not out[d]["base_failed"]]
    assert len(wrong) >= 10 and not any(wrong)
    stay = [out[d]["kept"] for d, _, _ in clean if not out[d]["base_failed"]]
    assert sum(stay) >= 0.99 * len(stay)
