import math
import random

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import language_id
from tributary.llm.common import fold_of
from tributary.llm.queries import op4_language_id


def slow_counts(text, settings):
    if not any(c.isalpha() for c in text or ""):
        return None
    signs = " "
    for c in (text or "").lower():
        c = c if c.isalpha() else " "
        signs += c if not (c == " " and signs[-1] == " ") else ""
    signs += " " if signs[-1] != " " else ""
    counts, mask = np.zeros(settings.buckets), (1 << 64) - 1
    for n in range(1, settings.longest + 1):
        for i in range(len(signs) - n + 1):
            if n == 1 and signs[i] == " ":
                continue
            gram = 0
            for c in signs[i:i + n]:
                gram = (gram * 0x110000 + ord(c)) & mask
            counts[((gram * 0x9E3779B97F4A7C15) & mask) >> (64 - settings.buckets.bit_length() + 1)] += 1
    return counts


def test_grams(monkeypatch):
    settings = language_id.Settings()
    for chunk in (1 << 20, 7, 2, 1):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        for text in ("One, TWO  three!", "üß 漢字 x", "a", "  a1b2  ", "123 456", "", None, "word " * 50):
            a, b = language_id.gram_counts(text, settings), slow_counts(text, settings)
            if chunk > 1:
                assert (a is None) == (b is None) and (a is None or (a == b).all()), (chunk, text)


def test_edge_cases(spark):
    english, german = "the house and the garden with a tree of that man ", "das haus und der garten mit einem baum von dem mann "
    rows = [(i, (english, german)[i % 2] * (1 + i % 5), ("en", "de")[i % 2], "x") for i in range(200)]
    rows += [(900, None, "en", "x"), (901, "", None, "x"), (902, "12 ?!", "de", "x"), (903, german * 9000, None, "x"),
             (None, english, None, "x"), (904, "漢字漢字", None, "x"), (904, "漢字漢字", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = language_id.report(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    for i in range(200):
        assert by[i]["lang_pred"] == ("en", "de")[i % 2] and by[i]["score"] > 0.9 and not by[i]["rejected"]
    for i in (900, 901, 902):
        assert tuple(by[i])[2:] == ("und", 0.0, True)
    assert by[903]["lang_pred"] == "de" and by[None]["lang_pred"] == "en"
    assert by[904]["rejected"] and by[904]["lang_pred"] in ("en", "de")
    model = language_id.fit(df)
    kept = language_id.accepted(df, model)
    assert kept.columns == df.columns and kept.count() == 202
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.report(bare).collect()} == {"und"}
    assert language_id.report(df.limit(0)).count() == 0


def test_foreign_and_junk_texts_are_rejected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, rng = language_id.fit(docs), random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    foreign = {
        "letters": ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(400)],
        "fi": "talo oli vanha ja sen ovi aukesi hitaasti kun mies tuli sisään eikä kukaan kuullut mitään".split(),
        "pl": "dom był stary a jego drzwi otwierały się powoli kiedy człowiek wszedł do środka".split(),
        "ru": "дом был старый и дверь медленно открылась когда человек вошел внутрь".split(),
    }
    for name, words in foreign.items():
        for n in (20, 100, 1000):
            assert language_id.predict(" ".join(rng.choice(words) for _ in range(n)), model)[2], (name, n)
    rows = [r for r in docs.collect() if r["lang"] and any(c.isalpha() for c in r["text"] or "")]
    assert sum(language_id.predict(r["text"], model)[2] for r in rows) <= 0.005 * len(rows)


def test_prediction_is_the_nearest_centroid(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit(docs)
    for r in docs.orderBy("n_chars").limit(40).collect():
        counts = slow_counts(r["text"], model.settings)
        if counts is None:
            assert language_id.predict(r["text"], model) == ("und", 0.0, True)
            continue
        vector = [math.log1p(c) * w for c, w in zip(counts, model.weights)]
        size = math.sqrt(sum(v * v for v in vector))
        near = [sum(v * c for v, c in zip(vector, centre)) / size for centre in model.centroids]
        best = max(range(len(near)), key=near.__getitem__)
        lang, score, rejected = language_id.predict(r["text"], model)
        assert abs(score - near[best]) < 1e-5 and near[model.languages.index(lang)] <= near[best] + 1e-5
        assert max(s for s, name in zip(near, model.languages) if name == lang) > near[best] - 1e-5
        bound = model.floors[best] * min(1.0, sum(counts) / model.settings.full_grams)
        assert rejected == (score < bound) or abs(score - bound) < 1e-5


def test_held_out_accuracy_and_inputs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = op4_language_id(spark, sf_dir)
    assert found.count() == docs.count()
    held = docs.select("doc_id", "lang").join(found.where("held_out"), "doc_id").where("lang_pred <> 'und'").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held) > 0
    # Held-out labels, sources and ids are never looked at.
    held_out = fold_of(F.col("doc_id"), 5) == 0
    masked = docs.withColumn("lang", F.when(~held_out, F.col("lang"))).withColumn("source", F.lit("x"))
    key = ["doc_id", "lang_pred", "score"]
    assert sorted(map(tuple, language_id.report(masked).select(*key).collect())) == sorted(
        map(tuple, found.select(*key).collect()))
