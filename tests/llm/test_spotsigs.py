import random
import re

from pyspark.sql import functions as F

from tests.llm import brute
from tributary.llm import spotsigs
from tributary.llm.queries import op1_spotsigs

TEXTS = [
    None, "", "!!! ???", "the of and", "The cat sat on the mat and the dog ran off with a very old bone.",
    "the cat sat, on the mat and THE DOG ran off with a very old bone", "no anchors", "üñ 🙂 der Hund und die Katze",
    "the " * 500 + "end", "word " * 3000, "a", "!!!", "the of", "A quick brown fox of the north is in a den.",
]


def spots(text):
    """The signatures as word tuples."""
    words, found = brute.words_of(text), set()
    content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    anchored = [i for i in content if i and words[i - 1] in spotsigs.ANCHORS]
    for n, i in enumerate(content):
        if i in anchored or i == 0 or not anchored:
            found.add((words[i - 1] if i in anchored else None, *[words[j] for j in content[n:n + spotsigs.CHAIN]]))
    if found:
        return found
    return {(re.sub(r"(?<=\w)[\W_]+(?=\w)", " ", text.lower()),)} if text else set()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def model(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        yield d, (len(t), brute.sha(edited), round(jaccard(spots(t), spots(edited)), 9),
                  round(jaccard(spots(t), spots(after)), 9), len(spots(t)))


def got(rows):
    return {r["doc_id"]: (r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9),
                          r["n_signatures"]) for r in rows}


def test_edge_cases(spark):
    rows = [(i * 7 % 100, t) for i, t in enumerate(TEXTS)] + [(None, "no id at all")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, sigs string, part int")
    out = spotsigs.report(df).collect()
    assert got(out) == dict(model(rows))
    prints = {}
    for r in out:
        text = dict(rows)[r["doc_id"]] or ""
        assert len(r["fingerprint"]) == 8 * r["n_signatures"]
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_texts_without_anchored_chains(spark):
    listed = [f"item{k}" for k in range(200)]
    rows = [(4, " ".join(listed)), (3, " ".join(["other", *listed[1:]])), (2, " ".join([*listed[:3], *(f"x{k}" for k in range(197))])),
            (1, "the end")]
    out = {r["doc_id"]: r for r in spotsigs.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got(out.values()) == dict(model(rows))
    assert out[4]["n_signatures"] == 200 and out[4]["near_next"] > 0.95 and out[3]["near_next"] < 0.05


def test_ties_single_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    same = spark.createDataFrame([(5, "the one cat"), (5, "the one cat"), (5, "the one cat")], schema)
    assert [r["near_next"] for r in spotsigs.report(same).collect()] == [1.0] * 3
    assert spotsigs.report(spark.createDataFrame([(1, "the only one")], schema)).first()["near_next"] == 1.0
    assert spotsigs.report(spark.createDataFrame([(None, "a cat"), (None, None)], schema)).count() == 2
    assert spotsigs.report(same.limit(0)).count() == 0
    mixed = spark.createDataFrame([(i // 3, f"the cat {i}") for i in range(600)], schema)
    assert spotsigs.report(mixed).count() == 600


def test_similar_against_all_pairs(spark):
    rng, rows = random.Random(2), []
    words = [f"w{i}" for i in range(80)] + spotsigs.ANCHORS[:12] * 4
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([5, 60, 90]))]
        for k in range(3):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), rows[0][1]), (len(rows) + 1, None), (len(rows) + 2, "")]
    df = spark.createDataFrame(rows, "id long, text string").select("id", spotsigs.signatures(F.col("text")).alias("sigs"))
    found = {(r["a"], r["b"]): round(r["likeness"], 9) for r in spotsigs.similar(df, 0.7).collect()}
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(spots(t or "")), i)
    want = {}
    for a, i in sets.items():
        for b, j in sets.items():
            if i < j and jaccard(a, b) >= 0.7:
                want[i, j] = round(jaccard(a, b), 9)
    assert found == want and want


def test_query_against_model(spark, sf_dir):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op1_spotsigs(spark, sf_dir).collect()) == dict(model(docs))
