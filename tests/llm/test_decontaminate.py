from pyspark.sql import functions as F

from tests.llm import brute
from tributary.llm import decontaminate
from tributary.llm.queries import op10_decontaminate

ITEM = "the quick brown fox jumps over the lazy dog while many small birds sing in old trees near water".split()


def variant(*changed):
    return " ".join("changed" if i in changed else w for i, w in enumerate(ITEM))


def model(docs, items, settings):
    out = {}
    for n, t in docs:
        out[n] = sorted((i, s, e) for i, b in items for _, s, e in brute.overlaps(t, b, settings))
    return out


def as_model(rows):
    return {r["doc_id"]: sorted((int(a), int(s), int(e)) for a, s, e in (
        x.split(":") for x in r["overlaps"].split(",") if x)) for r in rows}


def test_substitutions_and_edge_cases(spark):
    texts = [
        None, "", "short", " ".join(ITEM), "before it " + variant(4) + " after it", variant(3, 9), variant(1, 5, 9, 13),
        " ".join(reversed(ITEM)), (variant() + " ") * 30, variant(0, 1, 2, 3, 4, 5, 6, 7), variant().upper().replace(" ", "; "),
        " ".join(ITEM[:13]), " ".join(ITEM[:9]),
    ]
    docs = list(enumerate(texts))
    items = [(1, " ".join(ITEM)), (2, "too short an item"), (3, None), (4, " ".join(ITEM))]
    settings = decontaminate.Settings()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, at int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(df, bench, settings)
    assert as_model(got.collect()) == model(docs, items, settings)
    flags = {r["doc_id"]: r["contaminated"] for r in got.collect()}
    assert [i for i, v in flags.items() if v and i in (0, 1, 2, 7, 9, 12)] == []
    assert all(flags[i] for i in (3, 4, 5, 8, 10))
    small = decontaminate.Settings(block_rows=7)  # many blocks give the same
    assert sorted(map(str, decontaminate.report(df, bench, small).collect())) == sorted(map(str, got.collect()))
    kept = decontaminate.decontaminated(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, v in flags.items() if not v}


def test_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, variant()), (5, variant()), (5, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, variant()), (None, variant())], "item_id long, text string")
    assert sorted((str(r["doc_id"]), r["contaminated"]) for r in decontaminate.report(df, bench).collect()) == [
        ("5", False), ("5", True), ("None", True)]
    assert decontaminate.decontaminated(df, bench).count() == 1
    for a, b in ((df.limit(0), bench), (df, bench.limit(0)), (df.limit(0), bench.limit(0))):
        assert decontaminate.report(a, b).where("contaminated").count() == 0
        assert decontaminate.report(a, b).count() == a.count()


def test_query_against_model(spark, sf_dir):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = op10_decontaminate(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    got = as_model(rows)
    # The model is slow: it sees the items whose words a document shares with it in a run of three.
    grams = {}
    for i, t in items:
        w = brute.words_of(t)
        for k in range(len(w) - 1):
            grams.setdefault(tuple(w[k:k + 2]), set()).add(i)
    texts = dict(items)
    for n, t in docs:
        w = brute.words_of(t)
        near = {}
        for k in range(len(w) - 1):
            for i in grams.get(tuple(w[k:k + 2]), ()):
                near[i] = near.get(i, 0) + 1
        close = [(i, texts[i]) for i, v in near.items() if v >= 3]
        assert got[n] == sorted((i, s, e) for i, b in close for _, s, e in brute.overlaps(
            t, b, decontaminate.Settings())), n
    assert any(r["contaminated"] for r in rows)


def test_quoted_parts_and_short_items(spark):
    words = [f"i{k}" for k in range(40)]
    quoted = " ".join([*(f"a{k}" for k in range(15)), *words[14:27], *(f"b{k}" for k in range(15))])
    rows = [(1, quoted), (2, " ".join(words[14:25])), (3, "he asked what is the capital of peru again"), (4, "what is the capital")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words)), (8, "What is the capital of Peru?")], "item_id long, text string")
    out = {r["doc_id"]: (r["overlaps"], r["agree"]) for r in decontaminate.report(df, bench).collect()}
    assert out == {1: ("7:15:28", 1.0), 2: out[2], 3: ("8:2:8", 1.0), 4: ("", 0.0)}
    assert {r["doc_id"] for r in decontaminate.decontaminated(df, bench).collect()} == {2, 4}
    assert decontaminate.report(df, bench, decontaminate.Settings(block_rows=1)).where("contaminated").count() == 2


def test_repeated_words_on_both_sides(spark):
    n = 600
    df = spark.createDataFrame([(1, "same " * n), (2, "other words " * 20)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "same " * n)], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.report(df, bench).collect()}
    assert rows[1]["contaminated"] and rows[1]["items"] == "7" and rows[1]["agree"] == 1.0 and not rows[2]["contaminated"]


def test_columns_named_like_helpers(spark):
    df = spark.createDataFrame([(1, variant(), 5, 6)], "doc_id long, text string, text_key long, bad long")
    bench = spark.createDataFrame([(1, "quite other words")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.decontaminated(df, bench).collect()] == [(1, variant(), 5, 6)]


def test_seeds_above_the_bound_are_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(1, variant()), (2, "tiny item")], "item_id long, text string").write.parquet(str(tmp_path / "items"))
    bench = spark.read.parquet(str(tmp_path / "items"))
    df = spark.createDataFrame([(5, variant(4)), (6, "clean"), (7, "a tiny item")], "doc_id long, text string")
    for rows, sent in ((100, True), (1, False)):
        settings = decontaminate.Settings(block_rows=rows)
        test = decontaminate.seeds(bench.select("item_id", decontaminate.word_hashes(F.col("text")).alias("words")), settings).select("seed")
        met = test.select("seed").join(decontaminate._sent(test, settings), "seed")
        assert ("BroadcastHashJoin" in met._jdf.queryExecution().executedPlan().toString()) is sent
        assert {r[0] for r in decontaminate.report(df, bench, settings).where("contaminated").select("doc_id").collect()} == {5, 7}
