import corpus_pipeline
from tests.llm import brute
from tests.llm.test_packing import check_rows
from tests.llm.test_simhash import model as components
from tests.llm.test_simhash import print_of
from tributary.llm import decontaminate, language_id, secret_scan


def redacted(text):
    out, at = "", 0
    for s, _, e in brute.all_secrets(text, secret_scan.Settings()):
        if e <= at:
            continue
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = e
    return out + text[at:]


def plain(docs, items, model):
    """docs: (doc_id, text) without repeated ids."""
    docs = [d for d in docs if not language_id.predict(d[1], model)[2]]
    named = components([(i, print_of(t)) for i, t in docs])
    docs = [d for d, (i, _, c) in zip(docs, named) if i is None or i == c]
    settings = decontaminate.Settings()
    grams = {}
    for i, t in items:
        w = brute.words_of(t)
        for k in range(len(w) - 1):
            grams.setdefault(tuple(w[k:k + 2]), set()).add(i)
    texts, clean = dict(items), []
    for d, t in docs:
        w, near = brute.words_of(t), {}
        for k in range(len(w) - 1):
            for i in grams.get(tuple(w[k:k + 2]), ()):
                near[i] = near.get(i, 0) + 1
        if d is None or not any(brute.overlaps(t, texts[i], settings) for i, v in near.items() if v >= 3):
            clean.append((d, redacted(t)))
    return clean


def test_stages_against_plain_versions(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    expected = plain(docs, items, language_id.fit(table))
    assert 0 < len(expected) < len(docs)
    bins = check_rows(rows, expected, 2048)
    assert bins <= -(-sum(r["length"] for r in rows) // 2048) + 2


def test_stages_keep_columns_and_take_anything(spark, sf_dir):
    rows = [(None, None, "x", "s", 1), (1, "", None, "s", 0), (2, "plain words of the house " * 50, "en", None, None),
            (2, "plain words of the house " * 50, "en", None, None), (3, "Token: abcdef123456 and other words", "en", "s", 3),
            (None, "password = hunter2hunter2", "de", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == df.columns, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()
    clean = {r["doc_id"]: r for r in corpus_pipeline.redact_secrets(spark, df.where("doc_id = 3"), sf_dir).collect()}
    assert clean[3]["text"] == "[SECRET] and other words" and clean[3]["n_chars"] == len(clean[3]["text"])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
