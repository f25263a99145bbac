import random
from collections import defaultdict

import xxhash

from tributary.llm import simhash
from tributary.llm.queries import op3_simhash


def print_of(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def model(rows, bits=4):
    """rows: (doc_id, fingerprint); the component of each."""
    prints = sorted({p for _, p in rows})
    top = {p: p for p in prints}

    def find(p):
        while top[p] != p:
            p = top[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[i + 1:]:
            if (p ^ q).bit_count() <= bits:
                top[find(q)] = find(p)
    names = defaultdict(list)
    for d, p in rows:
        names[find(p)] += [d] * (d is not None)
    return [(d, f"{p:016x}", min(names[find(p)], default=None)) for d, p in rows]


def test_links_find_all_pairs(spark):
    rng = random.Random(4)
    prints = {0, 1, (1 << 64) - 1, 0xFFFFFFFF, 0xF << 60}
    for _ in range(40):
        p = rng.getrandbits(64)
        prints.add(p)
        for n in range(7):
            q = p
            for b in rng.sample(range(64), n):
                q ^= 1 << b
            prints.add(q)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    for bits in (4, 2):
        got = sorted(map(tuple, simhash.links(df, bits).collect()))
        want = sorted((min(signed[p], signed[q]), max(signed[p], signed[q]))
                      for p in prints for q in prints if p < q and (p ^ q).bit_count() <= bits)
        assert got == want


def test_roots(spark):
    rng = random.Random(9)
    edges = {(i, i + 1) for i in range(60)} | {(100, i) for i in range(101, 140)}
    edges |= {tuple(sorted(rng.sample(range(200, 300), 2))) for _ in range(70)}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    got = {r["node"]: r["root"] for r in simhash.roots(spark.createDataFrame(list(edges), "a long, b long")).collect()}
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            todo = [m for x in todo for m in near[x] if m not in seen and not seen.add(m)]
        assert got.get(n, n) == min(seen)
    assert simhash.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    texts = [None, "", " \t\n", "One", "one", "one two three", "A b\x0bc\x0cd e", "ü Ü one two three four", long, long + " end", long]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, "One", "x"), (None, "one", None), (None, "alone without id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(map(str, map(tuple, simhash.report(df).collect())))
    assert got == sorted(map(str, model([(d, print_of(t)) for d, t, _ in rows])))
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted((str(r[0]), r[1]) for r in kept.select("doc_id", "text").collect()) == sorted(
        [("0", None), ("3", "One"), ("5", "one two three"), ("6", texts[6]), ("7", texts[7]), ("8", long),
         ("None", "alone without id")])
    again = spark.createDataFrame([(1, "w a b c d"), (2, "w a b c d"), (2, "v e f g h"), (3, "v e f g h"), (None, "v e f g h")], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.deduplicated(again).collect()) == [(1, "w a b c d"), (2, "v e f g h")]
    assert simhash.report(df.limit(0)).count() == simhash.deduplicated(df.limit(0)).count() == 0


def test_query_against_model(spark, sf_dir):
    docs = [(r[0], print_of(r[1])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op3_simhash(spark, sf_dir).collect())) == sorted(model(docs))


def test_points_of_a_small_table_are_not_broadcast(spark, tmp_path):
    spark.range(300).selectExpr("xxhash64(id) AS fp").write.parquet(str(tmp_path / "nodes"))
    links = simhash.links(spark.read.parquet(str(tmp_path / "nodes")))
    assert "BroadcastHashJoin" not in links._jdf.queryExecution().executedPlan().toString()
    assert links.count() == 0
