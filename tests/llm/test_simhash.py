"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sublens.llm import simhash

DOCS = "/root/testdata/sf0.001/documents.parquet"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows):
    """rows: (id, fp); union by every pair of fingerprints within 3 bits."""
    fps = sorted({fp for _, fp in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for f in fps:
        for g in a[np.bitwise_count(a ^ np.uint64(f)) <= 3].tolist():
            parent[find(g)] = find(f)
    low = {}
    for i, fp in rows:
        r = find(fp)
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return sorted(((i, f"{fp:016x}", low.get(find(fp))) for i, fp in rows), key=str)


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(DOCS)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    want = plain_components(rows)
    assert got(simhash.simhash_components(docs)) == want
    assert len({c for _, _, c in want}) < len(want)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(5, "One two  three\tfour", "x"), (3, "one TWO three four", "y"), (3, "one TWO three four", "y"),
            (9, None, "z"), (8, "", None), (7, " \n ", "q"), (None, "just this", "n"), (2, "just", "n"),
            (1, long, "l"), (11, "Éa été", "u")]
    df = spark.createDataFrame(rows, "doc_id int, text string, fp string")
    want = plain_components([(i, plain_fingerprint(t)) for i, t, _ in rows])
    assert got(simhash.simhash_components(df)) == want
    assert simhash.simhash_components(df.limit(0)).count() == 0
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    lows = [c for c in {f: c for _, f, c in want}.values()]
    assert sorted(map(str, ids)) == sorted(map(str, set(lows)))


@pytest.mark.parametrize("hot_rows", [4, 2048])
def test_links_on_dense_and_sparse_fingerprints(spark, hot_rows):
    """Balls of near fingerprints share meeting places; with a low limit they
    pass through every finer cut.  Components equal those of all pairs."""
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for centre in fps[:6]:
        fps += [centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    fps += [fps[0] ^ (1 << b) ^ (1 << c) for b in range(8) for c in range(8, 14)]
    fps = sorted(set(f % (1 << 64) for f in fps))
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    from sublens.llm.components import components
    root = {r["vertex"]: r["root"] for r in components(simhash.links(df, 3, hot_rows)).collect()}
    want = plain_components(list(enumerate(fps)))
    groups = {}
    for i, h, c in want:
        groups.setdefault(c, set()).add(int(h, 16))
    mine = {}
    for f in fps:
        s = simhash._signed(f)
        mine.setdefault(root.get(s, s), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_pivot_test_never_discards_a_link():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in set(rng.integers(0, 64, 3))) for _ in range(500)], dtype=np.uint64)
    refs = simhash.pivots()
    apart = np.abs(simhash.distance_table(a, refs) - simhash.distance_table(a ^ flips, refs)).max(axis=1)
    assert (apart <= 3).all()
    far = np.abs(simhash.distance_table(a, refs) - simhash.distance_table(a[::-1].copy(), refs)).max(axis=1)
    assert (far > 3).mean() > 0.95


def test_one_of_each_group_stays(spark):
    docs = spark.read.parquet(DOCS)
    comp = simhash.simhash_components(docs).select("component_id").distinct()
    kept = simhash.keep_first(docs)
    assert kept.schema == docs.schema
    assert (sorted(r[0] for r in kept.select("doc_id").collect())
            == sorted(r[0] for r in comp.collect()))
    assert kept.join(docs.withColumn("t", F.col("text")).select("doc_id", "t"), "doc_id").filter("t <> text").count() == 0
