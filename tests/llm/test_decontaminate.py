"""Decontamination against a window-by-window brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from sublens.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items, window=13):
    w = plain_words(text)
    hit, names = set(), set()
    for name, t in items:
        b = plain_words(t)
        n = min(window, len(b))
        grams = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(name)
    return len(w), len(hit), sorted(names)


def got(docs, items, **options):
    rows = dc.verdicts(dc.scan(docs, items, **options)).select("doc_id", "_n_words", "_n_hit", "_items", "_contaminated").collect()
    return sorted(((r[0], (r[1], r[2], r[3]), r[4]) for r in rows), key=str)


def want(docs, items, window=13):
    b = [("" if r["item_id"] is None else str(r["item_id"]), r["text"]) for r in items.collect()]
    out = []
    for r in docs.collect():
        p = plain(r["text"], b, window)
        out.append((r["doc_id"], p, p[1] > 0 and 20 * p[1] >= p[0]))
    return sorted(out, key=str)


def test_whole_table(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    w = want(docs, items)
    assert got(docs, items) == w
    assert sum(x[2] for x in w) >= 2
    assert got(docs, items, max_words=200) == w          # several automata
    from sublens.llm.queries import op7_decontaminate
    q = {r["doc_id"]: r["items_sha256"] for r in op7_decontaminate(spark, SF).collect()}
    assert q == {i: hashlib.sha256(",".join(p[2]).encode()).hexdigest() for i, p, _ in w}


def test_random_words_of_a_small_alphabet(spark):
    """Short items, repeats and overlaps: many shared substrings."""
    rng = random.Random(11)
    items = [(i % 17 if i % 17 else None, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 3, 4, 5, 9, 20]))))
             for i in range(40)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for n in (3, 5, 8):
        b = spark.createDataFrame([x for x in items if len(x[1].split()) not in (1, 3)], "item_id long, text string")
        assert got(d, b, window=n) == want(d, b, n)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert got(d, b, window=6, max_words=50) == want(d, b, 6)


def test_edge_cases(spark):
    long = "x y z " * 40_000 + "Alpha beta-gamma Éa 1 2 3 4 5 6 7 8 9 10"
    item = "alpha BETA gamma Éa 1 2 3 4 5 6 7 8 9 10"
    d = spark.createDataFrame(
        [(1, None, "s"), (2, "", None), (3, item, "s"), (3, item, "s"), (None, "to Zwei drei!", "q"), (4, long, "l"),
         (5, "éa 1 2", "t")], "doc_id long, text string, _tag string")
    b = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "zwei DREI"), (4, "...")],
                              "item_id int, text string")
    assert got(d, b) == want(d, b)
    empty = spark.createDataFrame([], "item_id int, text string")
    assert got(d, empty) == want(d, empty)
    assert got(d.limit(0), b) == []
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "5"]


def test_spans_are_cut(spark):
    item = " ".join(f"i{k}" for k in range(15))
    text = "Before, these. " + item.upper().replace(" ", ", ") + "! After."
    d = spark.createDataFrame([(1, text), (2, "w " * 400 + item), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r["doc_id"]: r["text"] for r in dc.remove_spans(d, b).collect()}
    assert out == {1: "Before, these. ! After.", 2: "w " * 400 + item, 3: None}
    out = {r["doc_id"]: r["text"] for r in dc.remove_spans(d, b, span_words=15).collect()}
    assert out[2] == "w " * 400
    again = dc.verdicts(dc.scan(dc.remove_spans(d, b), b)).filter(F.col("_contaminated")).count()
    assert again == 0
