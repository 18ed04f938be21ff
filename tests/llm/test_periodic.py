"""Periodic runs: extensions on the grammar and whole results against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import periodic, queries
from sublens.llm.grammar import Grammar

SF = "/root/testdata/sf0.001"


def plain_runs(w, least=6, times=4):
    """Every maximal stretch of every period, smallest period first."""
    n, out = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_kept(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [x for i, x in enumerate(w) if i not in gone]


def texts_for(rng, n):
    out = []
    for _ in range(n):
        alphabet = [f"w{i}" for i in range(rng.randint(1, 4))]
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            unit = [rng.choice(alphabet) for _ in range(rng.randint(1, 7))]
            words += unit * rng.randint(2, 9) + unit[:rng.randint(0, 6)]
            words += [rng.choice(alphabet) for _ in range(rng.randint(0, 10))]
        out.append(words)
    return out


def test_extensions():
    rng = np.random.default_rng(3)
    for trial in range(60):
        text = [-1]
        for i in range(rng.integers(1, 4)):
            part = rng.integers(0, rng.integers(1, 4), rng.integers(0, 50))
            text += [*(np.tile(part[:5], 9) if trial % 2 else part).tolist(), -2 - i]
        text = np.array(text)
        inner = np.flatnonzero(text >= 0)
        pairs = [(x, y) for x in inner for y in inner if x != y][:2000]
        if not pairs:
            continue
        x, y = np.array(pairs).T
        grammar = Grammar(text)
        for back, way in ((False, 1), (True, -1)):
            want = []
            for a, b in pairs:
                n = 0
                while text[a + way * n] == text[b + way * n]:
                    n += 1
                want.append(n)
            assert grammar.extend(x, y, back).tolist() == want


@pytest.mark.parametrize("chunk", [1 << 17, 7])
def test_runs_of_random_words(monkeypatch, chunk):
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(60):
        texts = [[w.encode() for w in t] for t in texts_for(rng, rng.randint(1, 6))]
        for t, (n, runs, kept) in zip(texts, periodic._found(texts, 6, 4), strict=True):
            want = plain_runs(t)
            assert n == len(t)
            assert [(r["start"], r["length"], r["period"]) for r in runs] == want
            assert kept == b" ".join(plain_kept(t, want))


@pytest.mark.parametrize("least,times", [(2, 2), (9, 3)])
def test_other_limits(least, times):
    rng = random.Random(5)
    texts = [[w.encode() for w in t] for t in texts_for(rng, 80)]
    got = [[(r["start"], r["length"], r["period"]) for r in runs] for _, runs, _ in periodic._found(texts, least, times)]
    assert got == [plain_runs(t, least, times) for t in texts]


def contract_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(plain_kept(w, runs))))


def test_whole_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(contract_row(*r) for r in rows if len((r[1] or "").split()) < 3000)
    ids = {r[0] for r in want}
    got = sorted(tuple(r) for r in queries.op11_runs(spark, SF).collect() if r["doc_id"] in ids)
    assert got == want
    assert sum(r[1] > 0 for r in want) > 10 and len(want) > 150


def test_edge_rows(spark):
    long = " ".join(["a b c"] * 30_000)
    rows = [(1, None, 0), (2, "", 0), (3, " \t\x0b\n", 0), (4, "x " * 5, 0), (5, "x " * 6, 0), (5, "x " * 6, 0),
            (None, "p q r p q r p\tq r p q r", 0), (6, long, 0), (7, "a\x00b " * 7, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int").withColumn("runs", F.lit(1))
    out = periodic.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "kept"]
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["kept"]) for r in out.collect()))
    assert got == [
        (0, 8, [(0, 8, 2)], "p q r"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 5, [], "x x x x x"),
        (5, 6, [(0, 6, 1)], "x"), (5, 6, [(0, 6, 1)], "x"), (6, 90_000, [(0, 90_000, 3)], "a b c"),
        (7, 7, [(0, 7, 1)], "a\x00b")]
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, id_col="n_words")
