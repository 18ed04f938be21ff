"""Repeated passages against a table of all windows."""

import hashlib
import random

import numpy as np

from sublens.llm import repeats

SF = "/root/testdata/sf0.001"


def plain(rows, length=50):
    """rows: (id, text) -> sorted (id, n_bytes, n_removed, n_spans, sha256)."""
    last, low = 1 << 63, {}
    data = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    for o, b in data:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            low[w] = min(low.get(w, last), o)
    out = []
    for (i, _), (o, b) in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if low[b[k:k + length]] < o:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    rows = repeats.remove_repeats(df, **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]),
                    hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(w[2] > 0 for w in want) > 20
    assert got(docs) == want
    assert got(docs, hot_segments=2) == want             # most keys take the other way
    from sublens.llm.queries import op4_repeats
    q = [tuple(r) for r in op4_repeats(spark, SF).collect()]
    assert sorted(q, key=str) == want


def mixed_rows():
    rng = random.Random(8)
    words = [f"{chr(97 + rng.randrange(26))}{rng.randrange(999)}é" for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    long = " ".join(rng.choice(words) for _ in range(9000))
    rows = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51), (9, "x" * 400), (10, passage),
            (7, "pre " + passage + " post"), (7, passage), (12, passage[20:]), (12, passage[20:]), (None, passage + "!"),
            (None, passage + "!"), (None, "only here " * 30), (14, long), (15, long[5000:20000] + passage + long[:900]),
            (16, "ab" * 300), (17, "ba" * 300), (18, "\0" * 120), (19, "\0" * 90 + "q")]
    for i in range(20, 60):
        k = rng.randrange(len(passage))
        rows.append((i, passage[:k] + "#" + passage[k + 1:]))
    return rows


def test_edge_cases(spark):
    rows = mixed_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, o int")
    want = plain(rows)
    assert got(df) == want
    assert got(df, hot_segments=3) == want
    assert got(df.limit(0)) == []


def test_keys_depend_on_the_window_alone():
    data = np.random.default_rng(2).bytes(400)
    keys = repeats.window_keys(data)
    for i in range(0, 350, 7):
        assert repeats.window_keys(data[i:i + 50])[0] == keys[i]
    assert len(repeats.window_keys(b"x" * 49)) == 0
    assert len(set(repeats.window_keys(b"x" * 500).tolist())) == 1


def test_shard_covers():
    a, b = b"0123456789" * 3 + b"abcdefghij" * 6, b"zz" + b"abcdefghij" * 6
    assert repeats.shard_covers([a, b], np.array([1, 2])) == [[], [{"start": 2, "end": 62}]]
    assert repeats.shard_covers([a, b], np.array([5, 2])) == [[{"start": 30, "end": 90}], []]
    assert repeats.shard_covers([a, a], np.array([3, 3])) == [[], []]


def test_many_blocks_of_keys(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 20_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert repeats._blocks(repeats._source(docs, "doc_id", "text")) > 10
    assert got(docs) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_keys_of_one_owner_stay_out_of_the_suffix_array(monkeypatch):
    a, b, c = b"0123456789" * 6, b"abcdefghij" * 6, b"zz" + b"abcdefghij" * 6
    seen, whole = [], repeats.shard_covers
    monkeypatch.setattr(repeats, "shard_covers", lambda parts, *x: seen.append(parts) or whole(parts, *x))
    got = repeats.key_covers(np.array([3, 3, 5, 5, 8]), [a, a + b"!", b, c, a], np.array([4, 4, 1, 2, 1]))
    assert got == [[], [], [], [{"start": 2, "end": 62}], []]
    assert seen == [[b, c]]
    assert repeats.key_covers(np.array([3, 4]), [a, b], np.array([1, 2])) == [[], []]
    assert len(seen) == 1
