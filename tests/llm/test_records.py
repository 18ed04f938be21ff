"""Binary records: checksums, exact round trip, offsets, shuffled reads."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sublens.llm import records

DOCS = "/root/testdata/sf0.001/documents.parquet"


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums():
    assert slow_crc32c(b"123456789") == 0xE3069283          # the published check value
    rng = np.random.default_rng(5)
    parts = [rng.bytes(n) for n in (4, 5, 8, 127, 128, 129, 1000, 4096, 70_001)] + [b"\0" * 300]

    def mask(c):
        return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    assert records.masked_checksums(parts).tolist() == [mask(slow_crc32c(p)) for p in parts]
    assert len(records.masked_checksums([])) == 0


def expected(rows, end=1):
    tok = Tokenizer.from_file(records.default_tokenizer())
    enc = [(i, tok.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows]
    enc.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    out, start = [], 0
    for i, ids in enc:
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(index):
    return [tuple(r) for r in index.orderBy("start", "file", "position").select(
        "id", "start", "n_tokens", "ids_crc32").collect()]


@pytest.mark.parametrize("file_bytes", [32 << 20, 60_000])
def test_whole_table_round_trip(spark, file_bytes):
    docs = spark.read.parquet(DOCS)
    path, index = records.output(docs, file_bytes=file_bytes)
    assert result(index) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    files = index.select("file").distinct().count()
    assert files == 1 if file_bytes > 1 << 20 else files > 5
    some = index.filter("id % 17 = 3").orderBy(F.xxhash64("id"))
    got = {r["id"]: r["ids"] for r in records.read_some(spark, path, some).collect()}
    tok = Tokenizer.from_file(records.default_tokenizer())
    want = {r["doc_id"]: tok.encode(r["text"], add_special_tokens=False).ids + [1]
            for r in docs.filter("doc_id % 17 = 3").collect()}
    assert got == want


def test_edge_cases(spark):
    rows = [(7, None), (None, "a b"), (None, "b"), (7, ""), (3, "x " * 30_000), (3, "x " * 30_000), (-4, "é 　z<|endoftext|>q"),
            (5, "it's\tI'll\n\nwe've 123 ... ΟΔΟΣ Σ\x1c.\x85x"), (5, "other")] + [(9, f"w{i}") for i in range(40)]
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id int, text string, part int, record string")
    for size in (1 << 20, 2_000):
        _, index = records.output(df, file_bytes=size)
        got = result(index)
        want = expected(rows)
        ids = [g[0] for g in got]
        assert ids == [w[0] for w in want]
        assert sorted(g[2:] for g in got) == sorted(w[2:] for w in want)
        total = 0
        for g in got:
            assert g[1] == total
            total += g[2]
    _, index = records.output(df.limit(0))
    assert index.count() == 0


def test_hot_id_is_spread_in_order(spark):
    rows = [(9, f"w{i} " * 40) for i in range(300)] + [(i, "a b c " * 30) for i in range(600) if i != 9]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, index = records.output(df, file_bytes=8_000)
    r = index.select("file", "id", "start").collect()
    assert len({x["file"] for x in r if x["id"] == 9}) > 2
    ids = [x["id"] for x in sorted(r, key=lambda x: x["start"])]
    assert ids == sorted(ids)


def test_damage_is_found():
    rec = (5).to_bytes(8, "little") + b"\0\2" + b"\1\0\2\0"
    n = len(rec).to_bytes(8, "little")
    c = [int(x).to_bytes(4, "little") for x in records.masked_checksums([n, rec])]
    good = n + c[0] + rec + c[1] + b"\n"
    assert [r for _, _, r in records.parse(good * 3)] == [rec] * 3
    for i in (2, 9, 14, 24):
        bad = bytearray(good)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            list(records.parse(bytes(bad)))


def test_files_are_read_in_pieces(spark, monkeypatch):
    rows = [(i, "word " * (i % 60)) for i in range(200)] + [(700, "long " * 3000), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path, index = records.output(df, file_bytes=8_000)
    columns = ["file", "position", "offset", "size", "id", "n_tokens", "ids_crc32"]
    want = sorted(map(tuple, index.select(columns).collect()))
    monkeypatch.setattr(records, "PIECE_BYTES", 64)
    with records._batches_of(spark, records.PIECE_ROWS):
        assert sorted(map(tuple, records.scan(spark, path).collect())) == want
    files = {r["path"]: bytes(r["content"]) for r in
             spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    for size in (1, 7, 1 << 20):
        pieces = [(p, d[i:i + size]) for p, d in files.items() for i in range(0, max(len(d), 1), size)]
        assert sorted(r for some in records.pieced(iter(pieces)) for r in some) == want
    name, data = next((p, d) for p, d in files.items() if d)
    for cut in ([(name, data[:-3])], [(name, data[:-3]), (name.replace("part-", "part-9"), data)]):
        with pytest.raises(ValueError):
            list(records.pieced(iter(cut)))
    limit = spark.conf.get(records.BATCH)
    with records._batches_of(spark, 3):
        assert spark.conf.get(records.BATCH) == "3"
    assert spark.conf.get(records.BATCH) == limit


def test_word_encoder_equals_the_tokenizer(spark):
    import public_tokenizers
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["Don't I'LL we've x's", "ÀÉÎ ß ẞ ﬁ ² ½ x²", "e\u0301 \u0301a", "a\u00a0b\u2003c\x1cd\x85e", "<|endoftext|>a <|startoftext|>",
              "ABC... (a)", "ÿ× ÷ø Ø", "日本語 текст ΣΑΣ", "_a_ a_b 1a a1", ""]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        tok, enc = Tokenizer.from_file(path), records.WordEncoder(path)
        assert (enc.by_word, enc.by_piece) == ((True, True) if name[0] == "w" else (False, False))
        some = texts if name[0] == "w" else texts[-60:]
        for t in some:
            assert np.frombuffer(enc.encode(t), f"<u{enc.width}").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_store_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(records, "WORD_STORE", 50)
    enc, tok = records.WordEncoder(records.default_tokenizer()), Tokenizer.from_file(records.default_tokenizer())
    for i in range(40):
        t = " ".join(f"w{j}x, Same" for j in range(i * 3, i * 3 + 10))
        assert np.frombuffer(enc.encode(t), "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids
        assert len(enc.known) < 150 and len(enc.older) < 150
