"""Token ids as length-delimited binary records with an offset index.

A file is a run of frames, one for each document:

    u64  length of the record, little-endian
    u32  masked checksum of these 8 bytes
    ...  record
    u32  masked checksum of the record
    \\n   closes the frame (Spark's text sink writes it)

    record = i64 document id, u8 (1: the id is NULL), u8 bytes per token id,
             then the token ids, little-endian

Checksums are CRC-32C, masked by a rotation by 15 bits and an added constant, so
that a checksum stored next to its data is not itself a plausible checksum.

Files hold ascending document ids and follow each other in that order; they
are cut at quantiles of the id, so no global sort and no single writer exists.
An id that spans several quantiles (a third of all rows, say) is spread over that many
files.  Frames go out through Spark's own writer, with its commit protocol: a
lost task or executor leaves no partial file.  The index is a separate Parquet
table (file, position, offset, size, id, token count, start), built from
the files, by which single records are read in any order.

Defined cases: NULL text is empty: the end id alone.  A NULL document id sorts
first.  Rows with equal ids are ordered by their token ids.  Repeated rows are
repeated records.  No rows: an empty folder, an empty index.
"""

from __future__ import annotations

import bisect
import contextlib
import functools
import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.llm.common import run_folder

FILE_BYTES = 32 << 20         # about how much text goes into one file
END_ID = 1
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
WORD_STORE = 1 << 18          # words and pieces in each half of an encoder's store
PIECE_BYTES = 1 << 20         # of a file that a reading task gets at once ...
PIECE_ROWS = 4                # ... so many in an Arrow batch
POLYNOMIAL = 0x82F63B78       # CRC-32C, reflected
MASK_DELTA = 0xA282EAD8
BLOCK = 128                   # bytes of a checksum block
HEAD, RECORD_HEAD, TAIL = 12, 10, 5


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1)
    return t


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Four tables to feed 4 bytes at once, and four to pass BLOCK zero bytes."""
    t = [_byte_table()]
    for _ in range(3):
        t.append((t[-1] >> 8) ^ t[0][t[-1] & 255])
    step = np.stack(t)
    skip = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    for _ in range(BLOCK // 4):
        skip = _feed(skip, step)
    return step, skip


def _feed(state: np.ndarray, t: np.ndarray) -> np.ndarray:
    return t[3][state & 255] ^ t[2][(state >> 8) & 255] ^ t[1][(state >> 16) & 255] ^ t[0][state >> 24]


STEP, SKIP = _tables()


def _skip_block(state: np.ndarray) -> np.ndarray:
    return SKIP[0][state & 255] ^ SKIP[1][(state >> 8) & 255] ^ SKIP[2][(state >> 16) & 255] ^ SKIP[3][state >> 24]


def masked_checksums(parts: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of many byte strings of 4 bytes or more.  Each is padded in front
    with zeros to whole blocks (which leave an empty checksum register empty),
    the blocks run side by side, and their results are chained."""
    if not parts:
        return np.empty(0, dtype=np.uint32)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    blocks = -(-sizes // BLOCK)
    ends = np.cumsum(blocks) * BLOCK
    data = np.zeros(int(ends[-1]), dtype=np.uint8)
    for p, size, end in zip(parts, sizes.tolist(), ends.tolist(), strict=True):
        data[end - size:end] = np.frombuffer(p, dtype=np.uint8)
    first = ends - sizes
    for i in range(4):                    # the register starts with all bits set
        data[first + i] ^= 0xFF
    words = np.ascontiguousarray(data.view("<u4").reshape(-1, BLOCK // 4).T)
    state = np.zeros(words.shape[1], dtype=np.uint32)
    for w in words:
        state = _feed(state ^ w, STEP)
    crc = np.zeros(len(parts), dtype=np.uint32)
    start = ends // BLOCK - blocks
    order = np.argsort(-blocks, kind="stable")
    live = np.searchsorted(-blocks[order], -np.arange(1, int(blocks.max()) + 1), side="right")
    for k, n in enumerate(live.tolist()):
        at = order[:n]
        crc[at] = _skip_block(crc[at]) ^ state[start[at] + k]
    crc ^= np.uint32(0xFFFFFFFF)
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)


class _CharForms(dict):
    """How the tokenizer's pre-tokenizer spells a character, remembered."""

    def __init__(self, spell):
        super().__init__()
        self.spell = spell

    def __missing__(self, code: int) -> str:
        self[code] = out = "".join(x for x, _ in self.spell(chr(code)))
        return out


class WordEncoder:
    """Encodes texts with a tokenizer, word by word where that is the same.

    A tokenizer that drops white space encodes each word by itself, so words
    met before are taken from a bounded store.  A word of letters and the marks
    after it are two pieces, so a known word with another case or mark is
    put together from known pieces, and a new piece goes straight to the
    tokenizer's merges.  Both shortcuts are tried on probe texts first; a
    tokenizer for which they do not hold encodes whole texts."""

    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
    PROBE = "The  end, (a b) 12 Ünder.\nß-Éa ... «x»!? don't\tÇa $5.30 **it**"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        spell = self.tokenizer.pre_tokenizer
        self.forms = _CharForms(spell.pre_tokenize_str) if spell else None
        self.by_word, self.by_piece = True, spell is not None
        want = self._whole(self.PROBE)
        if self.by_piece and self.encode(self.PROBE) != want:
            self.by_piece, self.known = False, {"": b""}
        self.by_word = self.encode(self.PROBE) == want
        self.known, self.older = {"": b""}, {}

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _encode_new(self, words: set[str]) -> None:
        known, older, plain = self.known, self.older, self.PLAIN.fullmatch
        for w in words:
            if (seen := older.get(w)) is None:
                if self.by_piece and (m := plain(w)):
                    letters, marks = m.groups()
                    lower = letters.lower()
                    seen = self._new_piece(w) if lower == w else self._piece(lower)
                    if marks:
                        seen += self._piece(marks)
                else:
                    seen = self._whole(w)
            known[w] = seen

    def _piece(self, piece: str) -> bytes:
        seen = self.known.get(piece)
        if seen is None:
            seen = self.older.get(piece)
            if seen is None:
                seen = self._new_piece(piece)
            self.known[piece] = seen
        return seen

    def _new_piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.translate(self.forms))]
        return self._bytes(ids)

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._whole(text)
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        if len(self.known) >= WORD_STORE:                   # the oldest half goes
            self.older, self.known = self.known, {"": b""}
        if new := set(words).difference(self.known):
            self._encode_new(new)
        return b"".join(map(self.known.__getitem__, words))


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """Kept by a Python worker over its tasks."""
    return WordEncoder(path)


def _cuts(docs: DataFrame, id_col: str, text_col: str, file_bytes: int) -> list[int]:
    """Ids at which a new file begins: even quantiles, repeats kept."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)) + 16).alias("n")).first()["n"] or 0
    files = int(-(-total // file_bytes))
    if files < 2:
        return []
    at = F.percentile_approx(F.col(id_col).cast("long"), [i / files for i in range(1, files)],
                             max(10_000, 20 * files))
    return docs.agg(at.alias("q")).first()["q"] or []


@contextlib.contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows, for jobs with long rows that run inside."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def write_records(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Encode every row of docs and write the record files under path."""
    cuts = _cuts(docs, id_col, text_col, file_bytes)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer_path)
        end = int(end_id).to_bytes(enc.width, "little")
        head = bytes([enc.width])
        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                ids, out, part = b.column(0).to_pylist(), [], []
                for i, t in zip(ids, b.column(1), strict=True):
                    body = enc.encode(t.as_py()) + end
                    none = i is None
                    out.append((0 if none else i).to_bytes(8, "little", signed=True) + bytes([none]) + head + body)
                    lo = 0 if none else bisect.bisect_left(cuts, i)
                    hi = 0 if none else bisect.bisect_right(cuts, i)
                    part.append(lo if hi <= lo + 1 else lo + zlib.crc32(body) % (hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), b.column(0), pa.array(out, pa.binary())], ["part", "id", "record"])

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoder.cache_clear()            # the worker encodes no more
        pa.default_memory_pool().release_unused()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                r = b.column(0).slice(i, 256).to_pylist()
                s = [len(x).to_bytes(8, "little") for x in r]
                out = [n + int(a).to_bytes(4, "little") + x + int(c).to_bytes(4, "little")
                       for n, a, x, c in zip(s, masked_checksums(s), r, masked_checksums(r), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = src.mapInArrow(encode, "part int, id long, record binary")
    rows = rows.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "id", "record")
    frames = rows.select("record").mapInArrow(frame, "value binary")
    with _batches_of(docs.sparkSession, BATCH_ROWS):         # texts and records are long rows
        frames.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").option(
            "compression", "none").text(path)


def parse(data: bytes, whole: bool = True) -> Iterator[tuple[int, int, bytes]]:
    """(offset, size of the frame, record) of every frame, checksums verified.  If data
    is not the whole file, its last frame may be cut short and is left out."""
    at, found = 0, []
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        if at + HEAD + n + TAIL > len(data):
            if not whole:
                break
            raise ValueError(f"frame at {at} is cut short")
        found.append((at, n))
        at += HEAD + n + TAIL
    for i in range(0, len(found), 256):
        some = found[i:i + 256]
        heads = masked_checksums([data[a:a + 8] for a, _ in some])
        bodies = [data[a + HEAD:a + HEAD + n] for a, n in some]
        sums = masked_checksums(bodies)
        for (a, n), h, r, c in zip(some, heads, bodies, sums, strict=True):
            if int.from_bytes(data[a + 8:a + 12], "little") != h:
                raise ValueError(f"length checksum at {a}")
            if int.from_bytes(data[a + HEAD + n:a + HEAD + n + 4], "little") != c:
                raise ValueError(f"record checksum at {a}")
            yield a, HEAD + n + TAIL, r


def split_record(record: bytes) -> tuple[int | None, np.ndarray]:
    """(document id, token ids) of a record."""
    doc = None if record[8] else int.from_bytes(record[:8], "little", signed=True)
    return doc, np.frombuffer(record, dtype=f"<u{record[9]}", offset=RECORD_HEAD)


INDEX = "file int, position int, offset long, size long, id long, n_tokens long, ids_crc32 long"


def pieced(pieces: Iterator[tuple[str, bytes]]) -> Iterator[list[tuple]]:
    """Rows of INDEX from (path, bytes) pieces, those of a file in their order.  Only
    a piece and a frame that it cuts are held."""
    path, file, base, position, held, size, need = None, 0, 0, 0, [], 0, HEAD
    for name, piece in itertools.chain(pieces, [(None, b"")]):
        if name != path:
            if size:
                raise ValueError(f"frame at {base} is cut short")
            if name is None:
                return
            path, file, base, position, held, need = name, int(re.search(r"part-(\d+)-[^/]*$", name)[1]), 0, 0, [], HEAD
        held.append(piece)
        size += len(piece)
        if size < need:
            continue
        data, done, rows = b"".join(held), 0, []
        for at, n, rec in parse(data, whole=False):
            doc, ids = split_record(rec)
            rows.append((file, position, base + at, n, doc, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            position, done = position + 1, at + n
        held, size, base = [data[done:]], len(data) - done, base + done
        need = HEAD + int.from_bytes(held[0][:8], "little") + TAIL if size >= HEAD else HEAD
        if rows:
            yield rows


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files: where it is, its id, token count and the
    CRC-32 of its token ids as little-endian u32.  Files come to Python in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [x.strip().split(" ") for x in INDEX.split(",")]
        pieces = ((name.as_py(), x.as_py()) for b in batches for name, x in zip(b.column(0), b.column(1), strict=True))
        for rows in pieced(pieces):
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int32() if t == "int" else pa.int64())
                 for v, (_, t) in zip(zip(*rows, strict=True), cols, strict=True)], [n for n, _ in cols])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    last = F.greatest(F.ceil(F.length("content") / PIECE_BYTES).cast("int"), F.lit(1)) - 1
    pieces = files.select("path", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(
        F.col("content"), i * PIECE_BYTES + 1, F.lit(PIECE_BYTES)))).alias("piece"))
    return pieces.mapInArrow(run, INDEX)


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Scan the files, add each record's ``start`` (token ids before it over
    all files) and write the index table; returns it as read back.  The running sum is
    taken inside each file; only one total per file is added up across files."""
    with _batches_of(spark, PIECE_ROWS):
        scan(spark, path).write.parquet(f"{index_path}/scan")
    rows = spark.read.schema(INDEX).parquet(f"{index_path}/scan")
    totals = {r["file"]: r["n"] for r in rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect()}
    before = dict(zip(sorted(totals), itertools.accumulate([0, *[totals[f] for f in sorted(totals)]]), strict=False))
    bases = spark.createDataFrame(sorted(before.items()), "file int, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, total = None, 0
        for b in batches:
            f, n, base = (b.column(i).to_numpy() for i in (0, 5, 7))
            start = np.empty(len(f), dtype=np.int64)
            for i, (x, m, z) in enumerate(zip(f.tolist(), n.tolist(), base.tolist(), strict=True)):
                if x != file:
                    file, total = x, z
                start[i] = total
                total += m
            yield b.set_column(7, "start", pa.array(start))

    joined = rows.join(F.broadcast(bases), "file").select(*rows.columns, "base")     # a row for each file
    out = joined.repartition("file").sortWithinPartitions("file", "position")
    out.mapInArrow(run, INDEX + ", start long").write.parquet(f"{index_path}/index")
    return spark.read.schema(INDEX + ", start long").parquet(f"{index_path}/index")


def read_some(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(id, ids) of the records that ``wanted`` (rows of the index, in whatever
    order they were chosen) names: only their files are opened and only their
    bytes decoded."""
    numbers = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    need = wanted.select("file", "offset", "size")
    cut = files.withColumn("file", numbers).join(need, "file").select(
        F.substring(F.col("content"), F.col("offset").cast("int") + 1, F.col("size").cast("int")).alias("frame"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [split_record(r) for x in b.column(0) for _, _, r in parse(x.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in rows], pa.int64()),
                 pa.array([i.astype(np.int64) for _, i in rows], pa.list_(pa.int64()))], ["id", "ids"])

    return cut.mapInArrow(run, "id long, ids array<long>")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def output(docs: DataFrame, tokenizer_path: str | None = None, folder: str | None = None,
           id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
           file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Write files and index under ``folder`` (a fresh one in the shared folder
    if not given); returns the folder of the files and the index."""
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "records")
    write_records(docs, f"{folder}/files", tokenizer_path or default_tokenizer(), id_col, text_col, end_id, file_bytes)
    return f"{folder}/files", write_index(spark, f"{folder}/files", f"{folder}/meta")
