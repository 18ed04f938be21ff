"""Benchmark decontamination with a generalised suffix automaton.

The benchmark items, as sequences of normalised words (A-Z lower-cased; words are
runs of ASCII letters, digits and all non-ASCII characters), are put into one
suffix automaton.  Each document's words run through it once; at every word
the automaton's state gives the longest run ending there that occurs in some
item.  A run of ``window`` words or more is an occurrence of an item's window;
an item with fewer words is one window of its own, found along the state's suffix links.
Words inside an occurrence are hit, and touching occurrences form a span.

The automaton is broadcast, so its size is checked: items are cut into
groups of ``max_words`` words at most, each with its own automaton, and
documents pass through one after the other, merging their spans.

Defined cases: NULL text has no words and is not contaminated; an item with NULL
or empty text has no window; a NULL item id is listed as an empty string, and items
with the same id count once.  Repeated documents are repeated in the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import aside, text_bytes

WINDOW = 13
COVERAGE = (1, 20)            # contaminated from this share of hit words on
MAX_WORDS = 100_000           # words of items in one automaton

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
# what is not a word character becomes a space, A-Z its lower case
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Generalised suffix automaton over word sequences, with the windows that
    end at each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, words in items:
            seq = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if seq:
                sequences.append((name, seq))
                last = 0
                for c in seq:
                    last = self._extend(last, c)
        self.link[0] = 0
        self._find_windows(sequences)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the strings of q that end a path through p by c."""
        if self.length[p] + 1 == self.length[q]:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:                     # met in an earlier item
            return self._split(last, c, self.next[last][c])
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            self.link[new] = self._split(p, c, self.next[p][c])
        return new

    def _holder(self, state: int, length: int) -> int:
        """Along the links: the state that holds the suffix of that length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _find_windows(self, sequences: list[tuple[str, list[int]]]) -> None:
        full: dict[int, set[str]] = {}               # holder of a window -> items
        short: dict[int, set[tuple[int, str]]] = {}  # holder of a short item -> (its length, it)
        for name, seq in sequences:
            state = 0
            for i, c in enumerate(seq, 1):
                state = self.next[state][c]
                if i >= self.window:
                    full.setdefault(self._holder(state, self.window), set()).add(name)
            if len(seq) < self.window:
                short.setdefault(self._holder(state, len(seq)), set()).add((len(seq), name))
        self.full: list[frozenset[str] | None] = [None] * len(self.length)
        self.short: list[tuple[tuple[int, str], ...] | None] = [None] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            if self.length[s] >= self.window:
                self.full[s] = frozenset(full[s]) if s in full else self.full[self.link[s]]
            above = self.short[self.link[s]] or ()
            if s in short or above:
                self.short[s] = (*above, *sorted(short.get(s, ())))
        self.least = min([self.window, *(n for x in short.values() for n, _ in x)])

    def spans(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Spans [start, end) of hit words, and the items whose windows occur."""
        nxt, link, length, get = self.next, self.link, self.length, self.vocabulary.get
        window, least, full, short = self.window, self.least, self.full, self.short
        state = run = 0
        out: list[list[int]] = []
        items: set[str] = set()
        for end, w in enumerate(words, 1):
            c = get(w)
            if c is None:
                state = run = 0
                continue
            to = nxt[state].get(c)
            while to is None:
                state = link[state]
                run = length[state]
                to = nxt[state].get(c)
            state = to
            run += 1
            if run < least:
                continue
            hit = 0
            if run >= window:
                hit = window
                items |= full[state]
            elif short[state]:
                hit = max((n for n, _ in short[state] if n <= run), default=0)
            if short[state]:
                items.update(x for n, x in short[state] if n <= run)
            if hit:
                start = end - hit
                while out and start <= out[-1][1]:
                    start = min(start, out.pop()[0])
                out.append([start, end])
        return out, items


def _groups(items: DataFrame, id_col: str, text_col: str, max_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in groups of max_words words at most (a longer one alone)."""
    group, size = [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_bytes(F.col(text_col)))
    for name, text in rows.toLocalIterator():
        words = words_of(bytes(text))
        if group and size + len(words) > max_words:
            yield group
            group, size = [], 0
        group.append((name, words))
        size += len(words)
    if group:
        yield group


SPANS = "array<struct<start:int,end:int>>"


def _merge(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(a + b):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def scan(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """docs with ``_n_words``, ``_spans`` (of hit words) and ``_items``."""
    spark = docs.sparkSession
    none = pa.array([], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    out = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_spans": F.array().cast(SPANS),
                            "_items": F.array().cast("array<string>")})
    schema = out.schema

    def step(built):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = built.value
            for b in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
                at = {n: b.schema.get_field_index(n) for n in ("_n_words", "_spans", "_items", text_col)}
                counts, spans, names = [], [], []
                for t, s, x in zip(b.column(at[text_col]), b.column(at["_spans"]), b.column(at["_items"]), strict=True):
                    words = words_of((t.as_py() or "").encode())
                    found, hit = automaton.spans(words)
                    if s.as_py():
                        found = _merge(found, [[y["start"], y["end"]] for y in s.as_py()])
                    counts.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in found])
                    names.append(sorted(hit | set(x.as_py())))
                b = b.set_column(at["_n_words"], "_n_words", pa.array(counts, pa.int64()))
                b = b.set_column(at["_spans"], "_spans", pa.array(spans, none.type))
                yield b.set_column(at["_items"], "_items", pa.array(names, pa.list_(pa.string())))
        return run

    groups = 0
    for group in _groups(items, item_id_col, item_text_col, max_words):
        built = spark.sparkContext.broadcast(Automaton(group, window))
        out = out.mapInArrow(step(built), schema)
        groups += 1
    if not groups:                                   # no items: count words all the same
        out = out.mapInArrow(step(spark.sparkContext.broadcast(Automaton([], window))), schema)
    return out


def verdicts(scanned: DataFrame, coverage: tuple[int, int] = COVERAGE) -> DataFrame:
    """Adds ``_n_hit`` and ``_contaminated`` (hit, and hit words reach the coverage)."""
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    share, of = coverage
    return scanned.withColumn("_n_hit", hit).withColumn(
        "_contaminated", (F.col("_n_hit") > 0) & (F.col("_n_hit") * of >= F.col("_n_words") * share))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the characters from the first to the last word of each span."""
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for s, e in spans:
        out.append(text[last:at[s][0]])
        last = at[e - 1][1]
    return b"".join([*out, text[last:]])


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", coverage: tuple[int, int] = COVERAGE,
                 span_words: int | None = None, **options) -> DataFrame:
    """docs with the hit spans cut out of the texts of contaminated documents;
    with ``span_words`` also every span of at least that many words, wherever it is."""
    clear, names = aside(docs)
    text_col = names[text_col]
    found = verdicts(scan(clear, items, text_col, **options), coverage)
    take = F.when(F.col("_contaminated"), F.col("_spans")).otherwise(
        F.array().cast(SPANS) if span_words is None
        else F.filter("_spans", lambda s: s["end"] - s["start"] >= span_words))
    found = found.withColumn("_spans", take)
    schema = found.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, sp = b.schema.get_field_index(text_col), b.schema.get_field_index("_spans")
            new = [t.as_py() if not s.as_py() else
                   cut_spans(t.as_py().encode(), [(x["start"], x["end"]) for x in s.as_py()]).decode()
                   for t, s in zip(b.column(at), b.column(sp), strict=True)]
            yield b.set_column(at, text_col, pa.array(new, b.schema.field(at).type))

    return found.mapInArrow(run, schema).select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text",
                      coverage: tuple[int, int] = COVERAGE, **options) -> DataFrame:
    """docs without the contaminated ones; all others as they are, whatever their columns' names."""
    clear, names = aside(docs)
    found = verdicts(scan(clear, items, names[text_col], **options), coverage)
    return found.filter(~F.col("_contaminated")).select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])
