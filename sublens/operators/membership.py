"""Rows of a large table whose key is in one of several key sets, in one join.

``KeyFilter`` is a Bloom filter built and tested with built-in functions: the set's
keys set bits of a word array (one small aggregation), which enters the scan of the
large table as a scalar subquery's value, so rows without a key are dropped where they are
read, before any exchange.  Its size follows the counted number of keys, up to
``MAX_BITS``; beyond that more rows pass, and the join that follows decides exactly at
any size.

``rows_by_kind`` reads the table once: each row that passes is kept once for each kind of key it
may hold, tagged with the kind, and one left semi join on (kind, key) with the union of
the key sets decides.  Neither side is aggregated below the join, so the
adaptive planner may broadcast the keys or split a hot one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 3
BITS_PER_KEY = 12
MIN_BITS, MAX_BITS = 1 << 12, 1 << 26       # 512 bytes to 8 MB


def bits_for(n: int) -> int:
    bits = MIN_BITS
    while bits < min(MAX_BITS, n * BITS_PER_KEY):
        bits *= 2
    return bits


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


@dataclass(frozen=True)
class KeyFilter:
    """``may_hold(key)`` is true for every key of the set (NULL included), and for few others."""

    words: DataFrame        # one row: array<bigint>
    bits: int

    @classmethod
    def of(cls, keys: DataFrame, col: str, n: int) -> "KeyFilter":
        """Of the column's values as strings; ``n`` is their number, repeats included."""
        bits = bits_for(n)
        place = keys.select(F.explode(F.array(*_places(F.col(col).cast("string"), bits))).alias("at"))
        words = place.groupBy(F.expr("at div 64").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
        return cls(every.agg(F.transform(
            F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))),
            lambda w: w["bits"]).alias("words")), bits)

    def may_hold(self, key: Column) -> Column:
        words = self.words.scalar()
        tests = []
        for at in _places(key.cast("string"), self.bits):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            tests.append(F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class KeySets:
    """Several key sets as one table: kind, key (as a string)."""

    keys: DataFrame
    filters: dict[str, KeyFilter]

    @classmethod
    def of(cls, sets: list[tuple[str, DataFrame, str]], stage) -> "KeySets":
        """Of (kind, table, key column); a kind may come several times.  ``stage`` keeps
        a result that is read more than once."""
        tagged = [df.select(F.lit(kind).alias("kind"), F.col(col).cast("string").alias("key")) for kind, df, col in sets]
        keys = stage(reduce(DataFrame.unionByName, tagged))
        counts = {r["kind"]: r["n"] for r in keys.groupBy("kind").agg(F.count("*").alias("n")).collect()}
        return cls(keys, {kind: KeyFilter.of(keys.where(F.col("kind") == kind), "key", n) for kind, n in counts.items()})

    def rows(self, df: DataFrame, columns: dict[str, str], kind_name: str) -> DataFrame:
        """``df`` once for each kind whose set holds the row's value of that kind's column
        (NULL matches NULL), with the kind as column ``kind_name``."""
        may = {k: self.filters[k].may_hold(F.col(c)) for k, c in columns.items() if k in self.filters}
        if not may:
            return df.withColumn(kind_name, F.lit("")).where(F.lit(False))
        passed = df.where(reduce(lambda a, b: a | b, may.values()))
        kinds = F.explode(F.array(*[F.when(test, F.lit(k)) for k, test in may.items()]))
        tagged = passed.withColumn(kind_name, kinds).where(F.col(kind_name).isNotNull())
        key = F.lit(None).cast("string")
        for k, c in columns.items():
            key = F.when(F.col(kind_name) == k, F.col(c).cast("string")).otherwise(key)
        sets = self.keys.select(F.col("kind").alias("_kind"), F.col("key").alias("_key"))
        return (tagged.withColumn("_row_key", key)
                .join(sets, (F.col(kind_name) == F.col("_kind")) & F.col("_row_key").eqNullSafe(F.col("_key")), "left_semi")
                .drop("_row_key"))
