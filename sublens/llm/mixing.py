"""Mixing to target weights with soft domain membership, in DataFrame functions only.

A labelled table trains a domain classifier: multinomial Naive Bayes over word
hashes (``BUCKETS`` of them).  A document's log-likelihood counts for at most ``TRUST``
words, so short and mixed texts keep a soft posterior.  With n tokens and posterior
p of each document, projected gradient steps fit the rates r of the least-squares problem

    minimise |sum of r n p - target tokens per domain|^2,  r >= least

from r = 1.  A row's step is p.u / p.m, with the tokens m of each domain and u the residual of each domain, and the
result is cut to the bound.  With this scale for each row the largest curvature is 1 whatever the rows are.  First
steps are also scaled by the curvature (a matrix of the number of domains, summed over the rows that the bound
lets move): where targets can be met, a few reach them.  Where such a step gains too little, the plain ones follow, accelerated by
momentum that starts anew where the residual grows.  Each step is one or two distributed aggregates of
sums per domain; a row replays the moves so far, and every ``REPLAY`` moves its rate is stored with its posterior.

By default rates are 0 or more and the total stays what the rows have.  With ``least`` = 1
no row is lost: the target is the smallest total that cuts no domain below what it has now, and a little
more; where soft rows make that unreachable, the total rises (it is one more variable of the problem, bounded from
below).  Rates have no upper bound: a scarce domain is repeated as often as its target asks.  A domain's share is at most the
largest posterior any row has for it; a domain for which that is under a thousandth of its target (ABSENT) is left as it
is, and the others meet their parts of the total.  Other targets out of reach are missed (steps end where they bring the residual down by less than a hundredth in ``STALL`` moves) and named in a
warning.  ``copies`` makes the rate an integer: its floor, plus one by a hash of the id with the remaining chance.

Defined cases: NULL text has no words: no tokens, the prior as posterior, rate 1.
Labelled rows with a NULL or unlisted domain are left out; a domain without
labelled rows gets smoothed counts.  A NULL id hashes like 0.  Repeated rows get
equal rates.  Without tokens all rates are 1.  Other columns pass through, whatever their names.
"""

from __future__ import annotations

import json
import math
import warnings
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import aside, discard, stored

BUCKETS = 1024
TRUST = 30
SAMPLE = 20_000               # labelled rows the classifier is fitted to
HEADROOM = 1.02               # of the default total without loss: soft members of a domain stay whole too
MISSED = 1e-3                 # of all tokens: a share further off its target is warned of
BLOCK = 4096                  # copies of a row that are made at a time
ABSENT = 1e-3                 # of its target: a domain whose largest posterior is less has no rows
GAIN = 0.95                   # of the residual: what a step by curvature must leave less than
RIDGE = 1e-12                 # of the scaled curvature
STEPS = 300                   # moves at most
REPLAY = 16                   # moves after which the rates are stored
STALL = 25                    # moves that together must bring the residual down by a hundredth
TOLERANCE = 1e-7              # of the total: a residual at which the steps end
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def _words(text_col: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def labelled_rows(docs: DataFrame, labelled: DataFrame, domain_col: str, limit: int = SAMPLE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, domain) of up to ``limit`` labelled rows, chosen by a hash of the id."""
    ids = labelled.filter(F.col(id_col).isNotNull() & F.col(domain_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(
        F.min(domain_col).alias("domain"), F.max(domain_col).alias("_z")).filter("domain = _z").select("_id", "domain")
    n = ids.count()
    if n > limit:
        ids = ids.filter(F.pmod(F.xxhash64(F.col("_id"), F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * (limit / n)))
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    return src.join(F.broadcast(ids), "_id").select("text", "domain")      # bounded by limit


def fit_domains(rows: DataFrame, domains: list[str]) -> tuple[list[float], list[float]]:
    """Log priors, and the log-likelihoods of every bucket for each domain."""
    known = rows.filter(F.col("domain").isin(domains)).withColumn("w", _words("text"))
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}      # a row per domain
    counted = known.select("domain", F.explode("w").alias("w")).groupBy(_bucket(F.col("w")).alias("b")).agg(
        *[F.count_if(F.col("domain") == d).alias(f"c{i}") for i, d in enumerate(domains)]).collect()   # a row per bucket
    counts = {r["b"]: [r[f"c{i}"] for i in range(len(domains))] for r in counted}
    none = [0] * len(domains)
    totals = [sum(c[i] for c in counts.values()) + BUCKETS for i in range(len(domains))]
    table = [round(math.log((counts.get(b, none)[i] + 1) / totals[i]), 6) for b in range(BUCKETS) for i in range(len(domains))]
    rows_ = sum(sizes.values()) + len(domains)
    return [math.log((sizes.get(d, 0) + 1) / rows_) for d in domains], table


def posteriors(df: DataFrame, model: tuple[list[float], list[float]], text_col: str = "text") -> DataFrame:
    """df with ``_n`` (words) and ``_p`` (array of the domains' posteriors)."""
    priors, table = model
    d = len(priors)
    lookup = F.from_json(F.lit(json.dumps(table)), "array<double>")       # folded to one literal

    def add(acc: Column, w: Column) -> Column:
        at = _bucket(w) * d
        return F.struct(*[(acc[f"s{i}"] + F.get(lookup, at + i)).alias(f"s{i}") for i in range(d)])

    zero = F.struct(*[F.lit(0.0).alias(f"s{i}") for i in range(d)])
    out = df.withColumn("_w", _words(text_col))
    out = out.withColumns({"_n": F.size("_w").cast("long"), "_s": F.aggregate("_w", zero, add)}).drop("_w")
    trust = F.least(F.lit(float(TRUST)), F.col("_n").cast("double")) / F.greatest(F.col("_n"), F.lit(1))
    out = out.withColumn("_log", F.array(*[F.col("_s")[f"s{i}"] * trust + priors[i] for i in range(d)]))
    out = out.withColumn("_e", F.transform("_log", lambda x: F.exp(x - F.array_max("_log"))))
    total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return out.withColumn("_p", F.transform("_e", lambda x: x / total)).drop("_s", "_log", "_e")


class Rates(NamedTuple):
    """Lower bound, tokens of each domain, and the moves: momentum before a step, and its residuals."""

    least: float
    mass: list[float]
    moves: list[tuple[float, list[float]]]


def _solve(m: list[list[float]], v: list[float]) -> list[float]:
    """x with m x = v for a symmetric m, scaled to a diagonal of 1, by elimination with pivots; 0 where m has no row."""
    unit = [math.sqrt(m[i][i]) for i in range(len(v))]
    live = [i for i, u in enumerate(unit) if u > 0]
    a = [[m[i][j] / unit[i] / unit[j] + (RIDGE if i == j else 0.0) for j in live] + [v[i] / unit[i]] for i in live]
    for i in range(len(live)):
        k = max(range(i, len(live)), key=lambda r: abs(a[r][i]))
        a[i], a[k] = a[k], a[i]
        for r in range(len(live)):
            if r != i and a[i][i]:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * y for x, y in zip(a[r], a[i], strict=True)]
    out = [0.0] * len(v)
    for at, i in enumerate(live):
        out[i] = a[at][-1] / a[at][at] / unit[i] if a[at][at] else 0.0
    return out


def _dot(col: str, weights: list[float]) -> Column:
    return sum((F.get(col, F.lit(i)) * F.lit(w) for i, w in enumerate(weights)), F.lit(0.0))


def _replayed(before: Column, now: Column, solved: Rates) -> Column:
    """(before, now): a row's last two rates after the moves."""
    start = F.struct(before.alias("before"), now.alias("now"))
    if not solved.moves:
        return start
    moves = F.from_json(F.lit(json.dumps([{"b": b, "g": g} for b, g in solved.moves])), "array<struct<b:double,g:array<double>>>")
    mass = _dot("_p", solved.mass)

    def move(r: Column, m: Column) -> Column:
        slope = sum((F.get("_p", F.lit(i)) * m["g"][i] for i in range(len(solved.mass))), F.lit(0.0))
        after = r["now"] + m["b"] * (r["now"] - r["before"]) - F.when(mass > 0, slope / mass).otherwise(0.0)
        return F.struct(r["now"].alias("before"), F.greatest(F.lit(solved.least), after).alias("now"))

    return F.aggregate(moves, start, move)


def rate(solved: Rates) -> Column:
    """A row's rate."""
    return F.when(F.col("_n") > 0, _replayed(F.lit(1.0), F.lit(1.0), solved)["now"]).otherwise(F.lit(1.0))


def solve_rates(rows: DataFrame, weights: list[float], total: float | None = None, least: float = 0.0,
                steps: int = STEPS) -> Rates:
    """Moves of the rates of rows with _n and _p."""
    d = len(weights)
    weights = [w / sum(weights) for w in weights]
    state = rows.filter("_n > 0").select("_n", "_p", F.lit(1.0).alias("_before"), F.lit(1.0).alias("_now"))

    def have(momentum: float, moves: list[tuple[float, list[float]]]) -> tuple[list[float], list[float]]:
        """Expected tokens of each domain after the moves, and with the momentum added."""
        r = state.withColumn("_r", _replayed(F.col("_before"), F.col("_now"), Rates(least, mass, moves)))
        now = F.col("_r.now")
        ahead = now + F.lit(momentum) * (now - F.col("_r.before"))
        got = r.agg(*[F.sum(x * F.col("_n") * F.get("_p", F.lit(i))) for x in (now, ahead) for i in range(d)]).first()
        got = [x or 0.0 for x in got]
        return got[:d], got[d:]

    mass = [0.0] * d
    mass, _ = have(0.0, [])
    tokens = sum(mass)
    top = [x or 0.0 for x in state.agg(*[F.max(F.get("_p", F.lit(i))).alias(f"t{i}") for i in range(d)]).first()]
    free_total = total is None and least > 0
    if total is None:
        total = HEADROOM * max(
            [m / w for m, w, t in zip(mass, weights, top, strict=True) if w and t >= ABSENT * w] + [0.0]) if least > 0 else tokens
    solved = Rates(least, mass, [])
    if not tokens or not total:
        return solved
    on = [t >= ABSENT * w for t, w in zip(top, weights, strict=True)]
    floor, aim, aim_before, recent, kept = total, total, total, [], None

    def off(tokens_of: list[float], goal: float) -> list[float]:
        return [h - goal * w if o else 0.0 for h, w, o in zip(tokens_of, weights, on, strict=True)]

    def inner(v: list[float], u: list[float]) -> float:
        return sum(x * y for x, y in zip(v, u, strict=True))

    def size(v: list[float]) -> float:
        return math.sqrt(inner(v, v))

    def scaled(way: list[float], slope: list[float]) -> list[float]:
        """The slope through the curvature of the rows that may move against ``way``; the total counts as a row of
        membership -weights."""
        r = state.withColumn("_r", _replayed(F.col("_before"), F.col("_now"), Rates(least, mass, recent))["now"])
        r = r.filter((F.col("_r") > least) | (_dot("_p", way) < 0))
        got = r.agg(*[F.sum(F.col("_n") * F.get("_p", F.lit(i)) * F.get("_p", F.lit(j)) / _dot("_p", mass)).alias(f"m{i}_{j}")
                      for i in range(d) for j in range(i, d)]).first()
        moves_too = free_total and (aim > floor or inner(weights, way) > 0)
        return _solve([[(got[f"m{min(i, j)}_{max(i, j)}"] or 0.0) + (weights[i] * weights[j] if moves_too else 0.0) if on[i] and on[j]
                        else 0.0 for j in range(d)] for i in range(d)], slope)

    def store() -> None:
        nonlocal state, kept, recent
        r = state.withColumn("_r", _replayed(F.col("_before"), F.col("_now"), Rates(least, mass, recent)))
        old, kept = kept, stored(r.select("_n", "_p", F.col("_r.before").alias("_before"), F.col("_r.now").alias("_now")), "mixing-rates")
        state, recent = kept, []
        if old is not None:
            discard(old)

    slope = off(mass, aim)
    better = True
    while better and len(solved.moves) < steps and size(slope) > TOLERANCE * aim:
        better, way = False, slope
        for _ in range(2):
            way = scaled(way, slope)
            goal = max(floor, aim + inner(weights, way)) if free_total else aim
            now, _ = have(0.0, [*recent, (0.0, way)])
            if size(off(now, goal)) < GAIN * size(slope):
                better, aim, slope = True, goal, off(now, goal)
                recent.append((0.0, way))
                solved.moves.append((0.0, way))
                break
        if len(recent) == REPLAY:
            store()

    part = 1.0 / (1.0 + inner(weights, weights)) if free_total else 1.0
    sizes, momentum, pace, aim_before = [size(slope)], 0.0, 1.0, aim
    while len(solved.moves) < steps and sizes[-1] > TOLERANCE * aim:
        move = (momentum, [part * g for g in slope])
        solved.moves.append(move)
        recent.append(move)
        if free_total:
            aim_before, aim = aim, max(floor, aim + momentum * (aim - aim_before) + part * inner(weights, slope))
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        momentum, pace = (pace - 1) / faster, faster
        now, ahead_tokens = have(momentum, recent)
        sizes.append(size(off(now, aim)))
        if sizes[-1] > sizes[-2]:                    # overshot: momentum starts anew
            momentum, pace, ahead_tokens = 0.0, 1.0, now
        slope = off(ahead_tokens, aim + momentum * (aim - aim_before))
        if len(sizes) > STALL and min(sizes[-STALL:]) > 0.99 * min(sizes[:-STALL]):
            break                                    # as near as the rows allow
        if len(recent) == REPLAY:
            store()
    now, _ = have(0.0, recent)
    if kept is not None:
        discard(kept)
    missed = [h / (sum(now) or 1.0) - w for h, w in zip(now, weights, strict=True)]
    if any(abs(o) > MISSED for o in missed):
        warnings.warn(f"mixing: shares are off their targets by {[round(o, 4) for o in missed]}", stacklevel=2)
    return solved


def copies(id_col: str = "doc_id") -> Column:
    """Integer copies for a row with ``_rate``."""
    chance = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    return (F.floor("_rate") + (chance < F.col("_rate") - F.floor("_rate")).cast("long")).cast("long")


def rated(df: DataFrame, docs: DataFrame, labelled: DataFrame, domain_col: str = "lang",
          targets: dict[str, float] | None = None, total: float | None = None, keep: list[str] | None = None,
          id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> DataFrame:
    """df (columns ``keep``, or all; none may start with an underscore) with ``_n``, ``_p`` (in the order of targets)
    and ``_rate``; the classifier is fitted to labelled rows of docs."""
    return _rated(df, docs, labelled, domain_col, targets, total, keep, id_col, text_col, least, text_col)


def _rated(df, docs, labelled, domain_col, targets, total, keep, id_col, text_col, least, read_col) -> DataFrame:
    """rated, for texts that df has in read_col."""
    targets = targets or TARGETS
    model = fit_domains(labelled_rows(docs, labelled, domain_col, SAMPLE, id_col, text_col), list(targets))
    rows = posteriors(df, model, read_col).select(*(keep or df.columns), "_n", "_p")
    rows = stored(rows, "mixing-posteriors")
    solved = solve_rates(rows, list(targets.values()), total, least)
    return rows.withColumn("_rate", rate(solved))


def mix(df: DataFrame, docs: DataFrame, labelled: DataFrame, domain_col: str = "lang",
        targets: dict[str, float] | None = None, total: float | None = None,
        id_col: str = "doc_id", text_col: str = "text", least: float = 0.0) -> DataFrame:
    """df with every row as often as its rate asks for, same columns; with ``least`` = 1 no row is lost."""
    clear, names = aside(df)
    rows = _rated(clear, docs, labelled, domain_col, targets, total, None, id_col, text_col, least, names[text_col])
    # a row's copies in blocks, so that no array grows with its rate
    rows = rows.withColumn("_left", copies(names[id_col])).filter("_left > 0").withColumn(
        "_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_left") - 1, F.lit(BLOCK).cast("long"))))
    block = F.least(F.lit(BLOCK), F.col("_left") - F.col("_at")).cast("int")
    rows = rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), block)))
    return rows.select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])
