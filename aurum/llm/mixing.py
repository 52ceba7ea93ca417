"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

1. Every document falls into a cell of source, language and topic.  Where targets are given, the values
   without one count as ``other``; without given targets, every value has its own, however many.
2. The tokens of the cells are summed (partial sums before the shuffle).
3. Raking: the factors of each dimension's values are set in turn so that the weighted tokens meet
   its target shares, ``rounds`` times over or until nothing changes.  A round is one grouped sum over
   the cells, in one row a source; the driver holds a factor for each pair of language and topic.
4. A document is kept if a uniform number, drawn from a hash of its id and text, is below its cell's
   probability ``min(1, scale * factor)``.  With ``rate``, the scale is solved for so that this share
   of all tokens is expected in the sample; what cells lack that are kept whole, the others give.
   Without, no cell saturates, unless that would leave less than ``LEAST_RATE`` of the tokens: then
   the scale is solved for that share.  So a tiny source doesn't set the rate of the others.

Shares are relative; those of values that don't occur are left out and the others keep their
proportions.  Values without a target keep together the part of the tokens that they have, and the
targets share the rest.  Without given targets, sources get shares of the square root of their tokens (the hot
source shrinks), languages and topics keep what they have.

Defined cases: a null source or language counts as ``other``; a null or empty text has no tokens, its
document takes its cell's probability (1 if the whole cell has none); repeated rows draw equal
numbers; a null doc_id draws by the text alone; an empty table gives an empty result; other columns
pass through, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm.common import written

OTHER = "other"
DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 30
LEAST_RATE = 0.75

#: Topics by plain signs, first match counts.
TOPICS = (
    ("legal", r"(?i)\blicen[sc]ed?\b|all rights reserved|copyright"),
    ("contact", r"\w@\w|\d[ .-]\d\d\d[ .-]\d\d"),
    ("table", r" \| .* \| "),
    ("code", r"[{};]\n|\ndef |</\w"),
    ("numeric", r"\d\s+\d+\s+\d+\s+\d"),
)


def _has(text: Column, *parts: str) -> Column:
    out = F.contains(text, F.lit(parts[0]))
    for part in parts[1:]:
        out = out | F.contains(text, F.lit(part))
    return out


def topic(text: Column) -> Column:
    """The first topic whose pattern the text has; patterns run only where a plain part of them occurs."""
    signs = dict(TOPICS)
    found = {
        "legal": _has(F.lower(text), "licen", "all rights reserved", "copyright") & text.rlike(signs["legal"]),
        "contact": (_has(text, "@") & text.rlike(r"\w@\w")) | text.rlike(r"\d[ .-]\d\d\d[ .-]\d\d"),
        "table": _has(text, " | ") & text.rlike(signs["table"]),
        "code": _has(text, "{\n", "}\n", ";\n", "\ndef ") | (_has(text, "</") & text.rlike(r"</\w")),
        "numeric": text.rlike(signs["numeric"]),
    }
    out = F.lit("prose")
    for name in reversed(signs):
        out = F.when(found[name], name).otherwise(out)
    return F.coalesce(out, F.lit("prose"))


def token_count(text: Column) -> Column:
    """Words between ASCII white space, by counting the places where one begins."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _celled(docs: DataFrame) -> DataFrame:
    """One struct column for the document, so that no names clash, and its cell."""
    return docs.select(F.struct(*docs.columns).alias("doc"), topic(F.col("text")).alias("topic"), token_count(F.col("text")).alias("tokens"),
                       *(F.coalesce(F.col(d).cast("string"), F.lit(OTHER)).alias(d) for d in DIMENSIONS[:2]))


def _cells(celled: DataFrame, targets: dict[str, dict[str, float]] | None) -> DataFrame:
    named = celled
    for d in DIMENSIONS if targets is not None else ():
        named = named.withColumn(d, F.when(F.col(d).isin(list(targets[d])), F.col(d)).otherwise(F.lit(OTHER)))
    return named


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table that is part of the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _numbers(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _wanted(has: dict[str, float], shares: dict[str, float] | None) -> dict[str, float]:
    """The shares that the values are fitted to, 1 in sum: what has no target keeps its part of the tokens."""
    total = sum(has.values())
    own = {v: float(shares[v]) for v in has if v in shares} if shares is not None else {}
    kept = {v: t / total for v, t in has.items() if v not in own}
    left, given = 1.0 - sum(kept.values()) if own else 0.0, sum(own.values())
    return kept | {v: s * left / given if given else 0.0 for v, s in own.items()}


def raked(cells: DataFrame, targets: dict[str, dict[str, float]] | None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with tokens, and ``factor``, their calibrated weight.

    The cells lie in one row a source.  A weight is its tokens times a factor of the source, which follows
    in the row from those of languages and topics, and one of the pair of language and topic.  So a
    round is one grouped sum by pair; the driver holds the pairs, never the sources.
    """
    spark = cells.sparkSession
    cells = cells.where("tokens > 0")
    pairs = sorted((r.lang, r.topic, r.t) for r in cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("t")).collect())
    total = sum(t for *_, t in pairs)
    if not pairs:
        return cells.select(*DIMENSIONS, "tokens", F.lit(1.0).alias("factor"))
    numbered = _rows(spark, [{"lang": a, "topic": b, "k": k} for k, (a, b, _) in enumerate(pairs)], "lang string, topic string, k int")
    sources = cells.join(numbered, ["lang", "topic"]).groupBy("source").agg(
        F.sum("tokens").alias("t"), F.sort_array(F.collect_list(F.struct("k", "tokens"))).alias("cells"))
    if targets is None:
        roots = sources.agg(F.sum(F.sqrt("t"))).first()[0]
        sources = sources.withColumn("share", F.sqrt("t") / F.lit(roots))
    else:  # as many sources as targets, and ``other``
        has = {r.source: r.t for r in sources.select("source", "t").collect()}
        wanted = _wanted(has, targets["source"])
        sources = sources.join(_rows(spark, [{"source": v, "share": x} for v, x in wanted.items()], "source string, share double"), "source")
    sources = written(sources, "mixing-sources")

    def with_factor(g: list[float]) -> DataFrame:
        base = F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["tokens"] * F.get(_numbers(g), c["k"]))
        return sources.select("source", F.when(base > 0, F.col("share") / base).otherwise(0.0).alias("f"), "cells")

    fitted = [(0, _by(pairs, 0), None if targets is None else targets["lang"]), (1, _by(pairs, 1), None if targets is None else targets["topic"])]
    fitted = [(i, _wanted(has, shares)) for i, has, shares in fitted]
    after = [1.0 / total] * len(pairs)
    for _ in range(rounds):
        before = after
        sums = {r.k: r.w for r in with_factor(before).select("f", F.inline("cells")).groupBy("k").agg(F.sum(F.col("tokens") * F.col("f")).alias("w")).collect()}
        for i, wanted in fitted:
            now = _by([(a, b, sums[k] * after[k]) for k, (a, b, _) in enumerate(pairs)], i)
            after = [g * wanted[p[i]] / now[p[i]] if now[p[i]] > 0 else 0.0 for g, p in zip(after, pairs, strict=True)]
        if all(abs(x - y) <= 1e-14 * y for x, y in zip(after, before, strict=True)):
            break
    return (with_factor(before).select("source", "f", F.inline("cells")).join(numbered, "k")
            .select(*DIMENSIONS, "tokens", (F.col("f") * F.get(_numbers(after), F.col("k")) * F.lit(float(total))).alias("factor")))


def _by(pairs: list[tuple[str, str, float]], i: int) -> dict[str, float]:
    sums = dict.fromkeys((p[i] for p in pairs), 0.0)
    for p in pairs:
        sums[p[i]] += p[2]
    return sums


def scale(factors: DataFrame, rate: float | None = None) -> float:
    """The number with which ``sum(tokens * min(1, number * factor))`` is the share ``rate`` of all tokens.

    Newton's method on this concave function: it starts below, and each step counts the cells that
    the last one saturated as whole.  It ends when no further cell saturates.
    """
    weighted = F.col("tokens") * F.col("factor")
    some = factors.agg(F.sum("tokens").alias("tokens"), F.sum(F.when(F.col("factor") > 0, F.col("tokens"))).alias("reachable"),
                       F.sum(weighted).alias("weighted"), F.max("factor").alias("top"),
                       F.min(F.when(F.col("factor") > 0, F.col("factor"))).alias("low")).first()
    if not some.top:
        return 1.0
    budget = (LEAST_RATE if rate is None else rate) * some.tokens
    if budget >= some.reachable:
        return 1.0 / some.low
    number = budget / some.weighted
    while True:
        whole = F.lit(number) * F.col("factor") >= 1.0
        now = factors.agg(F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("whole"), F.sum(F.when(whole, 0.0).otherwise(weighted)).alias("rest")).first()
        after = (budget - now.whole) / now.rest if now.rest > 0 else number
        if after <= number * (1 + 1e-12):
            return number if rate is not None else max(number, 1.0 / some.top)
        number = after


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, *, rate: float | None = None, rounds: int = ROUNDS, seed: int = 17) -> DataFrame:
    """Every document as ``doc`` with its cell, ``tokens``, ``factor``, ``probability``, ``sampled``."""
    celled = _celled(docs)
    sums = written(celled.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mixing-sums")
    named = _cells(celled, targets)
    cells = _cells(sums, targets).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    factors = written(raked(cells, targets, rounds), "mixing-factors")
    factors = factors.select(*DIMENSIONS, "factor", F.least(F.lit(1.0), F.lit(scale(factors, rate)) * F.col("factor")).alias("probability"))
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc.doc_id"), F.col("doc.text")), 11) * F.lit(2.0**-53))
    return (named.join(factors, list(DIMENSIONS), "left")
            .select("doc", *DIMENSIONS, "tokens", F.coalesce("factor", F.lit(1.0)).alias("factor"),
                    F.coalesce("probability", F.lit(1.0)).alias("probability"),
                    (uniform < F.coalesce("probability", F.lit(1.0))).alias("sampled")))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, **options) -> DataFrame:
    """The sampled documents, all columns."""
    return mixed(docs, targets, **options).where("sampled").select("doc.*")
