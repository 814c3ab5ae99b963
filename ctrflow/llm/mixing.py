"""Mixing documents to target weights of domains, with soft membership.

A naive Bayes classifier of telling words, fitted on a labelled table, gives each document a probability of every domain. Rates
r >= 0 of documents (how often each is taken, in expectation) are fitted so that the expected tokens of
each domain, sum of r w p_k, match their targets: least squares by projected gradient, in which a step needs
one sum per domain over all documents and moves each document by its own probabilities. The few domains'
gradients are scaled by the inverse of the matrix of second moments of p, which makes one step exact where no rate meets
its bounds; a step that does not help is taken back and plain ones follow. Everything is DataFrame expressions and grouped sums.
"""

from __future__ import annotations

import json
import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.common import Scratch

#: Hashed words; labelled rows the classifier is fitted on at most (drawn by a hash of the id).
BUCKETS, MAX_ROWS = 1 << 14, 8_000
#: Weight of the words' log likelihood, since words are not independent.
TEMPER = 0.5
#: Counts added to found and expected ones, per fitted row and at least; log ratio of the two below which a word says nothing. Words that merely go with the
#: language or topic of a domain lie below it; summed over a long text they would outweigh the words that matter.
DAMP, LEAST_DAMP, LEAST_RATIO = 1 / 800, 0.5, math.log(3)
#: Steps of the gradient at most, steps between staged tables, and the relative error that ends them.
STEPS, STAGED, TOLERANCE = 40, 8, 1e-4


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


@dataclass
class DomainModel:
    """Log ratio of each hashed word in each domain against all, zero for most, and log probability of each domain."""

    domains: list[str]
    words: list[list[float]]
    priors: list[float]

    def posteriors(self, text: Column) -> tuple[Column, Column]:
        """(number of words, array of the probability of each domain) of a text.

        Null and empty texts have the probabilities of the domains alone.
        """
        weights = [F.from_json(F.lit(json.dumps(w)), "array<double>") for w in self.words]
        names = [f"d{i}" for i in range(len(self.domains))]
        zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(n) for n in names])

        def add(sums: Column, word: Column) -> Column:
            return F.struct((sums["n"] + 1).alias("n"), *[
                (sums[n] + F.get(w, bucket(word))).alias(n) for n, w in zip(names, weights)])

        def finish(sums: Column) -> Column:
            scores = F.array(*[F.lit(p) + TEMPER * sums[n] for n, p in zip(names, self.priors)])
            return F.struct(sums["n"].alias("n"), scores.alias("scores"))

        sums = F.aggregate(words(text), zero, add, finish)
        return sums["n"], sums["scores"]


def normalised(scores: str) -> Column:
    """Probabilities from a column of log scores."""
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def fit_domains(
    df: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text", label_col: str = "domain",
    max_rows: int = MAX_ROWS,
) -> DomainModel:
    """A classifier of ``domains`` from at most about ``max_rows`` labelled rows; other labels and nulls are left out.

    A domain without rows has the probability of its prior alone.
    """
    rows = df.where(F.col(label_col).isin(domains)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("domain"))
    share = min(1.0, max_rows / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 30)) <= int(share * (1 << 30)))
    one = rows.select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    counts: dict[str, dict[int, int]] = {d: {} for d in domains}
    for r in one.groupBy("domain", bucket(F.col("word")).alias("bucket")).count().collect():  # at most domains x BUCKETS
        counts[r["domain"]][r["bucket"]] = r["count"]
    n_rows = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    whole = np.zeros((len(domains), BUCKETS))
    for i, d in enumerate(domains):
        whole[i, list(counts[d])] = list(counts[d].values())
    expected = whole.sum(axis=1, keepdims=True) * whole.sum(axis=0) / max(1.0, whole.sum())
    damp = max(LEAST_DAMP, DAMP * sum(n_rows.values()))
    ratio = np.log((whole + damp) / (expected + damp))
    table = np.where(np.abs(ratio) >= LEAST_RATIO, ratio, 0.0).round(4).tolist()
    all_rows = sum(n_rows.values()) + len(domains)
    return DomainModel(domains, table, [math.log((n_rows.get(d, 0) + 1) / all_rows) for d in domains])


def fit_rates(
    df: DataFrame, model: DomainModel, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
    anchor: str | None = None, highest: float = 1.0, steps: int = STEPS,
) -> DataFrame:
    """(id, n_tokens, p_<domain> ..., rate) for every row.

    ``targets`` are the wanted shares of the domains' tokens (they are scaled to sum to one). The wanted number of tokens is the one
    at which the domain ``anchor`` is taken once, or without it the largest for which no domain needs more tokens than it has.
    Rates lie between 0 and ``highest``; targets out of reach are approached to about a percent of the least squares,
    where three steps in a row gain less than a thousandth. After ``steps`` steps the best rates so far are returned, with a warning
    in the log that says how far off they are; targets near the edge of what can be reached need more.
    Rows without words weigh nothing; their rate follows from their probabilities all the same. Null and repeated ids are kept.
    Other columns are not looked at. An empty table gives no rows.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    names = [f"p_{d}" for d in model.domains]
    n, scores = model.posteriors(F.col(text_col).cast("string"))
    scored = df.select(F.col(id_col), n.alias("n_tokens"), scores.alias("scores"))
    p = scored.select(id_col, "n_tokens", normalised("scores").alias("p"))
    rows = p.select(id_col, "n_tokens", *[F.col("p")[i].alias(c) for i, c in enumerate(names)], F.lit(1.0).alias("rate"))
    rows = scratch.stage(rows, "rates-0")

    def sums(frame: DataFrame, *of: Column) -> list[float]:
        return [x or 0.0 for x in frame.agg(*[F.sum(c) for c in of]).first()]

    w = F.col("n_tokens")
    tokens, *mass = sums(rows, w.cast("double"), *[w * F.col(c) for c in names])
    tokens = max(tokens, 1.0)
    share = {d: targets.get(d, 0.0) / sum(targets.values()) for d in model.domains}
    wanted = [m / share[d] for d, m in zip(model.domains, mass) if share[d] > 0 and anchor in (None, d)]
    goal = np.array([share[d] for d in model.domains]) * min(wanted, default=0.0) / tokens
    k = len(names)
    moments = sums(rows, *[w * F.col(a) * F.col(b) / tokens for a in names for b in names])
    moments = np.array(moments).reshape(k, k)
    # The largest row sum bounds the largest eigenvalue; its inverse is a step that cannot overshoot.
    plain = np.eye(k) / max(moments.sum(axis=1).max(), 1e-9)
    scaled = np.linalg.inv(moments + 1e-6 * np.eye(k))
    frame, rate = rows, F.col("rate")
    best, best_off, value = rows, None, math.inf
    reach, fast, depth, best_depth, still = 1.0, True, 0, 0, 0
    for i in range(1, steps + 1):
        off = np.array(sums(frame, *[w * F.col(c) * rate / tokens for c in names])) - goal
        now = float(off @ off)
        if now < value:
            still = still + 1 if now > 0.999 * value else 0
            best, best_off, value, best_depth = frame, off, now, depth
            # After a step that helped the plain ones reach further, and the scaled one is tried anew from time to time.
            reach, fast = (reach, True) if fast else (2 * reach, i % 4 == 0)
        else:
            # Back to the best rates; a plain step of reach one cannot fail, unless these are the best there are.
            still = still + 1 if not fast and reach <= 1 else still
            reach, fast = (reach, False) if fast else (max(1.0, reach / 4), False)
        if float(np.abs(best_off).max()) <= TOLERANCE * max(goal.sum(), 1e-9) or still > 2:
            break
        if best_depth >= STAGED:
            best, best_depth = scratch.stage(best, f"rates-{i}"), 0
        move = (scaled if fast else reach * plain) @ best_off
        change = sum((F.col(c) * float(x) for c, x in zip(names, move)), F.lit(0.0))
        frame, depth = best.withColumn("rate", F.least(F.greatest(rate - change, F.lit(0.0)), F.lit(float(highest)))), best_depth + 1
    else:
        logging.getLogger(__name__).warning("after %d steps the rates are %s of all tokens off the targets", steps, best_off)
    return best


def taken(rate: Column, key: Column) -> Column:
    """How many copies a row of that rate gets: the whole part, and one more with the probability of the rest, decided
    by a hash of its key. Rates within one percent of a whole number are taken for it."""
    whole = F.round(rate)
    rate = F.when(F.abs(rate - whole) <= 0.01, whole).otherwise(rate)
    rest = F.pmod(F.xxhash64(key, F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (rest < rate - F.floor(rate)).cast("int")).cast("int")
