"""Operator 8: quality by hierarchical empirical Bayes.

A document classifier (logistic regression on surface statistics, fitted on a bounded
sample of labelled rows) gives each document evidence.  Hosts (``levels[0]``) and paths
within hosts (``levels[1]``, ...) have their own base rates: a level's rate is the mean
evidence of its *other* documents, shrunk toward its parent's rate with a strength
estimated by moments from how much sites really differ.  Sparse sites therefore follow the
global prior, large ones speak for themselves.  The document's posterior moves its evidence
from the global base rate to that of its path.

All statistics are grouped sums over all documents (partially summed before the shuffle, so
a host with a third of the rows is no hot task); only the model's few coefficients and one
row of moments per level reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import table, text_or_empty

MAX_LABELLED = 50_000
THRESHOLD = 0.5
_SYMBOLS = "&$#*%|!^~<>{}[]=+_@\\/"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1)).cast("double")


def _without(text: Column, chars: str) -> Column:
    """Length of the text without the given characters."""
    return F.char_length(F.translate(text, chars, ""))


def features(text_col: str) -> dict[str, Column]:
    """Surface statistics of the whole text, each in a range of about 0 to 1 (null: empty)."""
    t = text_or_empty(text_col)
    chars = F.char_length(t)
    words = F.transform(F.array(F.split(t, r"[\x20\x09-\x0D]+")), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    lines = F.transform(F.array(F.split(t, "\n")), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    symbols, upper = chars - _without(t, _SYMBOLS), chars - _without(t, _UPPER)
    digits = chars - _without(t, "0123456789")
    return {
        "symbols": _share(symbols, chars), "upper": _share(upper, chars), "digits": _share(digits, chars),
        "any_symbols": F.least(F.lit(1.0), 20 * _share(symbols, chars)),
        "many_upper": F.least(F.lit(1.0), 5 * _share(upper, chars)),
        "distinct": _share(words.d, words.n), "few_distinct": F.greatest(F.lit(0.0), 0.5 - _share(words.d, words.n)),
        "lines": _share(lines.d, lines.n),
        "word_length": F.least(F.lit(1.0), _share(chars, words.n) / 20.0),
        "log_words": F.log1p(words.n.cast("double")) / 12.0,
        "distinct_long": (1 - _share(words.d, words.n)) * F.log1p(words.n.cast("double")) / 12.0,
    }


def _logit(p: Column) -> Column:
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(q / (1 - q))


def bounded(sample: DataFrame, names: list[str], label: str, most: int) -> DataFrame:
    """(label, __q_w, names): one row per id and features with the number of rows that it stands for,
    ``most`` rows at most (those of the least hash); a labelled id may be on any number of rows."""
    rows = sample.groupBy("__q_doc", label, *names).agg(F.count(F.lit(1)).cast("double").alias("__q_w"))
    return rows.orderBy(F.xxhash64("__q_doc", *names)).limit(most).select(label, "__q_w", *names)


def fit(sample: DataFrame, names: list[str], label: str) -> tuple[list[float], float]:
    """Coefficients of a weighted ridge logistic regression by Newton steps; the sample is bounded."""
    t = sample.toPandas()
    y, n = t[label].to_numpy(float), t["__q_w"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return [0.0] * len(names), 0.0 if len(y) == 0 else (4.0 if y[0] > 0.5 else -4.0)
    x = t[names].to_numpy(float)
    mean = np.average(x, axis=0, weights=n)
    std = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=n)) + 1e-9
    z = np.hstack([(x - mean) / std, np.ones((len(x), 1))])
    w, ridge = np.zeros(z.shape[1]), np.append(np.full(len(names), 1.0), 1e-6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (n * (p - y)) + ridge * w
        hess = (z * (n * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    coef = w[:-1] / std
    return coef.tolist(), float(w[-1] - (coef * mean).sum())


def _strength(sites: DataFrame, n: str, s: str, rate: float) -> float:
    """Prior strength by moments: how much site means differ beyond binomial noise."""
    m = sites.where(F.col(n) > 1).agg(
        F.sum(n).alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - rate, 2)).alias("v")).first()
    noise = rate * (1 - rate)
    if not m["k"] or m["k"] < 2 or noise <= 0:
        return 100.0
    between = (m["v"] - m["k"] * noise) / m["n"]          # weighted variance of the true rates
    return float(min(1e6, max(1.0, noise / between - 1))) if between > noise * 1e-6 else 1e6


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          levels: tuple[str, ...] = ("source", "lang"), label_id: str = "doc_id",
          label_col: str = "quality", max_labelled: int = MAX_LABELLED,
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``evidence`` (the classifier's probability that the document is good),
    ``site_rate`` (its path's rate without the document), ``posterior`` and ``keep``.

    Null texts count as empty; null level values are sites of their own.  Labels that are
    null or of unknown ids are ignored, several of one id are averaged; at most
    ``max_labelled`` rows (by hash; rows alike in id and features are one with a weight) fit the
    classifier.  Without labels the
    evidence is 0.5 and everything is kept (``posterior >= threshold`` with threshold 0.5).
    Repeated rows get equal scores.  Columns named like a result are replaced, others kept;
    an empty table gives an empty result."""
    out = ("evidence", "site_rate", "posterior", "keep")
    base = docs.drop(*out)
    feats = features(text_col)
    names = [f"__q_{k}" for k in feats]
    cols = [f.alias(n) for n, f in zip(names, feats.values())]
    given = (labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull())
                   .groupBy(F.col(label_id).alias("__q_id")).agg(F.avg(label_col).alias("__q_y")))
    total = given.count()
    share = min(1.0, max_labelled / max(1, total))
    given = given.where(F.pmod(F.xxhash64("__q_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    light = table(base.select(F.col(id_col).alias("__q_doc"), *[F.col(c).alias(f"__q_l{i}") for i, c in enumerate(levels)], *cols))
    sample = light.join(given, F.col("__q_doc") == F.col("__q_id"))
    coef, bias = fit(bounded(sample, names, "__q_y", max_labelled), names, "__q_y")

    def evidence(exprs: list[Column]) -> Column:
        z = F.lit(bias)
        for c, e in zip(coef, exprs):
            z = z + F.lit(c) * e
        return 1 / (1 + F.exp(-z))

    lv = [f"__q_l{i}" for i in range(len(levels))]
    seen = light.select(*lv, evidence([F.col(n) for n in names]).alias("p"))
    sites = table(seen.groupBy(*lv).agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")))
    whole = sites.agg(F.sum("n"), F.sum("s")).first()
    rate = (whole[1] / whole[0]) if whole[0] else 0.5
    # one row per site with the sums and strengths of all levels above it
    stats, strengths = sites.withColumnRenamed("n", f"n{len(lv) - 1}").withColumnRenamed("s", f"s{len(lv) - 1}"), {}
    for d in range(len(lv)):
        at = sites.groupBy(*lv[:d + 1]).agg(F.sum("n").alias(f"n{d}"), F.sum("s").alias(f"s{d}"))
        strengths[d] = _strength(at, f"n{d}", f"s{d}", rate)
        if d < len(lv) - 1:
            on = [F.col(c).eqNullSafe(F.col(f"{c}_k")) for c in lv[:d + 1]]
            stats = stats.join(at.select(*[F.col(c).alias(f"{c}_k") for c in lv[:d + 1]], f"n{d}", f"s{d}"), on).drop(
                *[f"{c}_k" for c in lv[:d + 1]])
    stats = stats.select(*lv, F.struct(*[c for d in range(len(lv)) for c in (f"n{d}", f"s{d}")]).alias("__q_site"))
    rows = base.withColumn("__q_p", evidence(list(feats.values())))
    rows = rows.join(stats, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(levels, lv)])
    site = F.lit(rate)
    for d in range(len(lv)):
        n, s, k = F.col(f"__q_site.n{d}") - 1, F.col(f"__q_site.s{d}") - F.col("__q_p"), strengths[d]
        site = (F.greatest(s, F.lit(0.0)) + k * site) / (n + k)
    prior = math.log(max(rate, 1e-6) / max(1 - rate, 1e-6))
    rows = rows.withColumn("__q_rate", site)
    post = 1 / (1 + F.exp(-(_logit(F.col("__q_p")) + _logit(F.col("__q_rate")) - prior)))
    rows = rows.withColumn("__q_post", F.round(post, 9))
    return rows.select(*base.columns, F.col("__q_p").alias("evidence"), F.col("__q_rate").alias("site_rate"),
                       F.col("__q_post").alias("posterior"), (F.col("__q_post") >= threshold).alias("keep"))
