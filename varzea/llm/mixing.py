"""Operator 4: soft-membership mixing to target weights, in DataFrame functions only.

Domains are what the labels table marks: `clean` (quality 1, not toxic), `junk` (quality 0) and `toxic` (quality 1,
toxic). A naive Bayes classifier over the presence of words and of binned shape features is counted with SQL
aggregates on a bounded sample of labelled rows (`max_train`, chosen by a hash of doc_id); features whose presence says
little about the domain (chi-square under MIN_CHI2) are left out, and the MAX_FEATURES that say most are the model. It gives every document posteriors q_dk.

Rates r_d >= 0 then minimise the squared distance of the totals sum_d r_d t_d q_dk from T_k, where t_d are a document's words and T_k the
target totals, by projected gradient: each round aggregates the expected totals of all documents (a few numbers reach
the driver) and every document's rate follows from the residuals so far, r <- clip(r - sum_k q_dk e_k), starting
from 1 (e is the scaled residual, see fit_rates). Rates have no upper bound unless `max_rate` is given. Targets that no rates
reach, be it for such a bound or since all posteriors are soft, are come as near to as possible, and the driver logs the distance.

Defined cases: null text has no words, prior posteriors and a rate without effect; domains without labelled rows have
posterior 0, and a domain whose expected words are exactly 0 cannot have its target: the other targets are scaled up; without any labels all rates are 1 and the
posteriors null; an empty table gives an empty result; repeated rows get equal rates; other columns pass through,
those that have the name of a result are replaced by it.
"""

from __future__ import annotations

import logging
import math
import sys

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import bounded_sample, hide, materialize, show, table

DOMAINS = ("clean", "junk", "toxic")
TARGETS = {"clean": 0.78, "junk": 0.06, "toxic": 0.16}
MAX_TRAIN, MIN_DF, MIN_CHI2, MAX_FEATURES = 20_000, 5, 25.0, 300
EVIDENCE = 12
MADE = ["n_tokens", *(f"p_{k}" for k in DOMAINS), "rate"]
STEP, ROUNDS, TOLERANCE = 0.9, 30, 1e-4
MIN_MASS = sys.float_info.min  # the least share of words above zero: only a domain without any has no target


def domain(quality: Column, toxic: Column) -> Column:
    return F.when(quality == 0, "junk").when((quality == 1) & (toxic == 1), "toxic").when(quality == 1, "clean")


def features(docs: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Add n_tokens and the array `found` of distinct features, of those in `only` if given; drops text. Features are words, and bins of shape measures."""
    rest = [c for c in docs.columns if c not in ("text", "n_tokens", "found")]
    d = docs.select(*rest, F.coalesce("text", F.lit("")).alias("_t"))
    d = d.withColumn("_w", F.filter(F.split(F.lower("_t"), r"[\x09-\x0D ,.;:]+"), lambda w: w != ""))
    d = d.withColumn("_low", F.translate("_t", "abcdefghijklmnopqrstuvwxyz ", ""))
    n, words = F.length("_t"), F.size("_w")
    share = lambda part: F.floor(F.coalesce(part * 20 / F.nullif(n, F.lit(0)), F.lit(0.0))).cast("string")
    without = lambda chars: F.length("_low") - F.length(F.translate("_low", chars, ""))
    shapes = {
        "symbols": share(without("#*$%&|<>!")),
        "capitals": share(without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        "word length": F.least(F.lit(30), F.floor(F.coalesce(n / F.nullif(words, F.lit(0)), F.lit(0.0)))).cast("string"),
        "size": F.least(F.lit(20), F.floor(F.log2(words + 1))).cast("string"),
    }
    shape = F.array(*(F.concat(F.lit(f" {k} "), v) for k, v in shapes.items()))  # a blank starts no word
    if only is not None:
        pick = lambda a: F.filter(a, lambda w: w.isin(only)) if only else F.array().cast("array<string>")
        found = F.concat(F.array_distinct(pick(F.col("_w"))), pick(shape))
    else:
        found = F.concat(F.array_distinct("_w"), shape)
    return d.select(*rest, words.cast("long").alias("n_tokens"), found.alias("found"))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> dict | None:
    """{"prior": log priors, "weights": {feature: log likelihood ratios of its presence}}, or None without labelled rows."""
    named = labels.groupBy("doc_id").agg(domain(F.max("quality"), F.max("toxic")).alias("domain")).filter("domain IS NOT NULL AND doc_id IS NOT NULL")
    sample = materialize(bounded_sample(named, "doc_id", max_train), "labelled")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by max_train
    found = materialize(features(rows), "features")
    n = {r["domain"]: r["n"] for r in found.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    if not total:
        return None
    per = found.select("domain", F.explode("found").alias("f")).groupBy("f").agg(F.count("*").alias("df"), *(F.count(F.when(F.col("domain") == k, 1)).alias(k) for k in DOMAINS))
    expect = lambda k: F.col("df") * F.lit(n.get(k, 0) / total)
    chi2 = sum(((F.col(k) - expect(k)) ** 2 / expect(k) for k in DOMAINS if n.get(k)), F.lit(0.0))
    best = per.filter(F.col("df") >= MIN_DF).withColumn("chi2", chi2).filter(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "f").limit(MAX_FEATURES).collect()
    ratio = lambda r, k: (r[k] + 0.5) / (n.get(k, 0) + 1) / ((r["df"] + 0.5) / (total + 1))
    weights = {r["f"]: [max(-3.0, min(3.0, math.log(ratio(r, k)))) for k in DOMAINS] for r in best}
    return {"prior": [math.log(n[k] / total) if n.get(k) else -math.inf for k in DOMAINS], "weights": weights}


def posteriors(docs: DataFrame, model: dict) -> DataFrame:
    """Add n_tokens and the array q of domain posteriors; drops text."""
    keys = sorted(model["weights"])
    places = F.array(*map(F.lit, keys)) if keys else F.array(F.lit(""))
    d = features(docs, keys).withColumn("_hit", F.transform("found", lambda f: F.array_position(places, f).cast("int"))).drop("found")
    for i in range(len(DOMAINS)):
        values = F.array(*(F.lit(float(round(model["weights"][k][i], 6))) for k in keys)) if keys else F.array(F.lit(0.0))
        d = d.withColumn(f"_z{i}", _sum("_hit", values, model["prior"][i]))
    top = F.greatest(*(F.col(f"_z{i}") for i in range(len(DOMAINS))))
    e = [F.exp(F.col(f"_z{i}") - top) for i in range(len(DOMAINS))]
    total = sum(e[1:], e[0])
    return d.withColumn("q", F.array(*(x / total for x in e))).drop("_hit", *(f"_z{i}" for i in range(len(DOMAINS))))


def _sum(hits: str, values: Column, start: float) -> Column:
    """The prior plus the evidence; that of more than EVIDENCE features is averaged down, since words are not independent."""
    total = F.aggregate(hits, F.lit(0.0), lambda a, i: a + F.element_at(values, i))
    return F.lit(float(start)) + total * F.lit(float(EVIDENCE)) / F.greatest(F.size(hits), F.lit(EVIDENCE))


def rate_column(history: list[list[float]], max_rate: float | None) -> Column:
    """The rate after all steps so far, from the residuals of each round."""
    r = F.lit(1.0)
    if not history:
        return r
    steps = F.expr("array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in g) + ")" for g in history) + ")")
    moved = lambda a, g: a - sum((F.get("q", F.lit(k)) * F.get(g, F.lit(k)) for k in range(len(DOMAINS))), F.lit(0.0))
    bound = lambda x: x if max_rate is None else F.least(F.lit(float(max_rate)), x)
    return F.aggregate(steps, r, lambda a, g: bound(F.greatest(F.lit(0.0), moved(a, g))))


def fit_rates(soft: DataFrame, targets: dict[str, float], max_rate: float | None = None) -> list[list[float]]:
    """Steps of the projected gradient over a table with n_tokens and q, K numbers a round.

    The distance is measured in the metric of the inverse Gram matrix of the documents whose rate is inside its bounds
    (sum of t q q^T), in which the gradient step has length 1 and domains of any size close in alike.
    """
    k_all = range(len(DOMAINS))
    t = F.col("n_tokens").cast("double")
    q = [F.get("q", F.lit(k)) for k in k_all]
    # A rate depends on q alone, so documents of equal posteriors count as one.
    alike = materialize(soft.groupBy("q").agg(F.sum("n_tokens").alias("n_tokens")), "alike")

    def totals(history):
        r, inside = F.col("_r"), (F.col("_r") > 0) & (F.lit(max_rate is None) | (F.col("_r") < F.lit(max_rate)))
        sums = [F.sum(t).alias("all"), *(F.sum(r * t * x).alias(f"m{k}") for k, x in enumerate(q))]
        sums += [F.sum(F.when(inside, t * q[i] * q[j])).alias(f"g{i}{j}") for i in k_all for j in k_all if i <= j]
        return alike.withColumn("_r", rate_column(history, max_rate)).agg(*sums).first()

    history: list[list[float]] = []
    want, last = None, math.inf
    while True:
        row = totals(history)
        if not row["all"]:
            return []
        mass = np.array([row[f"m{k}"] for k in k_all]) / row["all"]
        gram = np.array([[row[f"g{min(i, j)}{max(i, j)}"] or 0.0 for j in k_all] for i in k_all]) / row["all"]
        if want is None:
            want = np.array([targets.get(name, 0.0) if m >= MIN_MASS else 0.0 for name, m in zip(DOMAINS, mass)])
            want /= want.sum() or 1.0
        off = mass - want
        distance = float(np.abs(off).max())
        if distance < TOLERANCE or len(history) >= ROUNDS or abs(last - distance) < TOLERANCE / 100:
            if distance >= 10 * TOLERANCE:
                logging.getLogger(__name__).warning("targets are missed by %.4f of all words: %s", distance, dict(zip(DOMAINS, off.round(4).tolist())))
            return history
        last = distance
        step = STEP * np.linalg.solve(gram + np.eye(len(DOMAINS)) * max(1e-9, 1e-4 * np.trace(gram)), off)
        history.append([float(x) for x in step])


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, max_rate: float | None = None) -> DataFrame:
    """The documents without text, with n_tokens, p_<domain> and rate."""
    docs, names = hide(docs, "doc_id", "text")
    own = show(names, "text", *MADE)
    model = fit(docs, labels)
    if model is None:
        none = F.lit(None).cast("double")
        return features(docs).select(*own, "n_tokens", *(none.alias(f"p_{k}") for k in DOMAINS), F.lit(1.0).alias("rate"))
    soft = materialize(posteriors(docs, model), "posteriors")
    history = fit_rates(soft, targets or TARGETS, max_rate)
    made = {f"p_{k}": F.get("q", F.lit(i)) for i, k in enumerate(DOMAINS)} | {"rate": rate_column(history, max_rate)}
    return soft.withColumns(made).select(*own, *MADE)


def apply_mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents at their rates: all columns, n_tokens, p_<domain>, rate, and copies, a whole number of expectation
    rate that follows from the document's values. Documents of rate 0 are left out."""
    hidden, names = hide(docs, "doc_id", "text")
    mixed = mix(hidden.withColumn("_text", F.col("text")), labels).withColumnRenamed("_text", "text")
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("copies")), F.lit(1_000_000)) / 1_000_000
    return mixed.filter("rate > 0").select(*show(names, *MADE, "copies"), *MADE, F.floor(F.col("rate") + draw).cast("int").alias("copies"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mix(docs, table(spark, sf_dir, "labels")).select("doc_id", "n_tokens", *(f"p_{k}" for k in DOMAINS), "rate")
