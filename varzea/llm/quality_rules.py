"""Operator 3: quality rules by distribution divergence, in DataFrame functions only.

Each text's histogram of character classes and of common words is compared with its language's reference by the
Jensen-Shannon distance (base 2, 0 to 1). The references are gathered from all documents: every text that passes the
base rules adds its *share* of each bin once, so one very long text does not outweigh the others. Characters are compared
with the language's mean and with that mean drawn towards the mean of all texts (which counts as PRIOR_TEXTS texts); the
smaller distance is the text's, so a language of few texts is judged mildly and no number of texts switches the method.

Defined cases: a null text has no words and fails the base rule; a null language, and one without a text that passes the
base rule, has no reference, and its texts are judged by the base rule alone; a language without a list of common words, and
a text under MIN_WORDS_FOR_WORDS words, is judged by its characters alone; repeated rows are judged alike, one output row for each
input row; further columns pass through, those that have the name of a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import hide, materialize, show, table

# Twelve frequent function words of four languages, each a bin of the common-word histogram.
COMMON = {
    "en": "the of and to in a is that for it as with",
    "fr": "de la le et les des en un du une que est",
    "de": "der die und in den von zu das mit sich ist ein",
    "es": "de la que el en y los se del las un por",
}
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
#: words that a document of the pipeline needs
STAGE_MIN_WORDS = 1
#: guards and limits of the divergence rules
PRIOR_TEXTS, MIN_CHARS, MIN_WORDS_FOR_WORDS = 50, 200, 100
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.55
#: a text that is past both of these is rejected too: the two histograms together tell lists and tables from prose
BOTH_CHAR_DISTANCE, BOTH_WORD_DISTANCE = 0.13, 0.24
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SPACES, STOPS, SYMBOLS = " \t\n\x0b\f\r", ".,;:!?", "#*$%&|<>"
MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_share", "word_share", "char_distance", "word_distance", "kept"]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_stats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Add the base rule's counts, `base_failed`, and the share arrays `char_share` and `word_share`."""
    keep = [c for c in docs.columns if c not in (*STATS, "base_failed", "char_share", "word_share") and (keep_text or c != "text")]
    d = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_t"))
    d = d.withColumn("_w", F.regexp_extract_all("_t", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    # Each class is taken out of what the class before has left, so later passes read short strings.
    left = "_t"
    for name, chars in (("lower", LOWER), ("space", SPACES), ("upper", UPPER), ("stop", STOPS), ("symbol", SYMBOLS), ("digit", DIGITS)):
        d = d.withColumn(f"_{name}", F.translate(left, chars, ""))
        left = f"_{name}"
    size = {n: F.length(f"_{n}").cast("long") for n in ("t", "lower", "space", "upper", "stop", "symbol", "digit")}
    order = list(size)
    counts = {b: size[a] - size[b] for a, b in zip(order, order[1:])} | {"rest": size["digit"]}
    d = d.withColumn("_chars", F.array(*(counts[k] for k in ("lower", "upper", "space", "stop", "symbol", "digit", "rest"))))
    d = d.withColumn("_h", F.expr("CASE WHEN n_words < 3 THEN array() ELSE transform(sequence(0, cast(n_words AS int) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) END"))
    d = d.withColumn("_s", F.expr("CASE WHEN size(array_distinct(_h)) = size(_h) THEN array() ELSE sort_array(transform(_h, (h, i) -> named_struct('h', h, 'i', i))) END"))
    d = d.withColumn("_p", F.expr("sort_array(transform(filter(_s, (x, k) -> (k > 0 AND get(_s, k - 1).h = x.h) OR coalesce(get(_s, k + 1).h = x.h, false)), x -> x.i))"))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    bins = F.create_map(*(y for k, v in COMMON.items() for y in (F.lit(k), F.array(*map(F.lit, v.split())))))
    every = sorted({w for v in COMMON.values() for w in v.split()})
    d = d.withColumn("_bins", F.try_element_at(bins, F.col("lang")) if "lang" in docs.columns else F.lit(None).cast("array<string>"))
    d = d.withColumn("_hits", F.filter("_w", lambda w: w.isin(every)))
    d = d.withColumn("_found", F.transform("_bins", lambda b: F.size(F.filter("_hits", lambda w: w == b)).cast("double")))
    total, found = F.length("_t").cast("double"), F.aggregate("_found", F.lit(0.0), lambda a, x: a + x)
    words = F.col("n_words").cast("double")
    return d.select(
        *keep,
        "n_words",
        (F.length("_t") - counts["space"]).cast("long").alias("word_chars"),
        counts["symbol"].alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("cast(aggregate(transform(_p, (p, k) -> least(3, coalesce(get(_p, k + 1) - p, 3))), 0, (a, x) -> a + x) AS long)").alias("n_repeat_words"),
        F.when(F.length("_t") > 0, F.transform("_chars", lambda x: x / total)).alias("char_share"),
        F.when(F.col("n_words") > 0, F.concat(F.transform("_found", lambda x: x / words), F.array((words - found) / words))).alias("word_share"),
    ).withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"))


def mean_shares(bins: int, column: str):
    return F.array(*(F.avg(F.get(column, F.lit(i))) for i in range(bins)))


def references(stats: DataFrame) -> DataFrame:
    """Per language, and for all texts under the null language: the mean shares of the texts that pass the base rule, and their number."""
    good = stats.filter(~F.col("base_failed"))
    made = [mean_shares(7, "char_share").alias("char_ref"), mean_shares(13, "word_share").alias("word_ref"), F.count("*").alias("n_ref")]
    by_lang = good.filter(F.col("lang").isNotNull()).groupBy("lang").agg(*made)
    return by_lang.unionByName(good.agg(*made).select(F.lit(None).cast("string").alias("lang"), "char_ref", "word_ref", "n_ref"))


def js_distance(p: str, q: str):
    """Square root of the Jensen-Shannon divergence in bits; null where a side is null."""
    part = f"coalesce(aggregate(zip_with({p}, {q}, (a, b) -> CASE WHEN a > 0 THEN a * log2(2 * a / (a + b)) ELSE 0D END + CASE WHEN b > 0 THEN b * log2(2 * b / (a + b)) ELSE 0D END), 0D, (s, x) -> s + x), NULL)"
    return F.expr(f"sqrt(greatest(0D, 0.5D * {part}))")


def judge(docs: DataFrame, keep_text: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """Add the counts, base_failed, char_distance, word_distance and kept to every document. `min_words` is the
    verdict's own limit, base_failed keeps that of the base rule.

    The counts are written once with the documents (less their texts unless `keep_text`), since the verdict needs the
    references of all of them first.
    """
    docs, names = hide(docs, "text", "lang")
    stats = materialize(with_stats(docs.withColumn("lang", F.col("lang").cast("string")), keep_text), "quality")
    refs = materialize(references(stats), "references")
    some = refs.filter(F.col("lang").isNotNull())
    if some.count() <= 10_000:  # a row for each language
        some = F.broadcast(some)
    whole = refs.filter(F.col("lang").isNull()).first()["char_ref"]  # the one row of all languages: seven shares, null without texts
    d = stats.join(some, "lang", "left")
    drawn = [(F.get("char_ref", F.lit(i)) * F.col("n_ref") + F.lit(x).cast("double") * PRIOR_TEXTS) / (F.col("n_ref") + PRIOR_TEXTS) for i, x in enumerate(whole)]
    d = d.withColumn("drawn_ref", F.when(F.col("n_ref").isNotNull(), F.array(*drawn)))
    d = d.withColumn("char_distance", F.least(js_distance("char_share", "char_ref"), js_distance("char_share", "drawn_ref"))).withColumn("word_distance", js_distance("word_share", "word_ref"))
    verdict = F.expr(
        f"NOT (n_words < {min_words} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AND NOT (word_chars >= {MIN_CHARS} AND coalesce(char_distance > {MAX_CHAR_DISTANCE}, false))"
        f" AND NOT (n_words >= {MIN_WORDS_FOR_WORDS} AND (coalesce(word_distance > {MAX_WORD_DISTANCE}, false)"
        f" OR coalesce(char_distance > {BOTH_CHAR_DISTANCE} AND word_distance > {BOTH_WORD_DISTANCE}, false)))"
    )
    return d.withColumn("kept", verdict).select(*show(names, *MADE, *([] if keep_text else ["text"])), *MADE)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns. A short text is no reason to go here: only wordless ones fail
    by their length, since a text's shape says nothing of its quality below the guards of the divergence rules."""
    hidden, names = hide(docs, "text", "lang")
    return judge(hidden, min_words=STAGE_MIN_WORDS).filter("kept").select(*show(names))


def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, keep_text=False).select("doc_id", *STATS, "base_failed", "kept")
