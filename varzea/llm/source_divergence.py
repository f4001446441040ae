"""How far the sources of a language differ in their use of words, and the words that mark a source.

Tasks count terms by language and source over whole texts; Spark adds the counts up and keeps the terms of a language that
are in LEAST_DOCS or more of its documents. The kept terms of a language are dealt by a hash into chunks. In a chunk the
sorted array of its terms is the dictionary: a term's id is its place there (searchsorted), a bincount over source * width +
id gives each source a dense vector, and since ids keep the order of UTF-8, ties fall in the right order by id. Chunks give
their part of each distance and each source's first terms; Spark adds the parts and ranks.

A share is 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)), computed in whole numbers (exact for up to 9e15 terms).
A chunk holds about CELLS counts whatever the number of sources, so a task's memory does not grow with the table; a word
that is in every document is one row for each source when it gets there, as tasks and Spark's partial sums add first.

Edge cases: a null text, lang or source is ''; a group without terms has the shares of its zero counts; a language
without kept terms has pairs of value 0 and no terms; repeated rows and null ids count as documents; columns other than
text, lang and source are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varzea.llm.common import LOWER, materialize, release, table

LEAST_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP = 50
CELLS = 2_000_000
WIDTH = 4096
ENTRIES, SLICE = 250_000, 500  # distinct terms that a task holds before it passes their counts on; texts that it takes up at once
SMALL = 100_000  # rows of a table that is broadcast

#: a maximal run of letters A-Z, a-z and characters beyond ASCII, in UTF-8 with A-Z lower-cased
TERM = re.compile(rb"[a-z\x80-\xff]+")
COUNTS = "lang string, source string, term string, n long, docs long"
PARTS = "lang string, source string, part string, item string, value long"


def count_terms(batches):
    """Rows of (lang, source, term, occurrences, documents), a term once for each stretch of ENTRIES distinct ones."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows():
        for (lang, source), (n, docs) in found.items():
            if n:
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                numbers = [pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms, *numbers], names=["lang", "source", "term", "n", "docs"])

    for part in (batch.slice(i, SLICE) for batch in batches for i in range(0, batch.num_rows, SLICE)):
        for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
            n, docs = found.setdefault((lang, source), (Counter(), Counter()))
            terms = TERM.findall(text.encode("utf-8").translate(LOWER))
            n.update(terms)
            docs.update(set(terms))
        if sum(1 + len(n) for n, _ in found.values()) > ENTRIES:
            yield from rows()
            found.clear()
    yield from rows()


def share(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), three decimal digits at a time, so that no product overflows."""
    rest, by, out = count + PRIOR, total + PRIOR * terms, np.zeros(np.broadcast(count, total).shape, dtype=np.int64)
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, by)
        out = out * 1000 + whole
    return 1 + out


def chunk_parts(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of a chunk's counts and its language's sources: parts of the distances of pairs, and the first TOP terms of each source."""
    schema = pa.schema([(c, pa.int64() if c == "value" else pa.string()) for c in ("lang", "source", "part", "item", "value")])
    if not left.num_rows:
        return schema.empty_table()
    utf8 = lambda t, c: np.array([x.encode("utf-8") for x in t.column(c).to_pylist()], dtype=object)
    number = lambda t, c: t.column(c).to_numpy().astype(np.int64)
    lang, v = right.column("lang")[0].as_py(), right.column("v")[0].as_py()
    names = utf8(right, "source")
    by = np.argsort(names)
    names, total = names[by], number(right, "n")[by]
    found, n = utf8(left, "term"), number(left, "n")
    terms = np.unique(found)
    cell = np.searchsorted(names, utf8(left, "source")) * len(terms) + np.searchsorted(terms, found)
    count = np.bincount(cell, weights=n, minlength=len(names) * len(terms)).astype(np.int64).reshape(len(names), -1)
    p, q = share(count, total[:, None], v), share(count.sum(0), np.int64(total.sum()), v)
    sources, parts, items, values = [], [], [], []

    def add(source: np.ndarray, part: str, item: np.ndarray, value: np.ndarray) -> None:
        sources.append(source)
        parts.append(np.full(len(item), part, dtype=object))
        items.append(item)
        values.append(value)

    for i in range(len(names)):
        if i + 1 < len(names):
            add(np.full(len(names) - i - 1, names[i], dtype=object), "pair", names[i + 1 :], np.abs(p[i + 1 :] - p[i]).sum(1))
        more = np.flatnonzero((count[i] > 0) & (p[i] > q))
        more = more[np.lexsort((more, q[more] - p[i, more]))[:TOP]]
        add(np.full(len(more), names[i], dtype=object), "term", terms[more], (p[i] - q)[more])
    text = lambda x: pa.array(np.concatenate(x).tolist(), pa.binary()).cast(pa.string())
    value = np.concatenate(values)
    return pa.Table.from_arrays([pa.array([lang] * len(value), pa.string()), text(sources), pa.array(np.concatenate(parts).tolist(), pa.string()), text(items), pa.array(value)], schema=schema)


def small(df: DataFrame) -> DataFrame:
    """To be broadcast if it has few rows; else Spark chooses."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of (lang, source, text): distances to the language's other sources, all ranks;
    the TOP terms that a source uses more than its language does."""
    plain = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = plain.mapInArrow(count_terms, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    kept = counts.withColumn("all_docs", F.sum("docs").over(of_term)).withColumn("first", F.min("source").over(of_term) == F.col("source"))
    kept = materialize(kept.filter(F.col("all_docs") >= least_docs).select("lang", "source", "term", "n", "first"), "kept-terms")

    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("first"))
    groups = plain.select("lang", "source").distinct().join(of_source, ["lang", "source"], "left")
    groups = groups.withColumn("v", F.coalesce(F.sum("first").over(Window.partitionBy("lang")), F.lit(0)))
    width = F.greatest(F.lit(64), F.least(F.lit(WIDTH), F.lit(CELLS) / F.count("*").over(Window.partitionBy("lang"))))
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), "v", F.ceil(F.col("v") / width).cast("int").alias("chunks"))
    groups = materialize(groups, "groups")

    langs = groups.filter("v > 0").groupBy("lang").agg(F.max("chunks").alias("chunks"))
    dealt = kept.join(small(langs), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
    beside = groups.filter("v > 0").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    dealt, beside = dealt.select("lang", "chunk", "source", "term", "n"), beside.select("lang", "chunk", "source", "n", "v")
    parts = materialize(dealt.groupBy("lang", "chunk").cogroup(beside.groupBy("lang", "chunk")).applyInArrow(chunk_parts, PARTS), "parts")

    one, other = groups.filter("v = 0").select("lang", "source"), groups.filter("v = 0").select("lang", F.col("source").alias("item"))
    zeros = one.join(other, "lang").filter("source <> item").selectExpr("lang", "source", "'pair' AS part", "item", "0L AS value")
    sums = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "part", "value", F.explode(F.expr("array(struct(source, item), struct(item AS source, source AS item))")).alias("x"))
    pairs = both.select("lang", "x.source", "part", "x.item", "value").unionByName(zeros)
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    terms = parts.filter("part = 'term'").withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= TOP)
    result = materialize(pairs.unionByName(terms), "divergence")
    for done in (kept, groups, parts):
        release(docs.sparkSession, done)
    return result


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
