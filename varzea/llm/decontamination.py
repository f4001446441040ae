"""Operator 10: benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

An item is found in a document if at least `threshold` of the item's distinct 5-word shingles occur in it. An item's
sketch is its m smallest shingle hashes (bottom-m MinHash), m = floor((1 - threshold) * size) + 1: an item that is contained
lacks at most m - 1 shingles, so at least one sketch hash occurs in the document and no contained item is missed, however
long the document.

Items are partitioned by size (number of distinct shingles, doubling classes). Every class from SMALL shingles on has a
bound on its sketches' hashes, SLACK times the largest m / size of the class (about a third to a quarter of all hashes),
and a document probes with a hash only if it is within the bound of a class of its width. Sketch hashes beyond the bound
of their class, and those of items of fewer than SMALL shingles, whose minima may lie anywhere, are marked in a table of
bits (BITS of them for each, a power of two up to MOST_BITS), and a document probes with the hashes whose bit is set as well.
The table only spares probes: one that is full lets all hashes probe, and changes no result. Joining probes and sketches gives candidate pairs, which exact containment over all of the item's
shingles then confirms.

Words are runs of letters and digits, lower-cased, so that punctuation and case do not hide a leak. Items of fewer than
five words are one shingle of all their words, and documents are cut to shingles of that length as well.

Defined cases: null, empty or wordless documents and items match nothing; repeated items are found separately and
repeated documents get one row each; null ids take part (rows are matched by an internal key); other columns pass
through `decontaminate` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import hide, materialize, show, table

WIDTH, THRESHOLD, SMALL, SLACK = 5, 0.8, 8, 1.2
#: bits for each hash that is looked up by its value, and the most of them: 512 KB in the plan
BITS, MOST_BITS = 16, 1 << 22
ROW = "struct<a: bigint, b: bigint>"
#: rows of an item table up to which it is broadcast; beyond it Spark shuffles
BROADCAST_ROWS = 1_000_000


def words(text: str):
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(column: str, width: int):
    """All shingles of `width` words of an array of words, as XXH64 of the space-joined words."""
    joined = "concat_ws(' ', " + ", ".join(f"get({column}, i + {k})" for k in range(width)) + ")"
    return F.expr(f"CASE WHEN size({column}) < {width} THEN array() ELSE transform(sequence(0, size({column}) - {width}), i -> xxhash64({joined})) END")


def bit_table(hashes: DataFrame):
    """A column with the table of bits of (h), and how many bits: an array of longs, in the plan as one value."""
    n = hashes.count()
    size = 1 << max(10, min(MOST_BITS.bit_length() - 1, (n * BITS).bit_length()))
    place = F.shiftrightunsigned("h", 20).bitwiseAND(F.lit(size - 1))
    words = hashes.select(F.shiftrightunsigned(place, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    table = [0] * (size // 64)
    for r in words:  # at most MOST_BITS / 64
        table[r["word"]] = r["bits"]
    return hashes.sparkSession.createDataFrame([(table,)], "bits array<bigint>").scalar(), size


def wanted(bounds: dict[int, int | None], bits, size: int):
    """Whether a document probes with a hash (width, h): up to the bound of its width (none if it is null), or if its bit is set."""
    place = F.shiftrightunsigned("h", 20).bitwiseAND(F.lit(size - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    within = F.lit(False)
    for width, bound in bounds.items():
        within = within | ((F.col("width") == width) & (F.col("h") <= F.lit(bound))) if bound is not None else within
    return within | (F.get(bits, F.shiftrightunsigned(place, 6).cast("int")).bitwiseAND(mask) != 0)


def tagged(hashes, width: int):
    return F.transform(hashes, lambda h: F.struct(F.lit(width).alias("width"), h.alias("h")))


def small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if it is small enough; else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def sketch_size(size: str) -> str:
    return f"cast(floor({1 - THRESHOLD + 1e-9} * {size}) AS int) + 1"


def class_bounds(index: DataFrame) -> dict[tuple[int, int], int]:
    """(width, class): the largest hash that a document probes the class with. A few tens of classes at most."""
    share = f"CASE WHEN size >= {SMALL} THEN {SLACK} * ({sketch_size('size')}) / size END"
    rows = index.groupBy("width", "class").agg(F.max(F.expr(share)).alias("share")).filter("share IS NOT NULL").collect()
    return {(r["width"], r["class"]): int(min(1.0, r["share"]) * (2**64 - 1)) - 2**63 for r in rows}


def item_shingles(items: DataFrame) -> DataFrame:
    """(item, width, h, size, class, sketch): distinct shingles of each item row; `sketch` marks the bottom-m ones."""
    w = items.select(F.monotonically_increasing_id().alias("item"), "item_id", words("text").alias("w"))
    w = materialize(w.filter(F.size("w") > 0), "items")
    hashes = F.when(F.size("w") >= WIDTH, shingle_hashes("w", WIDTH))
    for k in range(WIDTH - 1, 0, -1):
        hashes = hashes.when(F.size("w") == k, shingle_hashes("w", k))
    d = w.select("item", "item_id", F.least(F.size("w"), F.lit(WIDTH)).alias("width"), F.array_sort(F.array_distinct(hashes)).alias("hs"))
    d = d.withColumn("size", F.size("hs")).withColumn("class", F.floor(F.log2("size")).cast("int"))
    d = d.withColumn("m", F.expr(f"{sketch_size('size')}"))
    return d.select("item", "item_id", "width", "size", "class", "m", F.posexplode("hs").alias("at", "h")).withColumn("sketch", F.col("at") < F.col("m")).drop("at", "m")


def containment(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row, item_id, shared, size): for every document row (column `row`) each item that it contains."""
    spark = docs.sparkSession
    index = materialize(item_shingles(items), "index")
    bounds = class_bounds(index)
    of_class = F.create_map(*(F.lit(y) for (k, c), b in bounds.items() for y in (f"{k} {c}", b))) if bounds else F.lit(None).cast("map<string,bigint>")
    bound = F.try_element_at(of_class, F.concat_ws(" ", "width", "class"))
    bits, size = bit_table(index.filter("sketch").filter(bound.isNull() | (F.col("h") > bound)).select("h").distinct())
    widths = [r["width"] for r in index.select("width").distinct().collect()]  # five at most
    if not widths:
        return spark.createDataFrame([], f"row {ROW}, item_id long, shared long, size int")
    d = docs.select("row", words("text").alias("w"))
    most = {k: max((b for (w, _), b in bounds.items() if w == k), default=None) for k in widths}
    parts = [tagged(F.array_distinct(shingle_hashes("w", k)), k) for k in widths]
    sketch = d.select("row", F.explode(F.concat(*parts)).alias("s")).select("row", "s.width", "s.h").filter(wanted(most, bits, size))
    probes = small(materialize(index.filter("sketch").select("width", "h", "item"), "sketches"))
    pairs = materialize(sketch.join(probes, ["width", "h"]).select("row", "item").distinct(), "candidates")
    # Exact containment: of the candidate documents only, all shingles that occur in an item.
    rows = pairs.select("row").distinct()
    again = docs.join(small(materialize(rows, "rows")), "row", "left_semi").dropDuplicates(["row"]).select("row", words("text").alias("w"))
    full = [tagged(F.array_distinct(shingle_hashes("w", k)), k) for k in widths]
    found = again.select("row", F.explode(F.concat(*full)).alias("s")).select("row", "s.width", "s.h")
    hits = found.join(small(index.select("width", "h", "item")), ["width", "h"]).groupBy("row", "item").agg(F.count("*").alias("shared"))
    sizes = index.select("item", "item_id", "size").distinct()
    kept = hits.join(pairs, ["row", "item"]).join(small(sizes), "item")
    return kept.filter(F.col("shared") >= F.lit(THRESHOLD - 1e-9) * F.col("size")).select("row", "item_id", "shared", "size")


def with_row(docs: DataFrame) -> DataFrame:
    """A key for every row that follows from its values, so that a repeated task gives it again; equal rows share it. Two
    hashes, so that no two of very many documents fall together."""
    own = [c for c in ("doc_id", "text") if c in docs.columns]
    return docs.withColumn("row", F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(F.lit(7), *own).alias("b")))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    hidden, names = hide(docs, "doc_id", "text")
    keyed = with_row(hidden)
    dirty = materialize(containment(keyed, items).select("row").distinct(), "dirty")
    return keyed.join(small(dirty), "row", "left_anti").select(*show(names))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and contained item: doc_id, item_id, shared and all distinct shingles of the item."""
    docs = with_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = materialize(containment(docs, table(spark, sf_dir, "benchmark")), "found")
    ids = docs.select("row", "doc_id").join(small(found), "row")
    return ids.select("doc_id", "item_id", "shared", F.col("size").cast("long").alias("n_shingles"))
