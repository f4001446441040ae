"""Operator 9: SimHash near-duplicates by pivot distance tables.

Every text gets a 64-bit fingerprint of its 4-word shingles. Distinct fingerprints carry a table of Hamming distances to
PIVOTS fixed reference fingerprints. Pairs come from buckets, not from all pairs: cut into six bit blocks or more (see
`cuts`), fingerprints at most four bits apart agree in all blocks but four at least, so they share a bucket. In a bucket a
pair whose pivot distances differ by more than the radius anywhere is discarded (triangle inequality), be it with the
bucket's hub or among its members, and the Hamming distance of the survivors is verified. Groups of copies are linked through one hub per bucket first; the pair search then skips
pairs that are connected already, so a group of near copies gives no quadratic number of links.

Defined cases: null, empty and wordless texts have fingerprint zero and are linked like any other; repeated rows with
the same id each get a row; a row without doc_id takes part with its fingerprint, and its component is the smallest
non-null id reachable (null if there is none); further columns do not disturb.

The pipeline stage (`keep_one`) goes by the same method, with fingerprints of 1,024 bits and the radius that a Jaccard similarity
of 0.8 needs, and verifies each pair by the exact similarity (near_copies.py).
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import LOWER, hide, materialize, show, table
from varzea.llm.components import components
from varzea.llm.near_copies import kept_keys

WIDTH, RADIUS, SEED, PIVOTS = 4, 4, 42, 16
#: the pipeline stage: words a shingle, and the Jaccard similarity of near copies
STAGE_WIDTH, STAGE_THRESHOLD = 5, 0.8


def cuts(n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the blocks that a fingerprint is cut into, for n distinct ones: two fingerprints within RADIUS agree
    in all blocks but RADIUS, whose bits together are a bucket's key. More blocks give longer keys: enough of them that a key
    has some two fingerprints on average."""
    for blocks in range(RADIUS + 2, 2 * RADIUS + 3):
        if n <= 1 << (64 // blocks * (blocks - RADIUS) + 1):
            break
    first = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(first, first[1:])]


def fingerprint(text: bytes) -> int:
    """64 bits: 1 where more than half of the shingles' XXH64 have a 1."""
    words = text.translate(LOWER).split()  # bytes.split() splits at \\x20 and \\x09-\\x0D
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - WIDTH + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    view, digest = memoryview(flat), xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65_536):
        h = np.array([digest(view[a:b], SEED) for a, b in zip(starts[i : i + 65_536], stops[i : i + 65_536])], dtype=">u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": [fingerprint(b"" if t is None else t.encode()) for t in pdf["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


def pivot_table(fp: str) -> list:
    """Two longs that hold the distances to PIVOTS references, a byte each. References are XXH64 values of 0, 1, 2, ..."""
    refs = [int(np.uint64(xxhash.xxh64_intdigest(str(i), SEED)).astype(np.int64)) for i in range(PIVOTS)]
    byte = [F.shiftleft(F.bit_count(F.col(fp).bitwiseXOR(F.lit(r))).cast("long"), 8 * (i % 8)) for i, r in enumerate(refs)]
    packed = []
    for k in range(0, PIVOTS, 8):
        x = byte[k]
        for y in byte[k + 1 : k + 8]:
            x = x.bitwiseOR(y)
        packed.append(x.alias(f"pivots{k // 8}"))
    return packed


def within_pivots(a: str, b: str) -> str:
    """SQL: no coordinate of the two tables differs by more than the radius."""
    one = lambda s, i: f"(shiftrightunsigned({s}pivots{i // 8}, {8 * (i % 8)}) & 255)"
    return " AND ".join(f"abs({one(a, i)} - {one(b, i)}) <= {RADIUS}" for i in range(PIVOTS))


def bucket_keys(fp: str, blocks: list[tuple[int, int]]):
    """Array of bucket keys: the number of the choice of blocks above, their bits below."""
    part = [F.shiftrightunsigned(F.col(fp), s).bitwiseAND(F.lit((1 << n) - 1)) for s, n in blocks]
    keys = []
    for k, chosen in enumerate(combinations(range(len(blocks)), len(blocks) - RADIUS)):
        key = F.lit(k).cast("long")
        for i in chosen:
            key = F.shiftleft(key, blocks[i][1]).bitwiseOR(part[i])
        keys.append(key)
    return F.transform(F.array(*keys), lambda key, k: F.struct(k.alias("choice"), key.alias("bits")))


def first_choice(x: str, blocks: list[tuple[int, int]]) -> str:
    """SQL: the number of the first choice of blocks that are all zero in the difference x, so that a pair is found once. As
    choices are in order, it is that of the first blocks that are zero."""
    zero = [f"(shiftrightunsigned({x}, {s}) & {(1 << n) - 1}) = 0" for s, n in blocks]
    cases = " ".join(f"WHEN {' AND '.join(zero[i] for i in chosen)} THEN {k}" for k, chosen in enumerate(combinations(range(len(blocks)), len(blocks) - RADIUS)))
    return f"(CASE {cases} ELSE -1 END)"


def links(nodes: DataFrame, blocks: list[tuple[int, int]] | None = None) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (fp), enough to connect all within the radius."""
    blocks = blocks or cuts(nodes.count())
    keyed = nodes.select("fp", *pivot_table("fp")).withColumn("key", F.explode(bucket_keys("fp", blocks)))
    full = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("fp", "pivots0", "pivots1")).alias("hub")).filter("n > 1")
    live = materialize(keyed.join(full, "key"), "buckets")
    near_hub = live.filter(f"hub.fp <> fp AND {within_pivots('', 'hub.')} AND bit_count(fp ^ hub.fp) <= {RADIUS}").select(F.col("fp").alias("u"), F.col("hub.fp").alias("v"))
    near_hub = materialize(near_hub.distinct(), "hubs")
    groups = components(near_hub).withColumnRenamed("node", "fp")
    rows = live.filter("n > 2").drop("hub", "n").join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    rows = materialize(rows, "labelled")
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(
        b,
        F.expr("a.key = b.key AND a.component < b.component")
        & F.expr(within_pivots("a.", "b."))
        & F.expr(f"bit_count(a.fp ^ b.fp) <= {RADIUS} AND a.key.choice = {first_choice('(a.fp ^ b.fp)', blocks)}"),
    )
    return near_hub.unionByName(pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs."""
    prints = materialize(fingerprints(docs), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(links(distinct)).withColumnRenamed("node", "fp")
    whole = materialize(distinct.join(groups, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "components")
    ids = whole.join(whole.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    return prints.join(ids, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = STAGE_WIDTH, threshold: float = STAGE_THRESHOLD) -> DataFrame:
    """One row of each group of near copies, texts linked by a Jaccard similarity of at least `threshold` of their shingles
    of `width` words: the row with the smallest id. Rows are told apart by all their values, so ids need not be unique."""
    docs, names = hide(docs, "doc_id", "text")
    nulls = F.array(*(F.col(c).isNull() for c in docs.columns))  # xxhash64 passes over nulls
    values = [F.to_json(F.struct(c)) if re.search(r"\b(map|variant)\b", kind) else F.col(c) for c, kind in docs.dtypes]  # that it does not take
    keyed = docs.withColumn("_key", F.xxhash64(*values, nulls))
    best = materialize(kept_keys(keyed.select(F.col("_key").alias("key"), F.col("doc_id").alias("id"), "text"), width, threshold), "best")
    return keyed.join(best.withColumnRenamed("key", "_key"), "_key", "left_semi").dropDuplicates(["_key"]).select(*show(names))


def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
