"""Near copies by exact Jaccard similarity of word shingles: the search of the pipeline's near_duplicates stage.

The method is that of op9, SimHash fingerprints with pivot distance tables over bit-block buckets, at the width and radius that a
similarity of 0.8 needs. There two fingerprints differ in 15 % of their bits, so a fingerprint has BITS bits instead of 64 and a
bucket's key is one block of it: a pair of similarity 0.8 agrees in a block of 14 bits with probability 0.1 and in one at least
of the 72 blocks with 1 - MISSED (0.0005), one of 0.85 with 1 - 2 * 10^-5, one of 0.9 with 1 - 2 * 10^-8. Blocks lengthen with the number of
texts, and then there are more of them, so that the probability stays. Sets of four and five shingles, whose fingerprints differ in
more bits, have the hashes of their subsets of four as keys besides.

In a bucket of up to CROWD texts those go on that have a near one there: by the numbers of shingles, by the table of distances to
PIVOTS reference fingerprints (triangle inequality), then by the Hamming distance of the first AHEAD words, which travel. Of fuller
buckets all go on. What goes on are texts, not pairs, so a group of near copies gives no quadratic number of rows. Each text is then
linked to one hub, of its buckets' hubs the text that meets most others, and the pair is verified by the exact Jaccard similarity
of the two shingle sets. In buckets of more than HUBLESS texts that are not wholly connected up to HUB_TURNS more hubs by lot
follow, so that few are left. What is left in buckets, of whatever size, that are not wholly connected is compared with each other
inside tasks by whole fingerprints, TILE by TILE rows, and only pairs of different components that may be similar come out, each
from the first bucket that it shares, after a tighter test by sketches of BINS bytes, the least hash of each bin of a text's
shingles; these are verified too, so no link between components is lost. Limits of distances lie DEVIATIONS standard deviations
above the expected one: each passes over a pair of 0.8 with a probability of about 10^-5.

Words are lower-cased (A-Z) and split at the white space of the contracts. A text of fewer than `width` words is one
shingle of all of them; wordless texts are copies of each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varzea.llm.common import LOWER, Words, chunks, materialize, mix, pieces, release
from varzea.llm.components import components

BITS, AHEAD, PIVOTS, LEAST_BLOCK, MISSED = 1024, 2, 8, 14, 5e-4
CROWD, HUB_TURNS, HUBLESS, BINS, DEVIATIONS, TILE = 256, 4, 16, 1024, 4.27, 1_000
#: up to so many shingles the bits of two sets of similarity 0.8 differ in up to 3/16 instead of 15 %
FEW = 8
_rng = np.random.default_rng(97)
_LANE = _rng.integers(0, 2**63, BITS // 64, dtype=np.uint64)
_PIVOT = _rng.integers(0, 2**63, (PIVOTS, AHEAD), dtype=np.uint64) * np.uint64(2) + np.arange(PIVOTS, dtype=np.uint64)[:, None] % np.uint64(2)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    parts, owner = pieces([t.translate(LOWER) for t in texts])
    words = [Words(parts[s]) for s in chunks(parts)]
    h = np.concatenate([w.hashes() for w in words])
    n = np.bincount(owner, weights=np.concatenate([w.per_text for w in words]), minlength=len(texts)).astype(np.int64)
    many = np.where(n > 0, np.maximum(1, n - width + 1), 0)
    after = np.cumsum(many)
    at = np.arange(int(many.sum())) + np.repeat(np.cumsum(n) - n - (after - many), many)
    long = np.repeat(np.minimum(width, n), many)
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        some = k < long
        value[some] = mix(value[some] * _STEP + h[at[some] + k])
    return [np.unique(value[e - m : e]) for m, e in zip(many, after)]


def fingerprint(shingles: np.ndarray) -> np.ndarray:
    """BITS bits as bytes: 1 where more than half of the shingles' hashes have a 1."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(shingles), 255):  # so many bits add up in a byte
        h = mix(shingles[i : i + 255, None] ^ _LANE)
        ones += np.add.reduce(np.unpackbits(h.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(shingles))


def differing(threshold: float) -> float:
    """The share of bits in which two fingerprints of this similarity differ: the angle of the sets' vectors."""
    return float(np.arccos(2 * threshold / (1 + threshold)) / np.pi)


def radius(bits: int, share: float) -> int:
    return int(bits * share + DEVIATIONS * (bits * share * (1 - share)) ** 0.5)


def cuts(n: int, threshold: float) -> np.ndarray:
    """The bits of each block, a row for a block, for n texts: so long that a bucket has CROWD / 2 of them at most on average (up to 24
    bits), so many that a pair of the similarity agrees in one but for MISSED. Blocks are cut one after another from the bits, as far
    as they go, and then from the bits in other orders."""
    block = min(24, max(LEAST_BLOCK, int(np.ceil(np.log2(max(1, 2 * n / CROWD))))))
    many = int(np.ceil(np.log(MISSED) / np.log(1 - (1 - differing(threshold)) ** block)))
    lot, a_row = np.random.default_rng(41), BITS // block
    orders = [np.arange(BITS)] + [lot.permutation(BITS) for _ in range(many // a_row)]
    return np.concatenate([o[: a_row * block].reshape(a_row, block) for o in orders])[:many]


def bucket_keys(prints: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Of fingerprints (rows of bytes) the keys: the number of the block above, its bits below."""
    bits = np.unpackbits(prints, axis=1)
    key = np.zeros((len(prints), len(blocks)), dtype=np.int64) + np.arange(len(blocks))
    for at in blocks.T:
        key = key * 2 + bits[:, at]
    return key


def fours(shingles: np.ndarray) -> list[int]:
    """Of a set of four or five its subsets of four, hashed; negative, so no key of a block."""
    subsets = [shingles] if len(shingles) == 4 else [np.delete(shingles, i) for i in range(5)] if len(shingles) == 5 else []
    return [-1 - (xxhash.xxh64_intdigest(x.tobytes()) >> 1) for x in subsets]


def prints(docs: DataFrame, width: int) -> DataFrame:
    """(key, id, node, n, print, fours) of every row of (key, id, text); texts of equal shingle sets share the node."""
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        for pdf in batches:
            texts = [b"" if t is None else t.encode() for t in pdf["text"]]
            for c in chunks(texts):
                sets = shingle_sets(texts[c], width)
                own = {"node": [xxhash.xxh64_intdigest(s.tobytes()) >> 1 for s in sets], "n": [len(s) for s in sets]}
                yield pdf.iloc[c][["key", "id"]].assign(**own, print=[fingerprint(s).tobytes() for s in sets], fours=[fours(s) for s in sets])

    return docs.mapInPandas(run, f"key long, id {kind}, node long, n long, print binary, fours array<long>")


def bytes_of(column) -> np.ndarray:
    """A row of bytes for each fingerprint."""
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), BITS // 8)


def keyed(nodes: DataFrame, blocks: np.ndarray) -> DataFrame:
    """(node, n, word0, ..., pivots, keys): a node's keys, the first words of its fingerprint and the table of their distances to the
    pivots, a byte each."""
    words = [f"word{i}" for i in range(AHEAD)]

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 2_000):
                part = pdf.iloc[at : at + 2_000]
                p = bytes_of(part["print"])
                ahead = np.ascontiguousarray(p[:, : 8 * AHEAD]).view(np.uint64)
                table = np.bitwise_count(ahead[:, None] ^ _PIVOT).sum(axis=2).astype(np.uint8)
                keys = [k.tolist() + list(more) for k, more in zip(bucket_keys(p, blocks), part["fours"])]
                yield part[["node", "n"]].assign(**dict(zip(words, ahead.view(np.int64).T)), pivots=table.view(np.int64)[:, 0], keys=keys)

    fields = ", ".join(f"{w} long" for w in words)
    return nodes.filter("n > 0").select("node", "n", "print", "fours").mapInPandas(run, f"node long, n long, {fields}, pivots long, keys array<long>")


def near(a: str, b: str, threshold: float) -> str:
    """SQL: the numbers of shingles, the pivot tables and the distance of the first words allow the similarity."""
    most = f"(CASE WHEN least({a}.n, {b}.n) <= {FEW} THEN {radius(64 * AHEAD, max(3 / 16, differing(threshold)))} ELSE {radius(64 * AHEAD, differing(threshold))} END)"
    byte = lambda x, i: f"(shiftrightunsigned({x}.pivots, {8 * i}) & 255)"
    pivots = " AND ".join(f"abs({byte(a, i)} - {byte(b, i)}) <= {most}" for i in range(PIVOTS))
    apart = " + ".join(f"bit_count({a}.word{i} ^ {b}.word{i})" for i in range(AHEAD))
    return f"least({a}.n, {b}.n) >= {threshold} * greatest({a}.n, {b}.n) - 1e-9 AND {pivots} AND {apart} <= {most}"


def texts_of(some: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of some nodes: `docs` has the texts by key, `nodes` a key of each node."""
    stands = nodes.select("node", "key").join(some, "node")
    return docs.select("key", F.coalesce("text", F.lit("")).alias("text")).join(stands, "key").dropDuplicates(["node"]).select("node", "text")


def verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs (u, v) of nodes whose sets have at least the Jaccard similarity `threshold`. Texts travel, not sets: they are a
    third of the size when compressed, and a set is soon made again. The pairs of a v that has many are dealt over several tasks."""

    def run(batches):
        for pdf in batches:
            for begin, end in stretches(pdf["a"].str.len().to_numpy() + pdf["b"].str.len().to_numpy()):
                part = pdf.iloc[begin:end]
                each = dict(zip(part["u"], part["a"])) | dict(zip(part["v"], part["b"]))
                sets = dict(zip(each, shingle_sets([t.encode() for t in each.values()], width)))
                keep = []
                for u, v in zip(part["u"], part["v"]):
                    p, q = sets[u], sets[v]
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(both >= threshold * (len(p) + len(q) - both) - 1e-9)
                yield part.loc[np.array(keep, dtype=bool), ["u", "v"]]

    lots = pairs.groupBy("v").agg(F.ceil(F.count("*") / F.lit(TILE)).alias("lots"))
    dealt = pairs.join(lots, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("lots")).alias("lot"))
    a = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("b")).join(lots, "v")
    b = b.select("v", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"))
    return dealt.join(a, "u").join(b, ["v", "lot"]).select("u", "v", "a", "b").mapInPandas(run, "u long, v long")


def stretches(sizes: np.ndarray, budget: int = 4_000_000):
    """(begin, end) of consecutive rows of about `budget` bytes together, one row at least."""
    upto = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] - sizes[begin] + budget, side="right")))
        yield begin, end
        begin = end


def bins_of(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BINS bytes for each set: of each bin's least hash eight bits, 1 to 255; 0 for a bin without any."""
    out = np.zeros((len(sets), BINS), dtype=np.uint8)
    for row, x in zip(out, sets):
        h = np.sort(mix(x * _STEP))  # the upper bits choose the bin, so a bin's hashes stand together and the least comes first
        which, first = np.unique(h >> np.uint64(54), return_index=True)
        row[which.astype(np.int64)] = (h[first] & np.uint64(0xFFFFFFFF)) % np.uint64(255) + np.uint64(1)
    return out


def sketched(texts: DataFrame, width: int) -> DataFrame:
    """(node, sketch) of (node, text)."""

    def run(batches):
        for pdf in batches:
            encoded = [t.encode() for t in pdf["text"]]
            for c in chunks(encoded):
                yield pdf.iloc[c][["node"]].assign(sketch=[r.tobytes() for r in bins_of(shingle_sets(encoded[c], width))])

    return texts.select("node", "text").mapInPandas(run, "node long, sketch binary")


def alike(left: DataFrame, sketches: DataFrame, blocks: np.ndarray, threshold: float) -> DataFrame:
    """Pairs (u, v) of nodes of a bucket in different components that may have the similarity. `left` has (bucket, node, n, component,
    size), `sketches` (node, print, sketch). A bucket of more than TILE rows is cut into tiles, and a task compares two tiles; smaller
    ones are taken together, some 2 * TILE rows at once."""
    share, words = differing(threshold), BITS // 64
    most, most_few = radius(BITS, share), radius(BITS, max(3 / 16, share))
    least = threshold - DEVIATIONS * (threshold * (1 - threshold) / BINS) ** 0.5
    lots = 1 + left.count() // (2 * TILE)
    d = left.select("bucket", "node", "n", "component", F.ceil(F.col("size") / F.lit(TILE)).alias("tiles"))
    d = d.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    lot = F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("bucket"), F.lit(lots)))  # null for a bucket of tiles
    d = d.select("bucket", "node", "n", "component", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), lot.alias("lot"), F.when(lot.isNull(), F.col("bucket")).alias("alone"))
    d = d.join(sketches, "node")

    def in_bucket(pdf: pd.DataFrame) -> list[np.ndarray]:
        node, n, component = (pdf[c].to_numpy() for c in ("node", "n", "component"))
        p = bytes_of(pdf["print"])
        keys, s = bucket_keys(p, blocks), p.view(np.uint64).reshape(len(pdf), words)
        bins = np.frombuffer(b"".join(pdf["sketch"]), dtype=np.uint8).reshape(len(pdf), BINS)
        first, bucket = pdf["own"].to_numpy() == pdf["low"].iloc[0], pdf["bucket"].iloc[0]
        one = pdf["low"].iloc[0] == pdf["high"].iloc[0]
        rows, others = (np.arange(len(pdf)), np.arange(len(pdf))) if one else (np.flatnonzero(first), np.flatnonzero(~first))
        to_pivot = np.bitwise_count(s ^ s[0]).sum(axis=1, dtype=np.int64)  # the pivot is a member: distances to it lie further apart
        found = []
        for i in rows:
            j = others[others > i] if one else others
            limit = np.where(np.minimum(n[j], n[i]) <= FEW, most_few, most)
            fit = (component[j] != component[i]) & (np.minimum(n[j], n[i]) >= threshold * np.maximum(n[j], n[i]) - 1e-9) & (np.abs(to_pivot[j] - to_pivot[i]) <= limit)
            j, limit = j[fit], limit[fit]
            close = np.bitwise_count(s[j] ^ s[i]).sum(axis=1, dtype=np.int64) <= limit
            j = j[close]
            same = keys[j] == keys[i]
            j = j[(keys[i][np.argmax(same, axis=1)] == bucket) | ~same.any(axis=1)] if len(j) else j  # of the buckets that they share this is the first
            for at in range(0, len(j), 512):
                k = j[at : at + 512]
                both = ((bins[k] == bins[i]) & (bins[k] > 0)).sum(axis=1)
                k = k[both >= least * ((bins[k] | bins[i]) > 0).sum(axis=1) - 1e-9]
                found.append(np.stack([np.full(len(k), node[i]), node[k]], axis=1))
        return found

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [f for _, some in pdf.groupby("bucket") for f in in_bucket(some)]
        return pd.DataFrame(np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64), columns=["u", "v"])

    return d.groupBy("lot", "alone", "low", "high").applyInPandas(run, "u long, v long")


def labelled(live: DataFrame, groups: DataFrame) -> DataFrame:
    """The bucket rows with each node's component."""
    return live.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def unconnected(rows: DataFrame) -> DataFrame:
    """The buckets whose nodes are not all connected."""
    return rows.groupBy("bucket").agg((F.min("component") < F.max("component")).alias("apart")).filter("apart").select("bucket")


def meeting(keys: DataFrame, threshold: float) -> DataFrame:
    """The bucket rows (bucket, node, n, word0, ..., pivots, size) of nodes that have a near one in the bucket, and all rows of buckets
    of more than CROWD; size is the number of them in the bucket. A row comes out once, however many near ones it meets."""
    own = [c for c in keys.columns if c != "keys"]
    buckets = keys.select(*own, F.explode("keys").alias("bucket"))  # in this order both sides of the join read one exchange
    full = materialize(buckets.groupBy("bucket").agg(F.count("*").alias("many")).filter(F.col("many") > CROWD).select("bucket"), "full")
    few = buckets.join(full.withColumnRenamed("bucket", "crowded"), F.expr("bucket = crowded"), "left_anti")
    met = few.alias("a").join(few.alias("b"), F.expr("a.bucket = b.bucket AND a.node <> b.node") & F.expr(near("a", "b", threshold)), "left_semi")
    live = met.unionByName(buckets.join(full, "bucket"))
    return live.withColumn("size", F.count("*").over(Window.partitionBy("bucket")))


def stars(left: DataFrame, draw: str, threshold: float) -> DataFrame:
    """(u, v): to each node u one hub v, near it but in another component, of the hubs of its buckets: those with the largest `draw`."""
    own = [c for c in left.columns if c not in ("bucket", "size", "draw")]
    hubs = left.groupBy("bucket").agg(F.max(F.struct(F.expr(draw).alias("draw"), *own)).alias("hub"))
    met = left.alias("a").join(hubs, "bucket").filter("a.component <> hub.component").filter(near("a", "hub", threshold))
    return met.groupBy(F.col("a.node").alias("u")).agg(F.max(F.struct("hub.draw", "hub.node")).alias("best")).select("u", F.col("best.node").alias("v"))


def links(rows: DataFrame, docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """Edges (u, v) between nodes, enough to connect all whose similarity is `threshold` or more. `docs` has the texts by key."""
    stands = rows.groupBy("node").agg(F.min_by(F.struct("n", "print", "fours"), "key").alias("own"), F.min("key").alias("key"))
    nodes = materialize(stands.select("node", "key", "own.*"), "nodes")
    blocks = cuts(nodes.count(), threshold)
    keys = materialize(keyed(nodes, blocks), "keys")
    live = materialize(meeting(keys, threshold), "live")
    release(live.sparkSession, keys)
    texts = materialize(texts_of(live.select("node").distinct(), docs, nodes), "texts")
    central = live.groupBy("node").agg(F.sum("size").alias("central"))
    linked, left = None, live.join(central, "node").withColumn("component", F.col("node"))
    for turn in range(1 + HUB_TURNS):
        drawn = stars(left.filter(F.col("size") > HUBLESS), f"xxhash64(node, {turn})", threshold) if turn else stars(left, "central", threshold)
        drawn = materialize(drawn, "stars")
        new = materialize(verified(drawn, texts, width, threshold), "hubs")
        linked = linked.unionByName(new) if turn else new
        if turn and new.isEmpty():
            break
        before, left = left, materialize(labelled(live, components(linked)), "labelled")
        if turn:
            release(left.sparkSession, before)
        if unconnected(left).isEmpty():
            return linked
    before, left = left, materialize(left.join(unconnected(left), "bucket", "left_semi"), "apart")  # once: other buckets' hubs give no edges
    release(left.sparkSession, before)
    some = texts.join(left.select("node").distinct(), "node", "left_semi")
    sketches = materialize(sketched(some, width).join(nodes.select("node", "print"), "node"), "sketches")
    rest = materialize(alike(left, sketches, blocks, threshold).distinct(), "rest")
    return linked.unionByName(verified(rest, texts, width, threshold))


def kept_keys(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """(key) of one row of (key, id, text) in each group: that with the smallest id, then key; rows without id come last."""
    rows = materialize(prints(docs, width), "prints")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least")
    first = rows.groupBy("node").agg(least).select("node", "least.*")
    groups = components(links(rows, docs, width, threshold))
    return first.join(groups, "node", "left").groupBy(F.coalesce("component", "node")).agg(least).select("least.key")
