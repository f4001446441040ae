"""Operator 6: repeated passages by distributed prefix doubling over a sampled suffix array.

The passages to remove are the bytes that a `LENGTH`-byte string covers which also starts in a document with a smaller
id. Sorting a suffix for every byte would move many times the input, so the suffixes are sampled without loss: every
LENGTH-byte window elects an anchor inside itself (the leftmost least of the names of its 32-byte substrings), equal
windows elect the same anchor at the same offset, and on ordinary text about a tenth of all positions are anchors.

Names double within a task: the name of 2k bytes comes from the pair of names of k bytes at offsets 0 and k (1, 2, 4, 8,
16, 32). Spark then ranks anchors in three rounds, each with a longer prefix, and drops what is unique:

1. 32 bytes: (rank, block) pairs are shuffled by rank; anchors whose rank occurs in one document only drop out.
2. All windows of the anchor (50 to 68 bytes, one pair of names more): equal contexts form a class, whose least document
   comes back. If a rank has one class only, its anchors are settled.
3. LENGTH bytes: the classes that share a rank send the names of their windows, one representative for each class, and
   get back which of them occur in a smaller document.

Blocks of whole documents (about BLOCK_BYTES) are written once, bucketed by block, and read by each round; a block sends
each rank once, however often it occurs, so no frequent passage piles up in one task. Rank groups are hashed to shards
of about SHARD_ANCHORS anchors. Names have 64 bits; ranks are compared together with their shard, and classes and windows
by a further name, so that a false match needs about 90 equal bits.

Defined cases: a null or short text loses nothing (0 bytes for null); rows with the same id are the same document and
remove nothing from each other; a null id counts as larger than all others; matches never cross documents; an empty
table gives an empty result. All other columns travel in the blocks and come back unchanged;
one that has the name of a result is replaced by it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.blocks import bits, frame, pack, pack_sorted, read_block, unbits, unpack, unpack_sorted, write_blocks
from varzea.llm.common import _BYTE, fields_of, hide, materialize, mix, show, table

LENGTH, GRAM = 50, 32
SPAN = LENGTH - GRAM + 1  # candidates of a window
SHARD_ANCHORS, CHUNK = 700_000, 1 << 16
NO_ID = np.iinfo(np.int64).max
_P = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in (1, 2, 4, 8, 16)]


class Block:
    """A block's documents and the runs of windows that elect the same anchor."""

    def __init__(self, payload: bytes):
        self.batch = read_block(payload)
        texts = self.batch.column("text").to_pylist()
        parts = [b"" if t is None else t.encode() for t in texts]
        self.bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        ids = self.batch.column("doc_id").to_pylist()
        self.ids = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)

    def chunks(self):
        """Names of GRAM bytes and the anchor of every window, a stretch at a time: (first window, windows' validity, names, anchors)."""
        n = len(self.bytes)
        for at in range(0, max(0, n - LENGTH + 1), CHUNK):
            stop = min(at + CHUNK, n - LENGTH + 1)
            g = _BYTE[self.bytes[at : stop + LENGTH - 1]]
            for k in range(5):
                w = 1 << k
                g = g[:-w] * _P[k] + g[w:]
            g = mix(g)
            least, place = g, np.zeros(len(g), dtype=np.uint8)
            for w in (1, 2, 4, 8, SPAN - 16):
                left = least[:-w] <= least[w:]
                if w == SPAN - 16:
                    break
                place = np.where(left, place[:-w], place[w:] + np.uint8(w))
                least = np.where(left, least[:-w], least[w:])
            w = SPAN - 16
            place = np.where(left, place[:-w], place[w:] + np.uint8(w))
            yield at, stop, g, place

    def runs(self, wanted=None):
        """Find runs: self.lo, self.hi (first and last window), self.doc, rank key and context name. With `wanted` (run numbers,
        sorted), instead return the windows' names of those runs, one after another."""
        lo, hi, doc, rank, context, names = [], [], [], [], [], []
        seen = 0
        for at, stop, g, place in self.chunks():
            s = np.arange(at, stop)
            owner = np.searchsorted(self.offsets, s, side="right") - 1
            inside = s + LENGTH <= self.offsets[owner + 1]
            anchor = s + place
            new = inside.copy()
            new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            last = np.flatnonzero(inside & np.concatenate([new[1:] | ~inside[1:], [True]]))
            if wanted is not None:
                mine = wanted[(wanted >= seen) & (wanted < seen + len(first))] - seen
                size = last[mine] - first[mine] + 1
                each = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[mine], size)
                names.append(mix(g[each] * _P[1] + g[each + LENGTH - GRAM]))
            else:
                key = g[anchor[first] - at]
                lo.append(s[first])
                hi.append(s[last])
                doc.append(owner[first])
                rank.append(mix(key + np.uint64(1)))
                shape = ((last - first) * 32 + (anchor[first] - s[first])).astype(np.uint64)
                context.append(mix(mix(g[first] + shape) * _P[1] + g[last + LENGTH - GRAM] * _P[2] + key))
            seen += len(first)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, dtype=kind)
        if wanted is not None:
            return join(names, np.uint64)
        self.lo, self.hi, self.doc = join(lo, np.int64), join(hi, np.int64), join(doc, np.int64)
        self.rank, self.context = join(rank, np.uint64), join(context, np.uint64)
        return self


class Round1:
    """Distinct ranks of a block, ordered by shard and key; which of them occur in more than one document."""

    def __init__(self, b: Block, shards: int):
        b.runs()
        order = ((b.rank % np.uint64(shards)) << np.uint64(32)) | (b.rank >> np.uint64(32))
        self.distinct, self.of_run = np.unique(order, return_inverse=True)
        ids = b.ids[b.doc]
        least, most = np.full(len(self.distinct), NO_ID), np.full(len(self.distinct), -NO_ID)
        np.minimum.at(least, self.of_run, ids)
        np.maximum.at(most, self.of_run, ids)
        self.several = least != most
        shard = (self.distinct >> np.uint64(32)).astype(np.int64)
        self.first = np.searchsorted(shard, np.arange(shards + 1))

    def live(self, answers: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(len(self.distinct), dtype=bool)
        for shard, said in answers.items():
            out[self.first[shard] : self.first[shard + 1]] = unbits(said, self.first[shard + 1] - self.first[shard])
        return out[self.of_run]


class Round2:
    """Distinct (rank, context) entries of a block's live runs, with the least document of each."""

    def __init__(self, b: Block, one: Round1, live: np.ndarray):
        self.run = np.flatnonzero(live)
        order, context = one.distinct[one.of_run[self.run]], b.context[self.run]
        ids = b.ids[b.doc[self.run]]
        by = np.lexsort((ids, context, order))
        new = np.ones(len(by), dtype=bool)
        new[1:] = (order[by][1:] != order[by][:-1]) | (context[by][1:] != context[by][:-1])
        self.entry = np.zeros(len(by), dtype=np.int64)
        self.entry[by] = np.cumsum(new) - 1
        at = by[new]
        self.order, self.context, self.least, self.example = order[at], context[at], ids[at], self.run[at]
        shard = (self.order >> np.uint64(32)).astype(np.int64)
        self.first = np.searchsorted(shard, np.arange(len(one.first)))

    def classes(self, answers: dict[int, tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Of each entry the least document of its class, and whether other classes share the rank."""
        least, mixed = self.least.copy(), np.zeros(len(self.least), dtype=bool)
        for shard, (a, m) in answers.items():
            s = slice(self.first[shard], self.first[shard + 1])
            least[s] = self.least[s] - unpack(a, np.int64)
            mixed[s] = unbits(m, s.stop - s.start)
        return least, mixed


class Round3:
    """The windows of the entries that stand for a class of a shared rank."""

    def __init__(self, b: Block, two: Round2, least: np.ndarray, mixed: np.ndarray):
        self.entries = np.flatnonzero(mixed & (two.least == least))
        self.size = (b.hi - b.lo)[two.example[self.entries]] + 1
        shard = (two.order[self.entries] >> np.uint64(32)).astype(np.int64)
        self.first = np.searchsorted(shard, np.arange(len(two.first)))
        self.ends = np.concatenate([[0], np.cumsum(self.size)])

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(int(self.ends[-1]), dtype=bool)
        for shard, said in answers.items():
            s = slice(self.ends[self.first[shard]], self.ends[self.first[shard + 1]])
            out[s] = unbits(said, s.stop - s.start)
        return out


SENT = "shard int, block long, a binary, b binary, c binary, n long"
ANSWER = "round int, shard int, block long, a binary, b binary"


def send1(shards: int):
    def run(batches):
        for pdf in batches:
            for block, payload in zip(pdf["block"], pdf["payload"]):
                one = Round1(Block(payload), shards)
                rows = []
                for k in range(shards):
                    s = slice(one.first[k], one.first[k + 1])
                    if s.stop > s.start:
                        rows.append((k, block, pack_sorted(one.distinct[s].astype(np.uint32)), bits(one.several[s]), b"", s.stop - s.start))
                yield frame(["shard", "block", "a", "b", "c", "n"], rows)

    return run


def rank1(pdf: pd.DataFrame) -> pd.DataFrame:
    """A rank is live if it occurs in several blocks, or in several documents of one."""
    keys = [unpack_sorted(a, np.uint32) for a in pdf["a"]]
    values, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared, at, rows = (count > 1)[inverse], 0, []
    for shard, block, several, n in zip(pdf["shard"], pdf["block"], pdf["b"], pdf["n"]):
        rows.append((1, shard, block, bits(shared[at : at + n] | unbits(several, n)), b""))
        at += n
    return frame(["round", "shard", "block", "a", "b"], rows)


def _answers(pdf: pd.DataFrame) -> list[dict]:
    out: list[dict] = [{}, {}, {}, {}]
    for r, shard, a, b in zip(pdf["round"], pdf["shard"], pdf["a"], pdf["b"]):
        out[r][shard] = (a, b) if r == 2 else a
    return out


def send2(shards: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers, rows = _answers(right), []
        for block, payload in zip(left["block"], left["payload"]):
            b = Block(payload)
            one = Round1(b, shards)
            two = Round2(b, one, one.live(answers[1]))
            for k in range(shards):
                s = slice(two.first[k], two.first[k + 1])
                if s.stop > s.start:
                    rows.append((k, block, pack_sorted(two.order[s].astype(np.uint32)), pack(two.context[s]), pack(two.least[s]), s.stop - s.start))
        return frame(["shard", "block", "a", "b", "c", "n"], rows)

    return run


def rank2(pdf: pd.DataFrame) -> pd.DataFrame:
    key = np.concatenate([unpack_sorted(a, np.uint32) for a in pdf["a"]])
    context = np.concatenate([unpack(b, np.uint64) for b in pdf["b"]])
    doc = np.concatenate([unpack(c, np.int64) for c in pdf["c"]])
    by = np.lexsort((context, key))
    k, c = key[by], context[by]
    del key, context
    new_key = np.concatenate([[True], k[1:] != k[:-1]])
    new = new_key | np.concatenate([[True], c[1:] != c[:-1]])
    del k, c
    cls = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[by], np.flatnonzero(new))[cls]
    group = np.cumsum(new_key) - 1
    classes = np.bincount(group[new])[group]
    back, mixed = np.empty(len(by), dtype=np.int64), np.empty(len(by), dtype=bool)
    back[by], mixed[by] = doc[by] - least, classes > 1
    at, rows = 0, []
    for shard, block, n in zip(pdf["shard"], pdf["block"], pdf["n"]):
        rows.append((2, shard, block, pack(back[at : at + n]), bits(mixed[at : at + n])))
        at += n
    return frame(["round", "shard", "block", "a", "b"], rows)


def _third(b: Block, shards: int, answers: list[dict]):
    one = Round1(b, shards)
    two = Round2(b, one, one.live(answers[1]))
    least, mixed = two.classes(answers[2])
    return two, least, Round3(b, two, least, mixed)


def send3(shards: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers, rows = _answers(right), []
        for block, payload in zip(left["block"], left["payload"]):
            b = Block(payload)
            two, _, three = _third(b, shards, answers)
            wanted = two.example[three.entries]
            by = np.argsort(wanted)
            names = b.runs(wanted[by])
            # back from the order of runs to the order of entries
            size = three.size[by]
            start = np.empty(len(by), dtype=np.int64)
            start[by] = np.cumsum(size) - size
            each = np.arange(int(three.ends[-1])) - np.repeat(three.ends[:-1], three.size) + np.repeat(start, three.size)
            names = names[each]
            for k in range(shards):
                e = slice(three.first[k], three.first[k + 1])
                if e.stop > e.start:
                    w = slice(three.ends[e.start], three.ends[e.stop])
                    rows.append((k, block, pack(names[w]), pack(three.size[e].astype(np.uint8)), pack(two.least[three.entries[e]]), w.stop - w.start))
        return frame(["shard", "block", "a", "b", "c", "n"], rows)

    return run


def rank3(pdf: pd.DataFrame) -> pd.DataFrame:
    name = np.concatenate([unpack(a, np.uint64) for a in pdf["a"]])
    doc = np.concatenate([np.repeat(unpack(c, np.int64), unpack(b, np.uint8)) for b, c in zip(pdf["b"], pdf["c"])])
    by = np.argsort(name, kind="stable")
    new = np.concatenate([[True], name[by][1:] != name[by][:-1]])
    least = np.minimum.reduceat(doc[by], np.flatnonzero(new))[np.cumsum(new) - 1]
    repeated = np.empty(len(by), dtype=bool)
    repeated[by] = least < doc[by]
    at, rows = 0, []
    for shard, block, n in zip(pdf["shard"], pdf["block"], pdf["n"]):
        rows.append((3, shard, block, bits(repeated[at : at + n]), b""))
        at += n
    return frame(["round", "shard", "block", "a", "b"], rows)


def covered(b: Block, shards: int, answers: list[dict]) -> np.ndarray:
    """Which bytes of the block go."""
    two, least, three = _third(b, shards, answers)
    step = np.zeros(len(b.bytes) + 1, dtype=np.int32)

    def cover(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(step, first, 1)
        np.add.at(step, last + LENGTH, -1)

    later = two.run[b.ids[b.doc[two.run]] > least[two.entry]]  # a smaller document has all of the run's windows
    cover(b.lo[later], b.hi[later])
    flags = three.repeated(answers[3])
    if len(three.entries):
        stands = np.full(len(two.least), -1, dtype=np.int64)
        stands[three.entries] = np.arange(len(three.entries))
        same = two.run[(stands[two.entry] >= 0) & (b.ids[b.doc[two.run]] == least[two.entry])]
        of = stands[two.entry[np.searchsorted(two.run, same)]]
        size = three.size[of]
        each = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        hit = flags[np.repeat(three.ends[of], size) + each]
        at = (np.repeat(b.lo[same], size) + each)[hit]
        cover(at, at)
    return np.cumsum(step[:-1]) > 0


def finish(shards: int, rest: list[str], with_text: bool):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers, out = _answers(right), []
        for payload in left["payload"]:
            b = Block(payload)
            gone = covered(b, shards, answers)
            rows = []
            for i, (x, y) in enumerate(zip(b.offsets[:-1], b.offsets[1:])):
                g, text = gone[x:y], b.bytes[x:y]
                left_over = text[~g].tobytes()
                spans = int(np.count_nonzero(np.diff(g.astype(np.int8), prepend=0) == 1))
                rows.append((int(y - x), int(np.count_nonzero(g)), spans, hashlib.sha256(left_over).hexdigest(), left_over.decode("utf-8", "ignore") if with_text else None))
            frame = b.batch.select(rest).to_pandas() if rest else pd.DataFrame(index=range(len(rows)))
            made = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "_text"])
            out.append(pd.concat([frame, made if with_text else made.drop(columns="_text")], axis=1))
        return pd.concat(out) if out else pd.DataFrame()

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Every row with n_bytes, n_removed, n_spans and kept_sha256; with_text: `text` holds what is left (cut characters dropped)."""
    docs, names = hide(docs, "doc_id", "text")
    rest = [c for c in docs.columns if c != "text"]
    made = write_blocks(docs.select(*rest, "text"))
    blocks, shards = made.table, max(16, math.ceil(made.size / 10 / SHARD_ANCHORS))
    answers = materialize(blocks.select("block", "payload").mapInPandas(send1(shards), SENT).groupBy("shard").applyInPandas(rank1, ANSWER), "round1")
    for send, rank, name in ((send2, rank2, "round2"), (send3, rank3, "round3")):
        sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(send(shards), SENT)
        answers = answers.unionByName(materialize(sent.groupBy("shard").applyInPandas(rank, ANSWER), name))
    schema = f"{fields_of(docs, rest)}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", _text string" if with_text else "")
    done = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish(shards, rest, with_text), schema)
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return done.select(*show(names, "text", *made), *made, *([F.col("_text").alias("text")] if with_text else []))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the repeated passages taken out of text, and n_chars (if there is one) counted anew. An emptied document stays."""
    hidden, names = hide(docs, "doc_id", "text")
    done = remove_repeats(hidden, with_text=True)
    if "n_chars" in docs.columns:
        done = done.withColumn(names["n_chars"], F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*show(names))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
