"""Operator 1: language-model scoring with an Elias-Fano n-gram trie.

A trigram model of hierarchical Dirichlet smoothing: with a = c(h w) / (c(h) + mu) and b = mu / (c(h) + mu) of each history h,
p(w3 | w1 w2) = a3 + b3 (a2 + b2 p(w3)), and p(w3) = (c + 1) / (N + V + 1). Everything is a count over all training
tokens, so the score of a text does not depend on how the work is split. The model is never in one place:

1. Documents become blocks of token numbers, tokenised once. Blocks send their distinct words with training counts,
   hashed to shards; the counts and word numbers (small for frequent words) come back. N and V are sums over the shards.
2. Blocks send their distinct pairs (w2, w3), sharded by w2; the pairs of a frequent w2 are spread over several shards by
   w3. A shard builds the trie of its pairs (see elias_fano.py), saves and maps it, and answers each pair's a and b as
   well as its count. That count is the history's total in the next round.
3. The same for trigrams (w2, w1, w3), sharded by (w2, w1); a frequent history is spread over several shards by w3.
4. Blocks sum the logarithms of each document's tokens.

A history's total comes from the round before, so shards that share a history need nothing of each other. A block sends
each word and n-gram once, however often it occurs. A shard has about SHARD_ENTRIES entries. Codes have 16 bits on the
way, 500 to a decade, and 8 bits in the trie.

Defined cases: a null or empty text is its end token alone; rows with a null id count by the text form of null (they are
held out: crc32 is null); without training tokens the base is log10(1/1) = 0 and so is the score; repeated rows score
alike; columns but doc_id, held_out and text are left out of the result.
"""

from __future__ import annotations

import math
import os
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.blocks import arrow_payload, frame, join_parts, pack, pack_sorted, read_block, split_parts, unpack, unpack_sorted, write_blocks
from varzea.llm.common import LOWER, Words, chunks, crc_mod, materialize, mix, pieces, release, table
from varzea.llm.elias_fano import Trie, distinct

BLOCK_BYTES, SHARD_ENTRIES, SLICE, TABLE = 4_000_000, 1_000_000, 1 << 18, 1 << 24
MU = {2: 2000.0, 3: 4.0}  # chosen by held-out probability
END, BEGIN = np.uint64(1), np.uint64(2)  # names of the two marks; words have hashes
SENT = "shard int, block long, n long, a binary, b binary, c binary, d binary, e binary"
ANSWER = "round int, shard int, block long, a binary, b binary, n_types long, n_tokens long"
ANSWERS = [f.split(" ")[0] for f in ANSWER.split(", ")]
VALUE = np.append(0.0, 10.0 ** (np.arange(1, 1 << 16) / 500 - 120))  # of the codes


def tokenise(batch: pa.RecordBatch) -> bytes:
    """A block: doc_id and held_out of its documents, tokens of each, sorted hashes of the distinct tokens, and the token numbers."""
    texts = [b"" if t is None else t.encode().translate(LOWER) for t in batch.column("text").to_pylist()]
    parts, owner = pieces(texts)
    hashes, per_part = [], []
    for s in chunks(parts):
        w = Words(parts[s])
        hashes.append(w.hashes())
        per_part.append(w.per_text)
    words = np.bincount(owner, weights=np.concatenate(per_part), minlength=len(texts)).astype(np.int64)
    size = words + 1
    token = np.full(int(size.sum()), END, dtype=np.uint64)
    is_word = np.ones(len(token), dtype=bool)
    is_word[np.cumsum(size) - 1] = False
    token[is_word] = np.concatenate(hashes)
    distinct, local = np.unique(np.append(token, BEGIN), return_inverse=True)
    kind = np.uint32 if len(distinct) < 1 << 32 else np.int64
    return join_parts(arrow_payload(batch.select(["doc_id", "held_out"])), pack(size), pack_sorted(distinct), pack(local[:-1].astype(kind)), bytes([kind is np.uint32]))


class Tokens:
    """A block's token stream: for each text its tokens' numbers, and how often training texts have each of the distinct tokens.
    The begin mark counts once for each training text."""

    def __init__(self, payload: bytes):
        rows, size, distinct, local, narrow = split_parts(payload)
        self.batch = read_block(rows)
        self.learn = np.array([not h for h in self.batch.column("held_out").to_pylist()], dtype=bool)
        self.size, self.distinct = unpack(size, np.int64), unpack_sorted(distinct, np.uint64)
        self.token = unpack(local, np.uint32 if narrow[0] else np.int64).astype(np.int64)
        self.begin = int(np.searchsorted(self.distinct, BEGIN))
        self.start = np.cumsum(self.size) - self.size
        self.doc = np.repeat(np.arange(len(self.size)), self.size)
        self.learned = self.learn[self.doc]
        self.count = np.bincount(self.token[self.learned], minlength=len(self.distinct))
        self.count[self.begin] = self.learn.sum()

    def by_shard(self, shards: int) -> Cut:
        return Cut((mix(self.distinct) % np.uint64(shards)).astype(np.int64))


class Cut:
    """Entries ordered by shard, and in a shard as they were."""

    def __init__(self, shard: np.ndarray):
        self.order = np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")
        ordered = shard[self.order]
        self.begin = np.flatnonzero(np.diff(ordered, prepend=-1))
        self.end = np.append(self.begin[1:], len(ordered))
        self.shard = ordered[self.begin]
        self.at = {s: i for i, s in enumerate(self.shard.tolist())}

    def __iter__(self):
        """(shard, positions of its entries), of shards with entries only."""
        for s, b, e in zip(self.shard.tolist(), self.begin, self.end):
            yield s, self.order[b:e]

    def __getitem__(self, shard: int) -> np.ndarray:
        i = self.at[shard]
        return self.order[self.begin[i] : self.end[i]]

    def spread(self, answers: dict[int, tuple], n: int) -> tuple[np.ndarray, np.ndarray]:
        """The a and the count of each of n entries from the shards' answers."""
        x, seen = np.zeros(n), np.zeros(n, dtype=np.int64)
        for k, (a, b) in answers.items():
            s = self[k]
            x[s] = VALUE[unpack(a, np.uint16)]
            if b:
                seen[s] = unpack(b, np.int64)
        return x, seen


def numbered(first: np.ndarray, second: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in ascending order, and each row's pair; `second` < n."""
    if len(first) and (int(first.max()) + 1) * n >= 1 << 63:
        raise OverflowError("a block has too many distinct tokens for pairs of 63 bits")
    key, of = np.unique(first * n + second, return_inverse=True)
    return key // n, key % n, of


class Grams:
    """A block's distinct n-grams as the shards want them: names in ascending order, (w2, w3) or (w2, w1, w3), their counts in
    training texts, the totals of their histories, and the n-gram of each token."""

    def __init__(self, t: Tokens, shards: int, answers: dict[int, dict], total: int, order: int):
        n = len(t.distinct)
        self.word_count, name = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        cut = t.by_shard(shards)
        for k, (a, b) in answers[1].items():
            self.word_count[cut[k]], name[cut[k]] = unpack(a, np.int64), unpack(b, np.int64) * shards + k
        by = np.argsort(name)
        rank = np.empty(n, dtype=np.int64)
        rank[by] = np.arange(n)
        name, count, begin = name[by], self.word_count[by], rank[t.begin]
        w3 = rank[t.token]
        w2 = np.roll(w3, 1)
        w2[t.start] = begin
        b, c, self.of_token = numbered(w2, w3, n)
        self.names, self.totals = (name[b], name[c]), count[b]
        if order == 3:
            p2, seen = self._cut(shards, total).spread(answers[2], len(b))
            self.lower = p2[self.of_token], backoff(self.totals, 2)[self.of_token]
            w1 = np.roll(w2, 1)
            w1[t.start] = begin
            here = np.roll(seen[self.of_token], 1)  # how often the pair before each token occurs
            here[t.start] = count[begin]
            b, a, of_history = numbered(w2, w1, n)
            totals = np.empty(len(b), dtype=np.int64)
            totals[of_history] = here
            h, c, self.of_token = numbered(of_history, w3, n)
            self.names, self.totals = (name[b[h]], name[a[h]], name[c]), totals[h]
        self.count = np.bincount(self.of_token[t.learned], minlength=len(self.totals))
        self.cut = self._cut(shards, total)

    def _cut(self, shards: int, total: int) -> Cut:
        """By the history; one of more than half a shard's tokens is spread over several shards by the last word."""
        h = np.zeros(len(self.totals), dtype=np.uint64)
        for x in self.names[:-1]:
            h = mix(h * np.uint64(31) + x.astype(np.uint64))
        split = (1 + self.totals * (2 * shards / max(total, 1))).astype(np.uint64)
        part = mix(self.names[-1].astype(np.uint64)) % split
        return Cut((mix(h + part) % np.uint64(shards)).astype(np.int64))


def send_words(shards: int):
    def run(batches):
        for pdf in batches:
            for block, payload in zip(pdf["block"], pdf["payload"]):
                t = Tokens(payload)
                rows = [(k, block, len(s), pack_sorted(t.distinct[s]), b"", b"", pack(t.count[s]), b"") for k, s in t.by_shard(shards)]
                yield frame(["shard", "block", "n", "a", "b", "c", "d", "e"], rows)

    return run


def count_words(shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        word = np.concatenate([unpack_sorted(a, np.uint64) for a in pdf["a"]])
        distinct, inverse = np.unique(word, return_inverse=True)
        total = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(total, inverse, np.concatenate([unpack(b, np.int64) for b in pdf["d"]]))
        rank = np.empty(len(distinct), dtype=np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(distinct))
        token = distinct != BEGIN
        sums = int((total[token] > 0).sum()), int(total[token].sum())
        at, rows = 0, []
        for shard, block, n in zip(pdf["shard"], pdf["block"], pdf["n"]):
            i = inverse[at : at + n]
            rows.append((1, shard, block, pack(total[i]), pack(rank[i]), *(sums if at == 0 else (0, 0))))
            at += n
        return frame(ANSWERS, rows)

    return run


def _answers(pdf: pd.DataFrame) -> dict[int, dict]:
    out: dict[int, dict] = {1: {}, 2: {}, 3: {}}
    for r, shard, a, b in zip(pdf["round"], pdf["shard"], pdf["a"], pdf["b"]):
        out[r][shard] = (a, b)
    return out


def backoff(totals: np.ndarray, order: int) -> np.ndarray:
    """The weight b of histories; the trie has it as a code, but a block knows the totals and need not be sent it."""
    return MU[order] / (totals + MU[order])


def send_grams(shards: int, total: int, order: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers, rows = _answers(right), []
        for block, payload in zip(left["block"], left["payload"]):
            g = Grams(Tokens(payload), shards, answers, total, order)
            for k, s in g.cut:
                names = [x[s] for x in g.names]
                rows.append((k, block, len(s), pack_sorted(names[0]), pack(names[1]) if order == 3 else b"", pack(names[-1]), pack(g.count[s].astype(np.uint32)), pack(g.totals[s][history_starts(names)])))
        return frame(["shard", "block", "n", "a", "b", "c", "d", "e"], rows)

    return run


def history_starts(names: list[np.ndarray]) -> np.ndarray:
    """Where the words before the last one change."""
    new = np.zeros(len(names[0]), dtype=bool)
    new[0] = True
    for x in names[:-1]:
        new[1:] |= x[1:] != x[:-1]
    return new


def to_code(x: np.ndarray) -> np.ndarray:
    """16 bits: 0 for zero, else 500 steps to a decade."""
    return np.where(x > 0, np.clip(np.round((np.log10(np.maximum(x, 1e-300)) + 120) * 500), 1, 65535), 0).astype(np.uint16)


def places_of(rows: list[np.ndarray]):
    """The sorted distinct values of some arrays, and a function that gives values their places. Numbers of words are dense,
    so that a table of them serves where it is small."""
    top = max(int(r.max()) for r in rows)
    if top < TABLE:
        there = np.zeros(top + 1, dtype=bool)
        for r in rows:
            there[r] = True
        names, place = np.flatnonzero(there), np.cumsum(there, dtype=np.uint32) - np.uint32(1)
        return names, lambda x: place[x]
    names = rows[0][:0]
    for begin in range(0, len(rows), 16):  # a few at a time: most names occur in many
        names = distinct(np.concatenate([names, *map(distinct, rows[begin : begin + 16])]))
    return names, lambda x: np.searchsorted(names, x).astype(np.uint32)


def shard_entries(pdf: pd.DataFrame, order: int):
    """The sorted names of a shard, and each entry's places in them (32 bits each), its count and its history's total."""
    read = {"a": lambda x: unpack_sorted(x, np.int64), "b": lambda x: unpack(x, np.int64), "c": lambda x: unpack(x, np.int64)}
    columns = ["a", "b", "c"] if order == 3 else ["a", "c"]
    names, place = places_of([read[k](x) for k in columns for x in pdf[k]])
    size = int(pdf["n"].sum())
    local = [np.empty(size, dtype=np.uint32) for _ in columns]
    count, total, at = np.empty(size, dtype=np.uint32), np.empty(size, dtype=np.int64), 0
    for row in pdf.itertuples(index=False):
        s = slice(at, at + row.n)
        mine = [read[k](getattr(row, k)) for k in columns]
        for out, x in zip(local, mine):
            out[s] = place(x)
        count[s] = unpack(row.d, np.uint32)
        total[s] = unpack(row.e, np.int64)[np.cumsum(history_starts(mine)) - 1]
        at += row.n
    return names, local, count, total


def ascending(local: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the entries by their columns of numbers below n, and where a new entry begins in it."""
    if n ** len(local) < 1 << 63:
        key = np.zeros(len(local[0]), dtype=np.int64)
        for x in local:
            key = key * n + x
        by = np.argsort(key)
        s = key[by]
        return by, np.concatenate([[True], s[1:] != s[:-1]])
    by = np.lexsort(tuple(reversed(local)))
    new = np.zeros(len(by), dtype=bool)
    new[0] = True
    for x in local:
        s = x[by]
        new[1:] |= s[1:] != s[:-1]
    return by, new


def answer_grams(order: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, local, count, total = shard_entries(pdf, order)
        by, new = ascending(local, len(names))
        first = np.flatnonzero(new)
        grams = tuple(x[by[first]] for x in local)
        total = total[by[first]]
        seen = np.add.reduceat(count[by].astype(np.int64), first)
        inverse = np.empty(len(by), dtype=np.uint32)
        inverse[by] = np.cumsum(new) - 1
        del by, new, local, count, first
        fd, path = tempfile.mkstemp(suffix=".trie")
        os.close(fd)
        try:
            Trie.build(names, grams, seen, total, MU[order]).save(path)
            trie = Trie.load(path)
            number = trie.numbers(names)
            x = np.concatenate([trie.weights(tuple(number[g[at : at + SLICE]] for g in grams), to_code)[0] for at in range(0, len(seen), SLICE)])
        finally:
            os.remove(path)
        at, rows = 0, []
        for shard, block, n in zip(pdf["shard"], pdf["block"], pdf["n"]):
            i = inverse[at : at + n]
            rows.append((order, shard, block, pack(x[i]), pack(seen[i]) if order == 2 else b"", 0, 0))
            at += n
        return frame(ANSWERS, rows)

    return run


def finish(shards: int, total: int, types: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers, out = _answers(right), []
        for payload in left["payload"]:
            t = Tokens(payload)
            g = Grams(t, shards, answers, total, 3)
            x, _ = g.cut.spread(answers[3], len(g.totals))
            y = backoff(g.totals, 3)
            c = g.word_count[t.token]
            one = (c + 1) / (total + types + 1)
            p = np.minimum(1.0, x[g.of_token] + y[g.of_token] * (g.lower[0] + g.lower[1] * one))
            n = len(t.size)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": t.batch.column("doc_id").to_pandas().astype("Int64"), "held_out": ~t.learn, "n_tokens": t.size, "n_known": np.bincount(t.doc[c > 0], minlength=n), "train_tokens": total,
                        "base_score": np.bincount(t.doc, weights=np.log10(one), minlength=n), "score": np.bincount(t.doc, weights=np.log10(p), minlength=n),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame()

    return run


def score(docs: DataFrame, shard_entries: int = SHARD_ENTRIES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row of (doc_id, held_out, text), learning from those that are not held out."""
    spark = docs.sparkSession
    held = docs.select("doc_id", F.coalesce("held_out", F.lit(True)).alias("held_out"), "text")
    made = write_blocks(held, block_bytes, tokenise)
    blocks, shards = made.table.select("block", "payload"), max(16, math.ceil(made.size / 6 / shard_entries))
    sent = blocks.mapInPandas(send_words(shards), SENT)
    rounds = [materialize(sent.groupBy("shard").applyInPandas(count_words(shards), ANSWER), "words")]
    sums = rounds[0].agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))).first()
    total, types = int(sums[0]), int(sums[1])
    for order in (2, 3):
        sent = blocks.groupBy("block").cogroup(union(rounds).groupBy("block")).applyInPandas(send_grams(shards, total, order), SENT)
        rounds.append(materialize(sent.groupBy("shard").applyInPandas(answer_grams(order), ANSWER), f"grams{order}"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scores = materialize(blocks.groupBy("block").cogroup(union(rounds).groupBy("block")).applyInPandas(finish(shards, total, types), schema), "scores")
    for r in rounds:
        release(spark, r)
    made.drop()
    return scores


def union(rounds: list[DataFrame]) -> DataFrame:
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def op1_lm_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "text"))
