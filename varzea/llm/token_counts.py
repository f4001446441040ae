"""Token counts by rank-synchronous array merging.

A task holds the distinct words of a slice of texts as pre-tokens in one ragged numpy array of symbols. Each round finds
the lowest-ranked pair of every pre-token and merges it everywhere in that pre-token, all pre-tokens at once; pre-tokens
without a pair that merges leave. What is left of a pre-token is its number of tokens. A pre-token of more than LONG
symbols would need as many rounds as it has different pairs: it goes rank by rank through buckets of positions instead,
which takes work in proportion to its length and gives the same symbols.

Texts are cut at ASCII white space, over which neither the normal form, nor the pre-tokens, nor special strings reach, and
each distinct word is counted once per task as long as it is remembered (REMEMBERED words of up to LONG bytes; a full
memory is emptied, which costs time and changes no count). There is no shuffle: a task's memory is bounded by its slice
of texts or its longest text.

Edge cases: null, empty and blank texts have 0 tokens; rows are kept as they are, repeated rows and null ids included;
other columns of the table are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from varzea.llm.common import chunks, table, utf8

LIMIT = 2048
REMEMBERED = 400_000
LONG = 512
NEVER = np.int32(2**31 - 1)

OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it prints, else one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


@dataclass(frozen=True)
class Merges:
    """A byte-level merge table with word ends: sorted keys left * size + right, and what each gives."""

    first: np.ndarray  # the symbol of a byte
    last: np.ndarray  # that of a byte which ends a pre-token
    size: int
    key: np.ndarray
    rank_of_key: np.ndarray
    left: np.ndarray  # by rank
    right: np.ndarray
    merged: np.ndarray

    @classmethod
    def load(cls, path: str) -> Merges:
        model = json.load(open(path, encoding="utf-8"))["model"]
        number, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([number[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([number[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([number[a + b] for a, b in pairs], dtype=np.int32)
        size = max(number.values()) + 1
        key = left * size + right
        by = np.argsort(key)
        chars = byte_characters()
        symbols = lambda suffix: np.array([number[c + suffix] for c in chars], dtype=np.int32)
        return cls(symbols(""), symbols(end), size, key[by], by.astype(np.int32), left.astype(np.int32), right.astype(np.int32), merged)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of pairs of symbols; NEVER where none merges."""
        want = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.rank_of_key[at], NEVER)


def every_other(at: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of ascending places, those that a scan from the left takes when a place that directly `follows` a taken one is passed over."""
    start = np.flatnonzero(~follows)
    run = np.cumsum(~follows) - 1
    return at[(np.arange(len(at)) - start[run]) % 2 == 0]


def merge_all(symbols: np.ndarray, size: np.ndarray, table: Merges) -> np.ndarray:
    """Symbols left of each sequence; `symbols` holds the sequences one after the other, `size` their lengths (1 or more)."""
    left = size.copy()
    active = np.flatnonzero(size > 1)
    sequence = np.repeat(np.arange(len(size)), size)
    keep = (size > 1)[sequence]
    symbols, sequence = symbols[keep], sequence[keep]
    rank = np.full(len(symbols), NEVER, dtype=np.int32)  # of the pair that begins at a symbol
    inside = np.flatnonzero(sequence[:-1] == sequence[1:]) if len(symbols) else np.zeros(0, dtype=np.int64)
    rank[inside] = table.rank(symbols[inside], symbols[inside + 1])
    while len(active):
        begin = np.concatenate([[0], np.cumsum(left[active])[:-1]])
        least = np.minimum.reduceat(rank, begin)
        done = least == NEVER
        if done.any():
            keep = np.repeat(~done, left[active])
            symbols, sequence, rank = symbols[keep], sequence[keep], rank[keep]
            active, least = active[~done], least[~done]
            if not len(active):
                break
        of = np.repeat(least, left[active])
        at = np.flatnonzero(rank == of)
        at = every_other(at, np.concatenate([[False], np.diff(at) == 1]))
        symbols[at] = table.merged[rank[at]]
        gone = np.zeros(len(symbols), dtype=bool)
        gone[at + 1] = True
        touched = np.zeros(len(symbols), dtype=bool)
        touched[at] = True
        left -= np.bincount(sequence[at], minlength=len(left))
        symbols, sequence, rank, touched = symbols[~gone], sequence[~gone], rank[~gone], touched[~gone]
        new = touched.copy()
        new[:-1] |= touched[1:]
        new = np.flatnonzero(new)
        rank[new] = NEVER
        new = new[new + 1 < len(symbols)]
        new = new[sequence[new] == sequence[new + 1]]
        rank[new] = table.rank(symbols[new], symbols[new + 1])
    return left


def merge_long(symbols: np.ndarray, table: Merges) -> int:
    """Symbols left of one long sequence. A pair's rank is above those of the pairs that made its symbols, so ranks go upwards only."""
    n = len(symbols)
    symbols, after, before, alive = np.append(symbols, -1), np.arange(1, n + 2), np.arange(-1, n), np.ones(n + 1, dtype=bool)
    buckets: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def add(at: np.ndarray) -> None:
        at = at[(at >= 0) & (after[at] < n)]
        rank = table.rank(symbols[at], symbols[after[at]])
        at, rank = at[rank != NEVER], rank[rank != NEVER]
        by = np.argsort(rank, kind="stable")
        edges = np.flatnonzero(np.diff(rank[by], prepend=-1))
        for places, r in zip(np.split(at[by], edges[1:]) if len(edges) else [], rank[by][edges].tolist()):
            if r not in buckets:
                heapq.heappush(ranks, r)
            buckets.setdefault(r, []).append(places)

    add(np.arange(n))
    while ranks:
        r = heapq.heappop(ranks)
        at = np.unique(np.concatenate(buckets.pop(r)))
        at = at[alive[at] & (symbols[at] == table.left[r]) & (after[at] < n)]
        at = at[symbols[after[at]] == table.right[r]]
        if not len(at):
            continue
        at = every_other(at, np.concatenate([[False], at[1:] == after[at[:-1]]]))
        second = after[at]
        symbols[at], alive[second] = table.merged[r], False
        after[at] = after[second]
        before[after[at]] = at
        add(np.unique(np.concatenate([before[at], at])))
    return int(alive[:n].sum())


class Counter:
    """The number of tokens of words: normal form and pre-tokens of the tokenizer's file, merges by arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.merges = Merges.load(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = regex.compile("|".join(map(regex.escape, self.special)))
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern, self.with_ends = regex.compile(pattern), regex.compile(pattern + r"|\n")
        own = Tokenizer.from_file(path)
        self.normal, self.words = own.normalizer, own.pre_tokenizer
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.agreed: dict[str, bool] = {}
        self.known: dict[bytes, int] = {}

    def agrees(self, c: str) -> bool:
        """Whether this Python's Unicode tables treat a character as those of the tokenizer's library do; both change over the years."""
        if c not in self.agreed:
            raw = [self.raw(x) for x, _ in self.words.pre_tokenize_str("a" + c + c)]
            same_normal = c.isspace() or self.normal.normalize_str(c) == lower(unicodedata.normalize("NFC", c))
            self.agreed[c] = same_normal and unicodedata.category(c) != "Cn" and raw == [x.encode() for x in self.pattern.findall("a" + c + c)]
        return self.agreed[c]

    def raw(self, word: str) -> bytes:
        """The bytes of a pre-token of the library, which writes each as a character."""
        return bytes(map(self.byte_of.__getitem__, word))

    def pre_tokens(self, words: list[str]) -> list[str]:
        """The pre-tokens of some words, and a line feed after each word's."""
        joined = "\n".join(words) + "\n"
        odd = set() if joined.isascii() else {c for c in set(joined) if not self.agrees(c)}
        if not odd:
            return self.with_ends.findall(lower(joined if joined.isascii() else unicodedata.normalize("NFC", joined)))
        out = []
        for w in words:
            if odd.isdisjoint(w):
                out += self.with_ends.findall(lower(unicodedata.normalize("NFC", w)))
            else:
                out += [self.raw(x).decode("utf-8") for x, _ in self.words.pre_tokenize_str(self.normal.normalize_str(w))]
            out.append("\n")
        return out

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word, none of which holds a line feed."""
        out = np.zeros(len(words), dtype=np.int64)
        if not words:
            return out
        parts, owner = b"\n".join(words).decode("utf-8").split("\n"), np.arange(len(words))
        if any("<|" in p for p in parts):
            cut = [self.split_special.split(p) for p in parts]
            out += np.array([len(c) - 1 for c in cut])
            parts, owner = [p for c in cut for p in c], np.repeat(owner, [len(c) for c in cut])
        found = self.pre_tokens(parts)
        distinct = {x: k for k, x in enumerate(dict.fromkeys(found))}
        number = np.fromiter(map(distinct.__getitem__, found), dtype=np.int64, count=len(found))
        stop = number == distinct["\n"]
        np.add.at(out, owner[(np.cumsum(stop) - stop)[~stop]], self.left([x.encode("utf-8") for x in distinct])[number[~stop]])
        return out

    def left(self, pre_tokens: list[bytes]) -> np.ndarray:
        """Symbols that are left of each pre-token."""
        size = np.fromiter(map(len, pre_tokens), dtype=np.int64, count=len(pre_tokens))
        data = np.frombuffer(b"".join(pre_tokens), dtype=np.uint8)
        symbols, ends = self.merges.first[data], np.cumsum(size)
        symbols[ends - 1] = self.merges.last[data[ends - 1]]
        out, long = np.empty(len(size), dtype=np.int64), size > LONG
        out[~long] = merge_all(symbols[~np.repeat(long, size)], size[~long], self.merges)
        for i in np.flatnonzero(long):
            out[i] = merge_long(symbols[ends[i] - size[i] : ends[i]], self.merges)
        return out

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text."""
        split = [t.split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({w for ws in split for w in ws}.difference(self.known))
        once = dict(zip(new, self.count(new).tolist()))
        self.known.update((w, n) for w, n in once.items() if len(w) <= LONG)
        number = self.known if all(len(w) <= LONG for w in new) else self.known | once
        return np.fromiter((sum(map(number.__getitem__, ws)) for ws in split), dtype=np.int64, count=len(split))


def lower(text: str) -> str:
    """Character by character: no form of sigma at a word's end."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each file and Python worker."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of (doc_id, text), by the tokenizer file at `path`."""

    def run(batches):
        own = counter(path)
        for batch in batches:
            texts, at = utf8(batch.column("text")), 0
            for part in chunks(texts):
                some = texts[part]
                n = own.totals(some)
                ids = batch.column("doc_id").slice(at, len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in some], pa.int64()), pa.array(n), pa.array(n > limit)], schema=OUT)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
