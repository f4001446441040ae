"""Alignment of two tokenizers by a dictionary of token groups.

Byte offsets where tokens of both tokenizers end cut the tokens of a text into groups. Groups repeat far more often than
they differ, so a task interns each distinct group (its A ids and B ids), writes the documents of a block as numbers of
groups, and keeps the block's dictionary beside them. Links are expanded once for each distinct group: in a block to count
the documents of each id pair, and over the corpus to add up the counts of a group's links. A document's sums are its
group frequencies times the values of the groups, which Spark joins back to the blocks by the group's ids.

Tokens are those of the libraries. A text is encoded in units: from a space after a character that is no white space to the
next such space. Neither tokenizer has a token across such a place (`Aligner` checks this of the vocabularies, and else
takes the whole text as one unit), so each distinct unit is encoded once as long as a task remembers it.

What is broadcast: the highest count of each A id, at most as many rows as A's vocabulary. The count of a pair is of
documents, each in one block, so blocks add up. A key that is in every block is one row for each block, and its sums are
pre-aggregated. Memory of a task: a block of documents (3 MB, or one document) and REMEMBERED units.

Edge cases: texts that are null, empty, or whose joined tokens differ from space+text have zeros and ''; repeated rows and
null ids count as documents of their own; columns other than doc_id and text are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.blocks import arrow_payload, join_parts, pack, pack_sorted, read_block, split_parts, unpack, unpack_sorted, write_blocks
from varzea.llm.common import chunks, materialize, release, table
from varzea.llm.token_counts import byte_characters

REMEMBERED = 300_000  # units
PART = 2_000_000  # characters of a text that are split at once

#: from a space to before the next space that follows a character which is no white space
UNIT = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
EDGE = re.compile(r"(?<=\S) ")

OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def parts_of(text: str, whole: bool):
    """A text in parts of about PART characters that end where units end."""
    begin = 0
    while not whole and len(text) - begin > PART:
        edge = EDGE.search(text, begin + PART)
        if not edge:
            break
        yield text[begin : edge.start()]
        begin = edge.start()
    yield text[begin:]


def spread(first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists that lie one after the other, `first` their starts and end: the places of the items of the chosen lists, and which choice each is of."""
    size = first[chosen + 1] - first[chosen]
    of = np.repeat(np.arange(len(chosen)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[chosen], size), of


class Aligner:
    """Two tokenizers, and the units and groups that a task has met."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        number = {c: i for i, c in enumerate(byte_characters())}
        named = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=False).items())
        self.bytes_a = {i: bytes(map(number.__getitem__, t)) for i, t in named}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        split = json.loads(self.a.to_str())["pre_tokenizer"]
        self.whole = not (split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]) or any("▁" in p.lstrip("▁") for p in pieces)
        self.size_b = len(pieces)
        self.length_a = np.zeros(max(self.bytes_a) + 1, dtype=np.int64)
        self.length_a[list(self.bytes_a)] = [len(x) for x in self.bytes_a.values()]
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.kind = np.uint16 if max(len(self.length_a), self.size_b) < 65535 else np.uint32
        self.between = np.iinfo(self.kind).max  # stands between the A ids and the B ids of a group
        self.space = self.b.piece_to_id("▁")
        self.reset()

    def reset(self) -> None:
        self.unit: dict[str, int] = {}
        self.text: list[str] = []  # of a unit, as its document's digest takes it
        self.group: dict[bytes, int] = {}
        self.named: list[str] = []  # of a group
        self.keys: list[bytes] = []
        none = np.zeros(0, dtype=np.int64)
        self.ok, self.n_a, self.n_b = np.zeros(0, dtype=bool), none, none
        self.groups, self.group_first = none, np.zeros(1, dtype=np.int64)
        self.links, self.link_first = none, np.zeros(1, dtype=np.int64)

    def encode_joined(self, units: list[str]) -> list[np.ndarray] | None:
        """The A ids and B ids of units one after the other, and each unit's numbers of them. The units are encoded as one text, in
        which they are units again; None if the tokens' bytes are not the text's."""
        text = "".join(units)
        a, b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:], num_threads=1)
        raw = text.encode("utf-8")
        if any(i not in self.bytes_a for i in set(a)) or b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        ends = np.cumsum([len(u.encode("utf-8")) for u in units])
        out = [np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)]
        for ids, length in zip(list(out), (self.length_a, self.length_b)):
            token = np.cumsum(length[ids])
            at = np.searchsorted(token, ends)
            if not (token[at] == ends).all():
                return None
            out.append(np.diff(at, prepend=-1))
        return out

    def learn(self, units: list[str]) -> None:
        """Encode units that are new, and intern their groups."""
        if not units:
            return
        plain, rest = [u for u in units if not u[-1].isspace()], [u for u in units if u[-1].isspace()]  # only a text's last unit ends in white space
        made = self.encode_joined(plain) if plain and not self.whole else None
        if made is None:
            plain, rest, made = [], units, [np.zeros(0, dtype=np.int64)] * 4
        units = plain + rest
        raw = [u.encode("utf-8") for u in units]
        in_a = [e.ids for e in self.a.encode_batch_fast(rest, add_special_tokens=False)]
        in_b = [[self.space] if u == " " else x for u, x in zip(rest, self.b.encode([u[1:] for u in rest], num_threads=1))] if rest else []
        fine = [all(i in self.bytes_a for i in x) and b"".join(map(self.bytes_a.get, x)) == r == b"".join(map(self.bytes_b.__getitem__, y)) for r, x, y in zip(raw[len(plain) :], in_a, in_b)]
        in_a, in_b = [x if k else [] for x, k in zip(in_a, fine)], [x if k else [] for x, k in zip(in_b, fine)]
        ok = np.concatenate([np.ones(len(plain), dtype=bool), np.array(fine, dtype=bool)])
        flat = lambda x: np.fromiter((i for ids in x for i in ids), dtype=np.int64)
        sizes = lambda x: np.fromiter(map(len, x), dtype=np.int64, count=len(x))
        a, b, n_a, n_b = (np.concatenate(x) for x in zip(made, (flat(in_a), flat(in_b), sizes(in_a), sizes(in_b))))
        unit_end = np.cumsum(np.where(ok, np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)), 0))
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b, of_unit = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b), np.searchsorted(unit_end, cut)
        size_a, size_b = np.bincount(of_a, minlength=len(cut)), np.bincount(of_b, minlength=len(cut))
        start = np.concatenate([[0], np.cumsum(size_a + size_b + 1)])
        flat = np.full(int(start[-1]), self.between, dtype=self.kind)
        flat[np.arange(len(a)) + of_b_before(of_a, size_b)] = a
        flat[np.arange(len(b)) + np.cumsum(size_a)[of_b] + of_b + 1] = b
        data, wide = flat.tobytes(), flat.itemsize
        keys = [data[x:y] for x, y in zip((start[:-1] * wide).tolist(), (start[1:] * wide).tolist())]
        # a link is a stretch between neighbouring ends of either tokenizer
        stretch = np.union1d(end_a, end_b)
        links = a[np.searchsorted(end_a, stretch)] * self.size_b + b[np.searchsorted(end_b, stretch)]
        of_link = np.searchsorted(cut, stretch)
        known = len(self.keys)
        number, new = np.empty(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        for i, k in enumerate(keys):
            n = self.group.setdefault(k, len(self.keys))
            if n == len(self.keys):
                self.keys.append(k)
                new[i] = True
            number[i] = n
        for k in self.keys[known:]:
            ids = np.frombuffer(k, dtype=self.kind).tolist()
            at = ids.index(self.between)
            self.named.append(",".join(map(str, ids[:at])) + "|" + ",".join(map(str, ids[at + 1 :])))
        self.links = np.concatenate([self.links, links[new[of_link]]])
        self.link_first = np.concatenate([self.link_first, self.link_first[-1] + np.cumsum(np.bincount(of_link, minlength=len(cut))[new])])
        each = np.bincount(of_unit, minlength=len(units))
        begin, names = np.cumsum(each) - each, [self.named[n] for n in number.tolist()]
        self.text += [";".join(names[x : x + n]) for x, n in zip(begin.tolist(), each.tolist())]
        self.groups = np.concatenate([self.groups, number])
        self.group_first = np.concatenate([self.group_first, self.group_first[-1] + np.cumsum(each)])
        self.ok, self.n_a, self.n_b = (np.concatenate(x) for x in ((self.ok, ok), (self.n_a, n_a), (self.n_b, n_b)))
        self.unit.update(zip(units, range(len(self.unit), len(self.unit) + len(units))))

    def block(self, batch: pa.RecordBatch) -> bytes:
        """The documents of a block: their counts, the frequencies of their groups, the dictionary of groups, the documents of each pair."""
        if len(self.unit) > REMEMBERED:
            self.reset()
        texts = batch.column("text").to_pylist()
        parts, owner = [], []
        for i, t in enumerate(texts):
            for p in parts_of(" " + t, self.whole) if t else ():
                parts.append(p)
                owner.append(i)
        digests, units, docs = [hashlib.sha256() for _ in texts], [], []
        begun, good = [False] * len(texts), np.array([bool(t) for t in texts], dtype=bool)
        for some in chunks(parts):
            split = [[p] if self.whole else UNIT.findall(p) for p in parts[some]]
            self.learn(sorted({u for x in split for u in x}.difference(self.unit)))
            for i, x in zip(owner[some], split):
                of = np.fromiter(map(self.unit.__getitem__, x), dtype=np.int64, count=len(x))
                digests[i].update((b";" if begun[i] else b"") + ";".join(map(self.text.__getitem__, of.tolist())).encode())
                begun[i], good[i] = True, good[i] and bool(self.ok[of].all())
                units.append(of)
                docs.append(np.full(len(of), i))
        none = np.zeros(0, dtype=np.int64)
        unit, doc = np.concatenate([none, *units]), np.concatenate([none, *docs])
        unit, doc = unit[good[doc]], doc[good[doc]]
        n = len(texts)
        total = lambda x: np.bincount(doc, weights=x[unit], minlength=n).astype(np.int64)
        n_a, n_b, n_groups = total(self.n_a), total(self.n_b), total(np.diff(self.group_first))
        digest = [d.hexdigest() if g else "" for d, g in zip(digests, good)]

        found, often = np.unique(doc * len(self.ok) + unit, return_counts=True)
        at, of = spread(self.group_first, found % max(1, len(self.ok)))
        held = (found // max(1, len(self.ok)))[of] * len(self.keys) + self.groups[at]
        held, back = np.unique(held, return_inverse=True)
        often = np.bincount(back, weights=often[of], minlength=len(held)).astype(np.int64)
        doc, group = held // max(1, len(self.keys)), held % max(1, len(self.keys))
        at, of = spread(self.link_first, group)
        every = len(self.length_a) * self.size_b
        pair, n_docs = np.unique(np.unique(doc[of] * every + self.links[at]) % every, return_counts=True)

        # numbers of groups depend on what the task met before; a block's own are in the order of their ids, as a repeated task must give the same block
        own, local = np.unique(group, return_inverse=True)
        keys = [self.keys[g] for g in own.tolist()]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys = [keys[k] for k in order]
        place = np.empty(len(keys), dtype=np.int64)
        place[order] = np.arange(len(keys))
        by = np.argsort(doc * len(keys) + place[local])
        local, often = place[local][by], often[by]
        rows = pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups, "groups_sha256": digest})
        per_doc = np.bincount(doc, minlength=n)
        sizes = np.fromiter(map(len, keys), dtype=np.uint32, count=len(keys))
        return join_parts(arrow_payload(rows), pack(per_doc.astype(np.uint32)), pack(local.astype(np.uint32)), pack(often.astype(np.uint32)), pack(sizes), b"".join(keys), pack_sorted(pair), pack(n_docs.astype(np.uint32)))


def of_b_before(of_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """For each A token: the B tokens and marks of the groups before its own."""
    return (np.cumsum(size_b) - size_b)[of_a] + of_a


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each Python worker."""
    return Aligner(path_a, path_b)


def keys_of(parts: list[bytes]) -> list[bytes]:
    ends = np.cumsum(unpack(parts[4], np.uint32).astype(np.int64)).tolist()
    return [parts[5][x:y] for x, y in zip([0, *ends], ends)]


def send_pairs(batches):
    """Each pair of a block and the number of its documents."""
    for batch in batches:
        for payload in batch.column("payload").to_pylist():
            parts = split_parts(payload)
            yield pa.RecordBatch.from_pydict({"pair": unpack_sorted(parts[6], np.int64), "n": unpack(parts[7], np.uint32).astype(np.int64)})


def send_groups(batches):
    """Each group of a block, and its number there."""
    for batch in batches:
        for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
            keys = keys_of(split_parts(payload))
            yield pa.RecordBatch.from_pydict({"block": np.full(len(keys), block), "at": np.arange(len(keys), dtype=np.int32), "key": pa.array(keys, pa.binary())})


def expand(path_a: str, path_b: str):
    """The links of each group: pair and how often it is among them."""

    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            keys = batch.column("key").to_pylist()
            of, pairs = [], []
            for i, key in enumerate(keys):
                ids = np.frombuffer(key, dtype=own.kind).astype(np.int64)
                at = int(np.argmax(ids == own.between))
                a, b = ids[:at], ids[at + 1 :]
                end_a, end_b = np.cumsum(own.length_a[a]), np.cumsum(own.length_b[b])
                stretch = np.union1d(end_a, end_b)
                pairs.append(a[np.searchsorted(end_a, stretch)] * own.size_b + b[np.searchsorted(end_b, stretch)])
                of.append(np.full(len(stretch), i))
            if keys:
                every = len(own.length_a) * own.size_b
                found, times = np.unique(np.concatenate(of) * every + np.concatenate(pairs), return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": batch.column("key").take(pa.array(found // every)), "pair": found % every, "times": times.astype(np.int64)})

    return run


def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block with their sums, from the values of its groups."""
    out, at = [], right["at"].to_numpy()
    for payload in left["payload"]:
        parts = split_parts(payload)
        rows = read_block(parts[0]).to_pandas(integer_object_nulls=True)
        per_doc, local, often = (unpack(parts[k], np.uint32).astype(np.int64) for k in (1, 2, 3))
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        for name in ("n_best", "count_sum"):
            value = np.zeros(len(unpack(parts[4], np.uint32)), dtype=np.int64)
            value[at] = right[name].to_numpy()
            sums = np.zeros(len(per_doc), dtype=np.int64)
            np.add.at(sums, doc, value[local] * often)
            rows[name] = sums
        rows["doc_id"] = rows["doc_id"].astype("Int64")
        out.append(rows)
    return pd.concat(out) if out else pd.DataFrame()


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each row of (doc_id, text): tokens, groups and links, and how common the links are in the corpus."""
    spark = docs.sparkSession
    made = write_blocks(docs.select("doc_id", "text"), payload=lambda batch: aligner(path_a, path_b).block(batch))
    blocks = made.table.select("block", "payload")
    size_a, size_b = vocabulary_sizes(path_a, path_b)

    pairs = blocks.mapInArrow(send_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = materialize(pairs.withColumn("a", F.floor(F.col("pair") / size_b)), "pairs")
    highest = pairs.groupBy("a").agg(F.max("n").alias("most"))  # at most size_a rows
    counts = pairs.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))

    met = blocks.mapInArrow(send_groups, "block long, at int, key binary")
    links = met.select("key").distinct().mapInArrow(expand(path_a, path_b), "key binary, pair long, times long")
    values = links.join(counts, "pair").groupBy("key").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    values = materialize(values, "groups")
    answers = met.join(values, "key").select("block", "at", "n_best", "count_sum")
    result = materialize(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, OUT), "alignment")
    for done in (pairs, values):
        release(spark, done)
    made.drop()
    return result


def vocabulary_sizes(path_a: str, path_b: str) -> tuple[int, int]:
    own = aligner(path_a, path_b)
    return len(own.length_a), own.size_b


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
