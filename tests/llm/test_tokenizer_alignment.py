"""Tokenizer alignment against a plain version, a document at a time."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from fixed import SF
from tokenizers import Tokenizer

from varzea.llm import tokenizer_alignment as t

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(docs):
    """Rows of (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of (doc_id, text) rows."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    chars = {c: i for i, c in enumerate(t.byte_characters())}
    all_links, rows = [], []
    for _, text in docs:
        text = text or ""
        in_a, in_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in in_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if len(p := b.id_to_piece(i)) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for i in in_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            all_links.append([])
            rows.append((0, 0, 0, 0, ""))
            continue
        spans = [[], []]
        for out, pieces in zip(spans, (bytes_a, bytes_b)):
            at = 0
            for p in pieces:
                out.append((at, at := at + len(p)))
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, i, j = [], 0, 0
        for c in cuts:
            x, y = [], []
            while i < len(in_a) and spans[0][i][1] <= c:
                x.append(str(in_a[i]))
                i += 1
            while j < len(in_b) and spans[1][j][1] <= c:
                y.append(str(in_b[j]))
                j += 1
            groups.append(",".join(x) + "|" + ",".join(y))
        links, j = [], 0
        for (s, e), x in zip(spans[0], in_a):
            while j and spans[1][j][0] > s:
                j -= 1
            k = j
            while k < len(in_b) and spans[1][k][0] < e:
                if spans[1][k][1] > s:
                    links.append((x, in_b[k]))
                k += 1
            j = max(0, k - 1)
        all_links.append(links)
        rows.append((len(in_a), len(in_b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for links in all_links for p in set(links))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    return [(i, *r[:4], sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), r[4]) for (i, _), links, r in zip(docs, all_links, rows)]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def key(x):
    return x[0] is not None, x[0] or 0, x[1:]


def awkward():
    rng = random.Random(5)
    ranges = [(32, 127), (9, 14), (0xA0, 0x3000), (0x3000, 0xD7FF), (0x10000, 0x1FFFF), (32, 33), (97, 123)]
    texts = [None, "", " ", "  ", "\n", "a ", " a", "a  b\t\n c \n", "<|endoftext|> <s> </s><unk>", "▁a b▁", "<0x41> x", "don't  we'll", "漢字 かな", "é́ x\x00y \x1c z", "x y z", "a" * 3000, "tail   "]
    texts += ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    return [(i, x) for i, x in enumerate(texts)] + [(3, "again  "), (None, "the quick brown fox"), (None, "the quick brown fox")]


@pytest.mark.parametrize("where", ["awkward", "odd", "sf"])
def test_equals_the_plain_version(spark, odd_dir, where):
    if where == "awkward":
        docs = awkward()
        got = t.alignment(spark.createDataFrame(docs, "doc_id long, text string"), A, B)
    else:
        base = odd_dir if where == "odd" else SF
        docs = [tuple(r) for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()]
        got = t.op13_tokenizer_alignment(spark, base)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=key) == sorted(plain(docs), key=key)


def test_blocks_do_not_depend_on_what_a_task_met_before(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in awkward()], "text": [x for _, x in awkward()]})
    own = t.Aligner(A, B)
    fresh = own.block(batch)
    own.reset()
    own.learn([" other", " x", " quick fox"[:6]])
    assert own.block(batch) == fresh
    monkeypatch.setattr(t, "PART", 7)  # texts are split in many parts
    assert t.Aligner(A, B).block(batch) == fresh
    monkeypatch.setattr(t, "REMEMBERED", 5)
    assert own.block(batch) == fresh
