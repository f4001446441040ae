"""Token counts against the tokenizer's own library."""

import random

import numpy as np
import public_tokenizers
import pytest
from fixed import SF
from tokenizers import Tokenizer

from varzea.llm.token_counts import Counter, merge_all, merge_long, op11_token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    return lambda texts: [len(x.ids) for x in own.encode_batch(list(texts), add_special_tokens=False)]


def test_awkward_texts(library):
    rng = random.Random(3)
    texts = ["", " \t\n", "a" * 5000, "aaab" * 3000, "漢字かな" * 900, "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "é ́x", "x<|endoftext|>Y <|startoftext|> <|ENDOFTEXT|> <|endof", "a\x1cb\x85c\xa0d", "don't WE'LL 's", " x　y ", "1234 ４５ ²"]
    ranges = [(32, 127), (0xA0, 0x3000), (0x3000, 0xD7FF), (0x10000, 0x33500)]
    texts += ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    assert Counter(PATH).totals([t.encode() for t in texts]).tolist() == library(texts)


def test_every_character(library):
    texts = [f"a{chr(c)}{chr(c)}B" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 17 == 0)]
    own = Counter(PATH)
    got = [n for i in range(0, len(texts), 20_000) for n in own.totals([t.encode() for t in texts[i : i + 20_000]]).tolist()]
    assert got == library(texts)


def test_both_layouts_leave_the_same_symbols():
    rng, own = random.Random(8), Counter(PATH).merges
    for alphabet in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz"):
        for n in (1, 2, 3, 40, 700):
            symbols = own.first[np.frombuffer("".join(rng.choice(alphabet) for _ in range(n)).encode(), dtype=np.uint8)]
            assert merge_long(symbols, own) == merge_all(symbols, np.array([n]), own)[0]


def test_a_full_memory_changes_nothing(monkeypatch, library):
    monkeypatch.setattr("varzea.llm.token_counts.REMEMBERED", 3)
    own, texts = Counter(PATH), ["one two three four five six", "one two seven " * 3, "one " + "x" * 3000] * 2
    assert [n for t in texts for n in own.totals([t.encode()]).tolist()] == library(texts)


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_query(spark, odd_dir, library, where):
    base = odd_dir if where == "odd" else SF
    docs = [(r[0], r[1] or "") for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, len(t.encode()), n, n > 2048) for (i, t), n in zip(docs, library(t for _, t in docs))]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1:])
    assert sorted(map(tuple, op11_token_counts(spark, base).collect()), key=key) == sorted(want, key=key)
