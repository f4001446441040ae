"""Source divergence against a plain version in whole numbers, and its registered SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from fixed import SF

from varzea.llm.oracles import oracle_sql
from varzea.llm.source_divergence import divergence, op12_source_divergence, share

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least):
    """Rows of (lang, source, text) documents."""
    docs = [tuple(x or "" for x in d) for d in docs]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOW)) for _, _, t in docs]
    often, count, sources = Counter(), defaultdict(Counter), defaultdict(set)
    for (lang, source, _), ws in zip(docs, terms):
        often.update((lang, w) for w in set(ws))
        sources[lang].add(source)
    for (lang, source, _), ws in zip(docs, terms):
        kept = [w for w in ws if often[lang, w] >= least]
        count[lang, source].update(kept)
        count[lang].update(kept)
    rows = []
    for lang, names in sources.items():
        v = [w for (x, w), n in often.items() if x == lang and n >= least]
        of = lambda c: {w: 1 + 1_000_000_000 * (c[w] + 5) // (sum(c.values()) + 5 * len(v)) for w in v}  # noqa: E731, B023
        q, p = of(count[lang]), {s: of(count[lang, s]) for s in names}
        for s in names:
            pairs = sorted((-sum(abs(p[s][w] - p[o][w]) for w in v), o.encode()) for o in names if o != s)
            more = sorted((q[w] - p[s][w], w.encode()) for w in v if count[lang, s][w] and p[s][w] > q[w])[:50]
            for part, found in (("pair", pairs), ("term", more)):
                rows += [(lang, s, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(rows)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(7)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(300)] + ["ΑΣ", "漢", "\U0001f600", "İ"]
    out = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "B", "é", None, "hot", "hot", "hot"]), " ".join(rng.choice(words).title() + rng.choice(["", "1", ",", "\x00", "_"]) for _ in range(rng.randrange(0, 80)))) for _ in range(400)]
    return [*out, ("fr", "x", "only here"), ("fr", "y", None), ("fr", "z", ""), ("en", "without", "..."), out[0], out[0], ("en", "a", "same " * 3000)]


@pytest.mark.parametrize("least", [1, 6])
def test_equals_the_plain_version(spark, docs, least, monkeypatch):
    from varzea.llm import source_divergence as s

    monkeypatch.setattr(s, "CELLS", 300)  # many chunks
    monkeypatch.setattr(s, "ENTRIES", 50)
    got = divergence(spark.createDataFrame(docs, "lang string, source string, text string"), least)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect()) == plain(docs, least)


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_query_and_its_sql(spark, odd_dir, where):
    base = odd_dir if where == "odd" else SF
    columns = ("lang", "source", "part", "item", "value", "rank")
    docs = [tuple(r) for r in spark.read.parquet(f"{base}/documents.parquet").select("lang", "source", "text").collect()]
    got = sorted(tuple(r[c] for c in columns) for r in op12_source_divergence(spark, base).collect())
    assert got == plain(docs, 30)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{base}/documents.parquet{'/*.parquet' if where == 'odd' else ''}')")
    result = con.execute(oracle_sql()["op12_source_divergence"])
    names = [d[0] for d in result.description]
    assert got == sorted(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


def test_shares_of_large_counts_are_exact():
    count, total, v = [0, 7, 8_999_999_999_999_000, 10**12], 8_999_999_999_999_900, 19
    want = [1 + 1_000_000_000 * (c + 5) // (total + 5 * v) for c in count]
    assert share(np.array(count), np.int64(total), v).tolist() == want
