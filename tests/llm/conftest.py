"""Small tables with awkward rows: nulls in every column, empty and very long texts, ties, repeated rows, further columns with clashing names."""

import random

import pytest

#: names that the operators use themselves
CLASHING = "q rate n_tokens n_words kept row w h s key block payload fp node size _text _t _id score lang_pred n_bytes _w found".split()


def sentence(rng, n):
    words = "river house old bridge stone market road winter garden light people small great water letter north village table paper window".split()
    return " ".join(rng.choice(words) + (str(rng.randrange(50)) if rng.random() < 0.3 else "") for _ in range(n))


def rows():
    rng = random.Random(4)
    long = sentence(rng, 30_000)
    shared = sentence(rng, 40)
    near = sentence(rng, 200)
    texts = [None, "", "   \n\t ", "a", "Ünïcödé ☃ words 漢字 here", long, "x" * 200_000, shared, near, near + " end", near, sentence(rng, 60) + " " + shared, shared + " " + sentence(rng, 60)]
    texts += [sentence(rng, rng.randrange(1, 150)) for _ in range(40)]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["web", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return out + [out[8], out[8], (None, near, "en", None, 3), (None, near + " tail of a copy", "en", None, 3), (None, None, None, None, None), (None, "only once " + sentence(rng, 80), "de", "web", 1)]


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("odd")
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.selectExpr("*", *(f"cast(null AS string) AS `{c}`" for c in CLASHING)).write.parquet(f"{base}/documents.parquet")
    labels = [(i, i % 2 if i % 5 else None, int(i % 7 == 0)) for i in range(45)] + [(3, 1, 0), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    long = rows()[5][1].split(" ")
    some = " ".join(rows()[8][1].split(" ")[:20] + [f"other{i}" for i in range(15)])  # half of it in a document that is there three times
    items = [(8, some), (1, " ".join(long[500:530])), (2, None), (3, ""), (4, "a"), (1, " ".join(long[500:530])), (None, " ".join(long[9000:9012])), (7, " ".join(long[100:108] + ["zzz"] * 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    html = "<html><nav><a>Menu</a></nav><article><h1>T &amp; x</h1><p>One  two\n three.</p></article><footer>c</footer></html>"
    pages = [(1, "u", html), (1, "u", html), (2, None, None), (3, "u", ""), (None, "u", "<p>open <b>never closed"), (5, "u", "<article>" + "<p>word word word.</p>" * 3000), (6, "u", "<script>unclosed")]
    spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS _html").write.parquet(f"{base}/pages.parquet")
    return str(base)


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("empty")
    for t in ("documents", "labels", "benchmark", "pages"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").limit(0).write.parquet(f"{base}/{t}.parquet")
    return str(base)
