"""The word features of a block."""

import numpy as np

from varzea.llm.html_extraction import Path, vectors


def test_every_word_of_a_long_block_counts():
    words = [f"w{i % 37}" for i in range(1000)]
    plain = vectors([(Path(None, ("p",)), " ".join(words), 0)])
    for at in (1, 40, 41, 42, 998):  # a stride would pass over some of these
        other = [*words[:at], "cookies", *words[at + 1 :]]
        assert not np.array_equal(vectors([(Path(None, ("p",)), " ".join(other), 0)]), plain)
    assert np.allclose(vectors([(Path(None, ("p",)), " ".join(reversed(words)), 0)]), plain, atol=1e-6)


def test_deeply_nested_tags_cost_no_more_than_others():
    import time

    from varzea.llm.html_extraction import blocks

    began = time.time()
    found = blocks("<div>x" * 100_000 + "</b>" * 1000)
    assert len(found) == 100_000 and vectors(found[:2000]).shape[0] == 2000
    assert found[-1][0].last(2) == ["div", "div"] and time.time() - began < 30


def test_formulas_are_text():
    from varzea.llm.html_extraction import blocks

    assert [t for _, t, _ in blocks("<p>a <math><mi>x</mi></math> b</p>")] == ["a x b"]


#: pages by hand, with layouts and words that the composed pages do not have: page, and the blocks of its main text
PAGES = [
    (
        '<html><body><div id="hd"><a href="/">Gazeta do Vale</a></div><div class="mn"><a href="/a">Cidade</a> <a href="/b">Campo</a> <a href="/c">Esporte</a></div><div class="ct"><h1>Ponte reabre depois da cheia</h1>'
        "<p>A ponte sobre o rio reabriu na segunda-feira, depois de três semanas de obras e de muitas reclamações dos moradores.</p><p>Segundo a prefeitura, os pilares foram reforçados e a pista ganhou nova sinalização.</p><p>O trânsito segue lento pela manhã, mas os ônibus já passam.</p></div>"
        '<div class="bt"><a href="/x">Leia mais</a> <a href="/y">Mais lidas</a></div><div>© 2024 Gazeta do Vale</div></body></html>',
        ["Ponte reabre depois da cheia", "A ponte sobre o rio reabriu na segunda-feira, depois de três semanas de obras e de muitas reclamações dos moradores.", "Segundo a prefeitura, os pilares foram reforçados e a pista ganhou nova sinalização.", "O trânsito segue lento pela manhã, mas os ônibus já passam."],
    ),
    (
        '<body><header><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav></header><main><h1>How the old mill was saved</h1><p>The mill had stood empty for forty years when a group of neighbours bought it.</p><blockquote>We could not watch it fall, said one of them.</blockquote>'
        "<p>Today its wheel turns again, and bread from its flour is sold every Saturday.</p></main><aside><p>Subscribe to our letter</p></aside><section class=\"comments\"><h3>Comments</h3><p>Great story, thanks!</p><p>My grandfather worked there.</p></section><footer><p>Imprint</p></footer></body>",
        ["How the old mill was saved", "The mill had stood empty for forty years when a group of neighbours bought it.", "We could not watch it fall, said one of them.", "Today its wheel turns again, and bread from its flour is sold every Saturday."],
    ),
    (
        '<div class="cookie-banner">We use cookies. <a href="#">Accept</a></div><div class="topbar"><a href="/login">Log in</a></div><article><h1>Der Winter kam früh</h1><p>Schon im Oktober lag Schnee auf den Dächern, und die Leute holten ihre Schlitten hervor.</p><div class="ad">Anzeige: Schuhe billig</div>'
        "<p>Die Alten sagten, so etwas habe es seit fünfzig Jahren nicht gegeben.</p><ul><li>Im Tal fielen zehn Zentimeter.</li><li>Auf dem Berg war es ein halber Meter.</li></ul></article><footer>Kontakt | Impressum</footer>",
        ["Der Winter kam früh", "Schon im Oktober lag Schnee auf den Dächern, und die Leute holten ihre Schlitten hervor.", "Die Alten sagten, so etwas habe es seit fünfzig Jahren nicht gegeben.", "Im Tal fielen zehn Zentimeter.", "Auf dem Berg war es ein halber Meter."],
    ),
]


def test_pages_by_hand(spark):
    """Words found and words wanted, over unseen pages."""
    from fixed import SF

    from varzea.llm import html_extraction

    model = html_extraction.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    pages = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PAGES)], "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(pages, model).collect()}
    hit = said = wanted = 0
    for i, (_, main) in enumerate(PAGES):
        found = set(got[i].split("\n\n")) - {""}
        hit += sum(len(t.split()) for t in found if t in main)
        said += sum(len(t.split()) for t in found)
        wanted += sum(len(t.split()) for t in main)
    assert hit / said >= 0.9 and hit / wanted >= 0.9, (hit, said, wanted, got)
