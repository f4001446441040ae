"""Texts longer than the stretches that arrays are bounded to."""

import numpy as np
import pytest

from varzea.llm import common, quality_classifier, toxicity


def test_words_of_any_length_are_whole():
    one = b"x" * 3_000_000
    parts, owner = common.pieces([one, b"a"])
    assert parts == [one, b"a"] and owner.tolist() == [0, 1]
    tabs = b"\t".join(b"word%d" % i for i in range(300_000))
    parts, _ = common.pieces([tabs])
    assert len(parts) > 1 and sum(len(common.Words([p]).start) for p in parts) == 300_000


def test_hashes_do_not_depend_on_the_stretch(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [b" ".join(rng.integers(97, 123, int(n)).astype(np.uint8).tobytes() for n in rng.integers(1, 900, 200))]
    whole = common.Words(texts).hashes()
    monkeypatch.setattr(common, "STRETCH", 300)
    assert (common.Words(texts).hashes() == whole).all()


def test_passages_do_not_restart(monkeypatch):
    rng = np.random.default_rng(4)
    text = b" \n".join(rng.integers(97, 123, int(n)).astype(np.uint8).tobytes() for n in rng.integers(1, 12, 3000))
    (_, x, count), = quality_classifier.bags([text])
    monkeypatch.setattr(quality_classifier, "PART_BYTES", 1000)
    (_, y, parts), = quality_classifier.bags([text])
    assert count.tolist() == parts.tolist() and np.allclose(x, y)


def test_terms_of_a_long_text():
    text = b" ".join(b"t%d" % (i % 500) for i in range(700_000))
    (_, t, n), = toxicity.term_sets([text])
    short, = toxicity.term_sets([b" ".join(b"t%d" % i for i in range(500))])
    assert n.tolist() == short[2].tolist() and t.tolist() == short[1].tolist()


@pytest.mark.parametrize("stretch", [50, 997])
def test_ngrams_across_a_stretch_count_once(monkeypatch, stretch):
    from varzea.llm import language_id

    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab  \n\té"), 4000)).encode(), b"", b" ", b"a"]
    whole = language_id.histograms(texts)
    monkeypatch.setattr(language_id, "STRETCH", stretch)
    assert np.allclose(language_id.histograms(texts), whole)


def test_long_words_differ_by_every_place(monkeypatch):
    """Halves of 4,096 bytes that change places give another hash; cut into stretches the hash is the same."""
    a, b = b"a" * 4096, b"b" * 4096
    words = [a + b, b + a, a + b + a, b + a + a, a * 3 + b, a * 2 + b + a, b"x" * 4095 + b"y", b"y" + b"x" * 4095]
    whole = [int(common.Words([w]).hashes()[0]) for w in words]
    assert len(set(whole)) == len(words)
    assert common.Words([b" ".join(words)]).hashes().tolist() == whole
    monkeypatch.setattr(common, "STRETCH", 1000)
    assert [int(common.Words([w]).hashes()[0]) for w in words] == whole


def test_a_long_page_is_scored_in_stretches(monkeypatch):
    from varzea.llm import html_extraction as h

    rng = np.random.default_rng(6)
    page = h.blocks("<html><body>" + "".join(f"<div class='c{i % 7}'><p>{'word ' * int(rng.integers(1, 9))}.</p></div>" for i in range(900)) + "</body></html>")
    model = h.Labeller()
    model.p["S"] = rng.normal(0, 0.1, model.p["S"].shape).astype(np.float32)
    whole = model.label([h.vectors(page)])[0]
    monkeypatch.setattr(h, "STRETCH", 64)
    assert len(page) == 900 and np.allclose(model.label_long(page), whole, atol=1e-5)


def test_memory_of_a_page_of_many_blocks():
    """A page of 20,000 short blocks takes little beside the blocks themselves."""
    import tracemalloc

    from varzea.llm import html_extraction as h

    page = h.blocks("<html><body>" + "<p>one two.</p>" * 20_000 + "</body></html>")
    model = h.Labeller()
    tracemalloc.start()
    assert len(model.label_long(page)) == 20_000
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 15e6
