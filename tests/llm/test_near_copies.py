"""The near_duplicates stage: planted copies of known similarity, and rows that share an id."""

import random

import corpus_pipeline


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def text_of(rng, n):
    return [f"w{rng.randrange(100_000)}" for _ in range(n)]


def test_copies_of_similarity_08_to_095_go(spark):
    rng = random.Random(8)
    rows, want, seen = [], [], []
    for g in range(60):
        base = text_of(rng, 300)
        copy = list(base)
        for at in rng.sample(range(10, 290, 7), 1 + g % 6):
            copy[at] = "changed"
        s = similarity(" ".join(base), " ".join(copy))
        seen.append(s)
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
        want += [2 * g] if s >= 0.8 else [2 * g, 2 * g + 1]
    far = text_of(rng, 300)
    rows += [(500, " ".join(far)), (501, " ".join(far[:240] + text_of(rng, 60)))]  # about 0.66
    want += [500, 501]
    assert min(seen) < 0.85 and max(seen) > 0.95
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == want


def test_a_star_of_copies_is_one_group(spark):
    """Copies of one text that are less alike among themselves are linked through it."""
    rng = random.Random(9)
    base = text_of(rng, 300)
    rows = [(1000, " ".join(base))]
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(10, 290, 7), 5):
            copy[at] = f"own{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [0]


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rng = random.Random(10)
    a, b, c = (" ".join(text_of(rng, 100)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "x"), (1, c, None), (2, b, "y"), (None, a, "z"), (None, "only here " + c[:300], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == sorted([(1, a), (1, b), (1, c), (0, "only here " + c[:300])])


def test_a_group_of_half_alike_copies_falls_as_by_all_pairs(spark, monkeypatch):
    """Copies whose pairs lie on both sides of the limit, many of them without a partner; several tiles of one bucket."""
    from varzea.llm import near_copies

    monkeypatch.setattr(near_copies, "TILE", 15)
    rng = random.Random(12)
    base, rows = text_of(rng, 200), []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(5, 195, 5), rng.randrange(0, 14)):
            copy[at] = f"own{i}_{at}"
        rows.append((i, " ".join(copy)))
    root = list(range(160))
    for i in range(160):
        for j in range(i):
            if similarity(rows[i][1], rows[j][1]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    want = sorted({min(i for i in range(160) if root[i] == r) for r in root})
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "map('k', doc_id % 2) AS further", "array(map(1, 'x')) AS deep")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in got.collect()) == want and 20 < len(want) < 150
    assert set(got.columns) == set(docs.columns)


def test_sketches_tell_the_similarity():
    """Of short sets all but exactly; of long ones within the deviation that the limit allows for."""
    import numpy as np

    from varzea.llm.near_copies import BINS, DEVIATIONS, bins_of

    rng = np.random.default_rng(4)
    for size, off in ((60, 0.02), (900, 0.05), (20_000, DEVIATIONS * 0.4 / BINS**0.5)):
        for share in (0.3, 0.8, 0.95):
            common = rng.integers(0, 2**63, int(size * share), dtype=np.uint64)
            x, y = (np.unique(np.concatenate([common, rng.integers(0, 2**63, size - len(common), dtype=np.uint64)])) for _ in range(2))
            true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            a, b = bins_of([x, y])
            assert abs(((a == b) & (a > 0)).sum() / ((a | b) > 0).sum() - true) < off + 0.004
    assert not bins_of([np.zeros(0, dtype=np.uint64)]).any()


def test_the_search_is_by_fingerprints_and_pivot_tables():
    """Of planted pairs of 0.8 nearly all share a block of their fingerprints; no pair within the radius is discarded by the pivots;
    sets of four and five shingles share the hash of a subset."""
    import numpy as np

    from varzea.llm.near_copies import BITS, bucket_keys, cuts, differing, fingerprint, fours, radius

    rng = np.random.default_rng(6)
    share, missed, far = differing(0.8), 0, []
    for texts in (100, 1_000_000):
        blocks = cuts(texts, 0.8)
        assert blocks.max() < BITS and all(len(set(b)) == len(b) for b in blocks.tolist())
        for size in (40, 400):
            for _ in range(300):
                common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (size * 8 // 10, size // 10, size // 10))
                p = np.stack([fingerprint(np.concatenate([common, x])) for x in (a, b)])
                keys = bucket_keys(p, blocks)
                missed += not (keys[0] == keys[1]).any()
                far.append(int(np.bitwise_count(p[0] ^ p[1]).sum()))
    assert missed <= 5 and abs(np.mean(far) / BITS - share) < 0.01 and max(far) <= radius(BITS, share) + 10
    assert set(fours(np.arange(5, dtype=np.uint64))) & set(fours(np.arange(4, dtype=np.uint64)))


def test_full_buckets_and_small_ones_give_the_same(spark, monkeypatch):
    """Groups of copies in buckets over the limit go by hubs and tiles, under it by pairs; short texts differ by one shingle."""
    from varzea.llm import near_copies

    rng = random.Random(14)
    base, rows = text_of(rng, 120), []
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(5, 115, 5), rng.randrange(0, 8)):
            copy[at] = f"own{i}_{at}"
        rows.append((i, " ".join(copy)))
    for g in range(20):
        short = text_of(rng, 9)
        rows += [(100 + 2 * g, " ".join(short)), (101 + 2 * g, " ".join(short[:8]))]  # 4 of 5 shingles
    docs, got = spark.createDataFrame(rows, "doc_id long, text string"), []
    for most in (2, 10_000):
        monkeypatch.setattr(near_copies, "CROWD", most)
        got.append(sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()))
    assert got[0] == got[1] and [i for i in got[0] if i >= 100] == list(range(100, 140, 2))


def test_pairs_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """Of a group of near copies smaller than a full bucket a few pairs a text are verified, not each with each; all of it is linked."""
    from varzea.llm import near_copies

    tried, whole = [], near_copies.verified

    def counted(pairs, *more):
        tried.append(pairs.count())
        return whole(pairs, *more)

    monkeypatch.setattr(near_copies, "verified", counted)
    rng = random.Random(15)
    base, many = text_of(rng, 300), 200
    rows = [(1000 + i, " ".join(text_of(rng, 50))) for i in range(100)]
    for i in range(many):
        copy = list(base)
        copy[rng.randrange(5, 295)] = f"own{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == [0, *range(1000, 1100)] and many - 1 <= sum(tried) <= 3 * many


def test_connected_buckets_are_passed_over_once(spark, monkeypatch):
    """A chain of copies takes several hubs; the bucket rows go through the join that leaves out connected buckets once, not each turn."""
    from varzea.llm import near_copies

    semi, turns, stars = [], [], near_copies.stars

    def counted(self, other, on=None, how=None):
        semi.append(isinstance(on, str) and (on, how) == ("bucket", "left_semi"))
        return join(self, other, on, how)

    monkeypatch.setattr(near_copies, "HUBLESS", 0)
    monkeypatch.setattr(near_copies, "stars", lambda *given: turns.append(1) or stars(*given))
    rng = random.Random(16)
    words, rows = text_of(rng, 300), [(1000 + i, " ".join(text_of(rng, 50))) for i in range(50)]
    for i in range(20):
        rows.append((i, " ".join(words)))
        words[12 * i : 12 * i + 12] = text_of(rng, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = type(docs).join
    monkeypatch.setattr(type(docs), "join", counted)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, *range(1000, 1050)]
    assert len(turns) > 2 and sum(semi) <= 1
