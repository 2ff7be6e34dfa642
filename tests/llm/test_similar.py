import random

import numpy as np

import corpus_pipeline
from shelf.llm import jaccard
from shelf.llm import simhash as j


def plain(text):
    words = (text or "").lower().split()
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: plain(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for k in sets:
            a, b = sets[i], sets[k]
            if k < i and (not a and not b or len(a & b) >= 0.8 * len(a | b)):
                x, y = root(i), root(k)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def edited(rng, words, n):
    """The words with n of them, far apart, replaced."""
    words = list(words)
    for at in rng.sample(range(0, len(words), 6), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    rows = [(0, ""), (1, None), (2, " \t"), (3, "one two"), (4, "One  two"), (5, "one three")]
    for _ in range(40):  # edited copies on both sides of 0.8, and chains of them
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((60, 150, 400)))]
        for _ in range(5):
            rows.append((len(rows), " ".join(words)))
            words = edited(rng, words, rng.randint(0, len(words) // 45)).split()
    base = [f"b{i}" for i in range(300)]  # a crowd near one text, of which few are near each other
    return rows + [(1000 + i, edited(rng, base, 6 if i else 0)) for i in range(60)]


def test_groups_match_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in j.similar_documents(frame).collect()} == want


def test_recall_at_the_least_similarity():
    """Pairs of texts at a similarity of 0.8 stand in each other's ball in some segment as often as planned, and foreign ones hardly ever."""
    rng = np.random.default_rng(4)
    for size in (45, 450, 4500):
        sets = []
        for _ in range(400 if size < 4500 else 120):  # 8/9 of each set is shared
            x = rng.integers(0, 1 << 32, size + size // 9, np.uint32)
            sets += [np.sort(x[: size]), np.sort(x[size // 9:])]
        bits = j.segment_bits(1 << 18)
        checks, packed = j._sketcher(bits, j.segments_needed(bits, 0.8))(sets)
        place, keys = [packed >> 5 * k & 31 for k in range(3)], packed >> 15
        ball = np.stack([keys ^ sum((1 << place[k]) * (m >> k & 1) for k in range(3)) for m in range(8)], 2)
        apart = np.array([bin((int(a) ^ int(b)) & (2**64 - 1)).count("1") for a, b in zip(checks[::2], checks[1::2])])
        met = ((ball[::2] == keys[1::2][:, :, None]) | (ball[1::2] == keys[::2][:, :, None])).any((1, 2)) & (apart <= j.CHECK_BITS)
        foreign = (ball[:-2:2] == keys[2::2][:, :, None]).any(2).mean()
        print(size, "met", met.mean(), "bits apart", apart.mean(), "foreign", foreign)
        assert met.mean() >= 0.98 and foreign < 8 / 2**bits * 8


def test_the_stage_drops_edited_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "/root/testdata/sf0.01")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_awkward_rows_and_an_empty_table(documents, no_documents):
    ids = [r.doc_id for r in j.deduplicate(documents).collect()]
    assert ids.count(None) == 2 and len(ids) - 2 == len(set(ids) - {None})
    assert j.similar_documents(no_documents).count() == 0
    assert j.deduplicate(no_documents).count() == 0


def crowd(n=150):
    """A text's n copies of which each has its own words, so that some pairs are above 0.8 and most not."""
    rng, base = random.Random(8), [f"c{i}" for i in range(240)]
    return [(i, edited(rng, base, 5 if i % 3 else 2)) for i in range(n)]


def test_a_forest_of_near_sets_joins_what_all_near_pairs_join():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 32, 9_000, np.uint32)  # over one block of columns
    sets = [np.unique(np.append(rng.permutation(base)[: len(base) - k], rng.integers(0, 1 << 32, k, np.uint32))) for k in (0, 300, 900, 1100, 5000) for _ in range(4)]
    near = {(i, k) for i, a in enumerate(sets) for k, b in enumerate(sets) if jaccard._near(a, b, 0.8)}
    found = jaccard.near_forest(sets, sets, 0.8)
    assert set(found) <= near and len(found) < 2 * len(sets) < len(near)
    parent = list(range(2 * len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, k in found:
        parent[root(i)] = root(len(sets) + k)
    assert all(root(i) == root(len(sets) + k) for i, k in near)


def test_a_crowd_is_compared_in_tiles_and_not_as_rows_of_pairs(spark, monkeypatch):
    rows, asked = crowd(), []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "BLOCK", 40)  # several tiles
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a: asked.append(pairs.count()) or verified(pairs, *a))
    got = {r.doc_id: r.component_id for r in j.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and len(set(got.values())) > 2
    assert sum(asked) < 4 * len(rows)
