import random

import numpy as np
import pytest
import xxhash

from shelf.llm import simhash as s


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=3):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, " \t ", "One", "a b", "Äb C d É", "a b c", "x y z " * 500, "A\x0bB\x1cC D e"])
def test_fingerprint_matches_the_definition(text):
    assert s.fingerprint(text) == plain_fingerprint(text)


def test_components_match_brute_force(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = []
    for b in base:
        x = b
        for _ in range(12):  # chains: each within 3 bits of the one before
            prints.append(x)
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << bit
    prints += prints[:10]
    pairs = {(a, b) for a in set(prints) for b in set(prints) if a < b and bin(a ^ b).count("1") <= 3}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(p),) for p in set(prints)], "fp long")
    want = {tuple(sorted((signed(a), signed(b)))) for a, b in pairs}
    for hot in (2048, 3):  # with and without the finer keys for crowded halves
        got = [tuple(r) for r in s.near_pairs(frame, hot=hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_whole_tables_match_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    got = s.simhash_components(documents).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), p, str(least.get(r))) for (i, _), p, r in zip(rows, prints, roots))
    assert sorted((str(r.doc_id), int(np.uint64(np.int64(r.fp))), str(r.component_id)) for r in got) == want


def test_deduplicate_keeps_one_of_each_group(documents):
    kept = s.deduplicate(documents)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    groups = {r.doc_id: r.component_id for r in s.similar_documents(documents).collect()}
    assert len(named) == len(set(named)) == len(set(groups.values()))
    assert ids.count(None) == 2


def test_empty_table(no_documents):
    assert s.simhash_components(no_documents).count() == 0
    assert s.deduplicate(no_documents).count() == 0
