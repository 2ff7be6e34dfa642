import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelf.llm import mixing as m


def highest_quotients(votes, seats, caps):
    got = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if got[i] < caps[i] and votes[i] > 0), key=lambda i: (votes[i] / (2 * got[i] + 1), -i), default=None)
        if best is None:
            break
        got[best] += 1
    return got


@pytest.mark.parametrize("votes,seats,caps", [([53, 24, 23], 7, [99] * 3), ([10, 10, 10], 4, [99] * 3), ([100, 1, 0], 20, [99, 99, 99]), ([5, 4, 3], 12, [2, 99, 99]), ([1.5], 3, [2]), ([], 3, []), ([0, 0], 3, [3, 3])])
def test_seats_go_to_the_highest_quotients(votes, seats, caps):
    assert m.sainte_lague(np.array(votes), seats, np.array(caps, int)).tolist() == highest_quotients(votes, seats, caps)


def test_adding_seats_never_takes_one_away():
    rng = np.random.default_rng(1)
    for _ in range(50):
        votes, caps = rng.random(6) * 100, rng.integers(1, 40, 6)
        before = np.zeros(6, int)
        for seats in range(0, int(caps.sum()) + 1):
            now = m.sainte_lague(votes, seats, caps)
            assert now.sum() == seats and (now >= before).all()
            before = now


def test_targets_share_everything_under_their_caps():
    target = m.water_fill(np.array([1000, 10, 10]), np.array([1, 2, 3]))
    assert target.tolist() == [960, 30, 30]
    assert m.water_fill(np.array([0, 0]), np.array([1, 2])).tolist() == [0, 0]


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def test_mix_is_whole_near_its_targets_and_repeatable(documents):
    got = m.mix(documents).collect()
    rows = documents.collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), size(r.text)) for r in rows)
    totals = Counter()
    for r in rows:
        totals[r.source] += size(r.text)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == totals[r.source]
        taken[r.source] += r.taken
    names = sorted((s for s in totals if s is not None)) + [None]
    want = dict(zip(names, m.water_fill(np.array([totals[s] for s in names]), np.array([1 + i % 3 for i in range(len(names))]))))
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6
    for s in names:
        assert abs(taken[s] - want[s]) <= 4 * m.BLOCK
    assert Counter(str(r) for r in m.mix(documents.repartition(7)).collect()) == Counter(str(r) for r in got)


def test_mixed_documents_hold_the_words_taken(documents):
    distinct = documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    wanted = {r.doc_id: r.taken for r in m.mix(distinct).collect()}
    mixed = m.mixed_documents(distinct)
    assert mixed.columns == distinct.columns
    taken = Counter()
    texts = {r.doc_id: r.text for r in distinct.collect()}
    for r in mixed.collect():
        taken[r.doc_id] += size(r.text)
        assert " ".join((r.text or "").split()) in " ".join((texts[r.doc_id] or "").split())
    assert {i: n for i, n in wanted.items() if n} == dict(taken)


def brute_shards(rows, shards):
    """(source, shard) -> words, by dealing every source's blocks to its seats one by one."""
    import zlib

    streams = {}
    for r in sorted(rows, key=lambda r: (r.h % m.CHUNKS, r.h, str(r.doc_id), r.size)):
        streams.setdefault(r.source, []).extend([(r.h, i) for i in range(r.size)])
    names = sorted(s for s in streams if s is not None) + [s for s in streams if s is None]
    sizes = [len(streams[s]) for s in names]
    _, quota = m.quotas(np.array(sizes), np.array([1 + i % 3 for i in range(len(names))]), shards=shards)
    out = Counter()
    for s, q in zip(names, quota):
        blocks = [streams[s][i:i + m.BLOCK] for i in range(0, max(1, len(streams[s])), m.BLOCK)]
        at = zlib.crc32(f"{m.SEED}:{s}".encode()) % len(blocks)
        for shard, k in enumerate(q):
            for _ in range(k):
                for word in blocks[at % len(blocks)]:
                    out[s, shard, word] += 1
                at += 1
    return out


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_every_shard_gets_its_quota_of_blocks(documents, shards):
    """Each word of each document is in the shards that dealing block by block puts it in."""
    rows = documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = m.mix(rows, shards=shards).collect()
    words = Counter()
    for r in got:
        for run in r.runs:
            for i in range(run["from"], run["to"]):
                words[r.source, run["shard"], (r.h, i)] += 1
    assert words == brute_shards(got, shards)


def test_rows_without_ids_and_columns_of_any_name(spark):
    rows = [(None, f"text number {i} " * 20, "a", 1, "k") for i in range(30)] + [("", "empty id " * 20, "a", 2, "k"), (None, "empty id " * 20, "a", 3, "k")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string, _key int, h string").withColumnRenamed("h", "run.to").withColumn("size", F.lit(1)).withColumn("row", F.lit("r"))
    got = m.mixed_documents(docs, shard_col="shard")
    assert got.columns == [*docs.columns, "shard"]
    seen = Counter()
    for r in got.collect():
        seen[r["_key"], r.doc_id] += size(r.text)
    assert seen == {(1, None): 30 * 60, (2, ""): 40, (3, None): 40}


def test_shards_have_equal_quotas():
    _, quota = m.quotas(np.array([64_000, 32_000, 8_000]), np.array([1, 2, 3]))
    per_shard = quota.sum(0)
    assert per_shard.max() - per_shard.min() <= 1


def test_empty_table(no_documents):
    assert m.mix(no_documents).count() == 0
    assert m.mixed_documents(no_documents).count() == 0
