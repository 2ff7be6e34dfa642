import zlib

import pytest

from shelf.llm import sharding as s


def test_rows_are_placed_once_with_gapless_slots(documents):
    got = s.shard_rows(documents, s.shard_tree(24), s.shard_tree(25)).collect()
    assert len(got) == documents.count()
    by: dict[int, list[int]] = {}
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 24
        assert r.grown_shard in (r.shard, 24)
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in got:
        if r.doc_id is not None:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    assert len({(r.doc_id, r.shard) for r in got if r.doc_id == 105}) == 1


def test_empty_table(no_documents):
    assert s.shard_rows(no_documents, s.shard_tree(24)).count() == 0


@pytest.mark.parametrize("n", [24, 25, 30])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    rows = spark.range(3000).selectExpr("id as doc_id", "'t' as text")
    got = s.shard_rows(rows, s.shard_tree(n), s.shard_tree(n + 1)).collect()
    moved = [r for r in got if r.shard != r.grown_shard]
    assert all(r.grown_shard == n for r in moved)
    assert 0.3 < len(moved) / (len(got) / (n + 1)) < 1.7


def test_movement_stays_in_the_subtree_whose_weight_changes(spark):
    tree = s.shard_tree(24)
    heavier = [s.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    rows = spark.range(4000).selectExpr("id as doc_id", "'t' as text")
    got = s.shard_rows(rows, tree, heavier).collect()
    region, rack = {x.shard: x.region for x in tree}, {x.shard: x.rack for x in tree}
    for r in got:
        if r.shard != r.grown_shard:  # only into shard 5's region, rack or itself
            assert region[r.grown_shard] == region[5]
            if region[r.shard] == region[5]:
                assert rack[r.grown_shard] == rack[5]
                if rack[r.shard] == rack[5]:
                    assert r.grown_shard == 5
    share = sum(r.grown_shard == 5 for r in got) / len(got)
    assert abs(share - 3 / 26) < 0.02


def test_weights_must_be_positive(spark):
    with pytest.raises(ValueError):
        s.shard_rows(spark.range(1).selectExpr("id as doc_id", "'' as text"), [s.Leaf(0, 0, 0, 0.0)])
