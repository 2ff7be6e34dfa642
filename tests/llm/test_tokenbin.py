import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelf.llm import tokenbin as t
from shelf.llm.bpe import default_path

PATH = default_path("word_bpe_49k.json")
LIBRARY, MINE = Tokenizer.from_file(PATH), t.WordBpe(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_is_encoded_as_the_library_does(text):
    assert np.frombuffer(MINE.encode(text), "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["ÉCOLE İstanbul ΣΑΣ", "a<|endoftext|>B", "ｅ\u0301 e\u0301 ﬁ", "\x1c\x85x\xa0y", "don't WE'LL 12 ½²", "Ǆ \u10d5\u1c95", "x" * 50_000])
def test_awkward_texts(text):
    assert np.frombuffer(MINE.encode(text), "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_records_detect_damage():
    data = t.frame(t.serialize(7, b"\1\0\2\0", 2)) + b"\n" + t.frame(t.serialize(None, b"", 2)) + b"\n"
    payload, after = t.unframe(data)
    assert t.parse(payload, 2)[0] == 7 and t.parse(payload, 2)[1].tolist() == [1, 2]
    assert t.parse(t.unframe(data, after)[0], 2)[0] is None
    for i in range(after):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            t.unframe(bytes(bad))
    with pytest.raises(ValueError):
        t.unframe(data[:after - 1])


def test_files_round_trip(spark, documents, tmp_path):
    folder = str(tmp_path / "tokens")
    t.write_tokens(documents, folder, file_bytes=20_000)
    got = t.read_tokens(spark, folder).collect()
    ids = {}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids.setdefault(r.doc_id, []).append(LIBRARY.encode(r.text or "", add_special_tokens=False).ids + [1])
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    want = sorted((str(k), len(x), crc(x)) for k, v in ids.items() for x in v)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    keys = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)
    assert t.spark_files(spark, folder).count() > 3
    # a shuffled read through the index
    files = {r.file: r.content for r in t.spark_files(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/index").orderBy(F.rand(1)).collect():
        doc_id, tokens = t.read_record(bytes(files[r.file]), r.offset, 2)
        assert doc_id == r.doc_id and len(tokens) == r.n_tokens and tokens.tolist() in ids[doc_id]


def test_a_repeated_row_fills_no_single_file(spark, tmp_path):
    rows = spark.createDataFrame([(7, "one text again " * 50)] * 600 + [(3, "x")], "doc_id long, text string")
    folder = str(tmp_path / "hot")
    t.write_tokens(rows.repartition(4), folder, file_bytes=60_000)
    assert max(len(r.content) for r in t.spark_files(spark, folder).collect()) < 40_000
    got = sorted(t.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [3] + [7] * 600 and len({r.ids_crc32 for r in got}) == 2


def test_edges_are_counted_by_halving(spark):
    import bisect

    for bounds in ([], [3], [1, 1, 5], [-9, 0, 0, 0, 7, 7, 100]):
        frame = spark.range(-12, 104).select("id", t._edges_below(F.array(*map(F.lit, bounds)).cast("array<bigint>"), F.col("id")).alias("n"))
        assert all(r.n == bisect.bisect_left(bounds, r.id) for r in frame.collect())


def test_empty_table(spark, no_documents, tmp_path):
    t.write_tokens(no_documents, str(tmp_path / "none"))
    assert t.read_tokens(spark, str(tmp_path / "none")).count() == 0
