import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelf.llm import bpe as b

PLAIN, SMALL = b.ByteBpe(b.default_path()), b.ByteBpe(b.default_path(), leaf=7, text_leaf=3)
LIBRARY = Tokenizer.from_file(b.default_path())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_is_encoded_as_the_library_does(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert PLAIN.encode(text) == want
    assert SMALL.encode(text) == want
    assert PLAIN.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("alphabet", ["a", "ab", "ethanior", " \n\t", "éàü", "$%&!'", "日本語中", "0123", "ß\u0301"])
def test_trees_of_unsplit_text_are_exact(alphabet):
    rng = random.Random(9)
    for n in (8, 60, 700, 5000):
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert SMALL.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab'srevmltd \n\t\u2003!?9é日"), max_size=60), st.integers(1, 9))
def test_cuts_may_fall_anywhere(text, leaf):
    """Contractions, runs of white space with what follows them, and words may be cut."""
    tree = b.ByteBpe.__new__(b.ByteBpe)
    tree.__dict__ = SMALL.__dict__ | {"text_leaf": leaf}
    assert tree.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_texts_go_through_their_trees(spark):
    """Fails if whole documents are encoded without halves and joins."""
    rows = b.op9_bpe(spark, "/root/testdata/sf0.01").select("doc_id", "n_joins").collect()
    long = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(f"length(text) > {b.TEXT_LEAF}").select("doc_id").collect()}
    assert len(long) > 10 and {r.doc_id for r in rows if r.n_joins} == long


def test_special_tokens_and_new_characters():
    for text in ("<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext", "\ua7ce\u0558x", "ΑΣ ΟΔΟΣ", "\x1c\x85\xa0 \u2003x"):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert PLAIN.encode(text) == ids and PLAIN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_bytes_that_are_no_text_decode_as_the_library_does():
    for ids in ([128], [128, 129, 50256], list(range(100, 256))):
        assert PLAIN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_long_pieces_take_little_time():
    for text in ("x" * 300_000, "ab" * 150_000, " " * 100_000):
        assert PLAIN.decode(PLAIN.encode(text)) == text


def test_round_trip_of_a_table(documents):
    rows = documents.collect()
    encoded = b.encode_documents(documents)
    decoded = b.decode_documents(encoded)
    assert sorted((str(r.doc_id), r.text) for r in decoded.collect()) == sorted((str(r.doc_id), r.text or "") for r in rows)
    want = []
    for r in rows:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted((str(r[0]), *tuple(r)[1:4]) for r in b.digest_documents(documents).collect()) == sorted(want)


def test_empty_table(no_documents):
    assert b.digest_documents(no_documents).count() == 0
