import re
from collections import Counter

import pytest

import corpus_pipeline as c
from shelf.llm import pii, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output as pandas frames."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in c.STAGES:
        folder = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SF).write.parquet(folder)
        out = spark.read.parquet(folder)
        seen[name] = (docs.collect(), out.collect(), out.columns)
        docs = out
    return seen


def test_columns_and_order(stages):
    assert [n for n, _ in c.STAGES] == ["toxicity", "near duplicates", "personal data", "mixing", "bpe"]
    for name, (_, _, columns) in list(stages.items())[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go_and_others_stay(spark, stages):
    before, after, _ = stages["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.scorer()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if score(r.text) < toxicity.CUT)


def test_one_document_of_each_group_stays(stages):
    """Groups by the Jaccard similarity of five-word shingles, as stages on word shingles have them, by brute force."""
    before, after, _ = stages["near duplicates"]
    words = {r.doc_id: (r.text or "").lower().split() for r in before}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert sorted(r.doc_id for r in after) == [i for i in ids if root(i) == i]


def test_personal_data_is_hidden(stages):
    before, after, _ = stages["personal data"]
    texts = {r.doc_id: r.text for r in after}
    assert texts.keys() == {r.doc_id for r in before}
    for r in before:
        for _, a, b in pii.base_spans(r.text):
            assert r.text[a:b] not in texts[r.doc_id]
        if not re.search("[0-9@]", r.text):
            assert texts[r.doc_id] == r.text


def test_mix_takes_whole_words_near_targets(stages):
    before, after, _ = stages["mixing"]
    size = lambda t: len(t.split())
    total, taken = sum(size(r.text) for r in before), sum(size(r.text) for r in after)
    assert abs(taken - total) < 0.1 * total
    own, got = {r.doc_id: size(r.text) for r in before}, Counter()
    for r in after:
        got[r.doc_id] += size(r.text)
    assert all(n <= 3 * own[i] for i, n in got.items())


def test_the_rest_is_encoded(spark, stages):
    before, after, _ = stages["bpe"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    assert c.run(spark, SF).count() == len(after)
