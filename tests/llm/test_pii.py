import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelf.llm import pii as p

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and p.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], p.KINDS.index(s[0])))


def test_base_spans_match_the_patterns():
    rng = random.Random(5)
    for alphabet in ("a1.@-+ 2()9", "0123456789 -", "ab@.c", "+1 ()-.\n"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(45)))
            assert p.base_spans(text) == plain(text), text


def test_long_texts_are_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "+" * 100_000, "+1" + "(" * 100_000):
        p.base_spans(text)


@pytest.fixture(scope="module")
def weights(spark):
    return p.trained(spark)


def test_network_finds_held_out_spans(weights):
    held = p.labelled_spans(300, seed=77)
    hit = extra = missed = 0
    for (_, gold), seen in zip(held, p.network_spans([t for t, _ in held], weights)):
        hit, extra, missed = hit + len(set(gold) & set(seen)), extra + len(set(seen) - set(gold)), missed + len(set(gold) - set(seen))
    assert hit / (hit + extra) > 0.9 and hit / (hit + missed) > 0.9


def test_windows_are_reconciled_over_the_whole_text(weights):
    filler = "an other word of no kind " * 40
    for shift in range(0, 96, 7):
        text = filler + "x" * shift + " (555) 123-4567 " + filler
        base, spans = p.all_spans([text], weights)[0]
        assert base == [] and [text[a:b] for _, a, b in spans] == ["(555) 123-4567"]


ODD = ["host 192.168.1².77 and more", "addr 192.168.²5.77 up", "ip ²12.168.101.44 x", "ip 192.1²8.101.44 x", "١٢٣.1.2.3", "card ４111 1111 1111 1111", "²" * 200, "+¹²³ 456 789 0123"]


def relevant(texts, spans):
    return [[s for s in found if re.search("[0-9@]", text[s[1]:s[2]])] for text, found in zip(texts, spans)]


def test_digits_beyond_ascii(weights):
    for text, (base, spans) in zip(ODD, p.all_spans(ODD, weights)):
        assert base == plain(text) and set(base) <= set(spans)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("0123456789@.+-() ,ab²٣\n"), st.characters()), max_size=260), max_size=4))
def test_windows_read_are_as_good_as_all(weights, texts):
    """Reading on while a span is open gives the spans of all windows, wherever a span can be."""
    some, every = p.network_spans(texts, weights), p.network_spans(texts, weights, everything=True)
    assert relevant(texts, some) == relevant(texts, every)
    for text, (base, spans) in zip(texts, p.all_spans(texts, weights)):
        assert base == plain(text) and set(base) <= set(spans)
        assert all(p.plausible(kind, text[a:b]) for kind, a, b in set(spans) - set(base))


def test_long_open_spans_are_read_on(weights):
    """Untrained weights leave spans open over many windows."""
    rng = np.random.default_rng(3)
    wild = {k: rng.standard_normal(x.shape) for k, x in weights.items()}
    texts = ["a" * 500 + "1" + "b" * 500, "word @ " + "x y " * 300, "".join(rng.choice(list("ab 1@."), 2000))]
    for w in (wild, wild | {"bias": np.where(np.arange(p.TAGS) == 2, 50.0, 0.0)}):
        assert relevant(texts, p.network_spans(texts, w)) == relevant(texts, p.network_spans(texts, w, everything=True))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    scores, tags, trans = rng.standard_normal((5, 3, p.TAGS)), rng.integers(0, p.TAGS, (3, 5)), rng.standard_normal((p.TAGS, p.TAGS))
    loss, ds, dt = p._crf(scores, tags, trans)
    for at in [(0, 0, 1), (4, 2, 3), (2, 1, 0)]:
        more = scores.copy()
        more[at] += 1e-5
        assert abs((p._crf(more, tags, trans)[0] - loss) / 1e-5 - ds[at]) < 1e-4
    more = trans.copy()
    more[2, 3] += 1e-5
    assert abs((p._crf(scores, tags, more)[0] - loss) / 1e-5 - dt[2, 3]) < 1e-4
    x, wx, wh, b = rng.standard_normal((4, 2, 3)), rng.standard_normal((3, 8)), rng.standard_normal((2, 8)), rng.standard_normal(8)
    total = lambda w: p._lstm(x, w, wh, b)[0].sum()
    hs, kept = p._lstm(x, wx, wh, b)
    dwx = p._lstm_back(np.ones_like(hs), kept, wx, wh)[1]
    more = wx.copy()
    more[1, 5] += 1e-5
    assert abs((total(more) - total(wx)) / 1e-5 - dwx[1, 5]) < 1e-4


def test_whole_tables(spark, documents, weights):
    extra = spark.createDataFrame([(700, "é mail a.b@c.org, ip 1.2.3.4 and 999.1.1.1 card 4111 1111 1111 1111 call +1 (555) 123-4567"), (701, None)], "doc_id long, text string")
    rows = documents.select("doc_id", "text").union(extra).union(spark.createDataFrame(list(enumerate(ODD, 800)), "doc_id long, text string"))
    texts = sorted((str(r.doc_id), r.text or "") for r in rows.collect())
    got = p.find_pii(rows).collect()
    assert len(got) == len(texts)
    for r in got:
        if r.doc_id == 700:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
            text = dict(texts)["700"]
            assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in plain(text)).encode()).hexdigest()
            assert set(p.joined(plain(text)).split(",")) <= set(r.spans.split(","))
        elif r.doc_id == 701:
            assert r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.spans == ""
    hidden = {r.doc_id: r.text for r in p.redact_documents(rows).collect()}
    assert hidden[700] == "é mail <EMAIL>, ip <IP> and 999.1.1.1 card <CARD> call <PHONE>" and hidden[701] is None


def test_columns_of_any_name(spark, weights):
    rows = spark.createDataFrame([(1, "mail a.b@c.org", "x", "y", 2)], "doc_id long, text string, _text string, `a.b` string, spans long")
    hidden = p.redact_documents(rows, weights)
    assert hidden.columns == rows.columns and [tuple(r) for r in hidden.collect()] == [(1, "mail <EMAIL>", "x", "y", 2)]


def test_empty_table(no_documents):
    assert p.find_pii(no_documents).count() == 0
