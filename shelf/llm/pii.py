"""Personal data: exact patterns, and a character-level bidirectional LSTM with a CRF on top.

The patterns give the base spans, which always stay. The network, in numpy, learns from labelled
spans in invented text; it reads overlapping windows, and every character takes its tag from the window
in whose middle it stands most, so spans are put together over the whole text, whatever its length.
Every kind of span holds a digit or an @, so reading starts at the windows that own one, and goes on to
both sides while a span is open: what can be a span comes out as if all windows were read. The network
adds spans that the patterns miss, such as phone numbers without a plus.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.llm.common import map_rows, read_table

KINDS = ("email", "ip", "card", "phone")
#: Characters per window (half of it the step), hidden units per direction, size of a character's vector.
WINDOW, HIDDEN, EMBED = 96, 16, 12
#: Labelled windows for training, passes over them, batch, rate and seed.
EXAMPLES, EPOCHS, BATCH, RATE, SEED = 2560, 4, 64, 0.02, 5
#: Windows decoded at a time, and texts read at a time.
DECODE, TEXTS = 512, 512
TAGS = 1 + 2 * len(KINDS)

_TRIGGER = re.compile("[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by start, then kind: (kind, start, end) in code points, end exclusive."""
    if not _TRIGGER.search(text):
        return []
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:  # an address ends at its @'s domain, and starts where the characters before it begin
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            done = match.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return _ordered(found)


# --- characters -------------------------------------------------------------------------------

_PLAIN = "\n !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SYMBOLS = 6 + len(_PLAIN)  # padding, digit, lower, upper, other letter, other


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.full(0x250, 5, np.int8)
    for c in range(0x250):
        ch = chr(c)
        table[c] = 1 if ch in "0123456789" else 6 + _PLAIN.index(ch) if ch in _PLAIN else 2 if ch.islower() else 3 if ch.isupper() else 4 if ch.isalpha() else 5
    return table


def char_ids(text: str) -> np.ndarray:
    """A class for each code point; letters beyond Latin count as one class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 0x250, _classes()[np.minimum(points, 0x24F)], 4)


# --- network ----------------------------------------------------------------------------------

Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Hidden states (time, rows, units) and what the way back needs."""
    steps, rows, _ = x.shape
    units = wh.shape[0]
    pre = x @ wx + b
    h, c = np.zeros((rows, units)), np.zeros((rows, units))
    hs, cs, gates = np.zeros((steps, rows, units)), np.zeros((steps, rows, units)), np.zeros((steps, rows, 4 * units))
    for t in range(steps):
        z = pre[t] + h @ wh
        z[:, : 3 * units] = _sigmoid(z[:, : 3 * units])
        z[:, 3 * units:] = np.tanh(z[:, 3 * units:])
        c = z[:, units:2 * units] * c + z[:, :units] * z[:, 3 * units:]
        h = z[:, 2 * units:3 * units] * np.tanh(c)
        hs[t], cs[t], gates[t] = h, c, z
    return hs, (x, hs, cs, gates)


def _lstm_back(dh_all: np.ndarray, kept: tuple, wx: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of input, wx, wh and b."""
    x, hs, cs, gates = kept
    steps, rows, units = hs.shape
    dz_all, dh, dc = np.zeros_like(gates), np.zeros((rows, units)), np.zeros((rows, units))
    for t in range(steps - 1, -1, -1):
        i, f, o, g = np.split(gates[t], 4, axis=1)
        tc, before = np.tanh(cs[t]), cs[t - 1] if t else np.zeros((rows, units))
        dh = dh + dh_all[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz_all[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dh, dc = dz_all[t] @ wh.T, dc * f
    flat = dz_all.reshape(-1, 4 * units)
    last = np.concatenate([np.zeros((1, rows, units)), hs[:-1]]).reshape(-1, units)
    return dz_all @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, last.T @ flat, flat.sum(0)


def _scores(ids: np.ndarray, w: Weights) -> tuple[np.ndarray, tuple]:
    """Scores of tags (time, rows, tags) for windows of character classes (rows, time)."""
    x = w["embed"][ids.T]
    ahead, kept_a = _lstm(x, w["fx"], w["fh"], w["fb"])
    back, kept_b = _lstm(x[::-1], w["bx"], w["bh"], w["bb"])
    both = np.concatenate([ahead, back[::-1]], axis=2)
    return both @ w["out"] + w["bias"], (kept_a, kept_b, both)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _crf(scores: np.ndarray, tags: np.ndarray, trans: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood per window, and its gradients by scores and transitions."""
    steps, rows, _ = scores.shape
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + _lse(alpha[t - 1][:, :, None] + trans, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _lse(trans + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _lse(alpha[-1], 1)
    grad = np.exp(alpha + beta - z[None, :, None])
    pairs = np.zeros_like(trans)
    for t in range(1, steps):
        pairs += np.exp(alpha[t - 1][:, :, None] + trans + (scores[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
    at = np.arange(rows)
    gold = scores[np.arange(steps)[:, None], at, tags.T].sum(0) + trans[tags[:, :-1], tags[:, 1:]].sum(1)
    grad[np.arange(steps)[:, None], at, tags.T] -= 1
    np.subtract.at(pairs, (tags[:, :-1], tags[:, 1:]), 1)
    return float((z - gold).mean()), grad / rows, pairs / rows


def train(examples: list[tuple[str, list[Span]]], *, window: int = WINDOW, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Weights:
    """Fit the network on texts with labelled spans, by Adam; texts are cut or padded to one window."""
    ids, tags = np.zeros((len(examples), window), np.int64), np.zeros((len(examples), window), np.int64)
    for r, (text, spans) in enumerate(examples):
        known = char_ids(text)[:window]
        ids[r, : len(known)] = known
        for kind, a, b in spans:
            k = 1 + 2 * KINDS.index(kind)
            tags[r, a:b] = k + 1
            if a < window:
                tags[r, a] = k
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.standard_normal(shape) * 0.3 / np.sqrt(shape[0] / 4)
    w = {"embed": draw(SYMBOLS, EMBED), "out": draw(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
    for d in "fb":
        w |= {f"{d}x": draw(EMBED, 4 * HIDDEN), f"{d}h": draw(HIDDEN, 4 * HIDDEN), f"{d}b": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
    m, v = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            scores, (kept_a, kept_b, both) = _scores(ids[rows], w)
            _, ds, dt = _crf(scores, tags[rows], w["trans"])
            g = {"trans": dt, "out": both.reshape(-1, 2 * HIDDEN).T @ ds.reshape(-1, TAGS), "bias": ds.sum((0, 1))}
            dboth = ds @ w["out"].T
            da, g["fx"], g["fh"], g["fb"] = _lstm_back(dboth[:, :, :HIDDEN], kept_a, w["fx"], w["fh"])
            db, g["bx"], g["bh"], g["bb"] = _lstm_back(dboth[::-1, :, HIDDEN:], kept_b, w["bx"], w["bh"])
            g["embed"] = np.zeros_like(w["embed"])
            np.add.at(g["embed"], ids[rows].T, da + db[::-1])
            step += 1
            pace = rate * (0.3 if epoch >= epochs - 2 else 1.0)
            for k in w:
                grad = np.clip(g[k], -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] = w[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return w


def decode(ids: np.ndarray, w: Weights) -> np.ndarray:
    """The best tags (rows, time) of windows of character classes, by Viterbi."""
    scores, _ = _scores(ids, w)
    steps, rows, _ = scores.shape
    best, back = scores[0], np.zeros(scores.shape, np.int64)
    for t in range(1, steps):
        paths = best[:, :, None] + w["trans"]
        back[t] = paths.argmax(1)
        best = scores[t] + paths.max(1)
    tags = np.zeros((rows, steps), np.int64)
    tags[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = back[t][np.arange(rows), tags[:, t]]
    return tags


# --- labelled spans ---------------------------------------------------------------------------

def labelled_spans(n: int, seed: int = SEED, window: int = WINDOW) -> list[tuple[str, list[Span]]]:
    """n invented texts with their spans: every kind in several forms, and numbers that are none of them."""
    rng = np.random.default_rng([seed, 1])
    pick = lambda items: items[int(rng.integers(len(items)))]
    number = lambda k: "".join(str(x) for x in rng.integers(0, 10, k))
    syllables = "an be co der ei fo gi ha in ju ka lo ment ne on pre qui ra st tion un ver wo xi you zu é ü ñ".split()
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))
    name = lambda: "".join(c for c in word() if c.isascii()) or "a"

    def card() -> str:
        body = pick("3456") + number(int(pick([14, 14, 14, 13])))
        digits = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        gap = pick(["", "", " ", "-"])
        return gap.join(digits[i:i + 4] for i in range(0, len(digits), 4))

    makers = {
        "email": lambda: f"{name()}{pick(['', '.', '_', '+'])}{pick([number(2), name(), ''])}x@{name()}{pick(['', number(1)])}.{pick(['', name() + '.'])}{pick(['com', 'org', 'net', 'de', 'io'])}",
        "ip": lambda: ".".join(str(x) for x in rng.integers(1, 256, 4)),
        "card": card,
        "phone": lambda: pick([f"+{rng.integers(1, 99)} ({number(3)}) {number(3)}-{number(4)}", f"+{rng.integers(1, 99)} {number(3)} {number(3)} {number(4)}",
                               f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}", f"+{number(11)}"]),
    }
    others = [lambda: number(int(rng.integers(1, 9))), lambda: f"{number(2)}.{number(1)}.{number(1)}", lambda: f"password={name()}{number(6)}{name()}", lambda: f"AKIA{number(3)}XB{number(4)}QR",
              lambda: f"20{number(2)}-{number(2)}-{number(2)}", lambda: f"{number(2)}:{number(2)}", lambda: f"{number(2)}.{number(2)} %", lambda: f"@{name()}", lambda: f"v{number(1)}.{number(2)}",
              lambda: f'token = "{number(3)}ab{number(5)}cd{number(4)}ef"', lambda: f"{number(2)},{number(3)}", lambda: f"http://{name()}.com/{number(5)}"]
    made = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < window:
            kind = pick([*KINDS, "other", "", "", "", "", "", ""])
            gap = pick([" ", " ", " ", ", ", ". ", "\n", ": "]) if text else ""
            text += gap
            if kind in makers:
                what = makers[kind]()
                spans.append((kind, len(text), len(text) + len(what)))
            else:
                what = pick(others)() if kind else pick([word(), word(), word().capitalize(), word().upper() + "!!", word() + pick(["***", "$$$", "%%%"])])
            text += what
        cut_left = int(rng.integers(0, 12))
        made.append((text[cut_left:], [(k, max(0, a - cut_left), b - cut_left) for k, a, b in spans if b - cut_left > 2]))
    return made


_TRAINED: dict[tuple[int, int], Weights] = {}


def trained(spark: SparkSession, examples: int = EXAMPLES, seed: int = SEED) -> Weights:
    """The network of this module, trained by one task, once per driver; the same seed gives the same network.

    Its labelled spans are invented, so it is the same for every corpus; it has some 6,000 numbers.
    """
    if (examples, seed) not in _TRAINED:
        def run(batches):
            for _ in batches:
                w = train(labelled_spans(examples, seed), seed=seed)
                yield pa.RecordBatch.from_arrays([pa.array(list(w)), pa.array([x.tobytes() for x in w.values()]), pa.array([list(x.shape) for x in w.values()])], ["name", "data", "shape"])

        rows = spark.range(0, 1, 1, 1).mapInArrow(run, "name string, data binary, shape array<long>").collect()
        _TRAINED[examples, seed] = {r["name"]: np.frombuffer(bytes(r["data"])).reshape(r["shape"]).copy() for r in rows}
    return _TRAINED[examples, seed]


# --- spans of whole texts ---------------------------------------------------------------------

def _owner(at: int, half: int) -> int:
    """The window whose tag a character takes: the one in which it stands farthest from an edge."""
    return max(0, (at - half // 2) // half)


def network_spans(texts: list[str], w: Weights, window: int = WINDOW, everything: bool = False) -> list[list[Span]]:
    """Spans that the network sees in whole texts: all of those with a digit or an @, and some others.

    Windows start every half window. A character's tag is that of the window in which it stands
    farthest from an edge; tags then join into spans across windows. First the windows that own a
    digit or an @ are read, then those beside a window at whose edge a span is open, until none is:
    a span with such a character is whole then, however long. With `everything`, all windows are read.
    """
    half = window // 2
    first_own = lambda k: 0 if k == 0 else half // 2
    known: dict[int, np.ndarray] = {}
    tags_of: list[dict[int, np.ndarray]] = [{} for _ in texts]
    todo: list[tuple[int, int]] = []
    last: list[int] = []
    for n, text in enumerate(texts):
        last.append(max(0, -(-len(text) // half) - 1))
        wanted = set(range(last[n] + 1)) if everything and text else {_owner(m.start(), half) for m in _TRIGGER.finditer(text)}
        todo += [(n, k) for k in sorted(wanted)]
    while todo:
        for at in range(0, len(todo), DECODE):
            part, rows = todo[at:at + DECODE], []
            for n, k in part:
                if n not in known:
                    known[n] = char_ids(texts[n])
                ids = known[n][k * half:k * half + window]
                rows.append(np.pad(ids, (0, window - len(ids))))
            for (n, k), tags in zip(part, decode(np.stack(rows), w), strict=True):
                tags_of[n][k] = tags[first_own(k):half + half // 2]
        more = set()
        for n, k in todo:
            tags = tags_of[n][k]
            more |= {(n, j) for j, edge in ((k - 1, tags[0]), (k + 1, tags[-1])) if edge and 0 <= j <= last[n] and j not in tags_of[n]}
        todo = sorted(more)
    found: list[list[Span]] = [[] for _ in texts]
    for n, read in enumerate(tags_of):
        open_: list | None = None
        for k in sorted(read):
            start, tags = k * half + first_own(k), read[k]
            for i in np.flatnonzero(tags).tolist():
                tag, p = int(tags[i]), start + i
                kind = KINDS[(tag - 1) // 2]
                if open_ and open_[0] == kind and open_[2] == p and tag % 2 == 0:
                    open_[2] = p + 1
                else:
                    if open_:
                        found[n].append(tuple(open_))
                    open_ = [kind, p, p + 1]
        if open_:
            found[n].append(tuple(open_))
    return found


def plausible(kind: str, what: str) -> bool:
    """Whether a text can be of a kind at all: what the network adds must keep each kind's rules of form."""
    digits = _digits(what)
    if kind == "email":
        return re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]+", what) is not None
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}(?:[.,][0-9]{1,3}){3}", what) is not None and all(int(p) <= 255 for p in re.split("[.,]", what))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9 .\-]+", what) is not None
    return 9 <= len(digits) <= 15 and re.fullmatch(r"\+?[0-9 ().\-]+", what) is not None and re.search(r"[()+\- ]", what) is not None


def all_spans(texts: list[str], w: Weights) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, base and added spans) of whole texts; added spans overlap no others."""
    results = []
    for text, seen in zip(texts, network_spans(texts, w), strict=True):
        base = base_spans(text)
        taken = [(a, b) for _, a, b in base]
        spans = list(base)
        for kind, a, b in seen:
            while a < b and text[a] in " \n\t,;:.":
                a += 1
            while a < b and text[b - 1] in " \n\t,;:.(":
                b -= 1
            if b > a and plausible(kind, text[a:b]) and all(b <= x or a >= y for x, y in taken):
                spans.append((kind, a, b))
                taken.append((a, b))
        results.append((base, _ordered(spans)))
    return results


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(df: DataFrame, weights: Weights | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (joined as kind:start:end) of every whole text; null and empty texts have none.

    Texts of any length are read in bounded batches of windows. Repeated rows are read each; equal starts
    are in the order of KINDS; extra columns are ignored; an empty table gives no rows.
    """
    w = weights or trained(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def describe(base: list[Span], spans: list[Span]) -> tuple:
        counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
        return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    def make():
        return lambda texts: [describe(*found) for found in all_spans([t or "" for t in texts], w)]

    added = {**{f"n_{k}": "long" for k in KINDS}, "base_sha256": "string", "spans": "string"}
    return map_rows(rows, ["doc_id"], added, make, TEXTS)


def redact_documents(df: DataFrame, weights: Weights | None = None, *, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns whatever their names, personal data replaced by its kind; a null text stays null."""
    w = weights or trained(df.sparkSession)

    def make():
        def run(texts: list[str | None]) -> list[tuple]:
            found = all_spans([t or "" for t in texts], w)
            return [(None if t is None else redact(t, spans),) for t, (_, spans) in zip(texts, found, strict=True)]

        return run

    others = [c for c in df.columns if c != text_col]
    rows = df.withColumn(text_col, F.col(text_col).cast("string"))
    return map_rows(rows, others, {text_col: "string"}, make, TEXTS, given=[text_col]).select(*[f"`{c}`" for c in df.columns])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(read_table(spark, sf_dir, "documents"))
