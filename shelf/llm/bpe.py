"""BPE encoding and decoding with a public vocabulary: long texts as trees of halves.

A long text is cut into halves, and these again, wherever the cuts fall. Leaves are encoded on their
own: cut into pieces as the vocabulary's pre-tokenizer cuts them, distinct short pieces remembered while
a task runs. Every join is then mended by encoding a growing window of pieces around it again, until the
window's outermost pieces on both sides are those that were there. That makes the whole exact: the
pattern that cuts pieces looks ahead only, and no farther than into the next piece, so what stands
before an agreed piece and what follows one is cut as in the whole text. A piece that is long itself is
a tree of bytes, whose leaves the library encodes in parallel; there windows are of tokens, and a sequence
of tokens is the BPE encoding of its text if and only if every two neighbours are that of theirs.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelf.llm.common import give_back, map_rows, read_table

#: Texts of more characters are encoded as trees with leaves of at most that many, and so are pieces of more bytes.
TEXT_LEAF, LEAF = 4096, 1024
#: Distinct pieces that a task remembers before it starts anew.
REMEMBERED = 100_000

#: The pattern by which the vocabulary's pre-tokenizer splits.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin letters, and texts of nothing else but ASCII: there the classes are these ranges, which the faster engine takes.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NOT_LATIN = re.compile("[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f]")
_LATIN_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[A-Za-z{LATIN}]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9{LATIN}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_BEYOND = re.compile("[԰-\U0010ffff]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(shifted)) for b in range(256)]


def latin(text: str) -> bool:
    """Whether a text is ASCII (without control characters but white space) and Latin letters whose lower case is Latin too."""
    return not _NOT_LATIN.search(text)


def sure(text: str) -> bool:
    """Whether the library's and this module's character classes are known to agree on a text.

    They may differ on characters that newer Unicode versions have added, and on a sigma's lower case.
    """
    if "Σ" in text:
        return False
    return not _BEYOND.search(text) or not any(unicodedata.category(c) == "Cn" for c in set(text))


class ByteBpe:
    """A byte-level BPE vocabulary in the library's JSON format (path)."""

    def __init__(self, path: str, leaf: int = LEAF, remembered: int = REMEMBERED, text_leaf: int = TEXT_LEAF):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if content["normalizer"] is not None or content["pre_tokenizer"].get("type") != "ByteLevel" or content["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        self.leaf, self.remembered, self.text_leaf = leaf, remembered, text_leaf
        self.joins = 0  # of texts' trees, so far
        self._whole = Tokenizer(self.library.model)  # the merges alone: no normalising, no splitting
        self._symbols = byte_symbols()
        byte_of = {s: b for b, s in enumerate(self._symbols)}
        self._special = {t["content"]: t["id"] for t in content["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in content["added_tokens"]):
            raise ValueError(f"{path} has added tokens with rules of their own")
        self._split_special = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        size = self.library.get_vocab_size(with_added_tokens=True)
        self._bytes: list[bytes] = [b""] * size
        for token, i in content["model"]["vocab"].items():
            self._bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self._special.items():
            self._bytes[i] = token.encode()
        self.names = [str(i) for i in range(size)]
        self._pieces = regex.compile(_SPLIT)
        self._known: dict[str, tuple[int, ...]] = {}

    def _model(self, data: bytes) -> list[int]:
        """The model's merges on bytes, without any pre-tokenizer."""
        return [t.id for t in self.library.model.tokenize("".join(map(self._symbols.__getitem__, data)))]

    def _leaves(self, data: bytes) -> list[list[int]]:
        """Encode all leaves of a long piece at once, in the library's threads."""
        parts = [data]
        while len(parts[0]) > self.leaf:
            parts = [half for p in parts for half in (p[: len(p) // 2], p[len(p) // 2:])]
        return [e.ids for e in self._whole.encode_batch_fast(["".join(map(self._symbols.__getitem__, p)) for p in parts], add_special_tokens=False)]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring texts, from the encodings of each."""
        k = 1
        while True:
            a, b = left[-k:], right[:k]
            window = self._model(b"".join(map(self._bytes.__getitem__, a + b)))
            if (k >= len(left) or window[0] == a[0]) and (k >= len(right) or window[-1] == b[-1]):
                return left[:-k] + window + right[k:] if k < len(left) else window + right[k:]
            k *= 2

    def encode_long(self, data: bytes) -> list[int]:
        """A long piece, from its leaves up; a level's joins only need the level below."""
        level = self._leaves(data)
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        return level[0]

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        if len(data) > self.leaf:
            return tuple(self.encode_long(data))
        ids = tuple(self._model(data))
        if len(piece) <= 64:
            if len(self._known) >= self.remembered:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def _encoded(self, pieces: list[str]) -> list[tuple[int, ...]]:
        known, piece = self._known, self._piece
        return [known.get(p) or piece(p) for p in pieces]

    def _join_texts(self, left: tuple[list, list], right: tuple[list, list], find) -> tuple[list, list]:
        """(pieces, ids of each) of two neighbouring texts, from those of each."""
        self.joins += 1
        (lp, li), (rp, ri), k = left, right, 1
        while True:
            a, b = lp[-k:], rp[:k]
            window = find("".join(a + b))
            if (k >= len(lp) or window[0] == a[0]) and (k >= len(rp) or window[-1] == b[-1]):
                both = lp[-1] + rp[0]
                ids = [tuple(self.join(list(li[-1]), list(ri[0]))) if p == both and len(p) > self.leaf else self._encoded([p])[0] for p in window]
                return (lp[:-k] if k < len(lp) else []) + window + rp[k:], (li[:-k] if k < len(li) else []) + ids + ri[k:]
            k *= 2

    def _tree(self, text: str, find) -> tuple[list[str], list[tuple[int, ...]]]:
        """(pieces, ids of each) of a text: its halves' and what their join changes."""
        if len(text) <= self.text_leaf:
            pieces = find(text)
            return pieces, self._encoded(pieces)
        half = len(text) // 2
        return self._join_texts(self._tree(text[:half], find), self._tree(text[half:], find), find)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text as the library gives them without special tokens added; null counts as empty."""
        if not text:
            return []
        if latin(text):
            find = _LATIN_SPLIT.findall
        elif sure(text):
            find = self._pieces.findall
        else:
            return self.library.encode(text, add_special_tokens=False).ids
        ids: list[int] = []
        for part in self._split_special.split(text) if self._split_special else [text]:
            if part in self._special:
                ids.append(self._special[part])
            elif part:
                ids.extend(chain.from_iterable(self._tree(part, find)[1]))
        return ids

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self._bytes[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def load_byte_bpe(path: str) -> ByteBpe:
    """A vocabulary for one task: Spark keeps a task's Python worker for other stages, which would hold it and its pieces beside their own."""
    found = ByteBpe(path)
    give_back()  # what reading the file took
    return found


def default_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(df: DataFrame, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; null and empty texts have no ids. Repeated rows are encoded each."""
    path = path or default_path()
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def make():
        bpe = load_byte_bpe(path)
        return lambda text: (bpe.encode(text),)

    return map_rows(rows, ["doc_id"], {"ids": "array<int>"}, make)


def decode_documents(df: DataFrame, path: str | None = None, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of id sequences; null counts as no ids."""
    path = path or default_path()
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def make():
        bpe = load_byte_bpe(path)
        return lambda ids: (bpe.decode(ids or []),)

    return map_rows(rows, ["doc_id"], {"text": "string"}, make)


def digest_documents(df: DataFrame, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_joins: encode, then decode, each whole text in one pass.

    n_joins counts the joins of the text's tree: 0 for texts of one leaf. Null and empty texts have no
    ids; repeated rows are encoded each; extra columns are ignored; an empty table gives no rows.
    """
    path = path or default_path()
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def make():
        bpe = load_byte_bpe(path)

        def digest(text: str | None) -> tuple[int, str, str, int]:
            before = bpe.joins
            ids = bpe.encode(text)
            listed = ",".join([bpe.names[i] for i in ids]).encode()
            return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest(), bpe.joins - before

        return digest

    return map_rows(rows, ["doc_id"], {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "n_joins": "int"}, make)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return digest_documents(read_table(spark, sf_dir, "documents"))
