"""BPE encoding and decoding by tree concatenation.

A long text is halved until the leaves are short; leaves are encoded independently, several at a time, and
neighbours are joined by encoding a window around the join again. The window grows until both sides agree with it at
places where agreement is proof:

* a *hard boundary*, where the pre-tokenizer splits whatever stands around it (letter to space, letter to digit, ...), or
* inside a run of one character class, i.e. inside one unsplit piece: a token sequence is the BPE encoding of a piece
  exactly if each pair of neighbours is the encoding of its own text, so one common token on either side settles it.

Where neither is met the window grows to the whole text, which is right by definition.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattik.llm.common import map_batches

#: Characters in a leaf; longer texts are halved.
LEAF = 4_096
#: Leaves of one text that are encoded at the same time.
THREADS = 2
#: Characters on either side of a join in the first window.
WINDOW = 64
#: Characters around a window's edge that must be of one class for the edge to lie inside one unsplit piece.
MARGIN = 4
#: The pre-tokenizer's pattern of byte-level BPE files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LETTER = regex.compile(r"\p{L}")
_DIGIT = regex.compile(r"\p{N}")


def char_class(c: str) -> str:
    """L(etter), N(umber), S(pace), O(ther), or '' for characters on whose class libraries may differ."""
    if c.isascii():
        if c.isalpha():
            return "L"
        if c.isdigit():
            return "N"
        if c in " \t\n\r\v\f":
            return "S"
        return "O" if " " < c < "\x7f" else ""
    if c < "ɐ" or "Ѐ" <= c < "Ѡ" or "一" <= c < "龦" or "ぁ" <= c < "゗":
        return "L" if _LETTER.match(c) else "N" if _DIGIT.match(c) else ""
    return ""


def hard_boundary(text: str, p: int) -> bool:
    """Whether the pattern always splits ``text`` before position ``p``, whatever else stands in it."""
    if p <= 0 or p >= len(text):
        return True
    a, b = char_class(text[p - 1]), char_class(text[p])
    return bool(a and b) and a != b and a != "S" and not (text[p - 1] == "'" and b == "L")


def one_class(text: str, lo: int, hi: int) -> bool:
    """Whether all of ``text[lo:hi]``, with a margin inside the text, is of one known class."""
    if lo < 0 or hi > len(text):
        return False
    kind = char_class(text[lo])
    return bool(kind) and all(char_class(c) == kind for c in text[lo:hi])


class Codec:
    """Byte-level BPE from a ``tokenizers`` JSON file, with its merge ranks run by tiktoken where the file allows it.

    ``encode`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids`` and ``decode`` equals
    ``Tokenizer.decode(ids, skip_special_tokens=False)``.
    """

    def __init__(self, path: str, leaf: int = LEAF, threads: int = THREADS):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = spec["normalizer"] is None and model["type"] == "BPE" and not model.get("ignore_merges") and not model.get("dropout")
        if not plain or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE files without normalizer and prefix space are supported")
        to_byte = {c: b for b, c in byte_alphabet().items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        by_merge = [bytes(to_byte[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        order = [ranks[b] for b in by_merge]
        if order != sorted(order):
            raise ValueError("ids don't follow the order of merges")
        self.special = special
        self.ids = {**{i: b for b, i in ranks.items()}, **{i: t.encode() for t, i in special.items()}}
        self.table = [self.ids.get(i, b"") for i in range(max(self.ids) + 1)]
        self.decimal = [str(i) for i in range(len(self.table))]
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.leaf, self.pool = leaf, ThreadPoolExecutor(threads) if threads > 1 else None
        self.raw = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> list[int]:
        if self.split is None or not any(t in text for t in self.special):
            return self.encode_plain(text)
        out: list[int] = []
        for i, part in enumerate(self.split.split(text)):
            out += [self.special[part]] if i % 2 else self.encode_plain(part)
        return out

    def encode_plain(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.raw(text)
        cuts = [0, len(text)]
        while max(b - a for a, b in zip(cuts, cuts[1:])) > self.leaf:
            cuts = sorted({*cuts, *((a + b) // 2 for a, b in zip(cuts, cuts[1:]))})
        leaves = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        parts = list((self.pool.map if self.pool else map)(self.raw, leaves))  # the encoder releases the interpreter's lock
        spans = list(zip(cuts, cuts[1:]))
        while len(parts) > 1:  # neighbours, level by level
            nodes = [(self.join(text, spans[i], parts[i], spans[i + 1], parts[i + 1]), (spans[i][0], spans[i + 1][1])) if i + 1 < len(parts) else (parts[i], spans[i]) for i in range(0, len(parts), 2)]
            parts, spans = [n[0] for n in nodes], [n[1] for n in nodes]
        return parts[0]

    def join(self, text: str, left: tuple[int, int], a: list[int], right: tuple[int, int], b: list[int]) -> list[int]:
        """Tokens of ``text[left[0]:right[1]]`` from those of its two halves."""
        whole, mid = text[left[0] : right[1]], left[1] - left[0]
        reach = WINDOW
        while True:
            i, s = self._edge(a, mid, reach, whole, back=True)
            j, e = self._edge(b, len(whole) - mid, reach, whole, back=False)
            if s == 0 and e == len(whole):
                return self.raw(whole)
            w = self.raw(whole[s:e])
            if self._left_agrees(whole, s, a, i, w) and self._right_agrees(whole, e, b, j, w):
                return a[:i] + w + b[j:]
            reach *= 2

    def _edge(self, tokens: Sequence[int], chars: int, reach: int, whole: str, back: bool) -> tuple[int, int]:
        """The token index and the position in ``whole`` at least ``reach`` characters from the join, on a character's edge."""
        if reach >= chars:
            return (0, 0) if back else (len(tokens), len(whole))
        run, i = b"", len(tokens) if back else 0
        while True:
            i += -1 if back else 1
            if i < 0 or i > len(tokens):
                return (0, 0) if back else (len(tokens), len(whole))
            piece = self.table[tokens[i if back else i - 1]]
            run = piece + run if back else run + piece
            if len(run) < reach:
                continue
            try:
                n = len(run.decode("utf-8"))
            except UnicodeDecodeError:
                continue  # the edge would cut a character
            if n >= reach:
                return (i, chars - n) if back else (i, len(whole) - chars + n)

    def _left_agrees(self, whole: str, s: int, a: Sequence[int], i: int, w: Sequence[int]) -> bool:
        if s == 0 or hard_boundary(whole, s):
            return True
        size = len(self.table[a[i]])
        return w[:1] == a[i : i + 1] and one_class(whole, s - MARGIN, s + size + MARGIN)

    def _right_agrees(self, whole: str, e: int, b: Sequence[int], j: int, w: Sequence[int]) -> bool:
        if e == len(whole):
            return True
        size = len(self.table[b[j - 1]])
        if hard_boundary(whole, e):  # b's tokens from here on must start at the same boundary
            return True
        return w[-1:] == b[j - 1 : j] and one_class(whole, e - size - MARGIN, e + MARGIN)

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join([self.table[i] for i in ids]).decode("utf-8", "replace")


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def _digest(parts: bytes) -> str:
    return hashlib.sha256(parts).hexdigest()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, leaf: int = LEAF, threads: int = THREADS) -> DataFrame:
    """Encode every whole text, then decode the ids again.

    Returns ``id_col``, ``n_tokens``, ``ids`` (with ``keep_ids``), ``ids_sha256`` (of the decimal ids joined by commas)
    and ``decoded_sha256``. A null text counts as empty (no ids); an empty table gives no rows; repeated rows are encoded
    each; very long texts are encoded whole; other columns are not read. ``path`` must be readable on every executor.
    """
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        codec = Codec(path, leaf, threads)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            all_ids, sums, back = [], [], []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text or "")
                all_ids.append(ids)
                sums.append(_digest(",".join([codec.decimal[i] for i in ids]).encode()))
                back.append(_digest(codec.decode(ids).encode("utf-8")))
            cols = [batch.column(0), pa.array([len(x) for x in all_ids], pa.int64())]
            cols += [pa.array(all_ids, pa.list_(pa.int32()))] if keep_ids else []
            cols += [pa.array(sums, pa.string()), pa.array(back, pa.string())]
            return pa.RecordBatch.from_arrays(cols, names=names)

        return run

    names = [id_col, "n_tokens", *["ids"] * keep_ids, "ids_sha256", "decoded_sha256"]
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens bigint" + ", ids array<int>" * keep_ids + ", ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(F.col(id_col), F.col(text_col)), make, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts from ids: ``id_col``, ``text``. Null ids give a null text."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        codec = Codec(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if x is None else codec.decode(x) for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

        return run

    return map_batches(encoded.select(id_col, ids_col), make, f"`{id_col}` {dict(encoded.dtypes)[id_col]}, text string")
