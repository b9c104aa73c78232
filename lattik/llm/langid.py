"""Language identification by word-first backoff.

A word that was seen in training is scored by its log frequency in each language. An unseen word falls back to its longest
character n-grams (with word edges) of which the model knows any, then to shorter ones. A text's language is the one with
the largest sum of its words' scores and the language's prior.

Everything that the training rows hold is kept: all words and all n-grams, as a sorted array of 64-bit keys and one row of log
frequencies each. What bounds the model is the documented bound of the training rows (``SAMPLE`` rows, ``SAMPLE_BYTES`` bytes).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lattik.llm.common import give_back, map_batches, materialize

#: Labelled rows, and UTF-8 bytes of their texts, that the model is learned from, at most (chosen by a hash of the id).
SAMPLE, SAMPLE_BYTES = 4_000, 8_000_000
#: Lengths of n-grams, from the longest; 0 stands for whole words.
LENGTHS = (5, 4, 3, 2, 1)
#: Added to every count.
SMOOTH = 0.5
#: Weight of a fallen-back word's n-grams, as a mean over them.
DISCOUNT = 0.6
#: Words whose scores a task remembers (a row of floats each).
CACHE = 1 << 16
UNKNOWN = "und"

#: Letters with their combining marks (``re`` has no class for letters: its ``[^\W\d_]`` holds number characters).
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def ngrams(word: str, n: int) -> list[str]:
    framed = f"<{word}>" if n > 1 else word
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


def key_of(n: int, gram: str) -> int:
    """The key of a word (n = 0) or n-gram; equals Spark's ``xxhash64(concat(n, ':', gram))`` as an unsigned number."""
    return xxhash.xxh64_intdigest(f"{n}:{gram}".encode("utf-8", "replace"), 42)


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    prior: list[float] = field(default_factory=list)
    #: Sorted keys, and for each the log frequencies by language.
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    table: np.ndarray = field(default_factory=lambda: np.empty((0, 0), np.float32))

    def plain(self) -> tuple:
        """What workers need, without this class."""
        return (self.languages, self.prior, self.keys, self.table)

    def scores(self, asked: list[str]) -> np.ndarray:
        """A row of scores for each word: those of the word itself, else the discounted mean over its longest known n-grams."""
        out = np.zeros((len(asked), len(self.languages)), np.float32)
        open_ = np.arange(len(asked))
        for n in (0, *LENGTHS):
            if not len(open_):
                break
            grams = [[asked[i]] if n == 0 else ngrams(asked[i], n) for i in open_]
            of = np.repeat(np.arange(len(open_)), [len(g) for g in grams])
            hashes = np.fromiter((key_of(n, g) for found in grams for g in found), np.uint64, len(of))
            at = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
            hit = self.keys[at] == hashes if len(self.keys) else np.zeros(len(of), bool)
            known = np.bincount(of[hit], minlength=len(open_))
            sums = np.zeros((len(open_), out.shape[1]), np.float32)
            np.add.at(sums, of[hit], self.table[at[hit]])
            done = known > 0
            out[open_[done]] = sums[done] / known[done, None] * (1.0 if n == 0 else DISCOUNT)
            open_ = open_[~done]
        return out


def _chosen(rows: DataFrame, sample: int, most_bytes: int) -> DataFrame:
    """At most ``sample`` rows and ``most_bytes`` bytes of ``id``, ``lang``, ``text``, in the order of a hash of the id."""
    sizes = rows.select("id", F.octet_length("text").alias("size"), F.xxhash64("id", F.lit(3)).alias("place"))
    total, volume = sizes.agg(F.count("*"), F.sum("size")).first()
    slots = 1 << 20
    share = min(1.0, 1.1 * sample / max(1, total), 1.1 * most_bytes / max(1, volume or 1))
    few = sizes.where(F.pmod("place", F.lit(slots)) < math.ceil(share * slots)) if share < 1 else sizes
    order = Window.orderBy("rank", "id")  # over ids and sizes of little more than ``sample`` rows, whatever the corpus
    ranked = few.withColumn("rank", F.pmod("place", F.lit(slots))).withColumn("nth", F.row_number().over(order)).withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ids = ranked.where((F.col("nth") <= sample) & ((F.col("upto") <= most_bytes) | (F.col("nth") == 1))).select("id").distinct()
    return rows.join(F.broadcast(ids), "id", "left_semi")  # ``sample`` ids at most


def train(docs: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from at most ``sample`` rows and ``most_bytes`` bytes of ``docs`` that have text and language (by a hash of the id).

    Rows with a null id, text or language are left out; rows of one id are chosen together, each counts. Without any row the
    model knows no language.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chosen = _chosen(rows, sample, most_bytes).select("lang", "text")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[lang, None] += 1
                seen.update((lang, w) for w in words(text))
            cols = [pa.array([k[i] for k in seen], pa.string()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*cols, pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "k"])

        return run

    counted = materialize(map_batches(chosen, make, "lang string, word string, k bigint").groupBy("lang", "word").agg(F.sum("k").alias("k")))
    documents = {r["lang"]: r["k"] for r in counted.where("word IS NULL").collect()}  # a row for each language
    languages = sorted(documents)
    if not languages:
        return Model()
    framed = F.concat(F.lit("<"), "word", F.lit(">"))

    def grams(n: int):
        whole = F.col("word") if n < 2 else framed
        cut = F.transform(F.sequence(F.lit(1), F.length(whole) - (n - 1)), lambda i: F.substring(whole, i, F.lit(n)))
        return F.transform(F.when(F.length(whole) >= n, cut).otherwise(F.array().cast("array<string>")), lambda g: F.concat(F.lit(f"{n}:"), g))

    seen = counted.where("word IS NOT NULL").select("lang", "k", F.explode(F.concat(F.array(F.concat(F.lit("0:"), "word")), *(grams(n) for n in LENGTHS))).alias("gram"))
    place = (F.array_position(F.array(*(F.lit(lang) for lang in languages)), F.col("lang")) - 1).cast("int").alias("at")
    found = seen.groupBy("lang", F.xxhash64("gram").alias("key"), F.substring("gram", 1, 1).cast("int").alias("n")).agg(F.sum("k").alias("k"))
    # bounded by ``most_bytes``; as columns of numbers, since rows of objects took the driver a multiple of the model's memory
    found = found.select(place, "key", "n", "k").toArrow()
    keys, row = np.unique(found["key"].to_numpy().view(np.uint64), return_inverse=True)
    counts = np.zeros((len(keys), len(languages)))
    counts[row, found["at"].to_numpy()] = found["k"].to_numpy()
    length = np.zeros(len(keys), np.int8)
    length[row] = found["n"].to_numpy()
    del found, row
    table = np.empty(counts.shape, np.float32)
    for n in (0, *LENGTHS):
        of = length == n
        size, distinct = counts[of].sum(axis=0), (counts[of] > 0).sum(axis=0)
        table[of] = np.log((counts[of] + SMOOTH) / (size + SMOOTH * (distinct + 1)))
    del counts, length
    give_back()
    total = sum(documents.values())
    return Model(languages, [math.log(documents[lang] / total) for lang in languages], keys, table)


def _answers(model: Model) -> Callable[[list[str | None]], list[tuple[str, float]]]:
    """Answers to a list of texts; scores of up to ``CACHE`` words are remembered."""
    prior = np.array(model.prior)
    known: dict[str, int] = {}
    rows = np.zeros((0, len(model.languages)), np.float32)

    def answer(texts: list[str | None]) -> list[tuple[str, float]]:
        nonlocal rows
        counted = [Counter(words(t)) if t and model.languages else Counter() for t in texts]
        new = sorted({w for c in counted for w in c} - known.keys())
        if len(known) + len(new) > CACHE and known:
            known.clear()
            rows = rows[:0]
            new = sorted({w for c in counted for w in c})
        if new:
            known.update(zip(new, range(len(rows), len(rows) + len(new))))
            rows = np.concatenate([rows, *(model.scores(new[i : i + 20_000]) for i in range(0, len(new), 20_000))])
        out = []
        for c in counted:
            if not c:
                out.append((UNKNOWN, 0.0))
                continue
            total = prior + np.fromiter(c.values(), float, len(c)) @ rows[[known[w] for w in c]]
            best = int(np.argmax(total))
            out.append((model.languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())))
        if len(known) > CACHE:  # a batch with more words than are remembered
            known.clear()
            rows = rows[:0]
        return out

    return answer


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` (a learned language, ``und`` for a text that is null or has no letter), ``score`` (0 to 1).

    The score is the posterior of the prediction, 0 for ``und``. Number characters (``½``, ``Ⅷ``) are no letters. Ties go to the
    language first in order. Repeated rows are answered each; very long texts are answered whole; an empty table gives no
    rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        answer = _answers(Model(*shared.value))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = answer(batch.column(1).to_pylist())
            cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            return pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, "lang_pred", "score"])

        return run

    return map_batches(docs.select(F.col(id_col), F.col(text_col)), make, f"`{id_col}` {dict(docs.dtypes)[id_col]}, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with a score of ``least`` or more."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model.plain()), docs.columns.index(text_col)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        answer = _answers(Model(*shared.value))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = answer(batch.column(at).to_pylist())
            return batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

        return run

    return map_batches(docs, make, docs.schema)
