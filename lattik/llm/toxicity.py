"""Toxicity by compression distance.

Two zstandard dictionaries are trained (``zstandard.train_dictionary``) on separate parts of a bounded labelled sample: one on
windows of ordinary texts, one on those windows of toxic texts that hold a word which tells toxic texts from ordinary ones. A
text is cut into overlapping windows of ``WIDTH`` words; each (by spans first) is compressed with the ordinary dictionary, and with the toxic
one joined to it, so that both compressors know ordinary text equally well and the difference of the lengths is what the
toxic dictionary explains. (With the toxic dictionary alone, common words make that difference noisy: the README has figures.)
Windows stand between fixed carriers that both dictionaries end with, so a block is always compressed.

How much likelier each difference is in toxic texts is calibrated on rows that the dictionaries don't know. A text's evidence
is the sum over its windows, that sum by the root of their number, its most toxic window and the share of toxic windows; a
logistic curve over them gives the score, shifted so that the threshold is the best one on the calibration rows.

Words and windows are counted once for each different context, not by texts: a text with hundreds of near copies doesn't count more.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattik.llm.common import map_batches, materialize, semi_join_ids

#: Labelled rows that the classifier is fitted on, at most (about; chosen by a hash of the id).
SAMPLE = 12_000
#: Tenths of the sample that the dictionaries are built from; scores are calibrated on the others, which the dictionaries don't know.
BUILD = 7
#: Words in a window; a window begins at every word. Windows are first compressed together, as spans of so many words; only a
#: span in which the toxic dictionary saves ``NOTABLE`` bytes is looked at window by window, in others nothing is saved.
WIDTH, SPAN, NOTABLE = 4, 8, 2
#: Bytes of the dictionaries, and windows that either is trained on, at most (by a hash of the window).
TOXIC_BYTES, ORDINARY_BYTES = 1_536, 110_000
WINDOWS = 80_000
#: The trainer's parameters: bytes of a segment and of the sequences that it counts.
SEGMENT, SEQUENCE = 16, 6
#: Least log odds, and least log-likelihood gain, of a telling word (a few ordinary contexts are tolerated); their number at most.
ODDS, GAIN, TELLING = 3.0, 16.0, 5_000
LEVEL = 3
#: The first and last bin of the bytes saved in a window.
SAVES = 20
#: A score from here on predicts 1.
THRESHOLD = 0.7

WORD = re.compile(r"\w+")
HEAD = b"QX7ZKV2WJ9PLN4TRB8DHM3FGY6SCU5AEI1O0" * 2
TAIL = b"0ZUX5KQW8VJ1PRL6TNB3DMH9FGY2SC4A7EIO"


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    #: Log odds that a window with so many bytes saved is of a toxic text.
    rates: dict[int, float] = field(default_factory=dict)
    #: Of the logistic curve: a weight for each kind of evidence, then the constant.
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0, -5.0)

    def plain(self) -> tuple:
        """What workers need, without this class."""
        return (self.toxic, self.ordinary, self.rates, self.curve)

    def savings(self) -> Callable[[str | None], Counter]:
        """Of a whole text, the number of windows by bytes that the toxic dictionary saves."""
        import zstandard as zs

        params = zs.ZstdCompressionParameters.from_level(LEVEL, format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=18)

        def compressor(content: bytes) -> Callable[[bytes], bytes]:
            return zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(content + TAIL + HEAD, dict_type=zs.DICT_TYPE_RAWCONTENT), compression_params=params).compress

        with_toxic, plain = compressor(self.ordinary + self.toxic), compressor(self.ordinary)

        def saved(part: list[bytes]) -> int:
            window = HEAD + b" " + b" ".join(part) + b" " + TAIL
            return len(plain(window)) - len(with_toxic(window))

        def of(text: str | None) -> Counter:
            out: Counter = Counter()
            w = [x.encode("utf-8", "replace") for x in words(text or "")]
            starts = max(1, len(w) - WIDTH + 1) if w else 0
            for i in range(0, starts, SPAN - WIDTH + 1):
                here = min(starts, i + SPAN - WIDTH + 1)
                if here - i == 1 or saved(w[i : i + SPAN]) >= NOTABLE:
                    out.update(max(-SAVES, min(SAVES, saved(w[k : k + WIDTH]))) for k in range(i, here))
                else:
                    out[0] += here - i
            return out

        return of

    def evidence(self, saved: dict[int, int]) -> tuple[float, ...]:
        """From the number of windows by bytes saved."""
        n = sum(saved.values())
        if not n:
            return (0.0, 0.0, 0.0, 0.0)
        rate = lambda z: self.rates.get(z, 0.0)
        total = sum(k * rate(z) for z, k in saved.items())
        return (max(-50.0, min(50.0, total)), total / n**0.5, max(map(rate, saved)), sum(k for z, k in saved.items() if rate(z) > 1) / n)

    def score(self, evidence: tuple[float, ...]) -> float:
        z = sum(w * x for w, x in zip(self.curve, (*evidence, 1.0)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _worded(sample: DataFrame) -> DataFrame:
    """``label``, the texts' words ``w``, and ``i``, ``word`` of each."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return sample.select("label", found.alias("w")).select("label", "w", F.posexplode("w").alias("i", "word"))


def _contexts(worded: DataFrame) -> DataFrame:
    """``word``, ``toxic``, ``ordinary``: how many different words precede it in toxic and in ordinary texts."""
    before = worded.select("label", "word", F.when(F.col("i") > 0, F.get("w", F.col("i") - 1)).otherwise("").alias("before"))
    pairs = before.groupBy("word", "before").agg(F.max("label").alias("t"), F.max(1 - F.col("label")).alias("o"))
    return pairs.groupBy("word").agg(F.sum("t").alias("toxic"), F.sum("o").alias("ordinary"))


def _few(windows: DataFrame) -> list[bytes]:
    """At most ``WINDOWS`` of the different windows, by a hash, in a fixed order."""
    slots = 1 << 20
    share = min(slots, max(1, slots * WINDOWS // max(1, windows.count())))
    chosen = windows.where(F.pmod(F.xxhash64("window"), F.lit(slots)) < share).distinct().limit(2 * WINDOWS).collect()
    texts = sorted(r["window"] for r in chosen)
    return [f" {t} ".encode("utf-8", "replace") for t in texts][: 2 * WINDOWS]


def _dictionary(windows: list[bytes], size: int) -> bytes:
    """A trained dictionary of at most ``size`` bytes; of very few windows, which can't be trained on, their text itself."""
    import zstandard as zs

    random.Random(5).shuffle(windows)
    repeated = windows * (2_000 // max(1, len(windows)) + 1)
    try:
        return zs.train_dictionary(size, repeated, k=SEGMENT, d=SEQUENCE).as_bytes()
    except zs.ZstdError:
        return b"".join(windows)[:size]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most about ``sample`` rows of ``labels`` (chosen by a hash of the id) and the texts of ``docs`` with their ids.

    Rows with a null id or label are left out. Equal texts count once; if their labels differ, and if an id has several
    labels, the text counts as toxic. Without toxic or ordinary texts, or without words that tell them apart, the model gives
    every text the same low score.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    total = known.count()
    slots = 1 << 20
    share = slots if total <= sample else max(1, slots * sample // total)
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(slots)) < share).groupBy("id").agg(F.max("label").alias("label"))
    texts = semi_join_ids(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), chosen.select("id"), "id")
    once = texts.join(F.broadcast(chosen), "id").where("text IS NOT NULL").groupBy("text").agg(F.max("label").alias("label"))
    rows = materialize(once.withColumn("build", F.pmod(F.xxhash64("text"), F.lit(10)) < BUILD).repartition(12))
    worded = _worded(rows.where("build"))
    counts = materialize(_contexts(worded))
    n_toxic, n_ordinary = counts.agg(F.sum("toxic"), F.sum("ordinary")).first()
    model = Model()
    if not n_toxic or not n_ordinary:
        return model
    odds = F.when(F.col("toxic") > 0, F.log((F.col("toxic") / n_toxic) / ((F.col("ordinary") + 0.5) / (n_ordinary + 1)))).otherwise(-99.0)
    telling = counts.withColumn("odds", odds).where((F.col("odds") > ODDS) & (F.col("toxic") * F.col("odds") > GAIN) & (F.length("word") > 1))
    telling = telling.orderBy((F.col("toxic") * F.col("odds")).desc(), "word").limit(TELLING).select("word")
    beside = F.concat_ws(" ", F.slice("w", F.greatest(F.col("i"), F.lit(1)), F.when(F.col("i") > 0, 3).otherwise(2)))
    toxic = _few(worded.where("label = 1").join(F.broadcast(telling), "word", "left_semi").select(beside.alias("window")))
    if not toxic:
        return model  # nothing tells the sample's toxic texts from its ordinary ones
    ordinary = _few(worded.where(f"label = 0 AND i % {WIDTH} = 0").select(F.concat_ws(" ", F.slice("w", F.col("i") + 1, WIDTH)).alias("window")))
    model.toxic, model.ordinary = _dictionary(toxic, TOXIC_BYTES), _dictionary(ordinary, ORDINARY_BYTES)
    plain = model.plain()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        of = Model(*plain).savings()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            saved = [[x for pair in sorted(of(t).items()) for x in pair] for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(saved, pa.list_(pa.int32())), batch.column(1)], names=["saved", "label"])

        return run

    # one short list of counts for each row of the bounded sample
    found = map_batches(rows.where("NOT build").select("text", "label"), make, "saved array<int>, label int").collect()
    if len({y for _, y in found}) < 2:
        return model
    _calibrate(model, sorted(([*zip(c[::2], c[1::2])], y) for c, y in found))
    return model


def _calibrate(model: Model, seen: list[tuple[list[tuple[int, int]], int]]) -> None:
    """Log odds of windows, then a logistic regression on the evidence, shifted so that the best F1 on the sample is at ``THRESHOLD``."""
    windows = (Counter(), Counter())
    for saved, y in seen:
        windows[y].update(dict(saved))
    total = [sum(windows[x].values()) or 1 for x in (0, 1)]
    for z in {*windows[0], *windows[1]}:
        model.rates[z] = math.log(((windows[1][z] + 0.5) / total[1]) / ((windows[0][z] + 0.5) / total[0]))
    x = np.array([(*model.evidence(dict(saved)), 1.0) for saved, _ in seen])
    y = np.array([label for _, label in seen], float)
    scale = np.abs(x).max(axis=0) + 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(60):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x / scale @ w, -30, 30)))
        hessian = (x / scale).T @ ((p * (1 - p))[:, None] * (x / scale)) + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hessian, (x / scale).T @ (y - p) - 0.05 * w)
        w += np.clip(step, -5, 5)
    w = w / scale
    z = x @ w
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(len(z)) + 1 + y.sum())
    last = np.append(z[order][:-1] > z[order][1:], True)
    at = int(np.argmax(np.where(last, f1, -1)))
    cut = (z[order][at] + z[order][min(at + 1, len(z) - 1)]) / 2
    w[-1] += math.log(THRESHOLD / (1 - THRESHOLD)) - cut
    model.curve = tuple(float(v) for v in w)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (0 to 1), ``predicted`` (1 from ``THRESHOLD`` on) for each whole text.

    Null and empty texts, and texts without words, have no window and no evidence. Repeated rows are
    scored each; very long texts are scored whole; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        of = _scores(Model(*shared.value))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [of(t) for t in batch.column(1).to_pylist()]
            predicted = pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), predicted], names=[id_col, "score", "predicted"])

        return run

    return map_batches(docs.select(F.col(id_col), F.col(text_col)), make, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double, predicted int")


def _scores(model: Model) -> Callable[[str | None], float]:
    of = model.savings()
    return lambda text: model.score(model.evidence(of(text)))


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that aren't predicted toxic."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model.plain()), docs.columns.index(text_col)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        of = _scores(Model(*shared.value))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([of(t) < THRESHOLD for t in batch.column(at).to_pylist()], pa.bool_()))

        return run

    return map_batches(docs, make, docs.schema)
