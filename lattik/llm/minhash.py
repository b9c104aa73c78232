"""b-bit MinHash near-duplicate detection on word shingles.

1. Each text gives its set of distinct shingle hashes; 128 minima of the set make 32 bands of 4, and the low 4 bits of
   each minimum are packed into bit planes (b-bit MinHash, Li & Koenig, 2010).
2. Texts with equal sets become one node. Nodes that share a band are candidates. The bit planes give the similarity,
   corrected for chance collisions, by XOR, OR and ``bit_count``; candidates far below the threshold are dropped.
3. The rest is confirmed on full sets. In each bucket one hub (first the node that shares buckets with most others) is
   compared with the others first. Members that are still in different components afterwards are compared if they share one
   of their rarest shingles, as all pairs of the wanted similarity do; so a bucket of near copies costs a star, not all its
   pairs, and no link between components is lost.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattik.llm.common import drop_table, map_batches, materialize, semi_join_ids
from lattik.llm.components import components

BANDS, ROWS = 32, 4
#: Low bits kept of each minimum.
BITS = 4
MINIMA = BANDS * ROWS
#: Standard errors by which an estimate may lie below the threshold.
SLACK = 6.0
#: Rounds in which each unsettled bucket compares one hub with its other members.
STAR_ROUNDS = 2
#: Groups of equal texts that hold more than one such part of all rows are joined by broadcast.
HOT_GROUPS = 1_000

_M64 = (1 << 64) - 1
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _rng_words(n: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random words (splitmix64 of a counter)."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word-shingle hashes (64 bits) of whole texts: A-Z lower-cased, words split at ASCII white space."""

    CHUNK = 1 << 20

    def __init__(self, width: int):
        self.width = width
        self.of_byte = _rng_words(256, 11) | np.uint64(1)
        self.base = 0x9DDFEA08EB382D69 | 1
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.weights = _rng_words(width, 23) | np.uint64(1)
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        ones = np.ones(n, np.uint64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = self.base & _M64, pow(self.base, -1, 1 << 64)
        self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    def words(self, data: bytes) -> np.ndarray:
        """Hashes of the words of ``data``, in order."""
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + self.CHUNK)
            if end < len(data) and (gap := _GAP.search(data, end)):  # on to the end of the word
                end = gap.start()
            elif end < len(data):
                end = len(data)
            parts.append(self._words(np.frombuffer(data, np.uint8, end - at, at)))
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def _words(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        if n > len(self.up):
            self._powers(max(n, 2 * len(self.up)))
        gap = self.space[raw]
        edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        upper = (raw >= 65) & (raw <= 90)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.of_byte[raw + (upper * np.uint8(32))] * self.up[:n], out=sums[1:], dtype=np.uint64)
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted set; a text of fewer words than the width is one shingle, one without words has none."""
        w = self.words(text.encode("utf-8")) if text else np.empty(0, np.uint64)
        if not len(w):
            return w
        n = max(1, len(w) - self.width + 1)
        out = np.full(n, min(len(w), self.width), np.uint64)
        for j in range(min(len(w), self.width)):
            out += w[j : j + n] * self.weights[j]
        return np.unique(mix(out))


class Signer:
    """Band keys and packed low bits from shingle sets."""

    BLOCK = 1 << 15

    def __init__(self) -> None:
        self.xor, self.mul = _rng_words(MINIMA, 37), _rng_words(MINIMA, 41) | np.uint64(1)
        self.band_seed, self.row_weight = _rng_words(BANDS, 53), _rng_words(ROWS, 59) | np.uint64(1)

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        """Minima (rows) of non-empty sets (columns), by blocks of elements that stay in the CPU's cache."""
        out = np.empty((MINIMA, len(sets)), np.uint64)
        i = 0
        while i < len(sets):
            j, n = i, 0
            while j < len(sets) and (j == i or n + len(sets[j]) <= self.BLOCK):
                n += len(sets[j])
                j += 1
            if j == i + 1:
                low = np.full(MINIMA, _M64, np.uint64)
                for at in range(0, n, self.BLOCK):
                    block = sets[i][at : at + self.BLOCK]
                    for k in range(MINIMA):
                        low[k] = min(low[k], ((block ^ self.xor[k]) * self.mul[k]).min())
                out[:, i] = low
            else:
                block = np.concatenate(sets[i:j])
                starts = np.cumsum([0, *(len(s) for s in sets[i : j - 1])])
                for k in range(MINIMA):
                    out[k, i:j] = np.minimum.reduceat((block ^ self.xor[k]) * self.mul[k], starts)
            i = j
        return out

    def bands(self, low: np.ndarray) -> np.ndarray:
        rows = mix(low).reshape(BANDS, ROWS, -1)
        keys = np.repeat(self.band_seed[:, None], low.shape[1], 1)
        for r in range(ROWS):
            keys = mix(keys + rows[:, r] * self.row_weight[r])
        return keys.T

    def planes(self, low: np.ndarray) -> np.ndarray:
        """For each set, ``BITS`` planes of ``MINIMA`` bits as 64-bit words."""
        bits = mix(low ^ np.uint64(0xA5A5A5A5))
        out = np.empty((low.shape[1], BITS * MINIMA // 64), np.uint64)
        for p in range(BITS):
            plane = ((bits >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
            out[:, p * MINIMA // 64 : (p + 1) * MINIMA // 64] = np.packbits(plane, axis=0).T.copy().view(np.uint64)
        return out


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a = int(mix(s).sum(dtype=np.uint64)) ^ len(s)
    b = int(np.bitwise_xor.reduce(mix(s + np.uint64(0x1234567))))
    return tuple(int(np.uint64(x).astype(np.int64)) for x in (a, b))


def _longs(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), flat)


def signatures(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n`` (set size), ``f1``, ``f2`` (the set's fingerprint), ``planes`` and ``bands`` (both null for empty sets)."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        shingler, signer = Shingler(width), Signer()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingler.shingles(t) for t in batch.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            low = signer.minima([sets[i] for i in full])
            place = np.full(len(sets), -1)
            place[full] = np.arange(len(full))
            take = pa.array(np.maximum(place, 0), mask=place < 0)
            prints = [_fingerprint(s) for s in sets]
            cols = [batch.column(0), pa.array([len(s) for s in sets], pa.int64())]
            cols += [pa.array([f[k] for f in prints], pa.int64()) for k in (0, 1)]
            cols += [_longs(x).take(take) if full else pa.nulls(len(sets), pa.list_(pa.int64())) for x in (signer.planes(low), signer.bands(low))]
            return pa.RecordBatch.from_arrays(cols, names=["id", "n", "f1", "f2", "planes", "bands"])

        return run

    schema = f"id {dict(docs.dtypes)[id_col]}, n bigint, f1 bigint, f2 bigint, planes array<bigint>, bands array<bigint>"
    return map_batches(docs.select(F.col(id_col), F.col(text_col)), make, schema)


def shingle_sets(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``f1``, ``f2``, ``shingles`` (the set)."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        shingler = Shingler(width)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingler.shingles(t) for t in batch.column(1).to_pylist()]
            prints = [_fingerprint(s) for s in sets]
            ends = np.cumsum([0, *(len(s) for s in sets)])
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            cols = [batch.column(0), *(pa.array([f[k] for f in prints], pa.int64()) for k in (0, 1))]
            cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            return pa.RecordBatch.from_arrays(cols, names=["id", "f1", "f2", "shingles"])

        return run

    schema = f"id {dict(docs.dtypes)[id_col]}, f1 bigint, f2 bigint, shingles array<bigint>"
    return map_batches(docs.select(F.col(id_col), F.col(text_col)), make, schema)


def similarity(a: str = "pa", b: str = "pb"):
    """The collision-corrected estimate from two columns of planes: (matches / minima - 2^-b) / (1 - 2^-b)."""
    words = MINIMA // 64
    differ = [F.expr("bit_count(" + " | ".join(f"({a}[{p * words + w}] ^ {b}[{p * words + w}])" for p in range(BITS)) + ")") for w in range(words)]
    chance = 2.0**-BITS
    return (1 - sum(differ[1:], differ[0]) / float(MINIMA) - chance) / (1 - chance)


def floor_of(threshold: float) -> float:
    """The estimate below which a pair of at least ``threshold`` does not fall, but for ``SLACK`` standard errors."""
    chance = 2.0**-BITS
    p = threshold + (1 - threshold) * chance
    return threshold - SLACK * (p * (1 - p) / MINIMA) ** 0.5 / (1 - chance)


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a`` < ``b`` of different ``label`` that can reach ``percent``: from ``node``, ``label``, ``shingles``.

    With all sets in one order of shingles, rarest first, the first common shingle of two such sets has enough places behind
    it in either set for the overlap that they need, percent/(100 + percent) * (|A| + |B|). Near copies that are too far
    apart mostly have no common shingle that early, as their own changes come first.
    """
    spread = sets.select("node", "label", F.explode("shingles").alias("s"))
    rarity = spread.groupBy("s").agg(F.count("*").alias("df"), (F.min("label") < F.max("label")).alias("mixed"))
    ordered = spread.join(rarity, "s").groupBy("node", "label").agg(F.sort_array(F.collect_list(F.struct("df", "s", "mixed"))).alias("all"))
    n = F.size("all")
    first = ordered.select("node", "label", n.alias("n"), F.posexplode(F.slice("all", 1, n - F.expr(f"(size(all) * {percent} + 99) div 100").cast("int") + 1)).alias("i", "t"))
    met = first.where("t.mixed").select("node", "label", "n", "i", F.col("t.s").alias("s"))
    x, y = (met.select("s", F.col("node").alias(p), F.col("label").alias(f"l{p}"), F.col("n").alias(f"m{p}"), F.col("i").alias(f"i{p}")) for p in "ab")
    near = x.join(y, "s").where(f"la <> lb AND a < b AND least(ma, mb) * 100 >= greatest(ma, mb) * {percent} AND least(ma - ia, mb - ib) * {100 + percent} >= (ma + mb) * {percent}")
    return near.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept`` (id = component_id).

    Two texts are linked if 100 * |A and B| >= percent * |A or B| for their sets of distinct ``width``-word shingles.
    Null, empty and white-space texts have no set and are linked with nothing; a row whose id is null is linked with
    nothing, its component is null and it is kept; very long texts are read whole; repeated rows are returned each, ties go to the smallest id; an empty
    table gives no rows. Other columns are not read.
    """
    signed = materialize(signatures(docs, width, id_col, text_col))
    own = F.col("id").isNotNull() & (F.col("n") > 0)
    nodes = materialize(
        signed.where(own).groupBy("f1", "f2").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "planes", "bands")))
        .withColumn("node", F.monotonically_increasing_id())
    )
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    buckets = materialize(spread.join(shared, "bucket").select("bucket", "node", "members"))
    involved = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    facts = materialize(nodes.select("node", "first_id", "f1", "f2", "n", "planes").join(involved, "node"))
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = semi_join_ids(whole, facts.select(F.col("first_id").alias("id")).distinct(), "id")
    sets = materialize(
        shingle_sets(texts, width, "id", "text").join(facts.select("f1", "f2", F.col("first_id").alias("id"), "node"), ["f1", "f2", "id"])
        .select("node", "shingles").dropDuplicates(["node"])
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        side = lambda x: facts.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("planes").alias(f"p{x}"))
        likely = (
            pairs.distinct().join(side("b"), "b").join(side("a"), "a")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            .where(similarity() >= floor_of(percent / 100)).select("a", "b", "na", "nb")
        )
        both = likely.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        both = both.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        met = both.withColumn("met", F.size(F.array_intersect("sa", "sb")))
        return met.where(F.col("met") * 100 >= (F.col("na") + F.col("nb") - F.col("met")) * percent).select("a", "b")

    labels, found = None, None
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            named = buckets.join(facts.select("node", "weight"), "node").select("bucket", "node", "weight", F.col("node").alias("label"))
        else:
            named = buckets.join(labels, "node", "left").select("bucket", "node", F.lit(0).alias("weight"), F.coalesce("label", "node").alias("label"))
        open_ = named.groupBy("bucket").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.max_by(F.struct("node", "label"), F.struct("weight", F.xxhash64("node", F.lit(turn)))).alias("hub")
        ).where("lo < hi").select("bucket", "hub")
        if found is not None:
            open_ = materialize(open_)
            if open_.isEmpty():
                break
        if turn < STAR_ROUNDS:
            pairs = named.join(open_, "bucket").where("label <> hub.label").select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
        else:  # what is still apart within a bucket
            apart = named.join(open_.select("bucket"), "bucket", "left_semi").select("node", "label").distinct()
            pairs = prefix_pairs(sets.join(apart, "node"), percent)
        new = confirmed(pairs)
        links = materialize(new if found is None else new.union(found))
        if found is not None:
            drop_table(found)
        found = links
        labels = materialize(components(links))
    heads = labels.join(facts.select("node", "first_id"), "node").groupBy("label").agg(F.min("first_id").alias("component_id"))
    grouped = labels.join(heads, "label").join(facts.select("node", "f1", "f2"), "node").select("f1", "f2", "component_id")
    firsts = nodes.select("f1", "f2", "first_id", "copies").join(grouped, ["f1", "f2"], "left").select("f1", "f2", "copies", F.coalesce("component_id", "first_id").alias("component_id"))
    # groups with a thousandth of all rows, fewer than a thousand, are answered by broadcast; no key of the other join is hot
    hot = F.col("copies") > F.lit(nodes.agg(F.sum("copies")).first()[0] or 0) / HOT_GROUPS
    firsts = materialize(firsts.withColumn("hot", hot).drop("copies"))
    rows = signed.select("id", "n", "f1", "f2")
    known = F.broadcast(firsts.where("hot").select("f1", "f2", F.col("component_id").alias("c")))
    large = rows.join(known, ["f1", "f2"]).withColumnRenamed("c", "component_id")
    small = rows.join(known, ["f1", "f2"], "left_anti").join(firsts.where("NOT hot").drop("hot"), ["f1", "f2"], "left")
    out = large.unionByName(small)
    out = out.withColumn("component_id", F.when(own, F.col("component_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
