"""Quality rules by weak supervision, in DataFrame functions only.

Eight rules look at a text's statistics and vote good (1), bad (-1) or abstain (0). They overlap: junk of one kind moves several
statistics at once (symbols between words also lengthen or shorten words, and break the ends of lines). That overlap is what
expectation-maximisation over the table of vote patterns (at most 3^8 rows, whatever the corpus) learns each rule's accuracies
from: how often it votes either way on good and on bad texts. It begins with the share of good votes and has no bound on any
accuracy. The posterior probability that a text is good replaces a filter that all rules must pass: a bad vote of a rule that
turns out to say little doesn't reject a text, and abstentions of telling rules may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattik.llm.common import materialize

#: White space between words (a regular expression's class and its characters; fixed values).
GAP, GAP_CHARS = r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bits of a window key that hold its position; the others hold its hash. Strings of 2 GB have fewer words.
PLACE = 30
#: Rounds of expectation-maximisation, and the change of the prior that ends it.
ROUNDS, STILL = 40, 1e-5
#: Votes of each kind that every rule is taken to have cast besides (no chance is then 0).
SMOOTH = 0.5
KEEP = 0.5
#: Characters at which lines end that are sentences or headings, and those that plain prose is made of.
LINE_ENDS = ".!?:;,\"'”»)"
PROSE = r"[\p{L}\p{M}\p{N}\s.,;:?'’\"“”«»()¿¡-]+"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that are found twice or more among ``words``.

    Windows' hashes are sorted together with their places, as longs; those whose hash has an equal neighbour go through the
    same again with other bits of the hash. What remains covers three words each, less overlaps.
    """
    low = (1 << PLACE) - 1

    def keyed(hashes: Column, places: Column, salt: int) -> Column:
        key = lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2), F.lit(salt))
        return F.sort_array(F.transform(places, lambda i: key(i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint"))))

    def same(a: Column, b: Column) -> Column:
        return F.shiftright(a, PLACE).eqNullSafe(F.shiftright(b, PLACE))

    def twice(keys: Column) -> Column:
        kept = let(keys, lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))))
        return F.transform(kept, lambda x: x.bitwiseAND(F.lit(low)).cast("int"))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def of(hashes: Column) -> Column:
        first = twice(keyed(hashes, F.sequence(F.lit(0), F.size(hashes) - 3), 1))
        return let(first, lambda f: F.when(F.size(f) == 0, F.lit(0).cast("bigint")).otherwise(let(F.sort_array(twice(keyed(hashes, f, 2))), covered)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(let(hashed, of))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the texts' counts; a null text has none of anything."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(GAP_CHARS))
    split = docs.select(
        F.col(id_col).alias("id"), text.alias("text"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP)).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != "").alias("lines"),
    )
    bare = F.array_join("words", "")
    return split.select(
        "id", F.size("words").cast("bigint").alias("n_words"), F.char_length(bare).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("bigint").alias("n_upper"),
        F.char_length(F.regexp_replace("text", PROSE, "")).cast("bigint").alias("n_odd"),
        F.size(F.filter("lines", lambda x: F.lit(LINE_ENDS).contains(F.substring(F.btrim(x, F.lit(GAP_CHARS)), -1, 1)))).cast("bigint").alias("n_ended"),
    )


def _vote(good: str, bad: str) -> Column:
    return F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")


#: Name, condition of a good vote, condition of a bad one (which goes first).
RULES = (
    ("length", "n_words >= 80", "n_words < 60"),
    ("word_length", "10 * word_chars BETWEEN 45 * n_words AND 65 * n_words", "10 * word_chars > 75 * n_words OR 10 * word_chars < 43 * n_words"),
    ("symbols", "100 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    ("odd", "100 * n_odd <= 2 * n_words", "10 * n_odd > n_words"),
    ("ends", "100 * n_ended >= 98 * n_lines", "100 * n_ended < 92 * n_lines"),
    ("lines", "100 * n_dup_lines <= 5 * n_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("repeats", "100 * n_repeat_words <= 5 * n_words", "100 * n_repeat_words > 25 * n_words"),
    ("shouting", "100 * n_upper <= 8 * word_chars", "100 * n_upper > 30 * word_chars"),
)
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def posterior(prior: float, chances: dict[str, dict[str, tuple[float, float]]]) -> Column:
    """Probability that a text is good, from its votes; ``chances``: of a good and of a bad vote by rule, on good and bad texts."""
    sides = {"good": F.lit(prior), "bad": F.lit(1 - prior)}
    for name, on in chances.items():
        v = F.col(name)
        for kind, (up, down) in on.items():
            sides[kind] = sides[kind] * F.when(v == 1, up).when(v == -1, down).otherwise(1 - up - down)
    return sides["good"] / (sides["good"] + sides["bad"])


def estimate(patterns: DataFrame, names: tuple[str, ...] = tuple(name for name, _, _ in RULES)) -> tuple[float, dict[str, dict[str, tuple[float, float]]]]:
    """Prior and each rule's chances by expectation-maximisation, from vote patterns with their ``n``.

    One row of sums comes back each round. Good is the class that the share of good votes in a pattern begins with; if the
    rules' good votes turn out to be rarer there than in the other class, the two are exchanged.
    """
    votes = [F.col(name) for name in names]
    up, down = (sum(((v == x).cast("int") for v in votes), F.lit(0)) for x in (1, -1))
    p, prior, chances = (up + 1) / (up + down + 2.0), 0.5, {name: {"good": (1 / 3, 1 / 3), "bad": (1 / 3, 1 / 3)} for name in names}
    for _ in range(ROUNDS):
        weights = {"good": F.col("p"), "bad": 1 - F.col("p")}
        sums = [F.sum(F.col("n") * w).alias(kind) for kind, w in weights.items()]
        for name in names:
            for kind, w in weights.items():
                for vote, tag in ((1, "up"), (-1, "down")):
                    sums.append(F.sum(F.when(F.col(name) == vote, F.col("n") * w).otherwise(0.0)).alias(f"{name}_{kind}_{tag}"))
        row = patterns.withColumn("p", p).agg(*sums).first()
        if row["good"] is None:
            break
        before, prior = prior, (row["good"] + SMOOTH) / (row["good"] + row["bad"] + 2 * SMOOTH)
        chances = {
            name: {kind: tuple((row[f"{name}_{kind}_{tag}"] + SMOOTH) / (row[kind] + 3 * SMOOTH) for tag in ("up", "down")) for kind in weights}
            for name in names
        }
        p = posterior(prior, chances)
        if abs(prior - before) < STILL:
            break
    if sum(of["good"][0] - of["good"][1] - of["bad"][0] + of["bad"][1] for of in chances.values()) < 0:
        prior, chances = 1 - prior, {name: {"good": of["bad"], "bad": of["good"]} for name, of in chances.items()}
    return prior, chances


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``p_good`` (posterior) and ``kept`` for each whole text.

    Null and empty texts have no words and fail the base rule; accuracies are estimated from all texts that pass it. Repeated
    rows are judged (and counted) each; very long texts are read whole; an empty table gives no rows; other columns are not
    read.
    """
    counted = statistics(docs, id_col, text_col)
    voted = materialize(counted.select("*", *(_vote(good, bad).alias(name) for name, good, bad in RULES)))
    names = [name for name, _, _ in RULES]
    patterns = materialize(voted.where(f"NOT ({BASE_FAILED})").groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    prior, chances = estimate(patterns)
    out = voted.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("p_good", posterior(prior, chances))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
