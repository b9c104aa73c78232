"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, units and names become typed placeholders that remember their value; windows of the remaining template are hashed
and joined with the benchmark's. Matches are judged by occurrence, so that a second version of an item or a template that
repeats in itself doesn't spoil the first: an item counts as found in a document if in one occurrence enough of its windows or
words are there, or one long run of them, and its placeholders are consistent: one value of the item always stands for one
value of the document, as in a question that was only re-parameterised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattik.llm.common import materialize, semi_join_ids

#: Words in a window; shorter items are one window.
WIDTH = 8
#: Percentage of an item's windows that a document must hold; or of its words, if ``RUN`` of them are matched at least.
SHARE = 40
#: Matched words in one run that are enough by themselves, if ``WIDTH`` of them at least are the same (not only of one kind).
RUN = 13
#: Percentage of an item's slots that must be consistent.
CONSISTENT = 90
#: Window rows of the benchmark up to which they are broadcast; more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000
UNITS = (
    "%", "°c", "°f", "kg", "mg", "g", "lb", "lbs", "oz", "km", "cm", "mm", "m", "mi", "ft", "mph", "kmh", "ml", "l", "s", "ms", "min", "mins", "h", "hr", "hrs",
    "meters", "metres", "kilometers", "kilometres", "miles", "feet", "inches", "grams", "kilograms", "pounds", "ounces", "liters", "litres", "seconds",
    "minutes", "hours", "days", "weeks", "months", "years", "dollars", "cents", "euros", "percent", "degrees", "watts", "volts",
)
MARK = "\x01"
#: Capitalised words that are no names: those that begin sentences and questions (fixed values).
COMMON = (
    "a", "about", "after", "all", "an", "and", "are", "as", "at", "before", "but", "by", "can", "did", "do", "does", "each", "every", "find", "first", "for", "from",
    "given", "had", "has", "have", "he", "her", "his", "how", "if", "in", "is", "it", "its", "let", "many", "most", "much", "no", "not", "now", "of", "on", "one", "or",
    "our", "she", "so", "some", "that", "the", "their", "then", "there", "these", "they", "this", "those", "to", "two", "was", "we", "were", "what", "when", "where",
    "which", "while", "who", "whose", "why", "will", "with", "you", "your",
)
#: A name: any other capitalised word, wherever it stands.
_NAME = r"(?<![\p{L}\p{N}])(?!(?:" + "|".join(w.capitalize() for w in COMMON) + r")(?!\p{L}))(\p{Lu}\p{Ll}+)(?!\p{L})"
#: Possessive, so that Java's matcher doesn't recurse on long runs of digits and dots.
_NUMBER = r"(\d++(?:[.,]\d++)*+)(?:\s?(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}]))?"
_TOKEN = MARK + r"[a-z]+:[^ \x01]*|[\p{L}\p{N}]+"


def tokens(text: Column, names: bool = True) -> Column:
    """Lower-cased words; a slot is ``\\x01kind:value``, and each number has a unit slot behind it, maybe of empty value.

    Without ``names`` these are words like others, as in a copy that is all in lower case.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), MARK, "")
    named = F.lower(F.regexp_replace(plain, _NAME, f" {MARK}name:$1") if names else plain)
    return F.regexp_extract_all(F.regexp_replace(named, _NUMBER, f" {MARK}num:$1 {MARK}unit:$2 "), F.lit(_TOKEN), F.lit(0))


def template(token: Column) -> Column:
    return F.when(token.startswith(MARK), F.substring_index(token, ":", 1)).otherwise(token)


def _counts(token: Column) -> Column:
    """Whether a token stands for a word; the unit slot of a number without unit doesn't."""
    return ~token.endswith(":")


def _windows(words: Column, width: int) -> Column:
    """Hashes of the windows of ``width`` words, in order; none for fewer words."""
    from lattik.llm.quality import let

    def of(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(F.lit(width), *(F.get(h, i + k) for k in range(width))))

    hashed = F.transform(words, lambda w: F.xxhash64(template(w)))
    return F.when(F.size(words) < width, F.array().cast("array<bigint>")).otherwise(let(hashed, of))


def _occurrences(pairs: DataFrame) -> DataFrame:
    """The matched word pairs (``id``, ``row``, ``item``, ``p``, ``q``, ``a``, ``b``, ``starts``) once for each group ``g`` that they are judged in.

    Groups are a run and a diagonal p - q of a row, a chain (words in the item's order, of each word of the row the match in the longest
    run), the matches that are equal word for word, and all matches of the document.
    """
    at = ["id", "row", "item"]
    by_run = Window.partitionBy(*at, "d").orderBy("p")
    runs = pairs.withColumn("d", F.col("p") - F.col("q")).withColumn("run", F.col("p") - F.row_number().over(by_run))
    runs = runs.withColumn("long", F.count("*").over(Window.partitionBy(*at, "d", "run")))
    best = F.row_number().over(Window.partitionBy(*at, "p").orderBy(F.desc("long"), "q")) == 1
    runs = runs.withColumn("best", best)
    back = F.coalesce(F.col("q") <= F.lag("q").over(Window.partitionBy(*at, "best").orderBy("p")), F.lit(False))
    runs = runs.withColumn("chain", F.sum(back.cast("int")).over(Window.partitionBy(*at, "best").orderBy("p")))

    def group(kind: str, *keys: str) -> Column:
        filled = [F.col(k).cast("bigint") for k in keys] + [F.lit(0).cast("bigint")] * (3 - len(keys))
        return F.struct(F.lit(kind).alias("kind"), filled[0].alias("x"), filled[1].alias("y"), filled[2].alias("z"))

    groups = [group("all"), group("diagonal", "row", "d"), F.when(F.col("long") >= RUN, group("run", "row", "d", "run")), F.when(F.col("best"), group("chain", "row", "chain")), F.when(F.col("exact"), group("exact"))]
    return runs.select("id", "item", "q", "a", "b", "starts", F.explode(F.array_compact(F.array(*groups))).alias("g"))


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id_col``, ``item_col``, ``n_windows`` (of the item), ``n_matched``, ``n_slots``, ``n_consistent``: items found in documents.

    The last three are those of the accepted group of matches (see ``_occurrences``) with most windows. Null and empty texts
    and items match nothing, nor do null ids. Rows of equal id count as one document; of rows of equal item each text is looked
    for (with its names as slots and as words), and the best found one is given; ties go to the one with more consistent slots.
    Very long texts are read whole. An empty table on either side gives no rows; other columns are not read.
    """
    forms = [benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("own"), tokens(F.col(item_text), names).alias("iw")) for names in (True, False)]
    worded = forms[0].unionByName(forms[1]).where(F.size("iw") > 0).distinct()
    words = F.size(F.filter("iw", _counts)).alias("n_words")
    items = materialize(worded.select("own", "iw", F.xxhash64("own", F.array_join("iw", " ")).alias("item"), F.least(F.size("iw"), F.lit(WIDTH)).alias("width"), words))
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # at most WIDTH rows
    if not widths:
        widths = [WIDTH]
    windows = None
    for width in widths:
        part = items.where(F.col("width") == width).select("item", F.posexplode(_windows(F.col("iw"), width)).alias("q", "hash"))
        windows = part if windows is None else windows.unionByName(part)
    windows = materialize(windows.distinct())
    small = windows.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    hint = F.broadcast if small else lambda x: x
    size = items.select("item", "n_words", (F.size("iw") - F.col("width") + 1).alias("n_windows"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def spread(rows: DataFrame, keep: list[str]) -> DataFrame:
        worded = rows.withColumn("dw", tokens(F.col("text")))
        every = F.concat(*(_windows(F.col("dw"), w) for w in widths)) if len(widths) > 1 else _windows(F.col("dw"), widths[0])
        return worded.select("id", *keep, F.posexplode(every).alias("p", "hash"))

    hashes = windows.select("hash").distinct()
    hits = spread(texts, []).select("id", "hash").join(hint(hashes), "hash").distinct()
    counted = hits.join(hint(windows), "hash").groupBy("id", "item").agg(F.countDistinct("q").alias("n_seen"), (F.max("q") - F.min("q") + WIDTH).alias("span"))
    likely = materialize(counted.join(hint(size), "item").where(f"100 * n_seen >= {SHARE} * n_windows OR span >= {RUN}"))

    # pairs of an item's and a document's word in the matched windows of what is left, each once
    again = semi_join_ids(texts, likely.select("id").distinct(), "id").withColumn("dw", tokens(F.col("text")))
    found = None
    for width in widths:
        at = again.select("id", F.xxhash64("text").alias("row"), "dw", F.posexplode(_windows(F.col("dw"), width)).alias("p", "hash"))
        part = at.join(hint(windows), "hash").join(items.where(F.col("width") == width), "item").select(
            "id", "row", "item", "p", "q", F.slice("iw", F.col("q") + 1, width).alias("a"), F.slice("dw", F.col("p") + 1, width).alias("b")
        )
        found = part if found is None else found.unionByName(part)
    found = found.join(likely.select("id", "item"), ["id", "item"], "left_semi")
    found = found.select("id", "row", "item", "p", "q", (F.col("a") == F.col("b")).alias("exact"), F.posexplode(F.arrays_zip("a", "b")).alias("o", "z"))
    pairs = found.groupBy("id", "row", "item", (F.col("p") + F.col("o")).alias("p"), (F.col("q") + F.col("o")).alias("q")).agg(
        F.min("z.a").alias("a"), F.min("z.b").alias("b"), F.max(F.col("o") == 0).alias("starts"), F.max("exact").alias("exact")
    )
    words = _occurrences(pairs).groupBy("id", "item", "g", "q").agg(F.min("a").alias("a"), F.max("starts").alias("starts"), F.max((F.col("a") == F.col("b")) & _counts(F.col("a"))).alias("same"), F.min("b").alias("low"), F.max("b").alias("high"))
    values = words.groupBy("id", "item", "g", "a").agg(F.count_if("starts").alias("starts"), F.count_if(_counts(F.col("a"))).alias("held"), F.count_if("same").alias("same"), (F.min("low") == F.max("high")).alias("one"))
    slot = F.col("a").startswith(MARK)
    judged = values.groupBy("id", "item", "g").agg(F.sum("starts").alias("n_matched"), F.sum("held").alias("held"), F.sum("same").alias("same"), F.count_if(slot).alias("n_slots"), F.count_if(slot & F.col("one")).alias("n_consistent"))
    enough = f"100 * n_matched >= {SHARE} * n_windows OR held >= {RUN} AND same >= {WIDTH} AND (g.kind = 'run' OR 100 * held >= {SHARE} * n_words)"
    judged = judged.join(hint(size), "item").where(f"({enough}) AND 100 * n_consistent >= {CONSISTENT} * n_slots")
    figures = F.struct("n_matched", "n_consistent", "n_slots", "n_windows")
    out = judged.join(items.select("item", "own"), "item").groupBy("id", "own").agg(F.max(figures).alias("f"))
    return out.select(F.col("id").alias(id_col), F.col("own").alias(item_col), "f.n_windows", "f.n_matched", "f.n_slots", "f.n_consistent")
