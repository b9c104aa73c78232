"""The training-data operators against brute force, on small tables with nulls, empty and repeated rows and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lattik.llm import bpe, decontam, html_text, langid, minhash, quality, queries, sharding, toxicity, urlfilter, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    rows = [(i, t, "en", "a", None) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS).withColumn("id", F.lit("clash")).withColumn("score", F.lit("clash"))


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(rows, width, percent=80):
    sets, head = {i: shingles(t, width) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def near_texts(n=60, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts + [" ".join(f"y{rng.randrange(10**6)}" for _ in range(50)) for _ in range(10)]


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_finds_exactly_the_components(spark, width):
    texts = [*near_texts(), None, "", " \n\t", "Two words", "two WORDS", "one", near_texts()[0]]
    got = minhash.near_duplicates(docs_of(spark, texts), width=width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute_components(list(enumerate(texts)), width)


def test_minhash_null_ids_repeated_rows_and_empty_table(spark):
    docs = docs_of(spark, ["a b c d e", "a b c d e", "a b c d e", "q"], [None, 3, 3, 4])
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [(-1, None, True), (3, 3, True), (3, 3, True), (4, 4, True)]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_bit_planes_estimate_similarity(spark):
    a, b = " ".join(f"a{i}" for i in range(1000)), " ".join([*(f"a{i}" for i in range(900)), *(f"b{i}" for i in range(100))])
    rows = minhash.signatures(docs_of(spark, [a, b]), 4).collect()
    one = spark.createDataFrame([(rows[0]["planes"], rows[1]["planes"])], "pa array<long>, pb array<long>")
    assert abs(one.select(minhash.similarity()).first()[0] - 0.81) < 0.12


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = queries.VOCABULARY
    library = Tokenizer.from_file(path)
    rng = random.Random(2)
    pools = ["ab", " \n\t", "a'b's 12!", "éü日本", "<|endoftext|>x ", "😀 a", "1234567", "!?-"]
    texts = [None, "", "Hello world", "a" * 5000, " " * 3000] + ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(2000))) for _ in range(60)]
    texts += [rng.choice(pools) * 300 for _ in range(20)]
    got = {r["doc_id"]: r for r in bpe.encode(docs_of(spark, texts), path, leaf=200).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    again = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs_of(spark, texts), path), path).collect()}
    assert again == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.encode(docs_of(spark, texts).limit(0), path).collect() == []


def test_bpe_joins_without_encoding_all_again():
    codec = bpe.Codec(queries.VOCABULARY, leaf=1000)
    text, sizes, raw = "".join(random.Random(4).choice("abcdefgh") for _ in range(64_000)), [], codec.raw
    codec.raw = lambda t: (sizes.append(len(t)), raw(t))[1]
    assert codec.encode(text) == raw(text)
    assert max(sizes) <= 4000


def test_language_words_first_then_shorter_ngrams(spark):
    rows = [(i, t, lang, "s", None) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(99, "no language", None, None, None), (None, "the", "de", None, None)]
    model = langid.train(spark.createDataFrame(rows, DOCS))
    assert model.languages == ["de", "en"]
    asked = ["the and", "und die", "hundes katzen", "cats dogs", None, "", "12 34!", "the and", "ж"]
    got = {r["doc_id"]: r for r in langid.identify(docs_of(spark, asked), model).collect()}
    assert [got[i]["lang_pred"] for i in range(8)] == ["en", "de", "de", "en", "und", "und", "und", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[8]["lang_pred"] == "de"
    nothing = langid.train(spark.createDataFrame([], DOCS))
    assert [r["lang_pred"] for r in langid.identify(docs_of(spark, ["a"]), nothing).collect()] == ["und"]
    assert langid.keep(docs_of(spark, asked), model, 0.5).columns == docs_of(spark, asked).columns


def test_language_on_held_out_documents(spark):
    got = queries.op4_langid(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got.collect())


def test_toxicity_on_planted_words(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 4)))
    bad = ["scoundrel", "villainous", "despicable"]
    texts, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        if i % 5 == 0:
            words[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append((i, int(i % 5 == 0)))
    docs = docs_of(spark, [*texts, None, "", "!!"])
    marked = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marked.where("doc_id % 2 = 0"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(got[i]["predicted"], y) for i, y in labels if i % 2]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    assert [got[i]["predicted"] for i in (400, 401, 402)] == [0, 0, 0]
    plain = toxicity.train(docs, marked.limit(0))
    assert toxicity.keep(docs, plain).count() == docs.count()


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(6)
    sentence = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n))
    texts = [sentence(120) for _ in range(200)] + ["*** " + sentence(100).replace(" ", " ### ") for _ in range(20)] + ["same words again " * 60, "x\nx\n\nx y\n " + sentence(60), None, "", " \n ", "a b"]
    got = {r["doc_id"]: r for r in quality.judge(docs_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        w = (text or "").replace("\x0b", " ").split()
        windows = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        repeated = {k for j in range(len(w) - 2) if windows[tuple(w[j : j + 3])] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in (text or "").split("\n") if x.split()]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert got[i]["base_failed"] == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
    assert all(got[i]["kept"] for i in range(200)) and not any(got[i]["kept"] for i in [*range(200, 221), 222, 223, 224, 225])
    assert quality.judge(docs_of(spark, texts).limit(0)).collect() == []


def planted_votes(rng, n, chances, prior):
    rows = Counter()
    for _ in range(n):
        kind = "good" if rng.random() < prior else "bad"
        rows[tuple(1 if (x := rng.random()) < chances[r][kind][0] else -1 if x < sum(chances[r][kind]) else 0 for r in chances)] += 1
    return rows


def test_quality_recovers_planted_accuracies_and_weighs_votes(spark):
    chances = {"a": {"good": (0.9, 0.02), "bad": (0.1, 0.8)}, "b": {"good": (0.7, 0.1), "bad": (0.3, 0.6)}, "c": {"good": (0.8, 0.05), "bad": (0.05, 0.15)}, "d": {"good": (0.4, 0.4), "bad": (0.35, 0.45)}, "e": {"good": (0.85, 0.05), "bad": (0.1, 0.75)}}
    rows = planted_votes(random.Random(8), 20_000, chances, 0.8)
    table = spark.createDataFrame([(*k, n) for k, n in rows.items()], "a int, b int, c int, d int, e int, n long")
    prior, found = quality.estimate(table, tuple("abcde"))
    assert abs(prior - 0.8) < 0.03
    for name, of in chances.items():
        for kind in of:
            assert all(abs(x - y) < 0.05 for x, y in zip(found[name][kind], of[kind])), (name, kind, found[name])
    p = {tuple(r[:5]): r["p"] for r in table.withColumn("p", quality.posterior(prior, found)).drop("n").collect()}
    assert p[1, 1, 1, -1, 1] > 0.9  # a bad vote of a rule that says nothing
    quiet = [v for k, v in p.items() if -1 not in k and k[0] == 0 and k[2] == 0 and k[4] == 0]
    assert quiet and min(quiet) < 0.5  # telling rules abstain

    def brute(k):
        on = {kind: (prior if kind == "good" else 1 - prior) for kind in ("good", "bad")}
        for name, v in zip("abcde", k):
            for kind in on:
                up, down = found[name][kind]
                on[kind] *= up if v == 1 else down if v == -1 else 1 - up - down
        return on["good"] / sum(on.values())

    assert all(abs(brute(k) - v) < 1e-9 for k, v in p.items())


@pytest.mark.parametrize("n", [0, 5, 100])
def test_sharding_equals_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(i if i % 7 or n == 100 else None, None if i % 9 == 0 else "é" * rng.randrange(20), "en", None if i % 11 == 0 else f"s{int(rng.random() ** 3 * 4)}", None) for i in range(n)]
    sharding.BUCKET_ROWS, kept = 10, sharding.BUCKET_ROWS
    try:
        got = sharding.assign(spark.createDataFrame(rows, DOCS), 6).collect()
    finally:
        sharding.BUCKET_ROWS = kept
    counts = Counter(r["shard"] for r in got)
    assert len(got) == n and all(0 <= s < 6 for s in counts) and max(counts.values(), default=0) - min((counts.get(s, 0) for s in range(6)), default=0) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    if n == 100:
        source = {i: s for i, _, _, s, _ in rows}
        for s in set(source.values()):
            share = Counter(r["shard"] for r in got if source[r["doc_id"]] == s)
            assert max(share.values()) - min(share.get(k, 0) for k in range(6)) <= 3


def test_decontamination_verbatim_and_reparameterised(spark):
    item = "On Monday the farmer Anna sold 12 kg of apples to Peter for 30 dollars, and then Anna bought 5 kg of pears from Maria with 12 dollars left."
    moved = "On Monday the farmer Clara sold 17 kg of apples to John for 44 dollars, and then Clara bought 9 kg of pears from Susan with 17 dollars left."
    mixed = "On Monday the farmer Clara sold 17 kg of apples to John for 44 dollars, and then Frank bought 9 kg of pears from Susan with 99 dollars left."
    texts = [f"intro words here. {item} more words follow", f"other. {moved} end", f"other. {mixed} end", "nothing to see here at all today", None, "", item]
    bench = spark.createDataFrame([(1, item), (2, "short one"), (3, None), (4, "")], "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find(docs_of(spark, texts), bench).collect()}
    assert got == {(0, 1), (1, 1), (6, 1)}
    assert decontam.find(docs_of(spark, texts), bench.limit(0)).collect() == [] == decontam.find(docs_of(spark, texts).limit(0), bench).collect()


def test_decontamination_judges_each_occurrence(spark):
    series = "Which number comes next in the series 3, 6, 9, 12, 15, 18, 21 that the teacher wrote on the board"
    sold = "On Monday the farmer Anna sold 12 kg of apples to Peter for 30 dollars, and then Anna bought 5 kg of pears from Maria with 12 dollars left."
    first = "On Monday the farmer Clara sold 17 kg of apples to John for 44 dollars, and then Clara bought 9 kg of pears from Susan with 17 dollars left."
    second = "On Monday the farmer Emma sold 21 kg of apples to Paul for 50 dollars, and then Emma bought 8 kg of pears from Laura with 21 dollars left."
    wider = [t.replace("and then", "and then very much later") for t in (first, second)]
    mixed = "On Monday the farmer Clara sold 17 kg of apples to John for 44 dollars, and then Frank bought 9 kg of pears from Susan with 99 dollars left."
    texts = [f"Intro. {series}. More.", f"Sheet. {sold} {first}", f"Sheet. {first} {second}", f"Sheet. {wider[0]} {wider[1]}", f"No. {mixed}", f"Same id. {first}", f"Same id. {second}", f"{mixed} {sold}"]
    bench = spark.createDataFrame([(1, series), (2, sold), (3, sold), (3, "another text of the same item that is nowhere to be seen")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find(docs_of(spark, texts, [0, 1, 2, 3, 4, 5, 5, 7]), bench).collect()}
    assert got == {(0, 1)} | {(i, k) for i in (1, 2, 3, 5, 7) for k in (2, 3)}


def test_decontamination_finds_parts_edits_and_short_items(spark):
    long = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    mid = long[:35]
    edited = [f"changed{chr(97 + i // 9)}" if i % 9 == 0 else w for i, w in enumerate(mid)]
    short = "What is the capital city of France?"
    counts = "How much is the sum of 3, 6, 9, 12, 15, 18, 21, 24, 27, 30, 33, 36, 39, 42, 45, 48, 51, 54, 57, 60"
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(mid)), (3, short), (4, counts)], "item_id long, text string")
    texts = [
        "before " + " ".join(long[40:53]) + " after", "before " + " ".join(long[40:52]) + " after", "before " + " ".join(mid[:17]) + " after", " ".join(edited),
        f"Please answer {short}", f"First, {short}", short, "Please answer Who is the capital city of France?", "Scores: 7, 1, 5, 9, 2, 8, 4, 6",
    ]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find(docs_of(spark, texts), bench).collect()}
    assert got == {(0, 1), (2, 1), (2, 2), (3, 1), (3, 2), (4, 3), (5, 3), (6, 3)}


def test_decontamination_lower_case_sentence_names_and_long_runs(spark):
    item = "Anna sold 12 kg of apples to Peter for 30 dollars. Peter sold 7 kg of them to Maria, and Anna paid Maria with 12 dollars."
    moved = "Clara sold 17 kg of apples to John for 44 dollars. John sold 9 kg of them to Susan, and Clara paid Susan with 17 dollars."
    mixed = "Clara sold 17 kg of apples to John for 44 dollars. Susan sold 9 kg of them to John, and Emma paid Frank with 99 dollars."
    series = "Continue the series 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 and name the rule"
    texts = [item.lower(), f"Before. {moved} After.", f"Before. {mixed} After.", f"See: {series}.", "1." * 200_000 + "1", "9" * 300_000, item]
    bench = spark.createDataFrame([(1, item), (2, series)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find(docs_of(spark, texts, [0, 1, 2, 3, 4, 5, None]), bench).collect()}
    assert got == {(0, 1), (1, 1), (3, 2)}


def test_decontamination_finds_the_planted_passages(spark):
    sf = "/root/testdata/sf0.01"
    import re

    flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    docs = [(r["doc_id"], flat(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], flat(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {(r["doc_id"], r["item_id"]) for r in queries.op8_decontam(spark, sf).collect()} == {(i, k) for i, t in docs for k, x in items if x in t}


PAGE = """<html><head><title>A &amp; B</title><style>p{}</style></head><body><p>One<p>Two <b>bo</b>ld<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>
<table><tr><td>aa<td>b<tr><td>c<td>dddd</table><div hidden>no</div><div style="display: none">no</div><script>var t="</p>";</script><pre>  k
   l</pre>tail<br>end"""


def test_html_layout(spark):
    want = "One\n\nTwo bold\n\n- a\n- b\n  3. x\n  4. y\n\naa | b\nc  | dddd\n\n  k\n   l\n\ntail\nend"
    assert html_text.extract_text(PAGE) == want
    rows = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "plain < text"), (5, "<div>" * 3000 + "deep"), (5, "<p")], "page_id long, html string").withColumn("text", F.lit(1))
    got = [(r["page_id"], r["title"], r["text"], r["n_lines"]) for r in html_text.extract(rows).orderBy("page_id", "text").collect()]
    assert got[:4] == [(1, "A & B", want, want.count("\n") + 1), (2, None, "", 0), (3, None, "", 0), (4, None, "plain < text", 1)]
    assert ("deep" in got[5][2]) or ("deep" in got[4][2])


def test_html_spans_visibility_and_depth():
    text = html_text.extract_text
    assert text("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a | b\n  | c\nd | e"
    assert text("<table><tr><td>x<td rowspan=2 colspan=2>yy<tr><td>z<tr><td>1<td>2<td>3</table>") == "x | yy |\nz |    |\n1 | 2  | 3"
    assert text("<div style='visibility:hidden'>no <span style='visibility: visible'>yes</span> no</div>") == "yes"
    assert text("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> <svg><title>t</title><text>label</text></svg>") == "x=1 label"
    assert text("<select><option>a<option selected>b<option>c</select>") == "b" and text("<select multiple><option>a<option>b</select>") == "a\nb"
    assert text("<div><div>a</div>b</div>c") == "a\nb\nc" and text("<b><b>a</b>b</b>c") == "abc"
    assert text("<div>" * 200_000 + "x" + "<p hidden>no</p>" + "</div>" * 200_000 + "y") == "x\ny"
    assert text("<i><u>" * 3_000 + "x<s hidden>no</s>" + "</u></i>" * 3_000 + "y") == "xy"


def test_html_head_without_end_tag():
    text = html_text.extract_text
    assert text("<html><head><title>T</title><body><p>Hello") == "Hello"
    assert text("<head><meta charset=utf-8><style>p{}</style><noscript><p>no</noscript><script>x</script><p>One<p>Two") == "One\n\nTwo"
    assert text("<html><head>\n<title>T</title>\nbare text<title>U</title></head><p>end") == "bare text\n\nend"
    assert text("<html><head><title>T</title></head><body>as before</body></html>") == "as before"


def test_warc_round_trip_and_audit(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").unionByName(spark.createDataFrame([(None, None, None), (1, "http://x/\r\n", "")], "page_id long, url string, html string"))
    first = warc.write(pages, f"file://{tmp_path}/w")
    read = warc.read(spark, f"file://{tmp_path}/w").cache()
    key = ["name", "key", "file", "seq", "offset", "length", "sha256"]
    assert sorted(map(tuple, first.select(*key).collect())) == sorted(map(tuple, read.select(*key).collect()))
    assert warc.root(warc.tree(first, 2)) == warc.root(warc.tree(read, 2)) and warc.compare(first, read).isEmpty()
    ids = sorted(r["name"] for r in read.select("name").distinct().collect())
    lost, bad, new = ids[3], ids[10], ids[-1]
    other = pages.where(~(warc.name_of("page_id", "url") == lost)).withColumn("html", F.when(warc.name_of("page_id", "url") == bad, F.concat(F.lit("x"), F.coalesce("html", F.lit("")))).otherwise(F.col("html")))
    warc.write(other, f"file://{tmp_path}/v", 1)
    found = warc.compare(first.where(F.col("name") != new), warc.read(spark, f"file://{tmp_path}/v")).collect()
    assert sorted((r["name"], r["status"]) for r in found) == sorted([(lost, "missing"), (bad, "corrupt"), (new, "extra")])
    got = {r["name"]: r["status"] for r in warc.audit(first, warc.read(spark, f"file://{tmp_path}/v")).collect()}
    assert {k: v for k, v in got.items() if v != "ok"} == {lost: "missing", bad: "corrupt"} and len(got) == len(ids)
    assert warc.audit(first.limit(0), first.limit(0)).collect() == []
    assert {r["status"] for r in warc.audit(first, first.limit(0)).collect()} == {"missing"}


def test_url_rules_and_trees(spark):
    urls = ["http://a.org/x", "HTTPS://B.ORG/y?u=http://z", "http://www.example.org/es/1", "http://example.org/en/12", "http://com/fr/", "http://x.com/de/1", "http://org", "nothing", None, "", "http://xorg/a", "http://example.org/en/2"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    seen = [(f"http://good{i}.net/en/{i}", 0) for i in range(80)] + [(f"http://win-big-casino{i}.net/p?a=1&b=2&c={i}", 1) for i in range(80)]
    model = urlfilter.train(spark.createDataFrame([*seen, (None, 1)], "url string, blocked int"))
    got = {r["page_id"]: r for r in urlfilter.judge(pages, model, queries.URL_RULES).collect()}
    assert [got[i]["rule"] for i in range(12)] == ["org/", "org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/", None, None, None, None, None, "org/"]
    assert (got[1]["host"], got[1]["path"]) == ("b.org", "/y") and (got[7]["host"], got[8]["host"], got[8]["path"]) == ("", "", "")
    assert [got[i]["verdict"] for i in range(6)] == ["allow", "allow", "block", "block", "allow", "block"]
    p = model.probability(["http://good99.net/en/99", "http://win-big-casino99.net/p?a=1&b=2&c=9"])
    assert p[0] < 0.5 < p[1]
    assert urlfilter.fit([], []).probability(["http://x/"])[0] < 0.5


def test_pipeline_stages_on_small_tables(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.decontaminated(spark, docs, "/root/testdata/sf0.01")
    leaks = {r["doc_id"] for r in queries.op8_decontam(spark, "/root/testdata/sf0.01").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - leaks and kept.columns == docs.columns
    some = docs.where("doc_id < 150")
    alone = corpus_pipeline.deduplicated(spark, some, "")
    want = brute_components([(r["doc_id"], r["text"]) for r in some.collect()], 5)
    assert {r["doc_id"] for r in alone.collect()} == {i for i, (_, _, k) in want.items() if k}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").collect() == []
