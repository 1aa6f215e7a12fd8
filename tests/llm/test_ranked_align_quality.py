"""Quality rules, ranked search and tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from postlake.llm import align, quality, ranked

DOCS = "doc_id long, text string, lang string"
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


TEXTS = [None, "", " \t\n", "one", "a b c a b c", "x x x x x", "a\n\na\n \nb", "😀 🎉 # * $\x0b%", "w " * 5000, "\n".join(["same line here"] * 40), "A1,b2;C3!" * 30, "é è Ä ß # | <>", "p q r s p q r", "a b c d e f g h " * 3]


def test_counts_of_texts(spark):
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(TEXTS)], DOCS)
    got = {r["doc_id"]: r["measures"] for r in quality.measure(rows.withColumn("Measures", F.lit(1))).collect()}
    for i, t in enumerate(TEXTS):
        m = got[i]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == plain_counts(t), t
        assert m["n_marks"] == len(re.findall(r"[!-/:-@\[-`{-~]", t or "")) and m["n_capitals"] == len(re.findall("[A-Z]", t or "")) and m["n_digits"] == len(re.findall("[0-9]", t or ""))


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.05), (200, 3, 0.05), (1000, 50, 0.05), (5000, 120, 0.05), (60, 1, 0.2)])
def test_binomial_tail(spark, n, k, p):
    want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n < 1000 else math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    row = spark.range(1).select(F.lit(k).cast("long").alias("k"), F.lit(n).cast("long").alias("n")).select(quality._at_most(F.col("k"), F.col("n"), p).alias("x")).first()
    assert row["x"] == pytest.approx(want, rel=1e-9)


def labelled(spark, n=1600, noise=0.0, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.25
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(80)]
        if bad:
            words = [w + "%%%" for w in words]
        elif rng.random() < noise:
            words = [w + "#" for w in words]
        docs.append((i, " ".join(words), "xx" if i % 2 else None))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_part_good_from_bad(spark):
    docs, labels = labelled(spark)
    measured = quality.measure(docs)
    cutoffs = quality.fit(measured, labels)
    assert {r["stratum"] for r in cutoffs.collect()} == {"xx", ""}
    got = quality.judge(measured, cutoffs).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    counts = {(r["quality"], r["kept"]): r["count"] for r in got}
    assert (0, True) not in counts and counts.get((1, False), 0) <= 0.05 * counts[1, True]


def test_bound_holds_and_small_strata_stay_whole(spark):
    docs, labels = labelled(spark, noise=0.3)  # cutting "#" would reject 30 % of the good
    measured = quality.measure(docs)
    for r in quality.fit(measured, labels).collect():
        assert r["n_good"] > 0 and r["cuts"][0] >= 100  # only the far larger share of the bad texts is cut
    few = labels.filter("doc_id < 40")
    cutoffs = quality.fit(measured, few)
    assert cutoffs.count() == 0
    assert quality.judge(measured, cutoffs).filter("not kept").count() == 0


def test_quality_edge_tables(spark):
    docs = spark.createDataFrame([(None, "a b", None), (1, None, "en"), (1, "x " * 60, "en"), (2, "word%d " * 3, "en")], DOCS).withColumn("kept", F.lit("old")).withColumn("stratum_key", F.lit(1))
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1)], "doc_id long, quality int")
    measured = quality.measure(docs)
    out = quality.judge(measured, quality.fit(measured, labels))
    assert out.count() == 4 and set(out.columns) == {*docs.columns, "measures"} and out.filter("kept").count() == 0
    empty = quality.measure(docs.limit(0))
    assert quality.judge(empty, quality.fit(empty, labels.limit(0))).count() == 0


# ranked search


def plain_search(docs, items, k):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total, words, df = len(held), sum(sum(c.values()) for _, c in held), collections.Counter(t for _, c in held for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = set()
    for item, own in asked.items():
        scored = []
        for i, c in held:
            m = 50 + (50 * sum(c.values()) * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out |= {(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])}
    return out


def random_texts(rng, n, size):
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("k,block,terms", [(5, 1 << 15, 500_000), (3, 7, 40), (50, 1, 500_000)])
def test_search_equals_brute_force(spark, k, block, terms):
    rng = random.Random(k)
    docs = [(i, t) for i, t in enumerate(random_texts(rng, 150, 60))] + [(500, None), (501, ""), (502, "W1 w2!W1"), (None, "w1 w3 w9"), (503, "w1 w3 w9"), (504, "ÄÖ ÄÖ w5")]
    items = [(i, t) for i, t in enumerate(random_texts(rng, 12, 12))] + [(70, None), (71, "?!"), (72, "ÄÖ"), (73, "nowhere"), (74, "w1"), (74, "w2")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = ranked.search(d, q, k=k, block_docs=block, terms_at_once=terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == plain_search(docs, items, k)


def test_reading_stops_before_the_end():
    rng = np.random.default_rng(0)
    n, m = 5000, 6
    doc = np.concatenate([rng.permutation(n)[:4000] for _ in range(m)])
    term = np.repeat(np.arange(m), 4000)
    impact = rng.pareto(1.0, len(doc)).clip(0, 5000).astype(np.int64) + 1
    block, best = ranked.Lists(doc, term, impact, n, m), ranked.Best(10)
    depth = block.search(np.arange(m), best, np.arange(n), np.zeros(n, bool), read=16)
    scores = np.zeros(n, np.int64)
    np.add.at(scores, doc, impact)
    want = sorted(zip(-scores, range(n), strict=True))[:10]
    assert list(zip(-best.scores, best.ids, strict=True)) == want and depth < 4000


def test_search_in_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked.search(docs, items).count() == 0
    assert ranked.search(items.select(F.col("item_id").alias("doc_id"), "text"), items.limit(0)).count() == 0
    named = ranked.search(items.select(F.col("item_id").alias("doc_id"), "text"), items.select(F.lit("q").alias("item_id"), "text"))
    assert [tuple(r) for r in named.collect()] == [("q", 1, 1, 2 * math.floor(1000 * math.log(4 / 3)) * (1000000000 // (1000 + 20 * 100)))]


# alignment


def plain_align(docs):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    coder, model = Tokenizer.from_file(JSON), SentencePieceProcessor(model_file=MODEL)
    coder.encode_special_tokens = True
    letters = {c: b for b, c in align._byte_letters().items()}
    rows, counts = [], collections.Counter()
    for i, t in docs:
        a = coder.encode(" " + t, add_special_tokens=False).ids if t else []
        b = model.encode(t) if t else []
        bytes_a = [bytes(letters[c] for c in coder.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(model.id_to_piece(x)[3:5], 16)]) if model.is_byte(x) else model.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not t or b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            rows.append((i, [], [], [], []))
            continue
        ends = lambda parts: np.cumsum([len(x) for x in parts]).tolist()
        ea, eb = ends(bytes_a), ends(bytes_b)
        cuts, groups, links = sorted(set(ea) & set(eb)), [], []
        before = 0
        for c in cuts:
            groups.append(([x for x, e in zip(a, ea, strict=True) if before < e <= c], [x for x, e in zip(b, eb, strict=True) if before < e <= c]))
            before = c
        for x, e, n in zip(a, ea, map(len, bytes_a), strict=True):
            links += [(x, y) for y, f, m in zip(b, eb, map(len, bytes_b), strict=True) if max(e - n, f - m) < min(e, f)]
        counts.update(links)
        rows.append((i, a, b, groups, links))
    top = collections.defaultdict(int)
    for (_, y), c in counts.items():
        top[y] = max(top[y], c)
    told = lambda groups: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return [(i, len(a), len(b), len(g), len(k), sum(counts[p] == top[p[1]] for p in k), sum(counts[p] for p in k), told(g)) for i, a, b, g, k in rows]


ALIGNED = [
    "Hello world, this is a test.", "  leading   and trailing  ", "tabs\tand\nlines\r\n\n", "Größe naïve café", "日本語のテキスト 😀🎉", "<|endoftext|> <s> </s> <0x0A> <unk>", "a▁b holds the mark", "", None, " ", "\x00\x01 control",
    "import numpy as np\nfor i in range(10):\n    print(i)", "the the the the", "ﬁ ligature é combining 　 wide", "3.14159 2,718 #hashtag @user", "supercalifragilisticexpialidocious " * 3,
]


@pytest.mark.parametrize("spill,slice_links", [(align.SPILL, align.SLICE), (50, 60)])
def test_alignment_equals_brute_force(spark, spill, slice_links):
    rng = random.Random(1)
    alphabet = list("abcde fgh  ij.\n\téß日😀▁")
    docs = list(enumerate(ALIGNED + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(60)])) + [(3, ALIGNED[3]), (None, "null id")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit(1)).repartition(3)
    got = align.align(rows, tokenizer=JSON, model=MODEL, spill=spill, slice_links=slice_links)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert collections.Counter(tuple(r[c] for c in columns) for r in got.collect()) == collections.Counter(plain_align(docs))


def test_alignment_digest_and_empty_table(spark):
    docs = spark.createDataFrame([Row(doc_id=1, text="a b")])
    text = align.align(docs, tokenizer=JSON, model=MODEL).first()["groups"]
    assert align.align(docs, tokenizer=JSON, model=MODEL, digest=True).first()["groups"] == hashlib.sha256(text.encode()).hexdigest()
    assert align.align(docs.limit(0), tokenizer=JSON, model=MODEL).count() == 0


def test_merge_of_runs():
    rng = np.random.default_rng(2)
    runs, want = [], []
    for r in range(9):
        n = int(rng.integers(1, 400))
        keys, places = rng.integers(0, 30, n), rng.integers(0, 50, n)
        order = np.lexsort((places, keys))
        keys, places, counts = keys[order] * 10**9, places[order], rng.integers(1, 9, n)
        runs.append((r << 33, align.pack(keys, places, counts, frame=17)))
        want += list(zip(keys.tolist(), (places + (r << 33)).tolist(), counts.tolist(), strict=True))
    blocks = list(align.merge(runs))
    got = [x for k, p, c in blocks for x in zip(k.tolist(), p.tolist(), c.tolist(), strict=True)]
    assert sorted(got) == sorted(want) and [x[0] for x in got] == sorted(x[0] for x in want)
