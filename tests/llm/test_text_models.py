"""Personal data, toxicity, language and the pipeline."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlake.llm import langid, pii, toxicity

DIR = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))), (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), m.end(), pii.KINDS[k]) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0]))


TEXTS = [
    None, "", "é😀 a@b.com_x@y.zz @c.de a@b", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.256 00000000000000000000001.2.3.4", "4111 1111 1111 1111 x 4111-1111-1111-1112 1 2", "+1 (275) 555-7228, +49 30 1234567890 +1", "a" * 5000 + "@b.co",
    "1" * 20000, "+" + "1 " * 5000 + "x", "x@y.z " * 700, "4111111111111111 " * 300, "DE89 3704 0044 0532 0130 00 and DE89370400440532013001", "my ssn is 123-45-6789, not 123-45-6780", "call 212-555-1234 or 212-555-9999x",
]


def test_spans_equal_a_plain_search(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, pii string")
    got = {r["doc_id"]: [(x["start"], x["end"], x["kind"]) for x in r["pii"]] for r in pii.find_pii(df).collect()}
    for i, t in enumerate(TEXTS):
        assert [x for x in got[i] if x[2] in pii.BASE] == plain(t or ""), t
    assert [x[2] for x in got[11]] == ["iban"]
    assert [x[2] for x in got[12]] == ["ssn", "ssn"] and [x[2] for x in got[13]] == ["local_phone", "local_phone"]


@pytest.mark.parametrize("text,want", [
    ("IBAN DE89370400440532013000 PLEASE PAY", ["DE89370400440532013000"]), ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", ["DE89 3704 0044 0532 0130 00"]), ("DE89370400440532013000 GB29NWBK60161331926819 NO9386011117947", ["DE89370400440532013000", "GB29NWBK60161331926819", "NO9386011117947"]),
    ("REF DE12 IBAN DE89 3704 0044 0532 0130 00 DE89", ["DE89 3704 0044 0532 0130 00"]), ("DE89370400440532013001", []), ("DE8937040044053201300", []), ("xDE89370400440532013000", []), ("DE893704004405320130000", []), ("MT84MALT011000012345MTLCAST001S OK", ["MT84MALT011000012345MTLCAST001S"]),
])
def test_account_numbers_by_country(spark, text, want):
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [text[x["start"] : x["end"]] for x in row["pii"] if x["kind"] == "iban"] == want


def test_spans_on_the_documents(spark):
    rows = pii.find_pii(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")).collect()
    assert all([(x["start"], x["end"], x["kind"]) for x in r["pii"] if x["kind"] in pii.BASE] == plain(r["text"] or "") for r in rows)


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.com now"), (2, None), (3, "none"), (4, "+4111 1111 1111 1111")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(pii.find_pii(df)).collect()}
    assert got[1] == "mail <email> now" and got[2] is None and got[3] == "none" and "1111" not in got[4]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(0)

    def maximal(s):
        """By definition: split at the best segment, and again on both sides."""
        best = max(((sum(s[i:j]), -i, -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
        if best[0] <= 1e-12:
            return []
        i, j = best[3], best[4]
        return maximal(s[:i]) + [round(best[0], 9)] + maximal(s[j:])

    for _ in range(200):
        s = rng.integers(-5, 6, rng.integers(1, 14)) + rng.random() * 1e-3
        sums = np.concatenate([[0], np.cumsum(s)])
        runs, i = [], 0
        while i < len(s):
            j = i
            while j < len(s) and s[j] > 0:
                j += 1
            if j > i:
                runs.append((sums[i], sums[j]))
            i = max(j, i + 1)
        assert [round(x[2], 6) for x in toxicity.segments(runs)] == pytest.approx([round(float(x), 6) for x in maximal(list(s))], abs=1e-5)


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    scored = toxicity.op3_toxicity(spark, DIR).join(labels, "doc_id").filter("held_out")
    right = scored.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right >= 0.9 and toxicity.op3_toxicity(spark, DIR).count() == docs.count()


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(i, "you awful pest" if i % 2 else "a fine day", "x") for i in range(60)] + [(100, None, "x"), (101, "", "x"), (102, "awful " * 50000, "x")], "doc_id long, text string, expected string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert out[100]["score"] == out[101]["score"] and out[100]["score"] < 0.5 and out[100]["expected"] == "x"
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r["score"] < 0.6 and not r["passages"] for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_paths_equal_plain_viterbi():
    rng = np.random.default_rng(2)
    counts = [0, 1, 5, 9, 3, 0, 12]
    first = np.concatenate([[0], np.cumsum(counts)])
    scores = rng.standard_normal((first[-1], 3)).astype(np.float32) * 4
    got = langid.paths(scores, first, 3.0)
    total = lambda lab, s: sum(s[t, x] for t, x in enumerate(lab)) - 3.0 * sum(a != b for a, b in zip(lab, lab[1:], strict=False))
    for a, b in zip(first, first[1:], strict=False):
        s, best = scores[a:b], None
        if b == a:
            continue
        best = s[0].copy()
        for row in s[1:]:
            best = np.maximum(best, best.max() - 3.0) + row
        assert total(list(got[a:b]), s) == pytest.approx(float(best.max()), rel=1e-4)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang")
    found = langid.op8_language(spark, DIR).join(docs, "doc_id").filter("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97


def test_mixed_language_spans_and_edges(spark):
    train = spark.createDataFrame([("the cat and the dog were with them " * 5, "en"), ("le chat et les chiens sont avec nous " * 5, "fr"), ("кошка и собака были здесь " * 5, "ru"), (None, "de"), ("x", None)], "text string, lang string")
    model = langid.fit(train)
    assert model.langs == ["en", "fr", "ru"]
    rows = [(1, "the dog and the cat with them " * 4 + "les chiens et le chat sont avec nous " * 4), (2, None), (3, "123 !?"), (4, "собака и кошка"), (5, "")]
    out = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [s["lang"] for s in out[1]["spans"]] == ["en", "fr"]
    assert [out[i]["lang_pred"] for i in (2, 3, 4, 5)] == ["und", "und", "ru", "und"]
    none = langid.fit(train.limit(0))
    assert {r["lang_pred"] for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), none).collect()} == {"und"}


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, sf)
        assert docs_out.columns == docs.columns
        docs = docs_out
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4] > 0
    last = corpus_pipeline.encode(spark, docs, sf)
    assert last.filter("not round_trip").count() == 0 and last.count() == sizes[-1]


def test_near_duplicates_stage_goes_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(1, a, "x"), (1, a, "y"), (2, a, "x"), (2, b, "x"), (None, c, "x"), (None, c, "y"), (3, c, "x"), (None, None, "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (None, c), (None, None), (None, None)], key=str)


def test_decontamination_stage_goes_by_row(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(12))
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, "a " + passage), (None, "clean"), (1, passage), (1, "fine"), (2, None)], "doc_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()} == {(None, "clean"), (1, "fine"), (2, None)}
