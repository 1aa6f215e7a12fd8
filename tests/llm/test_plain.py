"""Whole queries that SQL can't express, and the pipeline's stages, against plain versions on the smallest tables."""

import base64
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from postlake.llm import langid, pii, toxicity

DIR = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


# language: trigrams of bytes, scripts by Python's own characters, one Viterbi a text


def words_at(raw):
    return [(m.start(), m.end()) for m in re.finditer(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", raw)]


def features(raw):
    text = bytearray(b if b >= 128 or chr(b).isalpha() else 32 for b in low(raw.decode()).encode())
    padded, out = [32, *text, 32], []
    for i in range(len(text)):
        a, b, c = padded[i : i + 3]
        mix = (a * 0x9E3779B1 & 0xFFFFFFFF) ^ (b * 0x85EBCA77 & 0xFFFFFFFF) ^ (c * 0xC2B2AE3D & 0xFFFFFFFF)
        out.append((mix ^ mix >> 15) & langid.FEATURES - 1)
    return out


def script(word):
    return max(next((k for k, own in enumerate(langid.RANGES.values(), 1) if any(a <= ord(c) <= b for a, b in own)), 0) for c in word.decode())


def test_language_query(spark, docs):
    grams, scripts = defaultdict(Counter), defaultdict(Counter)
    for d in docs:
        if zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2 and d["lang"] is not None and d["text"] is not None:
            raw = d["text"].encode()
            f = features(raw)
            for a, b in words_at(raw):
                grams[d["lang"]].update(f[a:b])
                scripts[d["lang"]][script(raw[a:b])] += 1
    langs = sorted(grams)
    total = {x: sum(grams[x].values()) + langid.SMOOTH * langid.FEATURES for x in langs}
    log = {x: (lambda f, x=x: np.log((grams[x][f] + langid.SMOOTH) / total[x])) for x in langs}
    ok = lambda s: [x for x in langs if scripts[x][s] >= langid.SCRIPT_SHARE * sum(scripts[x].values())] or langs
    got = {r["doc_id"]: r for r in langid.op8_language(spark, DIR).collect()}
    assert len(got) == len(docs)
    for d in docs:
        raw = (d["text"] or "").encode()
        f, at = features(raw), words_at(raw)
        best, back = None, []
        for a, b in at:
            made = np.array([sum(log[x](k) for k in f[a:b]) for x in langs])
            may = np.isin(langs, ok(script(raw[a:b])))
            made = np.where(may, made, made.min() - 50)
            if best is None:
                best = made
                continue
            jump = best.max() - langid.SWITCH
            back.append([i if best[i] >= jump else int(best.argmax()) for i in range(len(langs))])
            best = np.maximum(best, jump) + made
        r = got[d["doc_id"]]
        if d["text"] is None or not any(c.isalpha() for c in d["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        label = [int(best.argmax())]
        for step in reversed(back):
            label.append(step[label[-1]])
        letters = Counter()
        for k, (a, b) in zip(reversed(label), at, strict=True):
            letters[k] += b - a
        name, most = max(letters.items(), key=lambda x: (x[1], -x[0]))
        assert r["lang_pred"] == langs[name] and r["score"] == pytest.approx(most / sum(letters.values()), abs=0.02)


def test_more_languages_than_a_byte_counts():
    rng = np.random.default_rng(1)
    scores = rng.standard_normal((40, 150)).astype(np.float32)
    scores[:, 140] += 50
    assert set(langid.paths(scores, np.array([0, 15, 40]), 3.0).tolist()) == {140}


def test_word_scores_in_blocks(monkeypatch):
    raw = np.frombuffer("the cat, sat  über кошка - on and on and on a verylongwordindeed\n".encode() * 3, np.uint8)
    feature, inside, starts, _ = langid._features(raw)
    table = np.random.default_rng(2).standard_normal((langid.FEATURES, 5)).astype(np.float32)
    whole = langid._word_scores(table, feature, inside, starts)
    monkeypatch.setattr(langid, "GROUP", 60)
    assert len(whole) == len(starts) and np.allclose(langid._word_scores(table, feature, inside, starts), whole, atol=1e-4)


def test_scripts_of_words():
    text = "abc über Ωmega кот עברית عربي हिन्दी தமிழ் ไทย ქართული ᏣᎳᎩ 漢字 かな 한글 𠀀 Հայ\n"
    data = np.frombuffer(text.encode(), np.uint8)
    _, _, starts, _ = langid._features(data)
    names = [langid.SCRIPTS[k] for k in langid._scripts(data, starts)]
    assert names == "latin latin greek cyrillic hebrew arabic devanagari tamil thai georgian cherokee han kana hangul han armenian".split()


# toxicity: counts, odds and segments from their definitions


def segments_of(s):
    best = max(((sum(s[i:j]), -i, -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
    if best[0] <= 1e-12:
        return []
    return segments_of(s[: best[3]]) + [best[0]] + segments_of(s[best[4] :])


def test_toxicity_scores_of_short_documents(spark, docs):
    words = lambda t: re.findall(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low(t).encode())
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    by_text = defaultdict(int)
    for d in docs:
        if label.get(d["doc_id"]) in (0, 1):
            by_text[d["text"]] = max(by_text[d["text"]], label[d["doc_id"]])
    seen = {k: Counter(w for t, y in by_text.items() if y == k for w in set(words(t))) for k in (0, 1)}
    every = set(seen[0]) | set(seen[1])
    n = {k: sum(seen[k].values()) for k in (0, 1)}
    mass = toxicity.PRIOR * (n[0] + n[1]) + 1e-3 * len(every)

    def of(w):
        prior = toxicity.PRIOR * (seen[0][w] + seen[1][w]) + 1e-3
        t, c = (seen[1][w] + prior) / (n[1] + mass), (seen[0][w] + prior) / (n[0] + mass)
        odds = np.log(t / (1 - t)) - np.log(c / (1 - c)) - toxicity.BOUND * np.sqrt(1 / (seen[1][w] + prior) + 1 / (seen[0][w] + prior))
        return max(odds, toxicity.LEAST) - toxicity.DRIFT

    listed = {w: of(w) for w, k in seen[1].items() if k > 1}
    model = toxicity.fit(spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet").filter(~toxicity.held_out()))
    assert len(model.words) == len(listed) and sorted(model.scores.tolist()) == pytest.approx(sorted(listed.values()), abs=1e-9)
    got = {r["doc_id"]: r["score"] for r in toxicity.op3_toxicity(spark, DIR).collect()}
    assert len(got) == len(docs)
    short = [d for d in docs if len(words(d["text"])) <= 60]
    assert len(short) >= 10
    for d in short:
        w = words(d["text"])
        found = sorted(segments_of([listed.get(x, toxicity.OTHER - toxicity.DRIFT) for x in w]), reverse=True)
        e = toxicity._expected(found, len(w), model.rate) if found else toxicity.K * len(w) + 1.0
        assert got[d["doc_id"]] == pytest.approx(2 ** max(-e / model.even, -1000), abs=1e-6)


def test_toxicity_recall_and_precision(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic in (0, 1)")
    rows = toxicity.op3_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    hit, toxic, said = sum(r["predicted"] and r["toxic"] for r in rows), sum(r["toxic"] for r in rows), sum(r["predicted"] for r in rows)
    assert toxic >= 50 and hit / toxic >= 0.85 and hit / said >= 0.95


# pipeline: each stage on what the one before kept


def test_pipeline_stages(spark, docs):
    frame = spark.read.parquet(f"{DIR}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, frame, DIR)
    model = toxicity.fit(frame, spark.read.parquet(f"{DIR}/labels.parquet").filter(~toxicity.held_out()))
    want = {r["doc_id"] for r in toxicity.score(frame, model).filter("score < 0.5").collect()}
    rows = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(rows) == want and len(want) > 0.8 * len(docs)

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = {i: shingles(t) for i, t in rows.items()}
    up = {i: i for i in rows}
    for a, b in itertools.combinations(sorted(rows), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = up[a], up[b]
            up = {k: min(x, y) if u in (x, y) else u for k, u in up.items()}
    single = corpus_pipeline.drop_near_duplicates(spark, clean, DIR)
    rows = {r["doc_id"]: r["text"] for r in single.collect()}
    assert set(rows) == {i for i, u in up.items() if i == u}

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known = defaultdict(set)
    for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
        w = word.findall(low(r["text"]))
        k = min(10, len(w))
        known[k] |= {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    hit = lambda t: any(tuple(w[i : i + k]) in own for k, own in known.items() if k for w in [word.findall(low(t))] for i in range(len(w) - k + 1))
    apart = corpus_pipeline.drop_contaminated(spark, single, DIR)
    rows = {r["doc_id"]: r["text"] for r in apart.collect()}
    assert set(rows) == {i for i, u in up.items() if i == u and not hit(next(d["text"] for d in docs if d["doc_id"] == i))}

    masked = corpus_pipeline.mask_personal_data(spark, apart, DIR)
    spans = {r["doc_id"]: r["spans_"] for r in pii.find_pii(apart, out="spans_").collect()}
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    assert set(texts) == set(rows) and any(spans.values())
    for i, t in rows.items():
        if not spans[i]:
            assert texts[i][0] == t
        for x in spans[i] or []:
            assert t[x["start"] : x["end"]] not in texts[i][0] or len(t[x["start"] : x["end"]]) < 8
        assert t is None or texts[i][1] == len(texts[i][0])

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in corpus_pipeline.encode(spark, masked, DIR).collect():
        assert r["ids"] == coder.encode_ordinary(texts[r["doc_id"]][0] or "") and r["n_tokens"] == len(r["ids"]) and r["round_trip"]
