"""Near-duplicates, repeated windows and strings, overlaps, embeddings: against brute force."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from postlake.llm import bwt, itq, minhash, store, windows, winnow
from postlake.llm.store import components, settings


def corpus(seed=1, n=60):
    """Random texts with exact and near copies, shared passages, short and empty ones, repeats inside a text."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["Über", "É", "THE", "the"]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = text(40)
    out = [None, "", " \n ", "one", "one two", "ONE two", text(19), text(20)]
    for _ in range(n):
        kind, base = rng.random(), rng.choice(out[7:])
        if kind < 0.2:
            out.append(base)
        elif kind < 0.45:
            own = base.split(" ")
            for _ in range(rng.randint(1, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
        elif kind < 0.65:
            out.append(text(rng.randint(0, 30)) + " " + passage + "\t" + text(rng.randint(0, 30)))
        elif kind < 0.75:
            one = text(25)
            out.append(one + " " + text(5) + "  " + one)
        else:
            out.append(text(rng.randint(5, 200)))
    return list(enumerate(out))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, kept string, n long")


def classes(n, links):
    up = list(range(n))
    for a, b in links:
        x, y = up[a], up[b]
        up = [min(x, y) if u in (x, y) else u for u in up]
    return up


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, words, percent):
    rows = corpus(2)
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
        sets.append({tuple(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set())
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = classes(len(rows), links)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, rows), words=words, percent=percent).collect()}
    assert [got[i]["n_shingles"] for i, _ in rows] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i, _ in rows] == want
    assert [got[i]["kept"] for i, _ in rows] == [i == c for i, c in enumerate(want)]


def test_near_copies_that_no_single_hub_links(spark):
    """A chain: neighbours are near, ends are not."""
    base = [f"t{i}" for i in range(300)]
    rows = [(k, " ".join(["x" + str(k)] * 0 + base[k * 6 :] + [f"u{i}" for i in range(k * 6)])) for k in range(12)]
    got = {r["component_id"] for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {0}


def test_near_duplicates_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is not None and r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect())
    assert got == [(False, None, True), (1, None, False), (1, None, False), (2, 2, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_of_different_texts_with_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(200)), " ".join(f"b{i}" for i in range(200))
    rows = [(None, a), (None, b), (None, a + " more"), (1, "c d e f"), (1, b + " more"), (2, b)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, False), (0, 0, True), (0, 0, True), (1, 0, False), (1, 1, True), (2, 0, False)]


def _plans(monkeypatch, *modules):
    """The plans of all tables that these modules write from now on, as Spark has them before it runs them."""
    seen, write = [], store.keep

    def noted(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    for m in modules:
        monkeypatch.setattr(m, "keep", noted)
    return seen


def test_near_duplicates_broadcast_nothing_by_a_guess(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 0)
    plans, rows = _plans(monkeypatch, minhash, store), corpus(3)
    rows += [(len(rows) + i, " ".join(f"c{(k * (i + 7)) % 50}" for k in range(30))) for i in range(5)]
    out = minhash.near_duplicates(frame(spark, rows))
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert len(plans) > 8 and [name for name, plan in plans if "Broadcast" in plan] == []


def test_marks_of_a_stage_beyond_the_broadcast_are_shuffled(spark, monkeypatch):
    docs = frame(spark, corpus(4))
    want = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 0)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in out.collect()) == want


def test_chunks_bound_the_misses():
    assert minhash.chunks_for(0.85) == 10 and minhash.chunks_for(0.8) == 12


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (8, 7), (1, 1), (None, 2)], "src long, dst long")
    assert {r["id"]: r["component"] for r in components(links).collect()} == {3: 3, 4: 3, 5: 3, 9: 3, 7: 7, 8: 7}


@pytest.mark.parametrize(("window", "gram"), [(20, 8), (4, 2)])
def test_repeated_windows(spark, window, gram):
    rows = corpus(3)
    seen, want = set(), {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        want[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    got = windows.remove_repeats(frame(spark, rows), window=window, gram=gram).collect()
    assert {r["doc_id"]: (r["n_words"], sum(x["end"] - x["start"] for x in r["removed"]), r["kept"]) for r in got} == want


def test_repeated_windows_of_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    rows = [(1, a), (1, b + " " + a), (1, a), (None, c), (2, c + " x"), (None, "one"), (3, "one"), (4, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_words"], sum(x["end"] - x["start"] for x in r["removed"])) for r in windows.remove_repeats(df).collect())
    first_a = hashlib.md5(a.encode()).digest() < hashlib.md5((b + " " + a).encode()).digest()
    own = [(1, 30, 0), (1, 30, 0), (1, 60, 30)] if first_a else [(1, 30, 30), (1, 30, 30), (1, 60, 0)]
    assert got == sorted([*own, (0, 30, 0), (0, 1, 0), (2, 31, 30), (3, 1, 0), (4, 0, 0), (4, 0, 0)])


def test_repeated_windows_of_an_empty_table(spark):
    assert windows.remove_repeats(frame(spark, [])).count() == 0


def test_repeated_windows_move_each_text_once(spark):
    """Texts with something to count went through two shuffles and a table on disk."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=12))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(500)) + " " + passage for _ in range(400)]
    folders = [Path(spark.sparkContext.getConf().get(k).removeprefix("file://")) for k in ("spark.local.dir", "spark.checkpoint.dir")]
    files = lambda: {p: p.stat().st_size for folder in folders for p in folder.rglob("*") if p.is_file() and p.suffix in (".data", ".parquet")}
    docs = frame(spark, list(enumerate(texts)))
    before = files()
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = windows.remove_repeats(docs, digest=True).collect()
    made = sum(size for p, size in files().items() if p not in before)
    assert sum(bool(r["removed"]) for r in got) == 399
    assert made < 1.7 * sum(map(len, texts)), made / sum(map(len, texts))


@pytest.mark.parametrize(("length", "gram", "crowded"), [(60, 20, 4000), (60, 20, 2), (9, 4, 4000)])
def test_repeated_strings(spark, length, gram, crowded):
    rows = corpus(4, 40)
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    want = {}
    for (k, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        want[k] = (len(t), int(gone.sum()), np.frombuffer(t, np.uint8)[~gone].tobytes())
    got = bwt.remove_repeats(frame(spark, rows), length=length, gram=gram, crowded=crowded).collect()
    assert {r["doc_id"]: (r["n_bytes"], sum(x["end"] - x["start"] for x in r["removed"]), bytes(r["kept"])) for r in got} == want


def test_interval_expansion_equals_counting():
    rng = random.Random(3)
    for it in range(300):
        size = rng.choice([1, 2, 3, 5, 9, 17, 40])
        base = bytes(rng.choice(b"ab" if it % 2 else b"abcdefgh") for _ in range(rng.randint(size, 120)))
        regions, weights = [], []
        for _ in range(rng.randint(1, 6)):
            a = rng.randint(0, len(base))
            r = bytearray(base[a : a + rng.randint(0, 80)])
            if r and rng.random() < 0.5:
                r[rng.randrange(len(r))] = ord("z")
            regions.append(bytes(r))
            weights.append(rng.choice([1, 1, 1, 2]))
        count = Counter()
        for r, w in zip(regions, weights, strict=True):
            for i in range(len(r) - size + 1):
                count[r[i : i + size]] += w
        for r, g in zip(regions, bwt.repeated_starts(regions, weights, size), strict=True):
            assert list(g) == [count[r[i : i + size]] >= 2 for i in range(len(r) - size + 1)]


def test_repeated_strings_same_id_and_null(spark):
    long = "abc " * 200
    df = spark.createDataFrame([(1, long), (1, "short"), (None, None)], "doc_id long, text string")
    got = sorted((r["n_bytes"], sum(x["end"] - x["start"] for x in r["removed"])) for r in bwt.remove_repeats(df, digest=True).collect())
    assert got == [(0, 0), (5, 0), (800, 800)]
    assert bwt.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_overlaps(spark, broadcast_rows):
    rows = corpus(5)
    items = [(0, rows[12][1]), (1, "one two"), (2, None), (3, "?!"), (4, rows[12][1]), (10, " ".join((rows[20][1] or "a").split()[:14])), (11, "x " + (rows[30][1] or ""))]
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams: dict = {}
    for k, t in items:
        w = pattern.findall(low(t or ""))
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(k))
    want = {}
    for i, t in rows:
        w = pattern.findall(low(t or ""))
        hit, who = [False] * len(w), set()
        for g, ks in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit[k : k + len(g)] = [True] * len(g)
                    who |= ks
        want[i] = (len(w), sum(hit), sorted(who))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnow.find_overlaps(frame(spark, rows), bench, broadcast_rows=broadcast_rows).collect()
    assert {r["doc_id"]: (r["n_words"], sum(x["end"] - x["start"] for x in r["hits"]), r["items"]) for r in got} == want
    empty = bench.limit(0)
    assert winnow.find_overlaps(frame(spark, rows), empty).filter("size(hits) > 0").count() == 0


def test_overlaps_beyond_the_broadcast_are_linear(spark):
    rng = random.Random(9)
    words = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    took = []
    for n in (5_000, 40_000):
        text = words(n)
        items = spark.createDataFrame([(k, " ".join(text[at : at + 30])) for k, at in enumerate(range(100, n - 100, 200))], "item_id long, text string")
        df = spark.createDataFrame([(1, " ".join(text)), (1, "other text"), (2, " ".join(words(50)))], "doc_id long, text string")
        start = time.time()
        got = {r["doc_id"]: (sum(x["end"] - x["start"] for x in r["hits"]), len(r["items"])) for r in winnow.find_overlaps(df, items, broadcast_rows=0).collect()}
        took.append(time.time() - start)
        k = len(range(100, n - 100, 200))
        assert got == {1: (30 * k, k), 2: (0, 0)}
    assert took[1] < 8 * took[0] + 5


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_overlaps_of_null_ids(spark, broadcast_rows):
    passage = " ".join(f"p{i}" for i in range(12))
    df = spark.createDataFrame([(None, "a " + passage), (1, passage + " b"), (2, "c d")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    got = {r["doc_id"]: sum(x["end"] - x["start"] for x in r["hits"]) for r in winnow.find_overlaps(df, bench, broadcast_rows=broadcast_rows).collect()}
    assert got == {None: 12, 1: 12, 2: 0}


def test_strings_of_one_byte(spark):
    """Every string of such a text has one anchor hash: the text is one region, compared within itself."""
    unit = "abcdefg" * 60
    texts = ["a" * 1_000_000, "b" * 399, "c" * 400, "x" + "d" * 401 + "y", unit + "z", "e" * 500 + "tail", "head" + "e" * 450, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: (r["n_bytes"], sum(x["end"] - x["start"] for x in r["removed"]), len(r["removed"])) for r in bwt.remove_repeats(df, digest=True).collect()}
    want = {}
    seen = Counter(t[i : i + 400] for t in texts[1:] for i in range(len(t or "") - 399))
    for k, t in enumerate(texts[1:], 1):
        gone = [False] * len(t or "")
        for i in range(len(gone) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = [True] * 400
        want[k] = (len(gone), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)))
    assert got == want | {0: (1_000_000, 1_000_000, 1)}
    assert time.time() - began < 120


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_overlaps_of_repeated_words(spark, broadcast_rows):
    """Equal words have equal hashes at every place; a phrase that many items share is one fingerprint of each."""
    n = 300_000
    df = spark.createDataFrame([(1, "na " * n), (2, "x " + "na " * 11 + "y"), (3, "template of many items that all say the same thing here " * 3)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "na " * 12), (8, "na " * 10)] + [(100 + i, f"{i} template of many items that all say the same thing here {i}") for i in range(200)], "item_id long, text string")
    began = time.time()
    got = {r["doc_id"]: (r["n_words"], sum(x["end"] - x["start"] for x in r["hits"]), len(r["items"])) for r in winnow.find_overlaps(df, bench, broadcast_rows=broadcast_rows).collect()}
    assert got == {1: (n, n, 2), 2: (13, 11, 2), 3: (33, 33, 200)}
    assert time.time() - began < 60


def test_embeddings_of_extreme_components(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((100, 8))
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate((v, s) for v in base for s in (1.0, 1e200, 1e-200, 5e-310))]
    rows += [(400, [1e308] * 8), (401, [-1e308] * 8), (402, [5e-324] + [0.0] * 7)] + [(500 + i, None) for i in range(300)]
    got = {r["vec_id"]: r for r in itq.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    same = [got[4 * i + k]["component_id"] == got[4 * i]["component_id"] and got[4 * i + k]["n_links"] >= 2 for i in range(100) for k in range(3)]
    assert len(got) == len(rows) and sum(same) >= 0.98 * len(same)
    assert all(got[500 + i]["n_links"] == 0 and got[500 + i]["kept"] for i in range(300))


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 16))
    rows = [(i, (base[i % 60] + 0.04 * (i // 60) * rng.standard_normal(16)).tolist()) for i in range(240)]
    rows += [(240, rows[3][1]), (241, None), (242, [0.0] * 16), (243, [float("nan")] * 16), (244, [1.0, None] * 8), (245, [1.0, 2.0]), (246, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n long")
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i < 241]
    links = {(a, b) for (a, x), (b, y) in itertools.combinations(ok, 2) if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95}
    got = {r["vec_id"]: r for r in itq.near_vectors(df).collect()}
    assert len(got) == len(rows)
    found = sum(got[i]["n_links"] for i, _ in ok)
    assert found <= 2 * len(links) and found >= 1.9 * len(links) * 0.95
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(241, 247))
    assert got[240]["n_links"] >= 1 and got[240]["component_id"] == got[3]["component_id"]
    assert itq.near_vectors(df.limit(0)).count() == 0


def crowd(kind, n, dims=64):
    """Unit vectors that share a direction, with copies at cosine 0.96 or so; one group of near copies among others; or few."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    noise = lambda k: unit(rng.standard_normal((k, dims)))
    if kind == "shared direction":
        base = unit(np.sqrt(0.86) * noise(1) + np.sqrt(0.14) * noise(n // 2))
    elif kind == "one group":
        return unit(np.concatenate([noise(1) + 0.2 * noise(n * 4 // 5), noise(n // 5)]))
    else:
        base = noise(n // 2)
    return np.concatenate([base, unit(base + 0.28 * noise(len(base)))])


@pytest.mark.parametrize(("kind", "n"), [("shared direction", 2000), ("one group", 500), ("few", 40)])
def test_embeddings_wherever_the_mean_is(spark, kind, n):
    x = crowd(kind, n).astype(np.float32).astype(float)
    near = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= 0.95
    links = int(near.sum()) - len(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = sum(r["n_links"] for r in itq.near_vectors(df).collect())
    assert links > n // 2 and 0.97 * links <= found <= links


def test_recall_at_the_threshold_at_the_widths_of_large_tables():
    """Pairs at cosine 0.95 exactly, of vectors that nothing was learned from: random ones, and clusters that share a direction."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = rng.standard_normal((40, 64))
    for some in (unit(rng.standard_normal((3000, 64))), unit(1.5 * unit(rng.standard_normal((1, 64))) + unit(centres[rng.integers(0, 40, 3000)] + rng.standard_normal((3000, 64))))):
        for count in (10**4, 10**7, 10**9):
            width, tables, taught = itq.plan(some[:2000], count, 0.95)
            turn = itq.learned(some[:2000], tables * width) if taught else itq.rotations(64, tables * width)
            x = some[2000:]
            y = itq.at_threshold(x, 0.95, seed=11)
            apart = ((x @ turn > 0) != (y @ turn > 0)).reshape(len(x), tables, width).sum(2)
            assert (apart.min(1) <= 1).mean() >= 0.98
        assert width >= 24


def test_learning_moves_vectors_from_the_borders():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((30, 16))[rng.integers(0, 30, 1500)] + 0.3 * rng.standard_normal((1500, 16))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    loss = lambda turn: ((unit @ turn - np.sign(unit @ turn) / 4) ** 2).sum()
    turn = itq.learned(x, 16)
    assert np.allclose(turn.T @ turn, np.eye(16), atol=1e-8) and loss(turn) < 0.97 * loss(itq.rotations(16, 16))


def test_digest_forms(spark):
    rows = corpus(6, 20)
    for module in (windows, bwt):
        full = {r["doc_id"]: r["kept"] for r in module.remove_repeats(frame(spark, rows)).collect()}
        short = {r["doc_id"]: r["kept_sha256"] for r in module.remove_repeats(frame(spark, rows), digest=True).collect()}
        raw = lambda v: v.encode() if isinstance(v, str) else bytes(v)
        assert {k: hashlib.sha256(raw(v)).hexdigest() for k, v in full.items()} == short
