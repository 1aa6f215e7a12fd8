"""Encoding, decoding and token files against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from postlake.llm import bpe, tokenfile
from postlake.llm.pieces import Pieces

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
ODD = ["", " ", "\n\n  x", "aaaaaaaaaaaaaaaa" * 40, "it's we'll 's ''s", "x² ½ a²b Ⅷ", "\x1c \x1d a\x1fb", "漢字かな交じり文", "😀👍🏽 é", "a b c", "0123456789" * 30, "<|endoftext|>", "\ta\r\n\tb"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_kernel_equals_library_on_random_texts(library):
    rng = random.Random(5)
    alphabets = ["ab", "aabbc \n", "abcdefghij ", "éèñ ß", "\x1c²½  \x85", "0123. -'s", "漢字かな", "thandreing "]
    coder = bpe._encoder(RANKS, P.PATTERN)
    for _ in range(600):
        s = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([3, 20, 300])))
        assert np.frombuffer(coder.encode([s])[0], np.int32).tolist() == library.encode_ordinary(s), s


def test_known_piece_with_an_odd_character_is_split_by_the_full_engine():
    coder = Pieces(lambda new: [p.encode().ljust(1) for p in new])
    assert coder.encode(["²"]) and coder.encode(["a²", "²5"]) == [b"a" + "²".encode(), "²5".encode()]


def test_round_trip(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None, ODD[3]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")  # a clashing column is replaced
    out = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, vocabulary_path=RANKS), vocabulary_path=RANKS).collect()}
    for i, t, _ in rows:
        assert out[i]["ids"] == library.encode_ordinary(t or "")
        assert bytes(out[i]["decoded"]) == (t or "").encode()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, vocabulary_path=RANKS), vocabulary_path=RANKS).count() == 0


def test_decode_skips_unknown_ids(spark):
    rows = spark.createDataFrame([(1, [999999, None, 0]), (2, None), (3, [])], "doc_id long, ids array<int>")
    out = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(rows, vocabulary_path=RANKS).collect()}
    assert out == {1: bpe.vocabulary(RANKS).bytes_of[0], 2: b"", 3: b""}


def test_op1_digests(spark, library):
    path = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = bpe.op1_bpe(spark, path).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(JSON)
    rows = [(7 * i % 31, t) for i, t in enumerate([*ODD, None, " word word", "über straße", "a<|endoftext|>b", "<|endoftext|><|endoftext|> c", "x <|endoftext|", "𝒜 b <|endoftext|>"])]
    assert len(dict(rows)) == len(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenfile.write_tokens(docs, f"{tmp_path}/t", tokenizer=JSON, files=3)
    back = tokenfile.read_tokens(spark, f"{tmp_path}/t")
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.with_crc32(back).collect()}
    start = 0
    for k, t in sorted(rows):
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[k] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    some = tokenfile.read_tokens(spark, f"{tmp_path}/t", "doc_id = 7").collect()
    assert len(some) == 1 and some[0]["start"] == got[7][0]


def test_token_files_of_an_empty_table(spark, tmp_path):
    tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/t", tokenizer=JSON, files=2)
    assert tokenfile.read_tokens(spark, f"{tmp_path}/t").count() == 0


def scanned(df):
    """Rows that the scan of a filtered read gives on."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_filter_skips_stripes_and_row_groups(spark, tmp_path):
    docs = spark.range(0, 12_000, 2).selectExpr("id as doc_id", "concat('word ', id, ' ', repeat('x y ', 20)) as text")
    tokenfile.write_tokens(docs, f"{tmp_path}/t", tokenizer=JSON, files=2, stripe_bytes=1 << 14)
    rows = spark.read.schema(tokenfile.SCHEMA).orc(f"{tmp_path}/t")
    assert scanned(rows) == 6_000
    assert 0 < scanned(rows.filter("doc_id = 6000")) <= 1_000  # one row group
    assert scanned(rows.filter("doc_id = 6001")) == 0  # inside the ranges, but in no Bloom filter
    assert scanned(rows.filter("doc_id > 20000")) == 0
    assert [r["doc_id"] for r in tokenfile.read_tokens(spark, f"{tmp_path}/t", "doc_id between 5998 and 6002").collect()] == [5998, 6000, 6002]


def test_memo_generations_change_nothing():
    from postlake.llm.pieces import Pieces

    coder = Pieces(lambda new: [f"<{p}>".encode() for p in new], memo=3)
    for texts in (["a b c d e", "a b"], ["a x y z"], ["", "b a", "it's 12 ok"], ["a b c d e"]) * 2:
        assert coder.encode(texts) == [b"".join(f"<{p}>".encode() for p in coder.full.findall(t)) for t in texts]


def test_split_equals_the_pattern():
    from postlake.llm.pieces import Pieces

    coder = Pieces(None)
    for t in [*filter(None, ODD), "Ⅷ ½ ² x\u2028 y\u00a0\u1680 z\u0085", "_a__b 'll're 'S", "e\u0301 न\u093e १२ 𝒜𝟙 😀", "\x1c\x1d a\x1f", "".join(map(chr, range(0x3000)))]:
        assert coder.split(t) == coder.full.findall(t)
