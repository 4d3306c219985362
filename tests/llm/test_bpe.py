import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from riskloom.llm.bpe import LISTED_TEXT, BytePairs, decode_bpe, decode_ids, encode_bpe, parse_ranks
from riskloom.llm.queries import queries
from tests.llm.conftest import EDGE

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = regex.compile(public_tokenizers.PATTERN)


def merged(piece, ranks):
    """Plain merging: the pair of lowest rank first, of equal ones the left."""
    parts = [bytes([b]) for b in piece]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return parse_ranks(file.read())


@pytest.fixture(scope="module")
def pairs(ranks):
    return BytePairs(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids_of(pairs, text):
    return np.frombuffer(pairs.encode(text, PIECES), np.int32).tolist()


def test_pieces_equal_plain_merging(ranks, pairs):
    rng = random.Random(5)
    tokens = list(ranks)
    for _ in range(1500):
        kinds = [
            bytes(rng.choices(range(256), k=rng.randint(0, 12))),
            b"".join(rng.choices(tokens, k=rng.randint(1, 6))),
            bytes(rng.choices(b"aeinst ", k=rng.randint(1, 40))),
            bytes(rng.choices(b"ab", k=rng.randint(1, 60))),
        ]
        for piece in kinds:
            assert pairs.encode_bytes(piece) == merged(piece, ranks)


def test_small_tables_of_random_merges():
    rng = random.Random(6)
    for _ in range(40):
        table = [bytes([b]) for b in range(256)]
        while len(table) < 270:
            parts = [rng.choice([b"a", b"b", b"c", *table[256:]]) for _ in "12"]
            ranks = {token: i for i, token in enumerate([*table, b"".join(parts)])}
            try:
                own = BytePairs(ranks)
            except ValueError:  # other merges come between
                continue
            if len(ranks) > len(table):
                table = list(ranks)
        library = tiktoken.Encoding(
            "small", pat_str=r"[\s\S]+", mergeable_ranks={t: i for i, t in enumerate(table)}, special_tokens={}
        )
        own = BytePairs({t: i for i, t in enumerate(table)})
        for _ in range(100):
            text = "".join(rng.choices("abc", k=rng.randint(1, 25)))
            assert own.encode_bytes(text.encode()) == library.encode_ordinary(text)


def test_every_code_point_falls_into_the_library_s_pieces(pairs, library):
    for c in [*range(0xD800), *range(0xE000, 0x110000, 7)]:
        text = f"a{chr(c)}b {chr(c)}1 {chr(c)}"
        assert ids_of(pairs, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "ab" * 150_000, " " * 300_000, "éa" * 100_000])
def test_long_pieces_take_linear_time(ranks, pairs, text):
    tokens = {rank: token for token, rank in ranks.items()}
    ids = ids_of(pairs, text)  # quadratic would not end
    assert decode_ids(ids, tokens).decode() == text
    assert all(map(pairs.apart.of, ids, ids[1:]))


def test_unfit_tables_are_errors():
    with pytest.raises(ValueError, match="single byte"):
        BytePairs({b"a": 0})
    with pytest.raises(ValueError, match="no merge"):
        BytePairs({bytes([b]): b for b in range(256)} | {b"abc": 256})


def encoded(df):
    return decode_bpe(encode_bpe(df, RANKS, public_tokenizers.PATTERN), RANKS)


def test_edge_rows(edge, library):
    df = edge.withColumns({"Ids": F.lit("own"), "decoded": F.lit(7)})
    out = encoded(df).collect()
    want = [(library.encode_ordinary(t or ""), (t or "").encode()) for _, t, _ in EDGE]
    got = [(r["ids"], bytes(r["decoded"])) for r in out]
    assert sorted(got) == sorted(want)
    assert out[0]["in0"] == "own in0" and "Ids" not in out[0].asDict()
    assert encoded(df.where("false")).count() == 0


def test_a_very_long_text_and_strings_of_special_tokens(spark, library):
    texts = ["word <|endoftext|> \U0001f600 " * (LISTED_TEXT // 20), "<|endoftext|>"]
    rows = encoded(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for row in rows:
        assert row["ids"] == library.encode_ordinary(row["text"])
        assert bytes(row["decoded"]).decode() == row["text"]


def test_null_ids_are_no_bytes(spark):
    rows = spark.createDataFrame([(None,), ([],), ([72],)], "ids array<int>")
    assert sorted(bytes(r["decoded"]) for r in decode_bpe(rows, RANKS).collect())[:2] == [b"", b""]


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries()["op11_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), listed)
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
