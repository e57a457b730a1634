"""Byte-level BPE, word tokens and packing against the libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import bpe, packing, token_output, tokens
from clickloom.llm.catalog import QUERIES, packed_documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    "", " ", "\n\n \t x", "don't DON'T 'st", "a" * 3000, "é" * 700, "日本語のテキスト。", "🙂🙃" * 40, "\x1c\x85\xa0 y",
    "12345 ²³¼", "ΣΑΣ Σας", "<|endoftext|> <|startoftext|>", "éé", "​ ", "tab\tand\r\nreturn",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def some_texts(n: int) -> list[str]:
    rng = random.Random(5)
    alphabets = ["abeiont ", "aAbB'st \n", "éàßñ tion", "0123456789., ", "日本語テキスト ", "!?#$%& \t"]
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_transducer_agrees_with_library(library):
    encode = bpe.Encoder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    for text in AWKWARD + some_texts(3000):
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode_ordinary(text), text


def test_small_tables_change_nothing(library):
    encode = bpe.Encoder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    encode.pieces.limit, encode.pieces.machine.max_states = 3, 5
    for text in AWKWARD + some_texts(200):
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_decoding_in_blocks_cuts_between_characters():
    ranks = bpe.load_ranks(RANKS)
    encode = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in AWKWARD:
        ids = np.frombuffer(encode(text), "<u4").tolist()
        for block in (1, 2, 7):
            parts = list(bpe.Decoder(ranks).stream(ids[i : i + block] for i in range(0, len(ids), block)))
            assert b"".join(parts) == text.encode()
            assert "".join(p.decode() for p in parts) == text
    assert bpe.Decoder({b"\xe6": 0, b"a": 1})(np.array([0, 1], "<u4").tobytes()) == b"\xe6a"


def test_columns_take_null_and_empty(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "the end"), (3, "the end")], "doc_id long, text string")
    ids = bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN)
    found = rows.select("doc_id", ids.alias("ids")).select("doc_id", bpe.decode(F.col("ids"), RANKS).alias("b")).collect()
    assert [bytes(r["b"]) for r in sorted(found)] == [b"", b"", b"the end", b"the end"]


def test_word_tokens_agree_with_library():
    own, library = tokens.WordTokenizer(WORDS, limit=50), Tokenizer.from_file(WORDS)
    marks = ["a <|endoftext|> b", "<|endoftext|><|startoftext|>", "x<|ENDOFTEXT|>y <|endof", "\n<|startoftext|>\u00c9t\u00e9 <|endoftext|>", "<|<|endoftext|>|>"]
    for text in AWKWARD + some_texts(1500) + marks:
        assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_packing_query_has_the_ids_of_the_library(spark, tmp_path):
    library = Tokenizer.from_file(WORDS)
    texts = [*AWKWARD, "a <|endoftext|> b", "word " * 9000, "", None, "short"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in QUERIES["op7_sum_of_squares_packing"](spark, str(tmp_path)).collect()}
    want = {}
    for doc, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            some = ids[at : at + 4096]
            want[doc, piece] = (at, len(some), zlib.crc32(np.array(some, "<u4").tobytes()))
    assert got == want


def check_packing(rows, capacity):
    """Pieces cover each document once; sequences are gapless and not too long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_doc.values():
        pieces.sort()
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert [s for _, s, _ in pieces] == [i * capacity for i in range(len(pieces))]
        assert all(n == capacity for _, _, n in pieces[:-1]) and 0 < pieces[-1][2] <= capacity
    for places in by_sequence.values():
        places.sort()
        ends = np.cumsum([n for _, n in places])
        assert [o for o, _ in places] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(by_sequence)


def test_sum_of_squares_chooses_by_definition():
    rng, capacity = random.Random(2), 12
    packer, gaps = packing.SumOfSquares(capacity), []
    for size in (rng.randint(1, capacity) for _ in range(300)):
        cost = lambda state: sum(sum(g == x for g in state) ** 2 for x in range(1, capacity))
        options = [(cost(gaps[:i] + [g - size] + gaps[i + 1 :]), g, i) for i, g in enumerate(gaps) if g >= size]
        options.append((cost([*gaps, capacity - size]), capacity + 1, len(gaps)))
        best = min(c for c, _, _ in options)
        bin_, offset = packer.place(size)
        if bin_ == len(gaps):
            assert offset == 0 and options[-1][0] == best and all(c > best for c, _, _ in options[:-1])
            gaps.append(capacity - size)
        else:
            assert gaps[bin_] == capacity - offset
            gaps[bin_] -= size
            assert (best, gaps[bin_] + size) == min((c, g) for c, g, _ in options)
    assert len(gaps) <= 1.05 * sum(capacity - g for g in gaps) / capacity + 3


def test_packed_documents(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(0, 300)))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "word " * 3000), (None, "left out")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("offset", F.lit("clash"))
    found = packed_documents(docs, 256).collect()
    used = check_packing(found, 256)
    assert {r["doc_id"] for r in found} == {i for i, _ in rows if i is not None}
    longer = sum(r["length"] > 128 for r in found)  # no two of them share a sequence
    assert used <= 1.08 * max(longer, sum(r["length"] for r in found) / 256) + 2
    assert packed_documents(docs.limit(0), 256).count() == 0


def test_shards_hold_repeated_rows(spark):
    pieces = spark.createDataFrame([(7, 0, 0, 100, 5)] * 300, "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(pieces, 256, shard_rows=50).collect()
    assert len(found) == 300 and len({(r["sequence_id"], r["offset"]) for r in found}) == 300
    assert len({r["sequence_id"] >> 32 for r in found}) > 3


def test_room_tree_finds_the_tightest():
    rng, tree, rooms = random.Random(4), token_output.RoomTree(37), []
    for _ in range(600):
        room = rng.randint(0, 37)
        if rng.random() < 0.6:
            rooms.append(room)
            tree.add(room, 1)
        elif rooms:
            tree.add(rooms.pop(rng.randrange(len(rooms))), -1)
        want = rng.randint(1, 37)
        assert tree.least_from(want) == min((r for r in rooms if r >= want), default=None)


def test_packed_rows_round_trip(spark):
    rng = np.random.default_rng(6)
    whole = {i: rng.integers(1, 60000, n).astype("<u4") for i, n in enumerate([0, 1, 31, 32, 33, 500, 7, 7, 20, 64])}
    docs = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in whole.items()] + [(99, None)], "doc_id long, ids binary")
    rows = token_output.pack_rows(docs, 32, pad=9).orderBy("sequence_id").collect()
    matrix = token_output.matrix(r["ids"] for r in rows)
    got = {}
    for line, r in zip(matrix, rows, strict=True):
        assert (line[r["n_ids"] :] == 9).all()
        places = token_output.positions(r["cu_seqlens"], r["starts"])
        assert len(places) == r["n_ids"] == r["cu_seqlens"][-1]
        for a, b, doc in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["doc_ids"], strict=False):
            got.update({(doc, int(p)): int(v) for p, v in zip(places[a:b], line[a:b], strict=True)})
    assert got == {(i, p): int(v) for i, ids in whole.items() for p, v in enumerate(ids)}
    assert token_output.pack_rows(docs.limit(0), 32).count() == 0


def test_long_pieces_do_not_copy_the_table_of_pieces():
    class Table(dict):
        def __or__(self, other):
            raise AssertionError("the whole table was copied")

    made = tokens.WordTokenizer(WORDS)
    text = "two words " + "abcdefgh" * 9 + " two " + "q" * 40
    want = made.library.encode(text, add_special_tokens=False).ids
    made.pieces = Table()
    assert list(np.frombuffer(made(text), "<u4")) == want and not any(len(p) > 32 for p in made.pieces)
    assert list(np.frombuffer(made(text), "<u4")) == want
