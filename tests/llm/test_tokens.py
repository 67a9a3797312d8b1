"""BPE against the tokenizers library; packing against its definition."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from callsift.llm import bpe
from callsift.llm.packing import pack
from callsift.llm.piece_codec import piece_codec
from callsift.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PARTS = ["'", " ", "  ", "\n", "\t", "s", "re", "ll", "ve", "d", "m", "t", "a", "É", "é", "1", "½", "٣", "!", "''", "…", " ", " "]
PARTS += ["中", "文", "😀", "<|endoftext|>", "the", "ing", "\r\n", "x" * 9, "\x1c", "\x85", "_", "é", "ª", "Ⅷ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary())


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pandas().set_index("doc_id")["text"]


def test_ids_and_text_like_the_library(library):
    tool, draw = bpe.codec(bpe.vocabulary()), random.Random(1)
    cases = ["", None, "a" * 3000] + ["".join(draw.choices(PARTS, k=draw.randint(0, 40))) for _ in range(3000)]
    for text, ids in zip(cases, tool.encode_all(cases)):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted
        assert tool.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_long_texts_are_cut_where_pieces_start(library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    tool, draw = bpe.codec(bpe.vocabulary()), random.Random(2)
    cases = ["".join(draw.choices(PARTS + [" a", " the"] * 9, k=400)) for _ in range(50)] + ["y" * 500]
    for text, ids in zip(cases, tool.encode_all(cases)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_like_the_library(name):
    tool, whole, draw = piece_codec(bpe.vocabulary(name)), Tokenizer.from_file(bpe.vocabulary(name)), random.Random(3)
    odd = PARTS + ["<|startoftext|>", "\xa0", "İ", "Σ", "ΑΣ", "Ǆ", "'S", "T", "ß", "ẞ", "e\u0301", "\ua7cd", "\U00010d43"]
    cases = ["", None, "a" * 3000, " \n "] + ["".join(draw.choices(odd, k=draw.randint(0, 40))) for _ in range(4000)]
    cases += [f"a{c}b {c}'s{c} " for c in map(chr, [*range(0x400), *range(0x400, 0xD800, 97), *range(0xE000, 0x110000, 997)])]
    for text, ids in zip(cases, tool.encode_all(cases)):
        assert np.frombuffer(ids, f"<u{tool.width}").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_ids_wider_than_two_bytes():
    tool = piece_codec(bpe.vocabulary(), 70_000)
    assert tool.width == 4 and len(tool.packed([70_000])) == 4


def test_bpe_query(spark, library, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op5_bpe"](spark, FOLDER).collect()}
    assert len(rows) == len(texts)
    for name, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[name]["n_tokens"] == len(ids)
        assert rows[name]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[name]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def check_packing(rows, wanted, length):
    """Each id in one piece, sequences gapless from 0, all but the last full."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(wanted)
    for name, pieces in by_doc.items():
        ids, at = wanted[name], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for name, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == length or name == len(by_sequence) - 1


def test_packing_query(spark, library, texts):
    wanted = {name: library.encode(text, add_special_tokens=False).ids + [1] for name, text in texts.items()}
    check_packing(QUERIES["op10_packing"](spark, FOLDER).collect(), wanted, 2048)


def test_packing_of_odd_rows(spark, library):
    from pyspark.sql import functions as F

    texts = [None, "", "a", "a", "word " * 300, None]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string, n long").repartition(3)
    wanted = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    got = pack(df, length=16).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(got, wanted, 16)
    assert pack(df.limit(0)).collect() == []


def test_odd_rows_keep_their_place_in_bpe(spark):
    df = spark.createDataFrame([(None, "a b", 1), (1, None, 2), (1, None, 2), (2, "", 3)], "doc_id long, text string, ids int")
    got = sorted((r["doc_id"] or 0, len(r["ids"]), r["decoded"]) for r in bpe.encode_decode(df).collect())
    assert got == [(0, 8, "a b"), (1, 0, ""), (1, 0, ""), (2, 0, "")]
