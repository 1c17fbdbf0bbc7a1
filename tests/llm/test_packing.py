"""Packing against the library: round trips, odd rows, sequences."""

import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparrowmill.llm.packing import Words, binary_lengths, pack_documents, write_buckets

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, _part string, ids int, sequence_id double"
LONG = " ".join(f"word{i % 977} of" for i in range(30_000))
ODD = [
    None, "", " \t\n", "one", "One", LONG, LONG, "x" * 5000, "É ß 😀 İ Σας", "it's we'll I'D", "a b c\x1cd\x85e",
    "é ́x\ń", "<|endoftext|>a <|startoftext|> <|end oftext|>", "1234 5.6,7",
    "Ärger ÇA été ŒUVRE Ⱥx µm ªº x²y ×÷ İĞ ǅ ʼn ẖ H̱ T̈ a­b", "a\u0085b\u00a0c‐’s “x” 5€ it’s", "'s's'S 'tis rock'n'roll l'll ''d", "don't DON'T <|ENDOFTEXT|> <|endoftext|", "A" * 3000 + "é" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def pack(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def check(rows, texts, library, longest):
    """Pieces against a plain restatement: each id in one piece, binary lengths, sequences of one piece."""
    want = []
    for doc_id, text in texts:
        ids, start = ids_of(library, text), 0
        while start < len(ids):
            length = longest
            while length > len(ids) - start:
                length //= 2
            want.append((doc_id, start, length, zlib.crc32(pack(ids[start:start + length])), len(ids), 0))
            start += length
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset)) for r in rows)
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    lengths = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths)


def test_binary_lengths():
    assert binary_lengths(5000, 2048) == [2048, 2048, 512, 256, 128, 8]
    assert binary_lengths(1, 2048) == [1] and binary_lengths(4, 1) == [1] * 4


def test_pieces(spark, library):
    texts = [*enumerate(ODD), (3, "one"), (None, "two words"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", "y", 1, 2.0) for i, t in texts], SCHEMA).repartition(4)
    for longest in (2048, 8):
        check(pack_documents(df, FILE, longest=longest).collect(), texts, library, longest)
    assert pack_documents(df.limit(0), FILE).count() == 0
    with pytest.raises(ValueError):
        pack_documents(df, FILE, longest=1000)


def test_sequences_are_written_by_bucket(spark, library, tmp_path):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string")
    write_buckets(pack_documents(df, FILE, full=True), str(tmp_path / "packed"))
    stored = spark.read.parquet(str(tmp_path / "packed"))
    assert stored.filter(F.size("ids") != F.col("length")).count() == 0
    back = {}
    for r in sorted(stored.collect(), key=lambda r: (r.doc_id, r.start)):
        back.setdefault(r.doc_id, []).extend(r.ids)
    assert back == {i: ids_of(library, t) for i, t in enumerate(ODD)}


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(docs, FILE).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], library, 2048)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abzAZÀéÿĀİıẞß .,!'srtevmld0189\t\n‐“…ƻɏ×÷_^~"), max_size=40))
def test_plain_texts(text):
    test_parts_stand_alone.hypothesis.inner_test(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'’sΣςé́İ<|>"), st.characters(min_codepoint=33, max_codepoint=0x250)), max_size=40))
def test_parts_stand_alone(text):
    words = test_parts_stand_alone.words
    assert words.encode(text) == pack(words.library.encode(text, add_special_tokens=False).ids)


test_parts_stand_alone.words = Words(open(FILE, "rb").read())
