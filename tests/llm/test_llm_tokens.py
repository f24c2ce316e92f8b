"""Token output, packing and byte-pair encoding against the tokenizers library."""

import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_fixtures import documents, empty, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticketlens.llm import bpe_codec, packing, rans_output
from ticketlens.llm.scratch import Scratch
from ticketlens.llm.token_ids import encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", "'s", "'", " ", "  ", "\n", "\t", "don't", "'RE", "é", "É", "ß", "×", "€", "1", "23", "!",
         "?!", "ll", "<|endoftext|>", "<|", "…", " ", "é", "İ", "Σ", "中文", "the", "ing", "\x85"]


@functools.cache
def library_of(path):
    return Tokenizer.from_file(path)


def expected(path, text):
    return library_of(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(7)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(3000)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_give_the_library_ids(path, mixed):
    ids, counts = encoder(path).encode(pa.array([*mixed, None]))
    ends = np.cumsum(counts)
    library = Tokenizer.from_file(path)
    for text, end, n in zip(mixed, ends, counts, strict=False):
        assert library.encode(text, add_special_tokens=False).ids == ids[end - n : end].tolist(), text
    assert counts[-1] == 0


def test_speculative_encoding_gives_the_library_ids(mixed):
    codec, library = bpe_codec.codec(WORDS), Tokenizer.from_file(WORDS)
    draw = random.Random(3)
    made = ["".join(draw.choices("aeioutnshrdlcm", k=draw.randint(1, 18))) for _ in range(5000)]
    made += ["a" * k for k in (47, 48, 49, 100)]
    ids, counts = codec.encode(pa.array([*mixed, *made]))
    for text, end, n in zip([*mixed, *made], np.cumsum(counts), counts, strict=True):
        own = ids[end - n : end]
        assert library.encode(text, add_special_tokens=False).ids == own.tolist(), text
        assert library.decode(own, skip_special_tokens=False) == codec.decode(own).decode()


def test_a_pair_is_compatible_when_its_text_is_encoded_to_it():
    bpe = bpe_codec.codec(WORDS).bpe
    draw = np.random.default_rng(5)
    plain = bpe.plain[bpe.plain >= 0]
    final = bpe.final[bpe.final >= 0]
    one, two = draw.choice(plain, 4000), draw.choice(final, 4000)
    names = {n: token for token, n in Tokenizer.from_file(WORDS).get_vocab().items()}
    library = Tokenizer.from_file(WORDS).model
    for a, b, good in zip(one, two, bpe.compatible(one, two), strict=True):
        text = names[bpe.real[a]] + names[bpe.real[b]].removesuffix("</w>")
        found = [token.id for token in library.tokenize(text)]
        assert good == (found == [bpe.real[a], bpe.real[b]])


def test_encode_decode_of_odd_rows(spark):
    library = Tokenizer.from_file(WORDS)
    found = bpe_codec.encode_decode(documents(spark), WORDS).collect()
    wanted = []
    for doc_id, text, _ in rows():
        ids = expected(WORDS, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((doc_id, np.array(ids, "<u4").tobytes(), decoded))
    assert sorted(map(repr, wanted)) == sorted(repr((r[0], bytes(r[1]), r[2])) for r in found)
    assert bpe_codec.encode_decode(empty(spark), WORDS).count() == 0


def test_files_hold_all_ids_in_order(spark):
    path = Scratch(spark, "test").path("ids")
    rans_output.write_ids(documents(spark).repartition(5), path, WORDS, end_id=2)
    found = rans_output.read_ids(spark, path).orderBy("start").collect()
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in found] == [r[0] for r in order]
    start = 0
    ids_of = {}
    for doc_id, text, _ in order:
        raw = np.array([*expected(WORDS, text), 2], "<u4").tobytes()
        ids_of.setdefault(doc_id, []).append(raw)
    for row in found:
        assert row["start"] == start
        assert bytes(row["ids"]) in ids_of[row["doc_id"]]
        assert row["ids_crc32"] == zlib.crc32(bytes(row["ids"]))
        assert row["n_tokens"] * 4 == len(row["ids"])
        start += row["n_tokens"]


def test_empty_tables_of_ids(spark):
    path = Scratch(spark, "test").path("none")
    rans_output.write_ids(empty(spark), path, WORDS, end_id=2)
    assert rans_output.read_ids(spark, path).count() == 0


def test_a_long_document_is_decoded_by_stretches_and_put_together(spark):
    draw = random.Random(2)
    text = " ".join(draw.choice(["alpha", "beta", "gamma", "river", "stone", "1", "x"]) for _ in range(300_000))
    docs = spark.createDataFrame([(1, "a b"), (2, text), (3, None), (4, "c"), (2, text)], "doc_id long, text string")
    path = Scratch(spark, "test").path("long")
    rans_output.write_ids(docs, path, WORDS, end_id=2)
    stretches = spark.read.parquet(f"{path}/stretches")
    long = stretches.where("array_contains(doc_ids, 2)").collect()
    assert len({(r["part"], r["block"]) for r in long}) == 2 and len(long) >= 6
    assert all(r["n_ids"] <= rans_output.BLOCK_IDS for r in stretches.collect())
    found = rans_output.read_ids(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [1, 2, 2, 3, 4]
    raw = np.array([*expected(WORDS, text), 2], "<u4").tobytes()
    assert all(bytes(r["ids"]) == raw and r["ids_crc32"] == zlib.crc32(raw) for r in found[1:3])
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(found, found[1:], strict=False))


def test_stretches_decode_alone_and_show_damage():
    draw = np.random.default_rng(1)
    ids = np.minimum(draw.geometric(0.01, 700_000), 5000).astype(np.uint16)
    names, counts = np.unique(ids, return_counts=True)
    coder = rans_output.Coder(names.astype(np.int64), rans_output.scaled(names, counts))
    parts = list(coder.stretches(ids))
    assert len(parts) == 1 + (700_000 - 1) // rans_output.BLOCK_IDS
    for first, n, states, payload in parts:
        assert (coder.decode(n, states, payload) == ids[first : first + n]).all()
    assert sum(n for _, n, _, _ in parts) == len(ids)
    entropy = -(counts / len(ids) * np.log2(counts / len(ids))).sum() * len(ids) / 8
    assert sum(len(payload) for *_, payload in parts) < 1.01 * entropy + 8 * rans_output.LANES
    first, n, states, payload = parts[2]
    spoiled = bytearray(payload)
    spoiled[100] ^= 255
    try:
        assert (coder.decode(n, states, bytes(spoiled)) != ids[first : first + n]).any()
    except ValueError:
        pass


def test_a_damaged_file_stops_the_reader(spark):
    path = Scratch(spark, "test").path("damaged")
    rans_output.write_ids(documents(spark), path, WORDS, end_id=2)
    spoiled = spark.read.parquet(f"{path}/stretches").withColumn("crc32", F.col("crc32") + (F.col("first") == 0).cast("int"))
    other = Scratch(spark, "test").path("other")
    spoiled.write.parquet(f"{other}/stretches")
    spark.read.parquet(f"{path}/table").write.parquet(f"{other}/table")
    with pytest.raises(Exception, match="damaged"):
        rans_output.read_ids(spark, other).collect()


def test_one_id_only_and_frequencies_add_up():
    names = np.array([7])
    coder = rans_output.Coder(names, rans_output.scaled(names, np.array([3])))
    states, payload, _ = coder.encode(np.array([7, 7, 7]))
    assert coder.decode(3, states, payload).tolist() == [7, 7, 7]
    some = rans_output.scaled(np.arange(40_000), np.arange(1, 40_001))
    assert some.sum() == 1 << rans_output.SCALE and some.min() >= 1


def test_plan_places_every_piece_once_without_gaps():
    draw = random.Random(11)
    for _ in range(40):
        capacity = draw.choice([10, 64, 1024])
        counts = {draw.randint(1, capacity): draw.randint(1, 60) for _ in range(draw.randint(0, 50))}
        places, ranks = {}, {}
        for length, first, n, sequence, each, offset in packing.plan(counts, capacity):
            for k in range(n):
                places.setdefault(sequence + k // each, []).append((offset + length * (k % each), length))
                ranks.setdefault(length, []).append(first + k)
        assert {x: sorted(r) for x, r in ranks.items()} == {x: list(range(n)) for x, n in counts.items()}
        for held in places.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= capacity
            assert sum(3 * length > capacity for _, length in held) <= 2
        total = sum(length * n for length, n in counts.items())
        assert len(places) <= 1.5 * -(-total // capacity) + 2


def test_packing_of_odd_rows(spark):
    found = packing.pack(documents(spark).repartition(4), BYTES, end_id=2).collect()
    wanted = []
    for doc_id, text, _ in rows():
        ids = np.array([*expected(BYTES, text), 2], "<u4")
        number = -(-len(ids) // 1024)
        start = 0
        for piece in range(number):
            length = len(ids) - (number - 1) * 1024 if piece == 0 else 1024
            crc = zlib.crc32(ids[start : start + length].tobytes())
            wanted.append((doc_id, piece, start, length, crc))
            start += length
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)[:5]) for r in found)
    held = {}
    for r in found:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty(spark), BYTES, end_id=2).count() == 0
    assert packing.pack(empty(spark), BYTES).columns[-2:] == ["sequence_id", "offset"]
