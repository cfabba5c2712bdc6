"""Token ids, packing and rANS files against the tokenizers library and exact round trips."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from plain import ODD
from tokenizers import Tokenizer

from parcelwise.llm import bpe, packing, rans
from parcelwise.llm.queries import QUERIES, tokenizer_file
from parcelwise.session import scratch_dir

TESTDATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ids string, start int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], DOCS)


def library(name):
    tokenizer = Tokenizer.from_file(tokenizer_file(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_have_the_ids_of_whole_texts(monkeypatch, name):
    pick, alphabet = random.Random(3), list(" \n\t\r'.,a1éÉ×́日s  　-İßΣ!\x0b\x1c\x85")
    texts = ["".join(pick.choices(alphabet, k=pick.randrange(14))) for _ in range(4000)]
    texts += ["don't 's 'll'", "<|endoftext|> <|startoftext|>", "a   b", " ", "\n\n a", None, ""] + [t for _, t in ODD[:6]]
    encoder, plain = bpe.Encoder(tokenizer_file(name)), library(name)
    for memo in (bpe.MEMO_ENTRIES, 50):
        monkeypatch.setattr(bpe, "MEMO_ENTRIES", memo)
        monkeypatch.setattr(bpe.bytewise, "SLICE_BYTES", 1 << 12)
        for low, high, ids, at in encoder.encode(pa.array(texts)):
            for row in range(low, high):
                assert ids[at[row - low] : at[row - low + 1]].tolist() == plain(texts[row]), texts[row]
    total = encoder.histogram(pa.array(texts), 1 << 16)
    expected = collections.Counter(i for t in texts for i in plain(t))
    assert {k: int(total[k]) for k in np.flatnonzero(total)} == expected


def check_pieces(pieces, docs, tokens):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, text in docs:
        ids, at = np.array(tokens(text) + [1], "<u4"), 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids) == (at, len(ids), ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    sizes = []
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= own[0].tier and {p.tier for p in own} == {own[0].tier}
        sizes.append(at)
    return sizes


def test_packing(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    name = tokenizer_file("word_bpe_49k.json")
    pieces = packing.pack(frame(spark, docs).repartition(3), name).collect()
    sizes = check_pieces(pieces, docs, library("word_bpe_49k.json"))
    assert all(n & (n - 1) == 0 and n <= 2048 for n in sizes)  # nothing to pad
    assert sum(n < 256 for n in sizes) <= 3 * 8
    groups = collections.defaultdict(set)
    for p in pieces:
        groups[p.step_group].add((p.tier, p.sequence_id))
    for own in groups.values():
        assert len({t for t, _ in own}) == 1 and sum(t for t, _ in own) <= packing.STEP_TOKENS


def test_packer_with_small_pools(monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 3000)
    pick = random.Random(1)
    for _ in range(30):
        packer, total = packing.Packer((4, 16, 64)), {}
        for k in range(pick.randrange(60)):
            total[k] = np.arange(pick.randrange(1, pick.choice([5, 20, 70, 300])), dtype=np.uint32)
            packer.add(k, total[k])
        packer.finish()
        seen = collections.defaultdict(list)
        for sequence in packer.done:
            size = sum(len(ids) for _, _, ids in sequence)
            assert size <= 64 and size & (size - 1) == 0
            for k, start, ids in sequence:
                assert len(ids)
                seen[k].append((start, ids))
        for k, ids in total.items():
            assert np.array_equal(np.concatenate([i for _, i in sorted(seen[k], key=lambda x: x[0])]), ids)


def test_packing_odd_texts(spark):
    odd = [r for r in ODD if r[0] not in (7, 8, None)]
    name = tokenizer_file("word_bpe_49k.json")
    check_pieces(packing.pack(frame(spark, odd), name).collect(), odd, library("word_bpe_49k.json"))
    twice = [p.length for p in packing.pack(frame(spark, [(None, None), (7, "a b"), (7, "a b")]), name).collect()]
    assert sum(twice) == 1 + 3 + 3
    assert packing.pack(frame(spark, []), name).collect() == []


def random_ids(pick, n, size):
    return np.array([min(int(pick.expovariate(0.05)), size - 1) for _ in range(n)], np.uint32)


def test_blocks_decode_from_start_and_every_checkpoint(monkeypatch):
    monkeypatch.setattr(rans, "CHECKPOINT_STEPS", 3)
    pick = random.Random(2)
    for n in (1, 2, 63, 64, 65, 1000, 40_000):
        ids = random_ids(pick, n, 500)
        table = rans.Table(np.bincount(ids, minlength=600))
        assert int(table.freq.sum()) == 1 << rans.SCALE
        data = rans.write_block([5, None], [1, n - 1], [0, 7], ids, table)
        assert rans.read_block(data, table)[:3] == ([5, None], [1, n - 1], [0, 7])
        assert np.array_equal(rans.read_block(data, table)[3], ids)
        lanes, every, marks = np.frombuffer(data, "<u4", 3, 4).tolist()
        for k in range(marks):
            assert np.array_equal(rans.read_block(data, table, k)[3], ids[(k + 1) * every * lanes :])
        bad = bytearray(data)
        bad[len(bad) // 2] ^= 1
        with pytest.raises(ValueError):
            rans.read_block(bytes(bad), table)
    with pytest.raises(ValueError):
        rans.write_block([1], [1], [0], np.array([599], np.uint32), table)


@pytest.mark.parametrize("block", [1 << 19, 500])
def test_token_files_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", block)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").limit(80).collect()]
    docs += [(d + 10_000 if d else None, t) for d, t in ODD if d not in (5, 6)]
    name, path = tokenizer_file("byte_bpe_50k.json"), scratch_dir(spark, "test")
    rans.write(frame(spark, docs), path, name)
    found = rans.read(spark, path, name).orderBy("start").collect()
    tokens = library("byte_bpe_50k.json")
    at = 0
    left = collections.Counter((d, np.array(tokens(t) + [0], "<u4").tobytes()) for d, t in docs)
    last = None
    for r in found:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
        left[r.doc_id, r.ids] -= 1
        assert last is None or r.doc_id >= last
        last = r.doc_id
    assert not any(left.values()) and len(found) == len(docs)
    longest = max(len(tokens(t)) + 1 for _, t in docs)
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert max(r.n_tokens for r in blocks) <= block and any(r.divided for r in blocks) == (longest > block)


def test_repeated_long_document_is_divided_and_joined_again(spark, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 300)
    name, path = tokenizer_file("byte_bpe_50k.json"), scratch_dir(spark, "test")
    docs = [(4, "one two three four " * 400), (4, "one two three four " * 400), (None, "x y " * 700), (5, "short")]
    rans.write(frame(spark, docs).repartition(3), path, name)
    tokens, at = library("byte_bpe_50k.json"), 0
    found = rans.read(spark, path, name).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 4, 4, 5]
    texts = dict(docs)
    for r in found:
        ids = np.array(tokens(texts[r.doc_id]) + [0], "<u4")
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids.tobytes())
        at += len(ids)


def test_empty_token_files(spark):
    name, path = tokenizer_file("byte_bpe_50k.json"), scratch_dir(spark, "test")
    rans.write(frame(spark, []), path, name)
    assert rans.read(spark, path, name).collect() == []


def test_registered_queries_agree_with_the_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    tokens, start = library("byte_bpe_50k.json"), 0
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_token_binary"](spark, TESTDATA).collect()}
    for doc_id in sorted(docs):
        ids = np.array(tokens(docs[doc_id]) + [0], "<u4")
        assert found[doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    tokens = library("word_bpe_49k.json")
    for p in QUERIES["op3_packing"](spark, TESTDATA).collect():
        ids = np.array(tokens(docs[p.doc_id]) + [1], "<u4")[p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(ids.tobytes())
