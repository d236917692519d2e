"""Packing against best fit over single pieces, and token ids against the tokenizer."""

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from collatio.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best fit with the longest first over single pieces: how full the sequences are."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - n)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.data())
def test_plan_fills_as_best_fit_does(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=120))
    counts = {n: lengths.count(n) for n in lengths}
    rows, n = packing.best_fit_plan(counts, capacity)
    taken = {}
    for length in counts:
        ranks = 0
        for first, many, each, seq, offset in sorted(r[1:] for r in rows if r[0] == length):
            assert first == ranks
            ranks += many
            for i in range(many):
                taken.setdefault(seq + i // each, []).append((offset + i % each * length, length))
        assert ranks == counts[length]
    assert sorted(taken) == list(range(n))
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(x for _, x in places) for places in taken.values()) == one_by_one(lengths, capacity)


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rng, letters = random.Random(1), "a bé\n\t  .,'s 　\x1c\x1f1² \x85<|endoftext|>\rßΩ漢"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", " ", "  a", "a  ", "\n", "don't  stop, won't"]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "a\n<|endoftext|>\n b<|endoftext|>c  <|endoftext|>", "x\u3000y z\x1cw"]
    texts += ["a\n\nb\n\n\nc\n", "a \nb", "a\xa0\nb\n", "\n\na\n", "a.\nb.\nc d\n\n", "a\tb\nc\xa0\nd", "x\r\ny\r\n", "a\n b", "a\n\n b c\nd e"]
    tokens = packing.Tokens(PATH)
    for _ in range(2):  # the second time from memory
        got = tokens.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in got] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    tokens = packing.Tokens(PATH)
    texts = pa.array(["a w" + str(i) for i in range(300)])
    before = [x.tolist() for x in tokens.encode(texts)]
    for _ in range(3):  # what was learned is forgotten in between
        assert before == [x.tolist() for x in tokens.encode(texts)] and len(tokens.known) <= 301


@pytest.mark.parametrize("ranks,broadcast_rows", [(packing.RANKS, packing.BROADCAST_ROWS), (7, 0)])
def test_pieces_and_places(spark, monkeypatch, ranks, broadcast_rows):
    monkeypatch.setattr(packing, "RANKS", ranks)
    monkeypatch.setattr(packing, "BROADCAST_ROWS", broadcast_rows)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "of", "Straße", "x1"]) for _ in range(rng.choice([0, 1, 5, 300, 1023, 1024, 3000])))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "same"), (1002, "same"), (None, "no id")]
    got = packing.pack(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, rank int").repartition(5), PATH).collect()
    by_doc, filled = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in rows:
        if doc in (1002, None):
            continue
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and all(r.length == 1024 for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert len(by_doc[1002]) == 2 and len(by_doc[None]) == 1
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(filled) == len(one_by_one([r.length for r in got], 1024))


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
