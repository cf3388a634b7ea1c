import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import documents, frame
from viewtide.llm import packing
from viewtide.llm.queries import word_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def own_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ.,'s<|>é̸=́ —\n\t1ßΣ\x85\x1c"), max_size=25), max_size=6))
def test_ids_are_the_tokenizers(texts):
    texts = [*texts, "x<|endoftext|>y", "It's WE'LL a'll."]
    encode = packing.Tokenize.at(word_tokenizer())
    encoded = [text.encode() for text in texts]
    offsets = np.cumsum([0, *map(len, encoded)])
    got = encode(np.frombuffer(b"".join(encoded), np.uint8), offsets)
    want = [np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == want


def test_forgets_words_and_learns_them_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encode = packing.Tokenize(word_tokenizer())
    for text in (b"ab cd", b"ef gh", b"ab ij kl mn op"):
        got = encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert got == encode.encode([text])


@pytest.mark.parametrize("capacity, lane_items", [(2048, 20_000), (64, 5)])
def test_packing_is_whole(spark, tokenizer, capacity, lane_items):
    rows = packing.pack_documents(
        frame(spark).select("doc_id", "text", "version"), word_tokenizer(), capacity, True, lane_items=lane_items, fan_in=2
    ).collect()
    want = defaultdict(int)
    for doc in documents():
        ids = own_ids(tokenizer, doc[1])
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[doc[0], piece, at, len(own), zlib.crc32(own.tobytes()), own.tobytes()] += 1
    have = defaultdict(int)
    bins = defaultdict(list)
    for r in rows:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = sum(r.length for r in rows) / capacity
    assert len(bins) <= 1.1 * least + 2


def test_items_that_never_join_end(spark):
    rows = spark.createDataFrame([(k, 0, 60, 1) for k in range(200)], "doc_id long, piece int, length long, ids_crc32 long")
    made = packing.pack_pieces(rows, 100, lane_items=10)
    assert made.select("sequence_id").distinct().count() == 200


def test_empty(spark):
    assert packing.pack_documents(frame(spark, []), word_tokenizer()).collect() == []
