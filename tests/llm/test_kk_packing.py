"""Operator 3: exact round trip of every id, and little padding."""
import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

import cases
from cases import SF
from kinlink.llm import kk_packing as K, queries

PATH = queries.PACK_VOCABULARY


def plain_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, got, capacity=4096):
    want = sorted((i if i is not None else -1, ids) for i, ids in ((i, plain_ids(t)) for i, t, *_ in rows))
    by = defaultdict(list)
    places = defaultdict(list)
    for r in got:
        by[r.doc_id if r.doc_id is not None else -1, r.doc_tokens].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    pieces = 0
    for doc_id, ids in want:
        left = by[doc_id, len(ids)]
        at = 0
        while at < len(ids):
            hit = next(r for r in left if r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes()))
            left.remove(hit)
            at += hit.length
            pieces += 1
        assert at == len(ids)
    assert pieces == len(got)
    return len(places), sum(len(ids) for _, ids in want)


def test_word_tokens_equal_the_tokenizer():
    texts = [t for _, t, *_ in cases.awkward()] + ["don't <|endoftext|> x", "a<|startoftext|>b", "́ é Å Å", "ΑΣ Σ İ", "1234 5,6 ...", "\x00 \x85y"]
    for limit in (400_000, 50):
        encode = K.WordTokens(PATH, most_words=limit, at_once=7)
        for _ in range(2):
            for text, got in zip(texts, encode(texts)):
                assert np.frombuffer(got, "<u4").tolist() == plain_ids(text)[:-1], text


def test_differencing():
    r = random.Random(3)
    sizes = [r.randint(1, 512) for _ in range(500)]
    window, sums = K.differencing(sizes, 32)
    assert np.bincount(window, sizes, 32).astype(int).tolist() == sums.tolist()
    assert sums.max() - sums.min() <= 64
    window = K.pack_block([100, 100, 100, 1], 100)     # the count rises until all fit
    assert np.bincount(window, [100, 100, 100, 1]).max() <= 100
    assert K.pack_block([5], 10).tolist() == [0]


def test_awkward_rows(awkward):
    got = K.pack(awkward, PATH).collect()
    check(cases.awkward(), got)
    small = K.pack(awkward, PATH, capacity=64, part=10, spare=1, windows=4).collect()
    check(cases.awkward(), small, 64)


def test_empty(empty):
    assert K.pack(empty, PATH).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sequences, ids = check(rows, queries.op3_packing(spark, SF).collect())
    assert ids / (4096 * sequences) > 0.95
