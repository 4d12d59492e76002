"""Token operators (4, 8, 9) against the tokenizers library, and packing against plain best fit."""

from __future__ import annotations

import hashlib
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import cases
from tillscope.llm.packing import pack, place, sweep
from tillscope.llm.token_count import token_counts
from tillscope.llm.word_bpe import WordBpe, encode_decode

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_equal_the_library(spark):
    got = token_counts(cases.table(spark), BYTE, limit=100).collect()
    library = Tokenizer.from_file(BYTE)
    want = Counter((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in cases.awkward())
    assert Counter(map(tuple, got)) == want


def test_word_bpe_equals_the_library(spark):
    got = {tuple(r) for r in encode_decode(cases.table(spark), WORD).collect()}
    library, want = Tokenizer.from_file(WORD), set()
    for i, t in cases.awkward():
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == want


def test_backtracking_equals_the_merges_on_random_words():
    r, library, own = random.Random(4), Tokenizer.from_file(WORD), WordBpe(WORD)
    for _ in range(3000):
        w = "".join(r.choice("abcdehinorstß漢🎉'.!1") for _ in range(r.randint(1, 25)))
        assert own.encode(w).tolist() == library.encode(w, add_special_tokens=False).ids


@pytest.mark.parametrize("operator", [lambda d: token_counts(d, BYTE), lambda d: encode_decode(d, WORD), lambda d: pack(d, BYTE)])
def test_empty_tables(spark, operator):
    assert operator(cases.empty(spark)).count() == 0


def best_fit(lengths, capacity):
    gaps = []
    opened = 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        opened += at >= len(gaps) and gap == capacity
        insort(gaps, gap - n)
    return opened


@pytest.mark.parametrize("seed", range(4))
def test_sweep_packs_as_plain_best_fit_decreasing(seed):
    r = random.Random(seed)
    lengths = [min(64, max(1, int(r.lognormvariate(2.5, 1)))) for _ in range(3000)] + [33] * 700
    runs = sweep(dict(Counter(lengths)), 64)
    left, used = Counter(lengths), {}
    order = np.sort(runs, order="key")
    for k, x in enumerate(order):
        length, rank = int(x["key"]) >> 48, int(x["key"]) & (1 << 48) - 1
        following = order[k + 1]["key"] if k + 1 < len(order) and int(order[k + 1]["key"]) >> 48 == length else (length << 48) + left[length]
        for j in range(int(following) - int(x["key"])):
            used.setdefault(int(x["sequence"]) + j, []).append((int(x["offset"]), length))
        assert rank < left[length]
    for places in used.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= 64
    assert sum(map(len, used.values())) == len(lengths)
    assert len(used) <= best_fit(lengths, 64) * 1.005 + 1


def test_pack(spark):
    library = Tokenizer.from_file(BYTE)
    rows = pack(cases.table(spark), BYTE, capacity=256).collect()
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in cases.awkward()}
    pieces = Counter()
    for r in rows:
        mine = ids[r.doc_id]
        assert zlib.crc32(mine[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.length <= 256 and (r.piece == 0 or r.length == 256) and (len(mine) > 256 or r.piece == 0)
        pieces[r.doc_id] += r.length
    assert pieces == Counter({i: len(x) * (2 if i == 2 else 1) for i, x in ids.items()})
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= 256


def test_one_length_for_all(spark):
    """A length that all pieces share is ranked over many tasks and fills sequences to the last."""
    pieces = spark.range(1000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "100L AS length", "id AS ids_crc32")
    rows = place(pieces, 256).collect()
    assert len({r.sequence_id for r in rows}) == 500 and {r.offset for r in rows} == {0, 100}
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000
