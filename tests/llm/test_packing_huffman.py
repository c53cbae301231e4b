"""Packing and token files against the tokenizer, brute force and round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpuslink.llm import huffman, packing
from corpuslink.llm.tokens import PieceEncoder, slices, tokenizer_path

TOKENIZERS = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", TOKENIZERS)
def test_pieces_give_the_tokenizers_ids(name, rows):
    texts = [r[1] for r in rows] + ["", " ", "a  b", "\n", "x\n\n y", " lead", "trail ", "a\tb",
                                    "I'm we'll\n don't", "\x00 a\x00b", "a" * 300 + " b",
                                    ",. ., a. b, c.,", "x \x1c y", "9. 8,", "...\nA b."]
    enc = PieceEncoder(tokenizer_path(name))
    for _ in range(2):                                   # new, then remembered
        ids, sizes = enc.encode(pa.array(texts, pa.string()))
        at = 0
        for t, n in zip(texts, sizes):
            assert ids[at:at + n].tolist() == enc.tokenizer.encode(
                t or "", add_special_tokens=False).ids, t
            at += n
        assert at == len(ids)


def test_slices_cover_all_rows():
    texts = pa.array(["a" * n for n in (5, 0, 100, 3)] + [None, "b"])
    assert list(slices(texts, 10)) == [(0, 2), (2, 1), (3, 3)]


def brute_cuts(places, cost, window):
    best = {0: (0, [0])}
    for i in range(1, len(places)):
        best[i] = min((best[j][0] + cost[i] + window - (places[i] - places[j]),
                       best[j][1] + [places[i]])
                      for j in range(i) if places[i] - places[j] <= window)
    return best[len(places) - 1][0]


def test_best_cuts_equal_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        window = rng.randrange(8, 30)
        places, cost = [0], [0]
        while len(places) < rng.randrange(2, 40):
            places.append(places[-1] + rng.randrange(1, window + 1))
            cost.append(rng.choice([0, 0, 3, 20]))
        cuts = packing.best_cuts(places, cost, window)
        assert cuts[0] == 0 and cuts[-1] == places[-1]
        at = dict(zip(places, cost))
        total = sum(window - (b - a) + at[b] for a, b in zip(cuts, cuts[1:]))
        assert all(b - a <= window for a, b in zip(cuts, cuts[1:]))
        assert total == brute_cuts(places, cost, window)


def test_every_id_lies_in_one_piece(docs, rows):
    got = packing.piece_digests(packing.pack_documents(docs, window=256, long_sentence=64,
                                                       step=16, segment_tokens=4000)).collect()
    enc = PieceEncoder(tokenizer_path(TOKENIZERS[0]))
    want = sorted((r[0] if r[0] is not None else -1, len(ids) + 1, zlib.crc32(
        np.array(ids + [1], "<u4").tobytes())) for r in rows
        for ids in [enc.tokenizer.encode(r[1] or "", add_special_tokens=False).ids])
    by_seq = defaultdict(list)
    for p in got:
        by_seq[p.sequence_id].append(p)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
    assert sum(p.length for p in got) == sum(n for _, n, _ in want)
    starts = sorted((p.doc_id if p.doc_id is not None else -1, p.doc_tokens) for p in got
                    if p.start == 0)
    assert starts == [(i, n) for i, n, _ in want]
    whole = [(i, n, c) for i, n, c in want if n < 20]
    found = [(p.doc_id if p.doc_id is not None else -1, p.length, p.ids_crc32) for p in got
             if p.length == p.doc_tokens]
    assert all(w in found for w in whole)


def test_little_padding(spark):
    docs = spark.createDataFrame(
        [(i, "\n".join("This is sentence number %d of it." % k for k in range(i % 90 + 1)))
         for i in range(400)], "doc_id long, text string").coalesce(1)
    out = packing.pack_documents(docs, window=256).collect()
    n = len({p.sequence_id for p in out})
    assert 1 - sum(p.length for p in out) / (256 * n) < 0.05


def test_empty_table(none):
    assert packing.pack_documents(none).count() == 0
    assert huffman.round_trip(none).count() == 0


def test_code_lengths_are_optimal_and_limited():
    import heapq
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 300):
        counts = np.zeros(huffman.IDS, np.int64)
        counts[rng.choice(huffman.IDS, n, replace=False)] = rng.integers(1, 1000, n)
        lengths = huffman.code_lengths(counts)
        assert sum(2.0 ** -int(x) for x in lengths if x) <= 1
        heap = [int(x) for x in counts if x]
        heapq.heapify(heap)
        total = heap[0] if n == 1 else 0
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            total += s
            heapq.heappush(heap, s)
        assert (lengths * counts).sum() == total
    counts = np.zeros(huffman.IDS, np.int64)             # Fibonacci: unlimited codes are long
    a, b = 1, 1
    for i in range(60):
        counts[i] = a
        a, b = b, a + b
    lengths = huffman.code_lengths(counts)
    assert lengths.max() == huffman.MAX_BITS
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1


def test_bits_round_trip_at_every_mark():
    rng = np.random.default_rng(2)
    counts = np.zeros(huffman.IDS, np.int64)
    counts[:5000] = rng.integers(1, 10 ** 6, 5000)
    lengths = huffman.code_lengths(counts)
    sizes = np.array([1, 2, 511, 512, 513, 3000, 1])
    ids = rng.integers(0, 5000, sizes.sum()).astype(np.uint16)
    starts, raw, marks, per = huffman.encode_ids(ids, sizes, lengths,
                                                 huffman.canonical_codes(lengths))
    n = np.full(per.sum(), huffman.MARK)
    n[np.cumsum(per) - 1] = sizes - huffman.MARK * (per - 1)
    at = marks + 8 * np.repeat(starts[:-1], per)
    table = huffman.decoding_table(lengths)
    assert (huffman.decode_bits(raw, at, n, table) == ids).all()
    last = np.flatnonzero(np.repeat(np.arange(7), per) == 5)   # one document alone
    assert (huffman.decode_bits(raw, at[last], n[last], table)
            == ids[sizes[:5].sum():sizes[:6].sum()]).all()


def test_files_give_back_all_ids(docs, rows):
    got = huffman.digests(huffman.round_trip(docs, block_ids=700)).collect()
    enc = PieceEncoder(tokenizer_path(TOKENIZERS[1]))
    ids = [(r[0], enc.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2])
           for r in rows]
    assert sorted((g.doc_id if g.doc_id is not None else -1, g.n_tokens, g.ids_crc32)
                  for g in got) == sorted(
        (i if i is not None else -1, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        for i, x in ids)
    at = 0
    for g in sorted(got, key=lambda g: g.start):
        assert g.start == at
        at += g.n_tokens
    named = [g.doc_id for g in sorted(got, key=lambda g: g.start) if g.doc_id is not None]
    assert named == sorted(named)
