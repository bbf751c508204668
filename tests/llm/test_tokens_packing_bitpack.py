import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from strata.llm import bitpack, packing
from strata.llm.tokens import ChunkEncoder

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def whole(path, texts):
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path,joined", [(BYTES, True), (WORDS, False)])
def test_chunks_give_the_ids_of_whole_texts(path, joined):
    rnd = random.Random(1)
    bits = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "é", "É", "ß", "İ", "Σ", "σς", "ÄÖ", "\xa0", "\x1c", "\x85", "1", "23",
            ".", ",", "...", "!?", "中文", "e\u0301", "<|endoftext|>", "\0", "#", "_", " the", "\r\n", "\u200b", "ŉ", "ª"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(5000)]
    got = ChunkEncoder(path, joined, max_cached=300).encode(texts)  # a cache that overflows
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == whole(path, texts)


def test_plan_places_every_piece_and_is_tight():
    rnd = random.Random(2)
    for capacity, n in ((64, 500), (2048, 3000), (10, 50)):
        hist = {}
        for _ in range(n):
            k = min(capacity, max(1, int(rnd.expovariate(4 / capacity))))
            hist[k] = hist.get(k, 0) + 1
        slots = packing.plan_slots(hist, capacity, groups=16)
        used = {}
        for length, count in hist.items():
            mine = np.nonzero(slots["length"] == length)[0]
            for rank in range(count):
                at = mine[np.searchsorted(slots["first"][mine], rank, "right") - 1]
                local = rank - slots["first"][at]
                s = int(slots["sequence"][at] + local // slots["copies"][at])
                used.setdefault(s, []).append((int(slots["offset"][at] + local % slots["copies"][at] * length), length))
        for places in used.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        total = sum(k * v for k, v in hist.items())
        assert len(used) <= -(-total // capacity) * 1.05 + 2
    assert len(packing.plan_slots({}, 2048)["length"]) == 0


def test_packing_round_trip(spark, edge_docs, no_docs):
    rows = packing.pack(edge_docs, BYTES, capacity=64, end_id=0, keep_ids=True).collect()
    texts = [(r.doc_id, r.text or "") for r in edge_docs.select("doc_id", "text").collect()]
    expected = sorted(((d is None, d or 0), ids + [0]) for (d, _), ids in zip(texts, whole(BYTES, [t for _, t in texts])))
    by_doc = {}
    for r in rows:
        assert r.length == len(r.ids) <= 64
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, pieces in by_doc.items():
        own = [ids for (key, ids) in expected if key == (d is None, d or 0)]
        for ids in own:
            starts = sorted({(r.piece, r.start, r.length) for r in pieces if ids[r.start:r.start + r.length] == r.ids})
            assert sum(x[2] for x in starts) >= len(ids)
            assert all(length == 64 for i, _, length in starts if i)
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)
    for s in {r.sequence_id for r in rows}:
        end = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 64
    assert packing.pack(no_docs, BYTES).count() == 0


def test_fixed_width_fields():
    rng = np.random.default_rng(3)
    for bits in (1, 3, 7, 8, 13, 16, 17, 24, 32):
        ids = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
        blob = bitpack.pack_ids(ids, bits)
        assert len(blob) == -(-1001 * bits // 8)
        assert (bitpack.unpack_ids(blob, bits, 0, 1001) == ids).all()
        for start, n in ((0, 0), (5, 9), (1000, 1), (333, 500)):  # random access
            assert (bitpack.unpack_ids(blob, bits, start, n) == ids[start:start + n]).all()
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


@pytest.mark.parametrize("vocabulary", [49_408, 70_000])
def test_files_round_trip(spark, edge_docs, no_docs, tmp_path, vocabulary):
    path = str(tmp_path / "ids")
    bitpack.write_ids(edge_docs, path, WORDS, vocabulary, 2, block_ids=50)
    got = sorted(bitpack.read_documents(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
    texts = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in edge_docs.select("doc_id", "text").collect()))
    start = 0
    assert [r.doc_id for r in got] == [d if ok else None for ok, d, _ in texts]
    for r, ids in zip(got, sorted([(k, whole(WORDS, [k[2]])[0]) for k in texts], key=lambda x: x[0])):
        if r.doc_id is not None:
            assert r.ids == ids[1] + [2]
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    bitpack.write_ids(no_docs, str(tmp_path / "none"), WORDS, vocabulary, 2)
    assert bitpack.read_documents(spark, str(tmp_path / "none")).count() == 0
