import bisect
import random
import zlib

import numpy as np
import pytest

from riskfold.llm import packing as P
from riskfold.llm.queries import tokenizer_file
from riskfold.llm.token_orc import ids_crc32
from riskfold.llm.tokens import ChunkEncoder


def best_fit_decreasing(sizes, capacity):
    free = []
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(free, s)
        room = free.pop(i) if i < len(free) else capacity
        bisect.insort(free, room - s)
    return len(free)


def _pack(spark, sizes, capacity):
    items = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    got = P.pack_best_fit(items, capacity).collect()
    assert sorted(r.id for r in got) == list(range(len(sizes)))
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, sizes[r.id]))
    for rows in by.values():
        at = 0
        for offset, size in sorted(rows):
            assert offset == at
            at += size
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("kind", ["mixed", "small", "equal", "full", "halves"])
def test_dense_and_gapless(spark, kind):
    rng = random.Random(kind)
    sizes = {
        "mixed": [rng.randint(1, 100) for _ in range(400)],
        "small": [rng.randint(1, 9) for _ in range(300)],
        "equal": [34] * 200 + [70] * 100,
        "full": [100] * 5 + [1],
        "halves": [50] * 7 + [51] * 3,
    }[kind]
    used = _pack(spark, sizes, 100)
    assert used <= best_fit_decreasing(sizes, 100) * 1.02 + 1


def test_no_items(spark):
    assert P.pack_best_fit(spark.createDataFrame([], "id long, size long"), 10).count() == 0


def test_pieces_cover_whole_texts(spark):
    rows = [(1, "word " * 5000, None), (2, None, 3), (3, "", None), (3, "again", 1), (3, "again", 1), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    name = tokenizer_file("word_bpe_49k.json")
    pieces = P.token_pieces(docs, name, 0, 2048)
    got = P.pack_pieces(ids_crc32(pieces), 2048).collect()
    tok = ChunkEncoder(name, False)._tok
    want = []
    for d, t, _ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(d, a // 2048, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for a in range(0, len(ids), 2048)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert len({r.sequence_id for r in got}) == -(-sum(w[3] for w in want) // 2048)
