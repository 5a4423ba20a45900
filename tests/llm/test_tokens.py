import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskfold.llm import token_orc as O
from riskfold.llm.queries import tokenizer_file
from riskfold.llm.tokens import ChunkEncoder, slices

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
ODD = [
    "", " ", "\n", "a  b", "it's we'll 'tis", "a\x1cb c", "Σίσυφος ΟΔΟΣ. x", "é é ́x y", "x_ y_. z9.",
    "<|endoftext|> a<|startoftext|>b", "a <|endoftext|> b", "<|startoftext|>x", "<|endoftext|>", "x<|endoftext|><|endoftext|>y  z", "<|endoftext |>", "日本語 テスト。", "½. ²! x", "a\tb c", "a\xa0b", "don't! stop", "  lead", "trail ", "naïve Straße, ÀÉ.",
]


@pytest.mark.parametrize("name,spaced", FILES)
def test_same_ids_as_whole_texts(name, spaced):
    rng = random.Random(1)
    alpha = "abZ9 \n.,!'_é́日\t% ²Σß"
    texts = ODD + ["".join(rng.choice(alpha) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    enc, plain = ChunkEncoder(tokenizer_file(name), spaced, cache_chunks=200), Tokenizer.from_file(tokenizer_file(name))
    texts += [t + "<|endoftext|>" + u for t, u in zip(texts[:60], texts[60:120], strict=True)]
    for at, part in slices(pa.array(texts), 500):
        ids, counts = enc.encode(part)
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts[at : at + len(part)]]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [x for w in want for x in w]


def _rows(spark, tmp_path, rows, name="t"):
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, part string")
    path = str(tmp_path / name)
    O.write_token_orc(df, path, tokenizer_file("byte_bpe_50k.json"), 2)
    return path


def test_round_trip(spark, tmp_path):
    rows = [(9, "b c", None, "x"), (3, None, None, None), (None, "n", None, None), (3, "a\n\nb", "1", "2"), (5, "long word " * 30_000, None, None), (9, "b c", None, "x")]
    path = _rows(spark, tmp_path, rows)
    got = O.ids_crc32(O.read_positions(spark, path)).orderBy("start").collect()
    enc = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    full = [(d, [*enc.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, _, _ in rows]
    assert [r.doc_id for r in got] == [None, 3, 3, 5, 9, 9]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((d or 0, len(i), crc(i)) for d, i in full)


def test_lookup_is_pushed_down_and_empty_table(spark, tmp_path):
    path = _rows(spark, tmp_path, [(i, f"text {i}", None, None) for i in range(200)])
    found = O.read_documents(spark, path, [7, 150])
    assert "PushedFilters: [In(doc_id, [" in found._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id for r in found.collect()} == {7, 150}
    assert O.read_positions(spark, _rows(spark, tmp_path, [], "e")).count() == 0


def test_files_are_in_ascending_order(spark, tmp_path):
    path = _rows(spark, tmp_path, [(i * 7 % 500, "w " * (i % 9), None, None) for i in range(500)])
    spans = O.read_documents(spark, path).groupBy("part").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).orderBy("part").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:], strict=False))
