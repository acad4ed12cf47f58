"""What a Python worker holds, and keeps after a task."""

import re
import subprocess
import sys

import pyarrow as pa
import pytest

from spanlink.llm import tokens
from spanlink.llm.common import beside


def test_the_tokenizer_gets_few_texts_of_a_batch_at_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counting(tokenizer_file, kind):
        def encode(texts):
            seen.add(1)
            assert len(texts) <= 512
            return [b"\1\0"] * len(texts)

        return encode

    monkeypatch.setattr(tokens, "encoder", counting)
    pytest.importorskip("public_tokenizers")
    docs = spark.range(3000).coalesce(1).selectExpr("id doc_id", "if(id = 7, null, 'a b') text")
    got = tokens.tokenize(docs, tokens.default_tokenizer()).collect()
    assert [r["doc_id"] for r in got] == list(range(3000)) and {r["n_tokens"] for r in got} == {2} and seen.value >= 6


def test_workers_give_freed_memory_back(spark, monkeypatch):
    given = spark.sparkContext.accumulator(0)
    monkeypatch.setattr("spanlink.llm.common.give_back", lambda: given.add(1))
    run = lambda batch: [pa.array([1] * batch.num_rows, pa.int64())]
    beside(spark.range(10).coalesce(1), ["id"], ["id"], "x long", lambda: run).collect()
    assert given.value >= 1


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_give_back_shrinks_a_process():
    code = """
from pathlib import Path
from spanlink.llm.common import give_back
def mb(): return int(Path('/proc/self/statm').read_text().split()[1]) * 4 // 1024
held = [bytearray(20_000) for _ in range(10_000)]
del held[::2]  # holes among blocks in use
before = mb(); give_back(); print('MB', before, mb())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    before, after = map(int, re.search(r"MB (\d+) (\d+)", out).groups())
    assert after < before - 20
