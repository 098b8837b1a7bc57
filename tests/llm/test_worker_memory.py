"""What a Python step leaves in the worker that Spark keeps for later steps."""

import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import byte_bpe, common, toxicity


def taken():
    """MB of this process that no file backs."""
    return int(re.search(r"Anonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.skipif(not hasattr(common._LIBC, "malloc_trim"), reason="another allocator")
def test_freed_memory_is_handed_back():
    pins = []

    def step(batches):
        for batch in batches:
            held = [np.ones(50_000, np.uint8) for _ in range(4000)]  # 200 MB in pieces that are not mapped one by one
            pins.append(held[-1])  # what stays lies above what is freed
            yield batch

    batch = pa.record_batch({"text": ["a"]})
    before = taken()
    assert [b.num_rows for b in common.tidy(step)([batch])] == [1]
    assert taken() - before < 100


def test_what_one_operator_keeps_goes_when_another_comes():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    batch = pa.record_batch({"row": [1, 2], "text": ["some words, and some", None]})
    for _ in range(2):  # kept for the next task of its own, and made anew after others
        for _ in range(2):
            (out,) = common.tidy(lambda b: byte_bpe.encoded_batches(b, path), "byte_bpe")([batch])
            assert out.column("row").to_pylist() == [1, 2]
            assert byte_bpe.vocabulary.cache_info().currsize == 1
        assert len(toxicity.word_rows("some words")) == 2
        list(common.tidy(iter, "toxicity")([batch]))
        assert (byte_bpe.vocabulary.cache_info().currsize, toxicity.hashes.cache_info().currsize) == (0, 1)
        list(common.tidy(iter)([batch]))
        assert toxicity.hashes.cache_info().currsize == 0


@pytest.mark.parametrize("texts", [["the same text", "", "the same text"], []])
def test_a_worker_takes_the_next_task_alike(texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    batch = pa.record_batch({"row": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    one, two = (list(common.tidy(lambda b: byte_bpe.encoded_batches(b, path), "byte_bpe")([batch])) for _ in range(2))
    assert one == two
