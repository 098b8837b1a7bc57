"""Token files against the library as it comes, on texts that hold its added token."""

import zlib

import numpy as np
import public_tokenizers
from helpers import ODD, by_id

from tidemark.llm import token_files

MARK = "<|endoftext|>"


def test_added_tokens(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [f"a {MARK} b", MARK, MARK * 3, f"  {MARK}\n\n{MARK}  x", f"it'{MARK}s <|endoftext|", f"<|endof{MARK}text|>"]
    texts += [f"{t or ''}{MARK}{t or ''}" for t in ODD] + [t or "" for t in ODD] + [f"w{i} {MARK}" * i for i in range(30)]
    expected, at = {}, 0
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        expected[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert by_id(token_files.report(docs), "start", "n_tokens", "ids_crc32") == expected
