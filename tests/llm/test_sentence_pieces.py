"""Merge-type pieces against the library, text by text."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD, by_id

from tidemark.llm import sentence_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def cases(model):
    rng = random.Random(1)
    signs = list("aeinrst  lothe\n\t01ÉéàЖи中文😀'.,-_x▁\x00�") + [model.pieces[rng.randrange(259, 32000)] for _ in range(300)]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 20)))
        yield text.replace("a", " " * rng.randint(1, 20)) if rng.random() < 0.2 else text
    yield from (t or "" for t in ODD)
    yield from ("x" * 30000, "中文" * 5000, " " * 3000 + "a", "ab" * 9000 + " é", "<s> </s><0x0A><unk>", "▁" * 40)


def test_encode_and_decode(library):
    model = sentence_pieces.Model(PATH)
    for text in cases(model):
        ids = library.encode(text)
        assert model.encode(text).tolist() == ids, repr(text)
        assert model.decode(ids) == library.decode(ids)


def test_decode_of_any_ids(library):
    model, rng = sentence_pieces.Model(PATH), random.Random(2)
    for _ in range(3000):
        ids = [rng.randrange(32000 if rng.random() < 0.7 else 260) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_cut_and_bounded_caches_change_nothing(library, monkeypatch):
    for limit, value in (("PIECE", 7), ("CACHED", 20), ("CACHED_PAIRS", 20), ("CACHED_CHARS", 4)):
        monkeypatch.setattr(sentence_pieces, limit, value)
    model = sentence_pieces.Model(PATH)
    for text in ("  a few words\nand   more of them, " * 20, "x" * 300 + " y" * 300):
        assert model.encode(text).tolist() == library.encode(text)


def test_dead_ends_are_left_again():
    """A vocabulary in which the longest first token leads nowhere."""
    model = sentence_pieces.Model(PATH)
    left = 0
    for unit in ("▁andthhaha", "▁ofantionedsh", "▁Verstte", "▁anesin", "▁xhesther"):
        taken = model.backtrack(unit)
        left += model.pieces[taken[0]] != max((p for p in model.ids if unit.startswith(p)), key=len)
        assert [model.pieces[i] for i in taken] == model.merged(unit)
    assert left


def test_query(docs, corpus, no_docs, tied, library):
    expected = {}
    for i, text, *_ in corpus:
        ids = library.encode(text or "", add_eos=True)
        expected[i] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode()))
    assert by_id(sentence_pieces.report(docs), "n_tokens", "ids_sha256", "decoded_sha256") == expected
    assert sentence_pieces.report(no_docs).count() == 0
    assert sentence_pieces.report(tied).count() == 6


def test_columns_travel(docs):
    out = sentence_pieces.decode(sentence_pieces.encode(docs, PATH, "doc_id", "row", "kept", end=False), PATH)
    assert out.select("row.*").columns == ["doc_id", "row", "kept"]
    assert out.filter("decoded <> replace(coalesce(row.row, ''), '▁', ' ')").count() == 0


def test_units_together_come_out_as_alone(library):
    """New units of a batch, dead ends and rare signs among them, get the tokens of the scalar way and of the library."""
    read = sentence_pieces.Model(PATH)
    draw = random.Random(12)
    signs = "aeinrstéßÉüñ" * 4 + ".,'-0123#本" + sentence_pieces.BLANK
    units = list({"".join(draw.choices(signs, k=draw.randint(2, 30))) for _ in range(3000)})
    units = [u for u in units if not read.holds_tied(u)]
    taken = read.together(units)
    assert sum(t is not None for t in taken) > len(units) / 2
    for unit, found in zip(units, taken):
        if found is not None and all(c in read.token for c in unit):
            assert np.frombuffer(found, np.int32).tolist() == read.backtrack(unit)
    some = [" ".join(draw.sample(units, 40)).replace(sentence_pieces.BLANK, " ") for _ in range(60)]
    assert [i.tolist() for i in read.encode_all(some)] == library.encode(some)
