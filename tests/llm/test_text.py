"""Operators that map texts: round trips, other libraries, brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from helpers import ODD, by_id

from tidemark.llm import byte_bpe, chat_format, fingerprints, piece_counts, pretokens, shingles, token_files, toxicity

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_against_tiktoken():
    rng, signs = random.Random(1), "aéz's  'rve'll'd't're'm\n\t\r   12٣!?\"'--\x1c\x85Ж中😀lLeEvŔ"
    cases = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    cases += [t or "" for t in ODD] + ["a" * 3000, "'" * 500, " " * 200, "zq" * 5000]
    vocab, encoding = byte_bpe.vocabulary(RANKS), tiktoken_encoding()
    for text, ids in zip(cases, vocab.encode(cases)):
        assert ids.tolist() == encoding.encode_ordinary(text)
        assert vocab.decode(ids, vocab.offsets(ids)) == text.encode()


def test_piece_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_BITS", 6)
    vocab, encoding = byte_bpe.Vocabulary(RANKS), tiktoken_encoding()
    for i in range(0, 400, 20):
        words = [f"w{j}x y{j * j}" for j in range(i, i + 20)]
        assert [x.tolist() for x in vocab.encode(words)] == [encoding.encode_ordinary(w) for w in words]


def test_byte_bpe_query(docs, corpus, no_docs):
    encoding = tiktoken_encoding()
    expected = {}
    for i, text, *_ in corpus:
        ids = encoding.encode_ordinary(text or "")
        expected[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode()))
    assert by_id(byte_bpe.report(docs), "n_tokens", "ids_sha256", "decoded_sha256") == expected
    assert byte_bpe.report(no_docs).count() == 0


def test_byte_bpe_round_trip_is_one_python_step(docs):
    """Two steps in a row would keep two Python workers per core on every executor."""
    both = byte_bpe.round_trip(docs, RANKS, "doc_id")
    assert both._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    apart = byte_bpe.decode(byte_bpe.encode(docs, RANKS, "doc_id"), RANKS)
    expected = {r.row.doc_id: (len(r.ids) // 4, bytes(r.ids), sha(r.decoded)) for r in apart.collect()}
    found = both.select("row.doc_id", "n_tokens", "ids", "decoded_sha256")
    assert {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in found.collect()} == expected


def test_token_files(docs, corpus, no_docs, tied, monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    at, expected = 0, {}
    for i, text, *_ in corpus:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert by_id(token_files.report(docs), "start", "n_tokens", "ids_crc32") == expected
    assert token_files.report(no_docs).count() == 0
    assert token_files.report(tied).count() == 6


def test_blocks_decode_from_checkpoints_and_notice_damage():
    ids = np.random.default_rng(3).integers(0, 5000, 300_000).astype(np.uint32) ** 2 // 5000
    table = token_files.Table.of(ids)
    block = token_files.pack([1, None], [1000, len(ids) - 1000], ids, token_files.Table.unpack(table.pack()))
    doc_ids, lengths, n, points, stream = token_files.unpack(block)
    parts = [token_files.decode_ids(n, points, stream, table, k, k + 1) for k in range(len(points))]
    assert len(points) > 1 and (np.concatenate(parts) == ids).all() and doc_ids == [1, None]
    try:
        token_files.unpack(block[:50] + bytes([block[50] ^ 1]) + block[51:])
        raise AssertionError("damage went unnoticed")
    except ValueError:
        pass


def test_frequencies_always_fit():
    for n in (np.ones(50_000), np.r_[np.ones(49_999), 1e12], 1 / np.arange(1, 50_258) ** 3, np.ones(1)):
        _, freq = token_files.scaled(np.arange(len(n)), n)
        assert freq.sum() == 1 << token_files.SCALE_BITS and freq.min() >= 1


def test_piece_counts(docs, corpus, no_docs):
    tokens = set(piece_counts.read_tokens(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    longest = max(map(len, tokens))

    def greedy(word):
        n = at = 0
        while at < len(word):
            at = next(j for j in range(min(len(word), at + longest), at, -1) if word[at:j] in tokens)
            n += 1
        return n

    expected = {}
    for i, text, *_ in corpus:
        words = (text or "").encode().split()
        expected[i] = (len(words), sum(greedy(b" " + w) for w in words))
    assert by_id(piece_counts.report(docs), "n_words", "n_pieces") == expected
    assert piece_counts.report(no_docs).count() == 0


def test_chat_marks_are_reversible():
    rng, path = random.Random(3), public_tokenizers.path("byte_bpe_50k.json")
    signs = ["[INST]", "[/INST]", "</s>", "<s>", "<", "[", "\\", "/s>", "é", "中😀", " ", "\n", "a", "<|endoftext|>", "INST]"]
    for _ in range(500):
        turns = [
            (rng.choice(["user", "assistant", "as[INST]"]), "".join(rng.choices(signs, k=rng.randint(0, 12))))
            for _ in range(rng.randint(1, 4))
        ]
        text, spans = chat_format.render(turns)
        offsets = np.array(chat_format.tokenizer(path).encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
        masked = chat_format.mask(offsets[:, 0], offsets[:, 1], spans)
        loss = chat_format.masked_texts(text, offsets[:, 0], offsets[:, 1], masked)
        assert chat_format.parse(text) == turns
        assert "".join(map(chat_format.unescape, loss)) == "".join(t for r, t in turns if r == "assistant")


def test_chat_query(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "assistant", "x"), (2, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").selectExpr("*", "1 AS starts")
    out = {r.conv_id: r for r in chat_format.report(turns).collect()}
    assert out[1].turns_sha256 == sha(b"user\na\nassistant\nb</s>\n") and out[1].loss_sha256 == sha(b"b</s>")
    assert (out[2].n_turns, out[2].loss_chars) == (2, 0) and out[None].loss_chars == 1
    assert out[-1].loss_sha256 == sha(chat_format.MARKS.encode()) and out[-1].n_turns == 2
    assert chat_format.report(turns.limit(0)).count() == 1


def test_word_and_shingle_hashes(monkeypatch):
    monkeypatch.setattr(shingles, "PART_BYTES", 64)
    data = [(t or "").encode() for t in ODD] + [b"a b c d e f", b"b c d e f"]
    hashes, count = shingles.words(data)
    words = [w for d in data for w in d.split()]
    assert count.tolist() == [len(d.split()) for d in data]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    found, number = shingles.shingles(hashes, count, 5)
    assert number[-2:].tolist() == [2, 1] and found[-1] == found[-2]


def shingle_set(text):
    w = text.encode().split()
    return set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)} - {()}


def test_fingerprints(docs, corpus, no_docs, tied):
    order = sorted(corpus, key=lambda r: -r[0])
    out = {r.doc_id: r for r in fingerprints.report(docs).collect()}
    assert len(out) == len(corpus)
    errors, same = [], {}
    for k, (i, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        changed = fingerprints.edited(text, following)
        assert (out[i].n_chars, out[i].edited_sha256) == (len(text), sha(changed.encode()))
        a, b = shingle_set(text), shingle_set(changed)
        errors.append(abs(out[i].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)))
        assert same.setdefault(text, out[i].fingerprint) == out[i].fingerprint
    assert np.mean(errors) < 0.05 and max(errors) < 0.25
    assert fingerprints.report(no_docs).count() == 0
    assert fingerprints.report(tied).count() == 6


def test_near_pairs(docs, corpus):
    pairs, members = fingerprints.near_pairs(docs)
    sets, named = {}, {}
    for i, text, *_ in corpus:
        found = shingle_set(text or "")
        if found:
            named.setdefault(frozenset(found), i)
    sets = {i: s for s, i in named.items()}
    expected = {(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == expected and expected
    assert by_id(members, "representative") == {
        i: (named.get(frozenset(shingle_set(t or "")), i),) for i, t, *_ in corpus
    }


def test_toxicity_learns_and_ignores_held_out_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 150)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        rows.append((i, " ".join(rng.choices(words, k=30) + ["zounds"] * toxic), "en", int(toxic)))
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, toxic INT")
    extra = spark.createDataFrame([(1000, None, None, None), (1001, "", "en", None)], table.schema)
    both = table.union(extra)
    labels = table.select("doc_id", "toxic")
    scores = {r.row.doc_id: r.score for r in toxicity.scored(both, labels, "doc_id").collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    right = [(scores[i] >= toxicity.PREDICTED) == bool(toxic) for i, _, _, toxic in held]
    assert np.mean(right) > 0.97 and scores[1000] == scores[1001] and all(0 <= s <= 1 for s in scores.values())
    # labels of held-out rows change nothing
    wrong = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1).otherwise(labels.toxic))
    assert {r.row.doc_id: r.score for r in toxicity.scored(both, wrong, "doc_id").collect()} == scores
    assert toxicity.clean(both, labels).count() < both.count()
    assert toxicity.clean(both, labels.limit(0)).count() == both.count()


def test_gradients_are_those_of_the_loss():
    net = toxicity.Network()
    documents = [toxicity.word_rows(t) for t in ("a b c d", "e f", "g h i j k")]
    labels = np.array([1, 0, 1], np.float32)

    def loss():
        p = np.clip(net.score(documents), 1e-7, 1 - 1e-7)
        return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())

    _, dense = net.gradients(documents, labels)
    for weight, gradient in zip([*net.filters, net.bias, net.out, net.rest], dense):
        at = np.unravel_index(np.abs(gradient).argmax(), weight.shape)
        before, step = weight[at], 1e-2
        weight[at] = before + step
        high = loss()
        weight[at] = before - step
        low = loss()
        weight[at] = before
        assert abs((high - low) / (2 * step) - gradient[at]) < 2e-2 * max(0.1, abs(gradient[at]))
