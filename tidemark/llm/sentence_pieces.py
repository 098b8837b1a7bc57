"""SentencePiece encoding and decoding: exact merges found by backtracking, not by merging.

A model of merge type joins the adjacent pair whose concatenation scores best until none
is in the vocabulary.  A sequence of tokens is that result exactly when every token is its
own result and every two neighbours, merged anew from their characters, come out as
themselves.  So a text is encoded from the left: Aho-Corasick gives the longest token at
every position, a token is taken when it is compatible with the one before, shorter ones
are tried next, and a bitfield remembers the positions from which nothing leads on.

The rule rests on an order of tokens.  Where tokens of a model share a score (runs of
blanks), the order also depends on the place; units that hold such a token are merged
pair by pair instead.

No token reaches from another character into a blank, or over a character that no token
holds, so a text falls into units there, and results of short units are kept.  New units of
a batch go through the automaton and from token to token together, a step of all of them
at a time in numpy; one from which no token leads on is traced back by itself.

Defined results
    NULL and empty texts have the end id alone and decode to the empty text.  A character
    without a token becomes its UTF-8 bytes' tokens.  U+2581 is the model's sign for a blank and
    decodes to one, as in the library.  Rows map one to one (ties, repeated rows and empty
    tables need no rule); the caller's columns travel in one struct.  A text of any length
    is encoded whole, in pieces of ``PIECE`` characters cut between units.
"""

import codecs
import heapq
import re
from array import array
from collections import Counter, defaultdict
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, texts

#: The blank inside a model, as the library writes it (fixed value).
BLANK = "▁"
#: Units kept with their ids per worker, the longest kept; pairs and steps of the automaton kept.
CACHED, CACHED_CHARS, CACHED_PAIRS, CACHED_STEPS = 400_000, 48, 1_000_000, 200_000
#: Signs that units encoded together may hold, Latin-1 and the most frequent ones in tokens; places for
#: their pairs, by hash; units that are tried together, and at the end each by itself.
SIGNS, PLACES, TOGETHER, FEW = 192, 1 << 20, 1 << 15, 16
#: Bytes of text per output batch, characters cut into units at a time.
SLICE_BYTES, PIECE = 1 << 20, 1 << 20

_NEVER = float("inf")
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Longest:
    """Aho-Corasick over reversed tokens: a match that ends somewhere in the reversed text begins there in the text.

    A state knows the longest token that ends in it, its own or that of its failure link.
    Transitions found through failure links are kept, up to ``CACHED_STEPS``.
    """

    def __init__(self, tokens):
        step, token = [{}], [-1]  # state -> sign -> state; state 0 is the root
        for text, number in tokens.items():
            state = 0
            for sign in reversed(text):
                following = step[state].get(sign)
                if following is None:
                    step[state][sign] = following = len(token)
                    step.append({})
                    token.append(-1)
                state = following
            token[state] = number
        link, level = [0] * len(token), [0]
        while level:  # links of a state rest on those of shorter strings
            here = []
            for parent in level:
                for sign, state in step[parent].items():
                    here.append(state)
                    if parent:
                        at = link[parent]
                        while sign not in step[at] and at:
                            at = link[at]
                        link[state] = step[at].get(sign, 0)
                    if token[state] < 0:
                        token[state] = token[link[state]]
            level = here
        self.step, self.link, self.token, self.room = step, link, token, CACHED_STEPS

    def _resolve(self, state, sign):
        at = self.link[state]
        while sign not in self.step[at] and at:
            at = self.link[at]
        following = self.step[at].get(sign, 0)
        if self.room:
            self.step[state][sign] = following
            self.room -= 1
        return following

    def __call__(self, unit):
        """The longest token that begins at each sign, or -1."""
        step, token, state, out = self.step, self.token, 0, []
        for sign in reversed(unit):
            following = step[state].get(sign)
            state = self._resolve(state, sign) if following is None else following
            out.append(token[state])
        out.reverse()
        return out


class Together:
    """Backtracking of many units at once: each turn tries one token of every unit.

    The automaton's steps on ``SIGNS`` signs are a table, those that follow
    failure links included.  Pairs that were checked are kept by the hash of the pair.
    """

    def __init__(self, model):
        self.model, matches = model, model.matches
        times = Counter(sign for text in model.token for sign in text)
        common = sorted(times, key=lambda sign: (sign > "\xff" and sign != BLANK, -times[sign], sign))[: SIGNS - 1]
        self.number = np.zeros(0x110000, np.uint8)  # 0: a sign that is not among them
        self.number[[ord(sign) for sign in common]] = np.arange(1, len(common) + 1)
        number = {sign: n for n, sign in enumerate(common, 1)}
        step = np.zeros((len(matches.token), SIGNS), np.int32)
        level = [0]
        while level:  # links lead to states of earlier levels
            for state in level:
                if state:
                    step[state] = step[matches.link[state]]
                for sign, following in matches.step[state].items():
                    if sign in number:
                        step[state, number[sign]] = following
            level = [following for state in level for following in matches.step[state].values()]
        self.step, self.token = step.ravel(), np.array(matches.token, np.int32)
        self.size = np.array(model.size, np.int64)
        self.shorter = np.array([model.next_shorter(i) for i in range(len(model.size))], np.int32)
        self.pairs, self.known = np.full(PLACES, -1, np.int64), np.zeros(PLACES, bool)

    def compatible(self, left, token):
        """Which pairs come out when merged anew; ``left`` is -1 at the beginning."""
        pair = (left + 1) * len(self.size) + token
        place = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) % PLACES
        out, new = self.known[place], np.flatnonzero(self.pairs[place] != pair)
        if len(new):
            _, first, same = np.unique(pair[new], return_index=True, return_inverse=True)
            one = new[first]
            found = [self.model.fits(a, b) for a, b in zip(left[one].tolist(), token[one].tolist())]
            out[new] = np.array(found)[same]
            self.pairs[place[one]], self.known[place[one]] = pair[one], found
            # of two pairs in one place the later stays, with its own answer
        return out

    def longest(self, code, start, size):
        """The longest token that begins at each sign of all units, longer units first."""
        out, state = np.empty(len(code), np.int32), np.zeros(len(size), np.int64)
        last = start + size - 1
        many = np.searchsorted(-size, -np.arange(size[0]), "left")  # units of more than 0, 1, ... signs
        for back, n in enumerate(many.tolist()):
            at = last[:n] - back
            state[:n] = self.step[state[:n] * SIGNS + code[at]]
            out[at] = self.token[state[:n]]
        return out

    def __call__(self, units):
        """Tokens of every unit as bytes of 32-bit numbers, None where a sign is rare or the way is long."""
        order = sorted(range(len(units)), key=lambda i: -len(units[i]))
        size = np.array([len(units[i]) for i in order], np.int64)
        stop = np.cumsum(size)
        start = stop - size
        code = self.number[np.frombuffer("".join([units[i] for i in order]).encode("utf-32-le"), np.uint32)]
        longest = self.longest(code, start, size)
        done = np.logical_or.reduceat(code == 0, start)
        lost = done.copy()
        # by place: no way leads on from here, the token taken here, where the one before began
        failed, took, came = np.zeros(len(code) + 1, bool), np.zeros(len(code), np.int32), np.zeros(len(code), np.int64)
        unit = np.flatnonzero(~done)
        at, left, token = start[unit], np.full(len(unit), -1, np.int64), longest[start[unit]].astype(np.int64)
        while len(unit) > FEW:
            back = np.flatnonzero(token < 0)
            if len(back):
                failed[at[back]] = True
                at[back] = here = came[at[back]]
                token[back] = took[here]
                first = here == start[unit[back]]
                left[back] = np.where(first, -1, took[came[here]])
                token[back] = self.shorter[token[back]]
            to = at + self.size[token]
            ends = to == stop[unit]
            good = (token >= 0) & (ends | ~failed[to])
            some = np.flatnonzero(good)
            good[some] = self.compatible(left[some], token[some])
            some = np.flatnonzero(good)
            took[at[some]] = token[some]
            on = some[~ends[some]]
            came[to[on]] = at[on]
            bad = np.flatnonzero(~good & (token >= 0))
            token[bad] = self.shorter[token[bad]]
            at[on], left[on], token[on] = to[on], token[on], longest[to[on]]
            if len(some) > len(on):
                open_ = np.flatnonzero(~(good & ends))
                unit, at, left, token = unit[open_], at[open_], left[open_], token[open_]
        lost[unit] = True
        unit = np.flatnonzero(~lost)
        at, taken = start[unit], []
        while len(unit):
            taken.append((unit, took[at]))
            at = at + self.size[took[at]]
            unit, at = unit[at < stop[unit]], at[at < stop[unit]]
        if not taken:
            return [None] * len(units)
        unit = np.concatenate([u for u, _ in taken])
        tokens = np.concatenate([t for _, t in taken])[np.argsort(unit, kind="stable")].tobytes()
        ends = (4 * np.cumsum(np.bincount(unit, minlength=len(units)))).tolist()
        out, begin = [None] * len(units), 0
        for i, end, no in zip(order, ends, lost.tolist()):
            if not no:
                out[i] = tokens[begin:end]
            begin = end
        return out


class Model:
    """Tokens of a merge-type model and the tables that encoding needs."""

    def __init__(self, path):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_file=path)
        if read.normalize("  a ｂ ") != f"{BLANK * 3}a ｂ{BLANK}":
            raise ValueError(f"{path} normalises texts; only models that keep them are supported")
        size = read.vocab_size()
        self.end, self.unknown = read.eos_id(), read.unk_id()
        piece = [read.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (read.is_control(i) or read.is_unknown(i) or read.is_byte(i) or read.is_unused(i))]
        self.byte = {int(piece[i][3:5], 16): i for i in range(size) if read.is_byte(i)}
        if len(self.byte) != 256:
            raise ValueError(f"{path} has no tokens for bytes")
        self.ids = {piece[i]: i for i in plain}
        self.order = {piece[i]: -read.get_score(i) for i in plain}
        times = {}
        for score in self.order.values():
            times[score] = times.get(score, 0) + 1
        signs = set().union(*self.ids)
        # characters that only longer tokens hold stand for their bytes
        self.pieces = {**dict(enumerate(piece)), **{size + n: c for n, c in enumerate(sorted(signs - self.ids.keys()))}}
        self.size = [len(self.pieces[i]) for i in range(len(self.pieces))]
        self.token = {**self.ids, **{p: i for i, p in self.pieces.items() if i >= size}}
        self.expanded = {i: [self.byte[b] for b in self.pieces[i].encode()] for i in range(size, len(self.pieces))}
        tied = [p for p, score in self.order.items() if len(p) > 1 and times[score] > 1]
        self.tied = [t for t in tied if not any(u in t for u in tied if u != t)]  # the others hold one of these
        self.longest = max(map(len, self.order))
        self.matches = Longest(self.token)
        self.neighbours = {p[i : i + 2] for p in self.token for i in range(len(p) - 1)}
        self.shorter, self.pairs, self.n_pairs, self.units = {}, defaultdict(dict), 0, {}
        self.holds_tied = re.compile("|".join(map(re.escape, self.tied)) or "(?!)").search
        inner = "".join(map(re.escape, sorted(signs - {BLANK})))
        self.cut = re.compile(f"{BLANK}*[{inner}]+|{BLANK}+|.", re.DOTALL)
        self.edge = re.compile(f"(?<=[^{BLANK}]){BLANK}")
        self.decoded = [p.replace(BLANK, " ").encode() for p in piece]
        for i in range(size):
            if read.is_control(i):
                self.decoded[i] = b""
        for value, i in self.byte.items():
            self.decoded[i] = bytes([value])
        self.decoded[self.unknown] = " ⁇ ".encode()
        self.silent = frozenset(i for i in range(size) if read.is_control(i))
        self.led = frozenset(i for i in plain if piece[i].startswith(BLANK))

    # -- merging, for compatibility and for tied tokens ----------------------------------

    def merged(self, text, edge=0):
        """Join the best pair, the leftmost first, until none is a token; None once a pair crosses ``edge``."""
        find, parts = self.order.get, list(text)
        best = [find(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while best and (low := min(best)) < _NEVER:
            at = best.index(low)
            if at == edge - 1:  # ``edge`` counts parts
                return None
            edge -= at < edge
            parts[at] += parts.pop(at + 1)
            del best[at]
            if at < len(best):
                best[at] = find(parts[at] + parts[at + 1], _NEVER)
            if at:
                best[at - 1] = find(parts[at - 1] + parts[at], _NEVER)
        return parts

    def tied_merged(self, unit):
        """A unit that may hold tied tokens, merged with a queue by score and place."""
        order, n = self.order, len(unit)
        end, after, before, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue = [(s, i, i + 2) for i in range(n - 1) if (s := order.get(unit[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            for a, b in ((i, after[i]), (before[i], i)):
                if b < n and a >= 0:
                    before[b] = a
                    if end[b] - a <= self.longest and (s := order.get(unit[a : end[b]])) is not None:
                        heapq.heappush(queue, (s, a, end[b]))
        return [self.token[unit[i : end[i]]] for i in range(n) if alive[i]]

    # -- backtracking -------------------------------------------------------------------

    def compatible(self, left, right):
        """Whether both come out when their characters are merged; no left one (-1) at the beginning."""
        first = "" if left < 0 else self.pieces[left]
        if self.n_pairs >= CACHED_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        parts = self.merged(first + self.pieces[right], len(first))
        known = parts is not None and len(parts) == 2 - (left < 0)
        self.pairs[left][right] = known
        return known

    @cached_property
    def together(self):
        return Together(self)

    def fits(self, left, right):
        known = self.pairs[left].get(right)
        return self.compatible(left, right) if known is None else known

    def next_shorter(self, token):
        """The longest token that begins ``token``, or -1."""
        text = self.pieces[token]
        found = next((self.token[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.token), -1)
        self.shorter[token] = found
        return found

    def backtrack(self, unit):
        """Tokens of a unit: the longest compatible one each time, back again where none leads on."""
        size, shorter, pairs, longest, n = self.size, self.shorter, self.pairs, self.matches(unit), len(unit)
        failed, at, left, taken, token = None, 0, -1, [], longest[0]
        after = pairs[left]
        while True:
            while token >= 0:
                to = at + size[token]
                if failed is None or not failed[to >> 3] >> (to & 7) & 1:
                    known = after.get(token)
                    if known or known is None and self.compatible(left, token):
                        break
                token = shorter[token] if token in shorter else self.next_shorter(token)
            else:
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                token = taken.pop()
                at -= size[token]
                left = taken[-1] if taken else -1
                after = pairs[left]
                token = shorter[token] if token in shorter else self.next_shorter(token)
                continue
            taken.append(token)
            if to == n:
                return taken
            at, left = to, token
            after = pairs[left]
            token = longest[at]

    def word_end(self, unit):
        """Where signs behind a word begin, as far as no token holds the last letter and the first sign."""
        end = len(unit)
        while end > 1 and not unit[end - 1].isalnum() and unit[end - 1] != BLANK:
            end -= 1
        return end if unit[end - 1 : end + 1] not in self.neighbours else len(unit)

    def _ids(self, taken):
        """Tokens as bytes of 32-bit numbers, characters without a token of their own by their bytes' tokens."""
        if self.expanded:
            taken = [i for token in taken for i in self.expanded.get(token, (token,))]
        return array("i", taken).tobytes()

    def _encode(self, unit):
        """Ids of one unit, as bytes."""
        if len(unit) == 1 and unit not in self.token:
            return array("i", [self.byte[b] for b in unit.encode()]).tobytes()
        end = self.word_end(unit)
        if end < len(unit):
            return self._encode(unit[:end]) + self._encode(unit[end:])
        if self.holds_tied(unit):
            return self._ids(self.tied_merged(unit))
        return self._ids(self.backtrack(unit))

    def learn(self, units):
        """Keep the ids of units that are not kept yet, all but long ones."""
        kept, split, alone, whole = self.units, [], [], set()
        for unit in units:
            if len(unit) > CACHED_CHARS:
                continue
            end = len(unit) if unit[-1].isalnum() else self.word_end(unit)
            if end < len(unit):
                split.append((unit, unit[:end], unit[end:]))
                whole.update(part for part in split[-1][1:] if part not in kept)
            else:
                whole.add(unit)
        for unit in whole:
            if len(unit) == 1 or self.holds_tied(unit):
                kept[unit] = self._encode(unit)
            else:
                alone.append(unit)
        for i in range(0, len(alone), TOGETHER):
            some = alone[i : i + TOGETHER]
            for unit, taken in zip(some, self.together(some)):
                if taken is None:
                    taken = self._encode(unit)
                elif self.expanded:
                    taken = self._ids(np.frombuffer(taken, np.int32).tolist())
                kept[unit] = taken
        for unit, word, signs in split:
            kept[unit] = kept[word] + kept[signs]

    def cut_up(self, text):
        """Units of a text, in pieces of about ``PIECE`` signs."""
        if not text:
            return
        text, start = BLANK + text.replace(" ", BLANK), 0
        while start < len(text):
            stop = len(text)
            if stop - start > PIECE and (found := self.edge.search(text, start + PIECE)):
                stop = found.start()
            yield self.cut.findall(text, start, stop), stop - start
            start = stop

    def encode_all(self, some):
        """Ids of every text without the end id, as arrays."""
        out, held, room = [array("i") for _ in some], [], PIECE

        def settle():
            if len(self.units) > CACHED:
                self.units.clear()
            ids = [list(map(self.units.get, units)) for _, units in held]
            self.learn({unit for (_, units), some in zip(held, ids) if None in some for unit, i in zip(units, some) if i is None})
            for (number, units), some in zip(held, ids):
                if None in some:
                    some = [i or self.units.get(unit) or self._encode(unit) for unit, i in zip(units, some)]
                out[number].frombytes(b"".join(some))
            held.clear()

        for number, text in enumerate(some):
            for units, signs in self.cut_up(text):
                held.append((number, units))
                room -= signs
                if room < 0:
                    settle()
                    room = PIECE
        settle()
        return out

    def encode(self, text):
        """Ids of a text without the end id, as an array."""
        return self.encode_all([text])[0]

    def decode(self, ids):
        """The text of any ids: the first blank goes, bytes that are no character are U+FFFD."""
        first = next((i for i in ids if i not in self.silent), None)
        whole = b"".join(map(self.decoded.__getitem__, ids))
        return (whole[1:] if first in self.led else whole).decode("utf-8", "each_byte")


@lru_cache(2)
def model(path):
    return Model(path)


# -- over tables -------------------------------------------------------------------


def encode(docs: DataFrame, path: str, *keep: str, end=True, back=False) -> DataFrame:
    """``row`` (a struct of ``keep``) and ``ids`` of every text, with the end id last.

    With ``back`` also the text that the ids stand for, ``decoded``, without a second step.
    ``path`` names a model file that every executor can open.
    """
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    if back:
        schema = schema.add("decoded", T.StringType())

    def run(batches):
        loaded = model(path)
        for batch in slices(batches, "text", SLICE_BYTES):
            flat, ends, decoded = array("i"), [0], []
            for found in loaded.encode_all(texts(batch)):
                if end:
                    found.append(loaded.end)
                flat.extend(found)
                ends.append(len(flat))
                if back:
                    decoded.append(loaded.decode(found))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))
            columns = [batch.column("row"), ids] + [pa.array(decoded, pa.string())] * back
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``row``, ``ids`` and the text they stand for, ``decoded``."""
    schema = T.StructType([*encoded.select("row", "ids").schema, T.StructField("decoded", T.StringType())])

    def run(batches):
        loaded = model(path)
        for batch in batches:
            ids = batch.column("ids")
            out = [loaded.decode(i.values.to_pylist()) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids, pa.array(out, pa.string())], ["row", "ids", "decoded"])

    return encoded.select("row", "ids").mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode(docs, path, "doc_id", back=True).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
