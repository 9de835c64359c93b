"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder."""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of the memo tables of one Python worker, about 150 MB; ``memo`` multiplies them.  Full tables of states and
# pairs are emptied and filled anew, of the pieces those used since the table before was full stay.
MAX_STATES = 100_000
MAX_PAIRS = 250_000
MAX_PIECES = 200_000
# Bits of a trie node's number.
BITS, NODE = 24, (1 << 24) - 1
# Bytes of results sent on at a time.
BATCH = 4 << 20


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks from a file of ``base64 rank`` lines."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


class Transducer:
    """Maps bytes to BPE token ids, reading left to right.

    As a nondeterministic machine it guesses where a token ends: a hypothesis is
    the last token and a node of the trie of all tokens.  A sequence of tokens is
    the BPE encoding exactly if every two neighbours, encoded on their own, stay
    as they are, so a guess is checked against the token before it only.  The
    machine is determinised as it runs: a state is the set of hypotheses with the
    tokens each still owes, and what all of them owe first is emitted.  An open
    hypothesis is at most one token long, which bounds the lookahead by the
    longest token.
    """

    def __init__(self, ranks: dict[bytes, int], memo: float = 1.0):
        self.ranks = ranks
        self.most_states, self.most_pairs = int(MAX_STATES * memo), int(MAX_PAIRS * memo)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.child: dict[int, int] = {}  # 256 * node + byte -> node
        self.token = [-1]
        for word, rank in ranks.items():
            node = 0
            for byte in word:
                step = self.child.get(node << 8 | byte)
                if step is None:
                    step = self.child[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                node = step
            self.token[node] = rank
        self.inner = bytearray(len(self.token))
        for at in self.child:
            self.inner[at >> 8] = 1
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}  # a token and the one before it, in one number
        if len(self.token) > NODE:
            raise ValueError("too many tokens")
        self._reset()

    def _reset(self, state: tuple = (0, ())) -> int:
        """Empty the state tables but for the start and ``state``, whose new number is returned.

        A state is flat: per hypothesis one number of the last token plus one and
        the node, then the tokens it owes.
        """
        self.states = list(dict.fromkeys(((0, ()), state)))
        self.state_id = {s: i for i, s in enumerate(self.states)}
        self.steps: dict[int, int] = {}  # 256 * state + byte -> next state
        self.emits: dict[int, tuple[int, ...]] = {}
        return len(self.states) - 1

    def merge(self, word: bytes, least: int = 1) -> list[int]:
        """The definition: merge the neighbours of lowest rank, leftmost first, until none (or ``least``) is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > least:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token`` last; none for a byte or a token that merges never make."""
        if token not in self.splits:
            word = self.bytes_of[token]
            parts = self.merge(word, 2)
            good = len(word) > 1 and len(parts) == 2
            self.splits[token] = tuple(parts) if good else None
        return self.splits[token]

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: at the start).

        The merges next to the boundary are undone from the latest: no pair
        across it may come before the merge that took one of its sides away.
        """
        if last < 0:
            return len(self.bytes_of[token]) == 1 or self.split(token) is not None
        x, y, before = last, token, None
        while True:
            across = self.ranks.get(self.bytes_of[x] + self.bytes_of[y])
            if across is not None and (before is None or across < before):
                return False
            left, right = self.split(x), self.split(y)
            if left and (x > y or not right):
                before, x = x, left[1]
            elif right:
                before, y = y + 1, right[0]
            else:
                return True

    def _follows(self, last: int, token: int) -> bool:
        pair = (last + 1) << 32 | token
        good = self.pairs.get(pair)
        if good is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            good = self.pairs[pair] = self.fits(-1, token) and self.fits(last, token)
        return good

    def _step(self, state: int, byte: int) -> int:
        after, met = [], False
        child_of, inner, token_of = self.child.get, self.inner, self.token
        hypotheses = iter(self.states[state])
        for place in hypotheses:
            owed = next(hypotheses)
            child = child_of((place & NODE) << 8 | byte)
            if child is None:
                continue
            if inner[child]:
                after += (place & ~NODE | child, owed)
            # a text has one encoding, so one hypothesis at most ends a token here
            if not met and (token := token_of[child]) >= 0 and self._follows((place >> BITS) - 1, token):
                met = True
                after += (token + 1 << BITS, (*owed, token))
        if not after:
            raise ValueError(f"no token for byte {byte}")
        # hypotheses stay in the order of their last boundary, so equal sets are equal tuples
        out = after[1]
        if out:
            for owed in after[3::2]:
                shared = 0
                while shared < len(out) and shared < len(owed) and out[shared] == owed[shared]:
                    shared += 1
                out = out[:shared]
            if out:
                after[1::2] = [owed[len(out) :] for owed in after[1::2]]
        key = tuple(after)
        to = self.state_id.get(key)
        if to is None:
            to = self.state_id[key] = len(self.states)
            self.states.append(key)
        self.steps[256 * state + byte] = to
        if out:
            self.emits[256 * state + byte] = out
        return to

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece; time grows with its length, memory with its tokens only."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out, steps, emits = 0, [], self.steps, self.emits
        for byte in piece:
            at = 256 * state + byte
            state = steps.get(at, -1)
            if state < 0:
                if len(self.states) >= self.most_states:
                    at = 256 * self._reset(self.states[at >> 8]) + byte
                    steps, emits = self.steps, self.emits
                state = self._step(at >> 8, byte)
            if at in emits:
                out.extend(emits[at])
        last = self.states[state]
        for place, owed in zip(last[::2], last[1::2], strict=True):
            if not place & NODE:
                out.extend(owed)
                return out
        raise ValueError("no sequence of tokens makes the piece")


class Pieces(dict):
    """Packed ids by piece of text; the machine runs for pieces not seen lately."""

    def __init__(self, machine: Transducer, memo: float = 1.0):
        super().__init__()
        self.machine, self.most = machine, int(MAX_PIECES * memo)
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.before.get(piece)
        if packed is None:
            packed = array("I", self.machine.encode(piece.encode("utf-8", "surrogatepass"))).tobytes()
            if sys.byteorder == "big":
                packed = np.frombuffer(packed, ">u4").astype("<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class StreamDecoder:
    """Turns token ids into text as they come; bytes of an unfinished character wait.

    The UTF-8 state is (least next byte, greatest next byte, bytes missing after
    it, bytes waiting).  Tokens that hold whole characters leave the start state
    as it is, so only the others (``cut``, one flag per id) take steps.  Invalid
    bytes become U+FFFD, or raise if ``strict``.
    """

    START = (0, 0, 0, 0)

    def __init__(self, bytes_of: dict[int, bytes], strict: bool = False, cut: np.ndarray | None = None):
        self.bytes_of, self.strict = bytes_of, strict
        self.cut = self.flags(bytes_of) if cut is None else cut
        self.state, self.tail = self.START, b""

    @classmethod
    def flags(cls, bytes_of: dict[int, bytes]) -> np.ndarray:
        """Per id whether its bytes begin or end inside a character."""
        out = np.zeros(max(bytes_of, default=0) + 1, bool)
        for token, word in bytes_of.items():
            out[token] = cls._token(cls.START, word) != (cls.START, True)
        return out

    @classmethod
    def byte(cls, state: tuple, b: int) -> tuple[tuple, bool]:
        """(next state, still valid)."""
        low, high, more, waiting = state
        if waiting:
            if low <= b <= high:
                return ((0x80, 0xBF, more - 1, waiting + 1) if more else cls.START), True
            return cls.byte(cls.START, b)[0], False
        if b < 0x80:
            return cls.START, True
        if 0xC2 <= b <= 0xDF:
            return (0x80, 0xBF, 0, 1), True
        if 0xE0 <= b <= 0xEF:
            return (0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF, 1, 1), True
        if 0xF0 <= b <= 0xF4:
            return (0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF, 2, 1), True
        return cls.START, False

    @classmethod
    def _token(cls, state: tuple, word: bytes) -> tuple[tuple, bool]:
        valid = True
        for b in word:
            state, ok = cls.byte(state, b)
            valid &= ok
        return state, valid

    def feed(self, ids: np.ndarray) -> str:
        """Text of the characters that ``ids`` complete."""
        state, valid, after = self.state, True, 0
        for i in np.flatnonzero(self.cut[ids]).tolist():
            if i > after and state != self.START:
                valid, state = False, self.START  # a whole character came too soon
            state, ok = self._token(state, self.bytes_of[int(ids[i])])
            valid, after = valid and ok, i + 1
        if len(ids) > after and state != self.START:
            valid, state = False, self.START
        data = self.tail + b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        waiting = state[3]
        ready, self.tail = (data[:-waiting], data[-waiting:]) if waiting else (data, b"")
        self.state = state
        if not valid and self.strict:
            raise ValueError("tokens are not UTF-8")
        return ready.decode("utf-8", "strict" if valid else "replace")

    def close(self) -> str:
        rest, self.tail, self.state = self.tail, b"", self.START
        if rest and self.strict:
            raise ValueError("text ends inside a character")
        return rest.decode("utf-8", "replace")


_MADE: dict[tuple[str, str], object] = {}


def _made(kind: str, raw: bytes, make):
    """The worker's ``make(raw)`` for a rank file, built once; one file at a time."""
    key = (kind, hashlib.sha256(raw).hexdigest())
    if key not in _MADE:
        for old in [k for k in _MADE if k[1] != key[1]]:
            del _MADE[old]
        _MADE[key] = make(raw)
    return _MADE[key]


def _encoder(raw: bytes, pattern: str, memo: float):
    gc.set_threshold(200_000, 20, 100)  # the memo tables are many small tuples without cycles
    look = _made(f"pieces {memo}", raw, lambda r: Pieces(Transducer(parse_ranks(r), memo), memo)).__getitem__
    find = regex.compile(pattern).findall
    return lambda text: b"".join(map(look, find(text or "")))


def _tables(raw: bytes) -> tuple[dict[int, bytes], np.ndarray]:
    bytes_of = {i: b for b, i in parse_ranks(raw).items()}
    return bytes_of, StreamDecoder.flags(bytes_of)


def _decoder(raw: bytes, block: int):
    bytes_of, cut = _made("tables", raw, _tables)

    def text_of(packed: bytes | None) -> str:
        ids = np.frombuffer(packed or b"", "<u4")
        stream = StreamDecoder(bytes_of, cut=cut)
        parts = [stream.feed(ids[i : i + block]) for i in range(0, len(ids), block)]
        return "".join([*parts, stream.close()])

    return text_of


def _with(docs: DataFrame, column: str, make, fields: list[T.StructField]) -> DataFrame:
    """``docs`` with the columns that ``make()(value)`` gives for ``column``; equal names are replaced.

    Results leave in batches of about BATCH bytes.
    """
    names = {f.name for f in fields}
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in names], F.col(f"`{column}`").alias("_value"))
    width = len(kept.columns) - 1
    kinds = [{"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[f.dataType.typeName()] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for b in batches:
            done, size, out = 0, 0, []
            for i, value in enumerate(b.column(width)):
                out.append(row(value.as_py()))
                size += sum(len(x) for x in out[-1] if not isinstance(x, int))
                if size >= BATCH or i + 1 == b.num_rows:
                    part = b.slice(done, len(out))
                    made = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:width], *made], [*b.schema.names[:width], *(f.name for f in fields)])
                    done, size, out = i + 1, 0, []

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields[:width], *fields]))


def _shared(docs: DataFrame, ranks_file: str):
    with open(ranks_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text_col: str, ranks_file: str, pattern: str, out: str = "ids", memo: float = 1.0) -> DataFrame:
    """``docs`` with n_tokens (long) and ``out`` (binary: ids as little-endian unsigned 32-bit integers).

    Every match of ``pattern`` is encoded on its own, without special tokens.
    Null and empty texts give no tokens.  The rank file is read once on the
    driver; workers keep memo tables of bounded size (``memo`` times the usual
    one), so texts and pieces of any length run in memory of the text itself.
    """
    raw = _shared(docs, ranks_file)

    def make():
        code = _encoder(raw.value, pattern, memo)
        return lambda text: (len(ids := code(text)) // 4, ids)

    return _with(docs, text_col, make, [T.StructField("n_tokens", T.LongType()), T.StructField(out, T.BinaryType())])


def decode(docs: DataFrame, ids_col: str, ranks_file: str, out: str = "decoded", block: int = 65_536) -> DataFrame:
    """``docs`` with the text of ``ids_col`` in ``out``, decoded in blocks of tokens; null ids give an empty text."""
    raw = _shared(docs, ranks_file)

    def make():
        text_of = _decoder(raw.value, block)
        return lambda ids: (text_of(ids),)

    return _with(docs, ids_col, make, [T.StructField(out, T.StringType())])


def round_trip(
    docs: DataFrame, text_col: str, ranks_file: str, pattern: str, out: str = "ids", back: str = "decoded", block: int = 65_536,
    memo: float = 1.0,
) -> DataFrame:
    """``docs`` with n_tokens, ``out`` and, decoded from it, ``back``: ``encode`` and ``decode`` in one pass of one worker."""
    raw = _shared(docs, ranks_file)

    def make():
        code, text_of = _encoder(raw.value, pattern, memo), _decoder(raw.value, block)
        return lambda text: (len(ids := code(text)) // 4, ids, text_of(ids))

    return _with(docs, text_col, make, [
        T.StructField("n_tokens", T.LongType()), T.StructField(out, T.BinaryType()), T.StructField(back, T.StringType())
    ])
