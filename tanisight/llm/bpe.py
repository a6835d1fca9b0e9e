"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is exactly one token that the encoding of the prefix ends with.
It is the token that is a suffix of the prefix, and that does not merge with the last token of what
is left. An automaton over the vocabulary lists the tokens that end at each byte; a test of the two
tokens' merge histories decides; back-pointers from the end of the piece give its ids.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tanisight.llm.common import as_bytes, id_and_text, slices
from tanisight.llm.encoding import BYTE_SPLIT, SpacedEncoder, byte_of_letter, token_bytes, vocabulary

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NEVER = 1 << 60


class SuffixAutomaton:
    """After reading some bytes, the tokens that are suffixes of them, longest first.

    A trie of the tokens whose failure links lead to the longest proper suffix that is a node too.
    Transitions found over failure links are kept.
    """

    def __init__(self, tokens: dict[bytes, int]):
        self.step: dict[int, int] = {}  # state * 256 + byte -> state
        self.fail, self.ends = [0], [()]
        children: list[list[tuple[int, int]]] = [[]]
        for data, token in tokens.items():
            state = 0
            for byte in data:
                after = self.step.get(state << 8 | byte)
                if after is None:
                    after = self.step[state << 8 | byte] = len(self.fail)
                    self.fail.append(0)
                    self.ends.append(())
                    children.append([])
                    children[state].append((byte, after))
                state = after
            self.ends[state] = ((token, len(data)),)
        trie, queue = dict(self.step), deque(after for _, after in children[0])
        while queue:
            state = queue.popleft()
            self.ends[state] += self.ends[self.fail[state]]
            for byte, after in children[state]:
                back = self.fail[state]
                while back and back << 8 | byte not in trie:
                    back = self.fail[back]
                self.fail[after] = trie.get(back << 8 | byte, 0)
                queue.append(after)

    def next(self, state: int, byte: int) -> int:
        key = state << 8 | byte
        found = self.step.get(key)
        if found is None:
            found = self.step[key] = self.next(self.fail[state], byte) if state else 0
        return found


class PrefixCoder:
    """Exact ids of a byte-level vocabulary with listed merges.

    Words around single spaces, and the pieces that they split into, are kept with their ids; a full
    cache is emptied.
    """

    LIMIT = 300_000

    def __init__(self, path: str):
        letters = byte_of_letter()
        vocab, self.special = vocabulary(path)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        for order, merge in enumerate(merges):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            whole = vocab[a + b]
            self.halves[whole] = vocab[a], vocab[b]
            self.made[whole] = order
            self.rank[vocab[a], vocab[b]] = order
        size = 1 + max(chain(vocab.values(), self.special.values()))
        values = [b""] * size
        for token, i in vocab.items():
            values[i] = token_bytes(token, letters)
        self.automaton = SuffixAutomaton({values[i]: i for i in vocab.values()})
        for token, i in self.special.items():
            values[i] = token.encode()
        self.bytes_of = pa.array(values, pa.large_binary())
        self.listed = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.find = regex.compile(BYTE_SPLIT).findall
        self.find_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.fits: dict[int, bool] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.encode = SpacedEncoder(lambda parts: self.many([" " + p for p in parts]), self.many, self.text).encode

    def spine(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """The tokens at one end of a token's merge tree, each with the rank at which it was used up."""
        used = NEVER
        while True:
            yield token, used
            if token not in self.halves:
                return
            used = self.made[token]
            token = self.halves[token][side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both tokens gives the two tokens again.

        It does unless some merge across their border came first: before its left part was used up
        within `left`, and not after its right part was used up within `right` (of equal merges the
        leftmost goes first).
        """
        for a, a_used in self.spine(left, 1):
            for b, b_used in self.spine(right, 0):
                order = self.rank.get((a, b))
                if order is not None and order < a_used and order <= b_used:
                    return False
        return True

    def learn_pieces(self, new: list[bytes]) -> None:
        """Encode pieces in byte order; what a piece shares with the one before is not done again."""
        step, ends, fits, follow = self.automaton.step, self.automaton.ends, self.fits, self.automaton.next
        last: list[int] = []  # per prefix of the piece: its last token, that token's length, the automaton's state
        lengths: list[int] = []
        states = [0]
        before = b""
        for data in sorted(new):
            same = 0
            for x, y in zip(before, data, strict=False):
                if x != y:
                    break
                same += 1
            del last[same:], lengths[same:], states[same + 1 :]
            state, before = states[-1], data
            for end in range(same, len(data)):
                byte = data[end]
                after = step.get(state << 8 | byte)
                state = follow(state, byte) if after is None else after
                for token, length in ends[state]:
                    if length > end:
                        break
                    pair = last[end - length] << 20 | token
                    good = fits.get(pair)
                    if good is None:
                        if len(fits) >= 1_000_000:
                            fits.clear()
                        good = fits[pair] = self.compatible(pair >> 20, token)
                    if good:
                        break
                last.append(token)
                lengths.append(length)
                states.append(state)
            ids, at = [], len(data) - 1
            while at >= 0:
                ids.append(last[at])
                at -= lengths[at]
            ids.reverse()
            self.pieces[data] = array("I", ids).tobytes()

    def many(self, texts: list[str]) -> list[bytes]:
        found = [[p.encode() for p in self.find(t)] for t in texts]
        pieces = set(chain.from_iterable(found))
        if len(self.pieces) + len(pieces) > self.LIMIT:
            self.pieces.clear()
        self.learn_pieces([p for p in pieces if p not in self.pieces])
        get = self.pieces.__getitem__
        return [get(split[0]) if len(split) == 1 else b"".join(map(get, split)) for split in found]

    def text(self, text: str) -> bytes:
        """A whole text; special tokens stand for themselves."""
        parts = self.find_special(text) if self.find_special else [text]
        return b"".join(array("I", [self.special[p]]).tobytes() if p in self.special else self.many([p])[0] for p in parts)

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of all ids, then text; bytes that are no text become replacement characters."""
        return joined_values(self.bytes_of, ids).decode("utf-8", "replace")


def joined_values(table: pa.Array, ids: np.ndarray) -> bytes:
    """The values of a binary array at the given places, one after the other."""
    if not len(ids):
        return b""
    _, offsets, data = table.take(pa.array(ids)).buffers()
    return data[: int(np.frombuffer(offsets, np.int64, len(ids) + 1)[-1])].to_pybytes()


_CODERS: dict[str, PrefixCoder] = {}


def coder(path: str) -> PrefixCoder:
    if path not in _CODERS:
        _CODERS[path] = PrefixCoder(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode every text, decode the ids, and give the digests of both; with_ids adds array<int>.

    One pass over the scan, without a shuffle. Null and empty text: no ids, the digests of the
    empty string. Repeated rows and doc_ids are rows of their own; an empty table gives no rows.
    """

    def run(batches):
        found = coder(path)
        for batch in slices(batches, 4000):
            ids = found.encode(as_bytes(batch))
            counts = [len(x) for x in ids]
            codes = [hashlib.sha256(joined_values(found.listed, x)[:-1]).hexdigest() for x in ids]
            texts = [hashlib.sha256(found.decode(x).encode()).hexdigest() for x in ids]
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(codes), pa.array(texts)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return id_and_text(docs).mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
