"""Token ids of whole texts, equal to those of the tokenizers library, from its vocabulary files.

Most texts take a faster path with the same result; tests compare both. Byte-pair merging by the
rank of the joined bytes equals merging by the listed pairs when every token of the vocabulary
encodes to itself, as here. Texts in characters whose Unicode class may differ between the two
splitting engines, and texts that contain the string of a special token, go to the library itself.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken

#: Splitting patterns of the two vocabularies (fixed values of their files).
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters of long-standing class: Latin, Greek, Cyrillic, punctuation, kana, Han, Hangul.
PLAIN_TEXT = re.compile(r"[\t\n\r -~¡-ɏΑ-ΡΣ-ώЀ-џ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]*\Z")
PLAIN_WORD = re.compile(r"[!-~¡-ɏ]*\Z")  # nothing here changes under canonical composition
RUNS = (b"  ", b"\n ", b" \n", b"\n\n", b"\t", b"\r")
CONTROL = (b"\v", b"\f", b"\x1c", b"\x1d", b"\x1e", b"\x1f")
SPECIAL = "<|"
END = "</w>"


def byte_of_letter() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def vocabulary(path: str) -> tuple[dict[str, int], dict[str, int]]:
    """Token -> id, and special token -> id."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return {t: i for t, i in content["model"]["vocab"].items() if t not in special}, special


def token_bytes(token: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in token)


def open_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def is_plain(text: str) -> bool:
    return SPECIAL not in text and (text.isascii() or PLAIN_TEXT.match(text) is not None)


def has_runs(text: str, data: bytes) -> bool:
    """Whether white space other than single spaces and line ends occurs in a plain text."""
    return any(r in data for r in RUNS) or text.isascii() and any(c in data for c in CONTROL)


class Cache(dict):
    """Part -> ids as bytes. Emptied when it would hold over LIMIT parts or SIZE bytes of parts and ids; that
    only costs time."""

    LIMIT = 100_000
    SIZE = 16 << 20

    def __init__(self, learn):
        super().__init__()
        self.learn, self.size = learn, 0

    def ids(self, parts: list) -> list[bytes]:
        found = list(map(self.get, parts))
        if None in found:
            new = [p for p, x in zip(parts, found, strict=True) if x is None]
            learned = dict(zip(new, self.learn(new), strict=True))
            size = sum(map(len, learned)) + sum(map(len, learned.values()))
            if len(self) + len(new) > self.LIMIT or self.size + size > self.SIZE:
                self.clear()
                self.size = 0
            if size <= self.SIZE:
                self.update(learned)
                self.size += size
            found = [learned[p] if x is None else x for p, x in zip(parts, found, strict=True)]
        return found


def joined(found: list[bytes], index: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Ids of documents whose parts are found[index[offsets[d] : offsets[d + 1]]]."""
    data = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    begins = np.cumsum(sizes) - sizes
    counts = sizes[index]
    ends = np.append(0, np.cumsum(counts))
    ids = data[np.repeat(begins[index] - ends[:-1], counts) + np.arange(ends[-1])]
    bounds = ends[offsets].tolist()
    return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


class Encoder:
    """Ids of documents as arrays of unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = open_tokenizer(path)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class SpacedEncoder:
    """Byte-level documents by their parts around single spaces.

    Splitting puts a space in front of what follows, so no token spans the place before a single
    space; parts can be encoded once each. Arrow finds the distinct parts of a slice of documents.
    """

    def __init__(self, part_ids, head_ids, text_ids):
        """part_ids, head_ids: ids of many parts behind a space, or without; text_ids: of any text."""
        self.parts, self.heads, self.text_ids = Cache(part_ids), Cache(head_ids), text_ids

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        regular = []
        for i, data in enumerate(texts):
            text = data.decode("utf-8", "replace")
            if is_plain(text) and not has_runs(text, data):
                regular.append(i)
            else:
                out[i] = np.frombuffer(self.text_ids(text), "<u4")
        if not regular:
            return out
        split = pc.split_pattern(pa.array([texts[i] for i in regular], pa.large_binary()).cast(pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy().copy()
        offsets = split.offsets.to_numpy()
        heads, where = np.unique(index[offsets[:-1]], return_inverse=True)
        index[offsets[:-1]] = len(words) + where
        found = self.parts.ids(words) + self.heads.ids([words[h] for h in heads])
        for i, ids in zip(regular, joined(found, index, offsets), strict=True):
            out[i] = ids
        return out


class ByteEncoder(Encoder):
    """Byte-level vocabularies. Looking ahead only matters where white space follows white space."""

    def __init__(self, path: str):
        super().__init__(path)
        letters = byte_of_letter()
        ranks = {token_bytes(t, letters): i for t, i in vocabulary(path)[0].items()}
        self.full = tiktoken.Encoding("full", pat_str=BYTE_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.single = tiktoken.Encoding("single", pat_str=BYTE_SPLIT.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out = []
        for data in texts:
            text = data.decode("utf-8", "replace")
            if not is_plain(text):
                out.append(np.frombuffer(self.whole(text), "<u4"))
                continue
            found = (self.full if has_runs(text, data) else self.single).encode_to_numpy(text, disallowed_special=())
            out.append(found.astype("<u4", copy=False))
        return out


class WordEncoder(Encoder):
    """Vocabularies that drop case and white space and mark the ends of words.

    The end mark becomes the byte 0, which plain words do not hold: a word's last byte and its mark
    are then the first to merge. Each distinct word around ASCII white space is encoded once.
    """

    def __init__(self, path: str):
        super().__init__(path)
        letters = byte_of_letter()
        ranks, final = {}, set()
        for token, i in vocabulary(path)[0].items():
            if token.endswith(END):
                ranks[token_bytes(token.removesuffix(END), letters) + b"\0"] = i
                final.add(i)
            else:
                ranks[token_bytes(token, letters)] = i
        self.is_final = np.zeros(max(ranks.values()) + 1, bool)
        self.is_final[list(final)] = True
        self.fast = tiktoken.Encoding("word", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.find = regex.compile(WORD_SPLIT).findall
        self.known = Cache(self.many)

    def many(self, words: list[str]) -> list[bytes]:
        out = [b""] * len(words)
        pieces, counts, plain = [], [], []
        for at, word in enumerate(words):
            if not PLAIN_WORD.match(word) or SPECIAL in word:
                out[at] = self.whole(word)
                continue
            word = word.lower()
            plain.append(at)
            if word.isascii() and word.isalpha():
                pieces.append(word)
                counts.append(1)
            else:
                found = self.find(word)
                pieces += found
                counts.append(len(found))
        if pieces:
            ids = self.fast.encode_to_numpy("\0".join(pieces) + "\0", disallowed_special=())
            ends = np.append(0, (np.flatnonzero(self.is_final[ids]) + 1) * 4)[np.cumsum(counts)].tolist()
            data, start = ids.astype("<u4", copy=False).tobytes(), 0
            for at, end in zip(plain, ends, strict=True):
                out[at] = data[start:end]
                start = end
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        marked = {i: self.whole(x.decode("utf-8", "replace")) for i, x in enumerate(texts) if SPECIAL.encode() in x}
        lower = pc.ascii_lower(pa.array([b"" if i in marked else x for i, x in enumerate(texts)], pa.large_binary()).cast(pa.large_string()))
        split = pc.ascii_split_whitespace(lower)  # an empty word at the end of a text has no ids
        coded = split.flatten().dictionary_encode()
        out = joined(self.known.ids(coded.dictionary.to_pylist()), coded.indices.to_numpy(), split.offsets.to_numpy())
        for i, ids in marked.items():
            out[i] = np.frombuffer(ids, "<u4")
        return out


_OPEN: dict[tuple[str, type], Encoder] = {}


def encoder(path: str, kind: type[Encoder]) -> Encoder:
    """The encoder of this worker process, kept between the tasks of a stage; only the last one used is kept."""
    if (path, kind) not in _OPEN:
        _OPEN.clear()
        _OPEN[path, kind] = kind(path)
    return _OPEN[path, kind]
