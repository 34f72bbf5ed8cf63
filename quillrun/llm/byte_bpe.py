"""Byte-level BPE over whole texts, with the ids of repeated words remembered.

The published pattern reads a space only at the start of a pre-token or inside a run of
white space. So a text may be cut before every space, and the segments encoded one by
one, unless a run of white space crosses such a cut; texts with such runs are encoded
whole. Both ways give the same ids.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache
from itertools import filterfalse, islice

import numpy as np
import tiktoken

#: A space between white space and more white space (or the end), and the separators
#: that Python counts as white space and Unicode does not.
UNSAFE = re.compile(r"\s (?:\s|\Z)|[\x1c-\x1f]")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in vocabulary files of this kind.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Words(dict):
    """Ids (little-endian uint32 bytes) of a word with a space before it."""

    def __init__(self, encode, entries: int):
        super().__init__()
        self.encode, self.entries = encode, entries

    def __missing__(self, word: str) -> bytes:
        ids = np.asarray(self.encode(" " + word), dtype="<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[word] = ids
        return ids


class ByteBpe:
    """Encoder and decoder for ranks, a pattern and special strings (none: ordinary)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int],
                 entries: int = 250_000):
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.special = {k: np.asarray([v], dtype="<u4").tobytes() for k, v in special.items()}
        self.cut = (
            re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
            if special
            else None
        )
        self.ordinary = self.encoding.encode_ordinary
        self.words = Words(self.ordinary, entries)
        pieces = dict((v, k) for k, v in ranks.items()) | {
            v: k.encode() for k, v in special.items()
        }
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.opens = np.array([p[:1] == b" " for p in self.pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian uint32 bytes."""
        if self.cut and any(s in text for s in self.special):
            return b"".join(
                self.special[part] if part in self.special else self._plain(part)
                for part in self.cut.split(text)
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if UNSAFE.search(text):
            return np.asarray(self.ordinary(text), dtype="<u4").tobytes()
        return self._joined(text.split(" "))

    def _joined(self, parts: list[str]) -> bytes:
        first = np.asarray(self.ordinary(parts[0]), dtype="<u4").tobytes()
        return first + b"".join(map(self.words.__getitem__, islice(parts, 1, None)))

    def encode_all(self, values: list[str]):
        """``encode`` of each text; their unknown words are first encoded together."""
        part, size = [], 0
        for value in values:
            part.append(value)
            size += len(value)
            if size > 4_000_000:
                yield from self._encode_part(part)
                part, size = [], 0
        yield from self._encode_part(part)

    def _encode_part(self, values: list[str]):
        """A text is split once; its words keep their hashes from one look to the next."""
        split = [
            None
            if self.cut and any(s in value for s in self.special) or UNSAFE.search(value)
            else value.split(" ")
            for value in values
        ]
        self._learn([parts for parts in split if parts])
        for value, parts in zip(values, split, strict=True):
            yield self._joined(parts) if parts else self.encode(value)

    def _learn(self, texts: list[list[str]]) -> None:
        known = self.words.__contains__
        new = set()
        for parts in texts:
            new.update(filterfalse(known, islice(parts, 1, None)))
        if len(new) + len(self.words) > self.words.entries:
            self.words.clear()
            new = set().union(*(islice(parts, 1, None) for parts in texts))
        # Joined by spaces, words without white space in front keep their ids, and every
        # word starts with the only token that starts with a space.
        new = [w for w in new if w and not w[0].isspace() and len(w) <= 64]
        if not new or UNSAFE.search(joined := " " + " ".join(new)):
            return
        ids = np.asarray(self.ordinary(joined), dtype="<u4")
        starts = np.flatnonzero(self.opens[ids]) * 4
        ids = ids.tobytes()
        ends = [*starts[1:].tolist(), len(ids)]
        self.words.update(
            (w, ids[a:b]) for w, a, b in zip(new, starts.tolist(), ends, strict=True)
        )

    def decode(self, ids: bytes) -> bytes:
        """Raw bytes of the ids, put one after the other."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def from_tiktoken(path: str, pattern: str) -> ByteBpe:
    """Encoder of a file of base64 ranks; no special strings."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return ByteBpe(ranks, pattern, {})


@lru_cache(maxsize=4)
def from_json(path: str, pattern: str) -> ByteBpe:
    """Encoder of a byte-level vocabulary file whose ids follow the order of merges.

    Its special strings are found inside texts, as the library for such files does by
    default.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    letters = byte_alphabet()
    ranks = {
        bytes(letters[c] for c in token): i for token, i in described["model"]["vocab"].items()
    }
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    for text in special:
        ranks.pop(text.encode(), None)
    return ByteBpe(ranks, pattern, special)
