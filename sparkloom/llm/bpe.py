"""Byte-level BPE: exact encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary is a tokenizers JSON file (byte-level pre-tokenizer without prefix space, no normalizer).
A text is cut into units at places where the pre-tokenizer always cuts, so a unit's ids do not depend on its
surroundings; each worker remembers the ids of recent units.
"""

from __future__ import annotations

import json
import re

import regex

#: The pre-tokenizer's pattern as published with the vocabulary (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters with the Unicode property White_Space (fixed value).
SPACE = " \t\n\x0b\x0c\r\x85\xa0  -     　"
_DOUBLE = re.compile(f"[{SPACE}][{SPACE}]")
_RUNS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairTree:
    """Minimum tree over the ranks of adjacent pairs, of fan-out WIDTH.

    Level 0 holds a rank for each symbol (the pair it starts), each higher level the minimum of WIDTH entries
    below. The root gives the lowest rank; descending to the first child that holds it gives its leftmost place.
    A point update touches one node a level.
    """

    WIDTH = 32
    NONE = 1 << 60

    def __init__(self, ranks: list[int]):
        self.levels = [ranks]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([min(low[i : i + self.WIDTH]) for i in range(0, len(low), self.WIDTH)])

    def root(self) -> int:
        return self.levels[-1][0]

    def leftmost(self, rank: int) -> int:
        at = 0
        for level in reversed(self.levels[:-1]):
            at = level.index(rank, at * self.WIDTH)
        return at

    def put(self, at: int, rank: int) -> None:
        levels = self.levels
        levels[0][at] = rank
        for k in range(1, len(levels)):
            start = at // self.WIDTH * self.WIDTH
            at //= self.WIDTH
            low = min(levels[k - 1][start : start + self.WIDTH])
            if levels[k][at] == low:
                return
            levels[k][at] = low


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        of_char = {c: b for b, c in enumerate(alphabet)}
        self.byte_id = [vocab[c] for c in alphabet]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[a] << 32 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes: dict[int, bytes] = {i: bytes(of_char[c] for c in t) for t, i in vocab.items()}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.any_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pre_token = regex.compile(PRE_TOKEN)

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token: merges the leftmost pair of lowest rank until none can be merged."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        none, rank = PairTree.NONE, self.rank.get
        if n <= PairTree.WIDTH:  # the tree would be its root node alone: a list, from which merged pairs can go
            merged = self.merged
            ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
            while ranks and (low := min(ranks)) != none:
                at = ranks.index(low)
                here = ids[at] = merged[low]
                del ids[at + 1], ranks[at]
                if at < len(ranks):
                    ranks[at] = rank(here << 32 | ids[at + 1], none)
                if at:
                    ranks[at - 1] = rank(ids[at - 1] << 32 | here, none)
            return ids
        tree = PairTree([rank(ids[i] << 32 | ids[i + 1], none) for i in range(n - 1)] + [none])
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while (low := tree.root()) != none:
            at = tree.leftmost(low)
            gone = after[at]
            ids[at] = self.merged[low]
            ids[gone] = -1
            right = after[at] = after[gone]
            tree.put(gone, none)
            if right < n:
                before[right] = at
                tree.put(at, rank(ids[at] << 32 | ids[right], none))
            else:
                tree.put(at, none)
            left = before[at]
            if left >= 0:
                tree.put(left, rank(ids[left] << 32 | ids[at], none))
        return [i for i in ids if i >= 0]

    def encode_unit(self, unit: str) -> list[int]:
        out: list[int] = []
        for piece in self.pre_token.findall(unit):
            out += self.merge(piece.encode())
        return out

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """The text's ordinary parts, each with the id of the special token that follows it."""
        if self.any_special is None or not (found := list(self.any_special.finditer(text))):
            return [(text, None)]
        out, at = [], 0
        for m in found:
            out.append((text[at : m.start()], self.special[m[0]]))
            at = m.end()
        return [*out, (text[at:], None)]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part, special in self.segments(text):
            for unit in units(part):
                out += self.encode_unit(unit)
            if special is not None:
                out.append(special)
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def units(text: str) -> list[str]:
    """Parts of the text whose pre-tokens, one part after the other, are those of the text.

    Pre-tokens never span from a character that is no white space to one that is, so the text may be cut there.
    Where no two white space characters meet, splitting at spaces and line ends does that.
    """
    if not text:
        return []
    if _DOUBLE.search(text):
        return _RUNS.findall(text)
    first, *rest = text.replace("\n", " \n").split(" ")
    return ([first] if first else []) + [c if c[:1] == "\n" else f" {c}" for c in rest]


class UnitCache(dict):
    """What `make` gives for each unit; forgets all when over `most` entries, so memory stays bounded.

    Units that follow a single space are kept without it; `plain` holds those that were cut otherwise.
    """

    LONGEST = 256

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most, self.plain = make, most, {}

    def __missing__(self, chunk: str):
        value = self.make(chunk if chunk[:1] == "\n" else f" {chunk}")
        if len(chunk) <= self.LONGEST:
            self[chunk] = value
        return value

    def whole(self, unit: str):
        value = self.plain.get(unit)
        if value is None:
            value = self.make(unit)
            if len(unit) <= self.LONGEST:
                self.plain[unit] = value
        return value

    def of(self, text: str) -> list:
        """make() of each unit of the text, in order."""
        if len(self) + len(self.plain) > self.most:
            self.clear()
            self.plain.clear()
        if not text:
            return []
        if _DOUBLE.search(text):
            return [self.whole(u) for u in _RUNS.findall(text)]
        first, *rest = text.replace("\n", " \n").split(" ")
        out = list(map(self.__getitem__, rest))
        return [self.whole(first), *out] if first else out
