"""A byte-level BPE vocabulary compiled to a transducer that counts tokens."""

from __future__ import annotations

import json
from functools import lru_cache

_FULL = 1 << 19


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Reads a pre-token byte by byte; its transitions carry the numbers of tokens that become certain.

    The last token of a prefix's encoding is the only token that ends there, fits what is before it and keeps the merge
    order across the seam. What later bytes can depend on is the longest suffix that may still grow into a token, with
    the last token and the count at each place in it: that is the state. States and transitions are compiled when first
    met and forgotten together when ``full`` of them are held, so that memory is bounded whatever the text.
    """

    def __init__(self, path: str, full: int = _FULL) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        signs, model = byte_signs(), content["model"]
        self.special = tuple(t["content"].encode() for t in content["added_tokens"])
        self.born: dict[bytes, int] = {bytes([b]): -1 for b in range(256)}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (bytes(signs[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            if left + right not in self.born:
                self.born[left + right], self.parts[left + right] = rank, (left, right)
        self.merge = {pair: self.born[token] for token, pair in self.parts.items()}
        self.prefixes = {t[:n] for t in self.born for n in range(1, len(t))}
        self.longest = max(map(len, self.born))
        self.full = full
        self._forget()

    def _forget(self) -> None:
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.final: list[int] = []
        self.moves: dict[int, tuple[int, int]] = {}
        self.counts: dict[bytes, int] = {}
        self._state((b"", (b"",), (0,)))

    def _state(self, state: tuple) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.final.append(state[2][-1])
        return self.number[state]

    def seam(self, left: bytes, right: bytes) -> bool:
        """Whether no merge across the seam comes before the merges that made the tokens on its two sides."""
        if not left:
            return True
        key = (left, right)
        if key not in self.fits:
            self.fits[key] = self._seam(left, right)
        return self.fits[key]

    def _seam(self, left: bytes, right: bytes) -> bool:
        born, merge, before = self.born, self.merge, len(self.parts) + 1
        while True:
            if merge.get((left, right), before) < before:
                return False
            if born[left] < 0 and born[right] < 0:
                return True
            # Undo the later merge. One across the seam beats an equal one on its right, but not on its left.
            if born[left] > born[right]:
                before, left = born[left], self.parts[left][1]
            else:
                before, right = born[right] + 1, self.parts[right][0]

    def _move(self, number: int, byte: int) -> tuple[int, int]:
        suffix, last, counts = self.states[number]
        text = suffix + bytes([byte])
        for start in range(max(0, len(text) - self.longest), len(text)):
            token = text[start:]
            if token in self.born and self.seam(last[start], token):
                break
        last, counts = (*last, token), (*counts, counts[start] + 1)
        keep = next((i for i in range(len(text)) if text[i:] in self.prefixes), len(text))
        base = counts[keep]
        return self._state((text[keep:], last[keep:], tuple(c - base for c in counts[keep:]))), base

    def count(self, word: bytes) -> int:
        """The number of tokens of a pre-token."""
        known = self.counts.get(word)
        if known is not None:
            return known
        if len(self.moves) > self.full or len(self.counts) > self.full or len(self.fits) > self.full:
            self._forget()
        state, total, moves = 0, 0, self.moves
        for byte in word:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = moves[state << 8 | byte] = self._move(state, byte)
            state, more = move
            total += more
        total += self.final[state]
        if len(word) <= 32:
            self.counts[word] = total
        return total


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per worker process, with all it has compiled so far."""
    return Transducer(path)
