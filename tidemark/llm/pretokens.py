"""Where a byte-level BPE cuts a text before it merges: a deterministic transducer whose chunk maps are composed by a scan.

The pattern of byte-level BPE (contractions, runs of letters, digits and other signs with a space before them, white
space) is compiled into a machine of twelve states over twelve classes of characters. A step may mark a cut before the
character read, before the one ahead of it, or both. A sequence of characters is split into chunks; each chunk's map from
any state to the state after it is found for all chunks at once, a parallel prefix scan composes the maps, and with each
chunk's state known all chunks emit their cuts together.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

(_FRESH, _LETTER, _NUMBER, _SIGN, _SPACE, _SPACES, _BLANK, _BLANKS, _QUOTE, _QUOTE_R, _QUOTE_V, _QUOTE_L) = range(12)
(_L, _N, _S, _W, _Q, _P, _STMD, _R, _V, _LL, _E, _END) = range(12)
_HERE, _BEFORE = 1, 2
CHUNK = 256

# The code points of white space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, kind: int) -> tuple[int, int]:
    letter = kind in (_L, _STMD, _R, _V, _LL, _E)
    if state in (_QUOTE_R, _QUOTE_V, _QUOTE_L):
        if kind == (_LL if state == _QUOTE_L else _E):
            return _FRESH, 0
        state, cut = _step(_LETTER, kind)
        return state, cut | _BEFORE
    if kind == _END:
        return _FRESH, 0
    if state == _QUOTE:
        pending = {_STMD: _FRESH, _R: _QUOTE_R, _V: _QUOTE_V, _LL: _QUOTE_L, _Q: _SIGN, _P: _SIGN}
        if kind in pending:
            return pending[kind], 0
    white = state in (_SPACE, _SPACES, _BLANK, _BLANKS)
    if kind in (_S, _W):
        several = _SPACES if kind == _S else _BLANKS
        return (several, 0) if white else (_SPACE if kind == _S else _BLANK, _HERE)
    after = _LETTER if letter else _NUMBER if kind == _N else _SIGN
    cut = _BEFORE if state in (_SPACES, _BLANKS) else 0
    if state in (_SPACE, _SPACES) or state == after:
        return after, cut
    return _QUOTE if kind == _Q else after, cut | _HERE


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = [[_step(state, kind) for kind in range(12)] for state in range(12)]
    nexts = np.array([[s for s, _ in row] for row in steps], dtype=np.uint8).ravel()
    cuts = np.array([[c for _, c in row] for row in steps], dtype=np.uint8).ravel()
    kinds = np.full(sys.maxunicode + 1, _P, dtype=np.uint8)
    for code in range(sys.maxunicode + 1):
        group = unicodedata.category(chr(code))[0]
        if group in "LN":
            kinds[code] = _L if group == "L" else _N
    kinds[_WHITE] = _W
    kinds[0x20], kinds[0x27] = _S, _Q
    for sign, kind in {"s": _STMD, "t": _STMD, "m": _STMD, "d": _STMD, "r": _R, "v": _V, "l": _LL, "e": _E}.items():
        kinds[ord(sign)] = kind
    return nexts, cuts, kinds


def _scan(maps: np.ndarray) -> np.ndarray:
    """For each chunk the state before it: the maps of all chunks ahead of it, composed, at the first state."""
    reach = 1
    maps = maps.copy()
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
        reach *= 2
    return np.concatenate([np.zeros(1, dtype=np.uint8), maps[:-1, _FRESH]])


def run(kinds: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The cut bits of each step of the machine over a sequence of classes."""
    nexts, cuts, _ = _tables()
    chunks = -(-len(kinds) // chunk)
    padded = np.full(chunks * chunk, _END, dtype=np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(chunks, chunk).T)
    maps = np.repeat(np.arange(12, dtype=np.uint8)[None], chunks, axis=0)
    # Most signs lead to one state from any: soon a chunk's map is constant, and one state stands for all.
    alike, apart = np.zeros(chunks, dtype=np.uint8), np.arange(chunks)
    for k, column in enumerate(columns):
        alike = nexts[alike * np.uint8(12) + column]
        if len(apart):
            maps[apart] = now = nexts[maps[apart] * np.uint8(12) + column[apart][:, None]]
            if k % 4 == 3:
                one = (now == now[:, :1]).all(axis=1)
                alike[apart[one]] = now[one, 0]
                apart = apart[~one]
    done = np.ones(chunks, dtype=bool)
    done[apart] = False
    maps[done] = alike[done][:, None]
    state = _scan(maps) if chunks else np.zeros(0, dtype=np.uint8)
    out = np.empty_like(columns)
    for column, cut in zip(columns, out):
        at = state * np.uint8(12) + column
        np.take(cuts, at, out=cut)
        state = nexts[at]
    return out.T.reshape(-1)[: len(kinds)]


def pretokens(data: np.ndarray, bounds: np.ndarray, special: tuple[bytes, ...] = ()) -> tuple[np.ndarray, ...]:
    """Byte spans (starts, ends) of the pre-tokens, and of the special strings, with the row that each lies in.

    ``data`` holds the UTF-8 texts of some rows, one after another. Special strings are cut out first, as they stand.
    """
    _, _, table = _tables()
    raw = data.tobytes()
    codes = np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    edges = np.searchsorted(chars, bounds)
    kinds = table[codes]
    found = []
    for sign in special:
        at = raw.find(sign)
        while at >= 0:
            row = int(np.searchsorted(bounds, at, side="right")) - 1
            if at + len(sign) <= bounds[row + 1]:
                found.append((at, at + len(sign), row))
                first, last = np.searchsorted(chars, (at, at + len(sign)))
                kinds[first:last] = _END
            at = raw.find(sign, at + len(sign))
    kinds = np.insert(kinds, edges[1:], _END)
    cut = run(kinds)
    begins = (cut & _HERE) > 0
    begins[:-1] |= (cut[1:] & _BEFORE) > 0
    stops = np.flatnonzero(begins | (kinds == _END))
    first = begins[stops]
    symbol, until = stops[:-1][first[:-1]], stops[1:][first[:-1]]
    marks = edges[1:] + np.arange(len(bounds) - 1)
    row = np.searchsorted(marks, symbol)
    chars = np.append(chars, len(data))
    signs = np.array(found, dtype=np.int64).reshape(-1, 3)
    return chars[symbol - row], chars[until - row], row, signs[:, 0], signs[:, 1], signs[:, 2]
