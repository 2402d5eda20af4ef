"""The smallest MD5 digest among many joined texts, hashed in batches.

A batch computes the first word of all its digests, step by step over whole arrays.  The smallest
word decides nearly every draw; texts that share it are compared by their full digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LANES = 1 << 14  # digests of a batch, whose arrays stay in the cache of a core
SHORT = 55  # bytes of a text that fit into one block of MD5
_WORDS = 16
_STEPS = 61  # the last three steps do not change the first word
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TURNS = [turn for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for turn in four * 4]
_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_READ = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % _WORDS for i in range(64)]
_LEFT, _RIGHT = [np.uint32(t) for t in _TURNS], [np.uint32(32 - t) for t in _TURNS]


def first_words(words: list[np.ndarray | int], state: np.ndarray) -> np.ndarray:
    """First four bytes of the digests, as numbers in the order of the hex digits.

    ``words``: the words of the padded texts, arrays as wide as ``state`` or numbers that all share.
    """
    a, b, c, d, f = state
    for part, value in zip(state, _START):
        part.fill(value)
    for i in range(_STEPS):
        if i < 16:
            np.bitwise_xor(c, d, f)
            np.bitwise_and(f, b, f)
            np.bitwise_xor(f, d, f)
        elif i < 32:
            np.bitwise_xor(b, c, f)
            np.bitwise_and(f, d, f)
            np.bitwise_xor(f, c, f)
        elif i < 48:
            np.bitwise_xor(b, c, f)
            np.bitwise_xor(f, d, f)
        else:
            np.invert(d, f)
            np.bitwise_or(f, b, f)
            np.bitwise_xor(f, c, f)
        word = words[_READ[i]]
        if isinstance(word, int):
            np.add(f, np.uint32(_ADDED[i] + word & 0xFFFFFFFF), f)
        else:
            np.add(f, np.uint32(_ADDED[i]), f)
            np.add(f, word, f)
        np.add(a, f, a)
        np.left_shift(a, _LEFT[i], f)
        np.right_shift(a, _RIGHT[i], a)
        np.bitwise_or(a, f, a)
        np.add(a, b, a)
        a, b, c, d = d, a, b, c
    np.add(b, np.uint32(_START[0]), b)
    return b.byteswap(inplace=True)


def _laid(texts: list[bytes], offset: int) -> np.ndarray:
    """The texts as words of blocks that are zero elsewhere."""
    blocks = np.zeros((len(texts), 4 * _WORDS), np.uint8)
    lengths = np.array([len(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + offset
    blocks[row, column] = np.frombuffer(b"".join(texts), np.uint8)
    return blocks.view("<u4").astype(np.uint32, copy=False)


def _batches(heads: list[bytes], tails: list[bytes], allowed: np.ndarray | None, most: int) -> Iterator[tuple]:
    """(heads, tails, words) of the pairs in batches, by head: all that ``allowed`` names, with the words of their texts.

    Heads of one length share the place of their tails.  Words that all pairs share are numbers.
    """
    lengths = np.array([len(h) for h in heads])
    kinds, kind = np.unique(lengths, return_inverse=True)
    order = np.argsort(kind, kind="stable")
    kind, headed = kind[order], _laid([heads[i] for i in order], 0)
    tailed = np.stack([_laid([t + b"\x80" for t in tails], n) for n in kinds])
    tailed[:, :, 14] = 8 * (kinds[:, None] + np.array([len(t) for t in tails]))
    shared = [not headed[:, w].any() and (tailed[:, :, w] == tailed[0, 0, w]).all() for w in range(_WORDS)]
    numbers = [int(n) for n in tailed[0, 0]]
    if allowed is not None:
        row, column = np.nonzero(allowed[order])
        for at in range(0, len(row), most):
            i, j = row[at : at + most], column[at : at + most]
            yield order[i], j, [numbers[w] if shared[w] else headed[i, w] | tailed[kind[i], j, w] for w in range(_WORDS)]
        return
    width = min(len(tails), most)
    height = max(1, most // width)
    for left in range(0, len(tails), width):
        right = min(left + width, len(tails))
        for top in range(0, len(heads), height):
            rows = slice(top, top + height)
            cuts = [0, *(np.flatnonzero(np.diff(kind[rows])) + 1).tolist(), len(kind[rows])]
            words = [numbers[w] if shared[w] else np.empty((cuts[-1], right - left), np.uint32) for w in range(_WORDS)]
            for w in range(_WORDS):
                for since, until in zip(cuts, cuts[1:]) if not shared[w] else ():
                    tail = tailed[kind[top + since], left:right, w]
                    np.bitwise_or(headed[top + since : top + until, w, None], tail, words[w][since:until])
            yield order[rows], slice(left, right), [w if isinstance(w, int) else w.ravel() for w in words]


def smallest(heads: pa.Array, tails: pa.Array, allowed: np.ndarray | None, state: np.ndarray) -> dict[int, tuple[str, int]]:
    """Per head the smallest MD5 of head and tail in hex and its tail, the first of equal ones.

    ``allowed`` tells which pairs count (default: all), ``state`` is room for five arrays of a batch.  A head without
    a pair has no entry.
    """
    best: dict[int, tuple[str, int]] = {}
    if not len(tails) or allowed is not None and not allowed.any():
        return best
    if allowed is not None:
        some = allowed.any(axis=1)
        back, heads, allowed = np.flatnonzero(some).tolist(), heads.filter(pa.array(some)), allowed[some]
    heads, tails = [t.encode() for t in heads.to_pylist()], [t.encode() for t in tails.to_pylist()]

    def compare(rows: np.ndarray, columns: np.ndarray) -> None:
        for i, j in zip(rows.tolist(), columns.tolist()):
            found = (hashlib.md5(heads[i] + tails[j], usedforsecurity=False).hexdigest(), j)
            if i not in best or found < best[i]:
                best[i] = found

    if max(map(len, heads)) + max(map(len, tails)) > SHORT:
        compare(*np.nonzero(np.ones((len(heads), len(tails)), bool) if allowed is None else allowed))
    else:
        for i, j, words in _batches(heads, tails, allowed, state.shape[1]):
            if isinstance(j, slice):
                found = first_words(words, state[:, : len(i) * (j.stop - j.start)]).reshape(len(i), -1)
                row, column = np.nonzero(found == found.min(axis=1, keepdims=True))
                compare(i[row], column + j.start)
            else:
                found = first_words(words, state[:, : len(i)])
                starts = np.flatnonzero(np.diff(i, prepend=-1))
                low = np.repeat(np.minimum.reduceat(found, starts), np.diff(starts, append=len(i)))
                compare(i[found == low], j[found == low])
    return best if allowed is None else {back[i]: found for i, found in best.items()}
