"""Simple-8b word-aligned coding with escapes, in numpy.

A 64-bit word holds a selector in its top 4 bits and, below, as many ids as
fit at the selector's width. Selector 15 is an escape: its payload numbers an
entry of an exception list, for ids of more than 60 bits. Ids are coded in
blocks; a block's last word may hold fewer ids than it has room for, so the
number of ids of each block is kept beside it.
"""

from __future__ import annotations

import numpy as np

COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
BLOCK = 1024


_LIMITS = (np.uint64(1) << WIDTHS.astype(np.uint64)) - np.uint64(1)
_PLACE = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64)).astype(np.int8)


def _places(ids: np.ndarray) -> np.ndarray:
    """The place in WIDTHS of each id's width; ``len(WIDTHS)`` for an escape."""
    if int(ids.max()) < len(_PLACE):
        return _PLACE[ids.astype(np.uint16)]
    return np.searchsorted(_LIMITS, ids).astype(np.int8)


def _choices(place: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The selector that holds most ids from each position on. Blocks are laid
    out with gaps, so that no selector looks past the end of one."""
    gap = int(COUNTS[0])
    at = np.arange(len(place)) + np.repeat(np.arange(len(sizes)) * gap, sizes)
    laid = np.zeros(len(place) + gap * len(sizes), np.int8)
    laid[at] = place
    choice = np.full(len(laid), len(COUNTS) - 1, np.int8)
    for k in range(len(COUNTS) - 2, -1, -1):  # the selector with most ids comes last and wins
        wide, seen = laid > k, 1  # a too wide id among the next ``seen``
        while seen < COUNTS[k]:
            step = min(seen, int(COUNTS[k]) - seen)
            before = wide.copy()
            wide[:-step] |= before[step:]
            seen += step
        choice[~wide] = k
    out = choice[at]
    out[place == len(WIDTHS)] = ESCAPE
    return out


def encode(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code blocks of consecutive ids. ``sizes`` are the blocks' numbers of
    ids. Returns (words, words per block, exceptions)."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n_blocks = len(sizes)
    if not n_blocks or not len(ids):
        return np.zeros(0, np.uint64), np.zeros(n_blocks, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    total, block_end = len(ids), np.repeat(ends, sizes)
    here, choice = np.arange(total), _choices(_places(ids), np.asarray(sizes))
    step = np.where(choice == ESCAPE, 1, COUNTS[np.minimum(choice, len(COUNTS) - 1)])
    following = np.minimum(here + step, block_end)
    at, live, first = ends - sizes, np.flatnonzero(sizes > 0), np.zeros(total, bool)
    while len(live):  # all blocks advance by one word at a time
        p = at[live]
        first[p] = True
        at[live] = following[p]
        live = live[at[live] < ends[live]]
    start = np.flatnonzero(first)
    owner = np.searchsorted(ends, start, side="right")
    selector = choice[start].astype(np.uint64)
    words = selector << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(int(COUNTS[0]), np.uint64)])
    for k, (count, bits) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist())):
        rows = np.flatnonzero(selector == k)
        if len(rows):
            room = block_end[start[rows]] - start[rows]
            for slot in range(count):
                value = np.where(slot < room, padded[start[rows] + slot], np.uint64(0))
                words[rows] |= value << np.uint64(bits * slot)
    rows = np.flatnonzero(selector == ESCAPE)
    words[rows] |= np.arange(len(rows), dtype=np.uint64)
    return words, np.bincount(owner, minlength=n_blocks), ids[start[rows]]


def decode(words: np.ndarray, word_counts: np.ndarray, sizes: np.ndarray, exceptions: np.ndarray) -> np.ndarray:
    """The ids of blocks of ``word_counts`` words and ``sizes`` ids."""
    total = int(np.sum(sizes))
    out = np.zeros(total, np.uint64)
    if not total:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = np.where(selector == ESCAPE, 1, COUNTS[np.minimum(selector, len(COUNTS) - 1)])
    block = np.repeat(np.arange(len(sizes)), word_counts)
    done = np.cumsum(count) - count
    first_word = np.cumsum(word_counts) - word_counts
    ends = np.cumsum(sizes)
    base = np.zeros(len(sizes), np.int64)
    some = word_counts > 0
    base[some] = done[first_word[some]]
    start = done - base[block] + (ends - sizes)[block]
    room = ends[block] - start
    for k, (slots, bits) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist())):
        rows = np.flatnonzero(selector == k)
        if not len(rows):
            continue
        mask = np.uint64((1 << bits) - 1)
        for slot in range(slots):
            inside = rows[slot < room[rows]]
            out[start[inside] + slot] = (words[inside] >> np.uint64(bits * slot)) & mask
    rows = np.flatnonzero(selector == ESCAPE)
    out[start[rows]] = exceptions[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out
