"""Simple-8b: many small integers in each 64-bit word, by blocks.

The top four bits of a word select how many integers of which width follow from
the low end. Selector 0 is the escape for integers of more than 60 bits: two
words in a row, the first with the low 60 bits and the second with the rest, so
that escapes are told apart by counting alone. Blocks hold the same number of
integers, the last one fewer; offsets of the blocks in words let every block be
decoded without the others. All steps work on whole arrays.
"""

from __future__ import annotations

import numpy as np

#: (integers in a word, bits of each), from many to few; the place is the selector - 1.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
           (4, 15), (3, 20), (2, 30), (1, 60))
BLOCK = 1024
_COUNTS = np.array([0, *(n for n, _ in LAYOUTS)], np.int64)
_LOW = np.uint64((1 << 60) - 1)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, offset of each block and of the end, in words)."""
    values = np.asarray(values, np.uint64)
    blocks = -(-len(values) // block)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    room = block + 60  # zeros behind each block, so that its last word may look past its end
    padded = np.zeros((blocks, room), np.uint64)
    padded[:, :block].flat[: len(values)] = values
    lengths = np.full(blocks, block, np.int64)
    lengths[-1] = len(values) - block * (blocks - 1)
    widths = _widths(padded.ravel())
    # Widest value among the next n; each n is reached from a smaller one.
    widest, selector = {1: widths}, np.zeros(len(widths), np.uint8)
    selector[widths <= 60] = 14
    done = 1
    for place in range(len(LAYOUTS) - 2, -1, -1):
        n, bits = LAYOUTS[place]
        shift = n - done
        over = widest[done].copy()
        over[:-shift] = np.maximum(over[:-shift], widest[done][shift:])
        widest, done = {n: over}, n
        fits = over <= bits
        if not fits.any():
            # A wider window of wider values cannot fit either.
            break
        selector[fits] = place + 1
    selector = selector.reshape(blocks, room)
    rows, at = np.arange(blocks), np.zeros(blocks, np.int64)
    row_of, at_of, selector_of = [], [], []
    while len(rows):
        chosen = selector[rows, at]
        row_of.append(rows)
        at_of.append(at)
        selector_of.append(chosen)
        at = at + np.maximum(_COUNTS[chosen], 1)
        going = at < lengths[rows]
        rows, at = rows[going], at[going]
    row, start, chosen = (np.concatenate(x) for x in (row_of, at_of, selector_of))
    order = np.argsort(row, kind="stable")
    row, start, chosen = row[order], start[order], chosen[order]
    flat, base = padded.ravel(), row * room + start
    words = chosen.astype(np.uint64) << np.uint64(60)
    for place, (n, bits) in enumerate(LAYOUTS):
        at = np.flatnonzero(chosen == place + 1)
        for j in range(n if len(at) else 0):
            words[at] |= flat[base[at] + j] << np.uint64(j * bits)
    escaped = np.flatnonzero(chosen == 0)
    if len(escaped):
        wide = flat[base[escaped]]
        words[escaped] = wide & _LOW
        words = np.insert(words, escaped + 1, wide >> np.uint64(60))
        row = np.insert(row, escaped + 1, row[escaped])
    return words, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=blocks))]).astype(np.int64)


def decode(words: np.ndarray, offsets: np.ndarray, length: int, block: int = BLOCK) -> np.ndarray:
    """The ``length`` values of consecutive blocks; ``offsets`` count from the first word."""
    if not length:
        return np.zeros(0, np.uint64)
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selector]
    escapes = np.flatnonzero(selector == 0)
    counts[escapes[0::2]] = 1  # of the two words of an escape the first holds the place
    per_word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ends = np.cumsum(counts)
    first = np.concatenate([[0], ends])[offsets[:-1]]
    start = ends - counts - first[per_word] + per_word * (block + 60)
    out = np.zeros((len(offsets) - 1) * (block + 60), np.uint64)
    for place, (n, bits) in enumerate(LAYOUTS):
        at = np.flatnonzero(selector == place + 1)
        mask = np.uint64((1 << bits) - 1)
        for j in range(n if len(at) else 0):
            out[start[at] + j] = (words[at] >> np.uint64(j * bits)) & mask
    if len(escapes):
        low, high = escapes[0::2], escapes[1::2]
        out[start[low]] = (words[low] & _LOW) | ((words[high] & _LOW) << np.uint64(60))
    return out.reshape(-1, block + 60)[:, :block].ravel()[:length]
