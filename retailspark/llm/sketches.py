"""Word shingles and order MinHash sketches of many texts at a time, by array operations."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying by it loses nothing
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def words(texts: list[str], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for each word of the texts, lower-cased if ``fold``, and where each text's words start (one more
    entry)."""
    return hashed([(t.lower() if fold else t).encode() for t in texts])


def hashed(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts that are bytes."""
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = _SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    edges = np.cumsum([0, *(len(r) + 1 for r in raw)])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    length = ends - starts
    kept = data[~space].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(length) - length
    place = np.arange(len(kept)) - np.repeat(first, length)
    found = mix(np.add.reduceat(kept * powers(int(length.max()))[place], first))
    return found, np.searchsorted(starts, edges)


def shingles(found: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for every run of ``size`` words of each text, in order; shorter texts have one of all their words."""
    count = np.diff(edges)
    number = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
    out_edges = np.concatenate([[0], np.cumsum(number)])
    text = np.repeat(np.arange(len(count)), number)
    at = edges[text] + np.arange(len(text)) - out_edges[text]
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate([found, np.zeros(size, np.uint64)])
    inside = edges[1:][text]
    for j in range(size):
        total = total * _BASE + np.where(at + j < inside, padded[at + j], np.uint64(j + 1))
    return mix(total), out_edges


def occurrences(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many equal values stand before each one in its text."""
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.lexsort((values, text))
    same = np.zeros(len(values), bool)
    same[1:] = (values[order][1:] == values[order][:-1]) & (text[order][1:] == text[order][:-1])
    run = np.arange(len(values))
    out = np.empty(len(values), np.int64)
    out[order] = run - np.maximum.accumulate(np.where(same, 0, run))
    return out


def labelled(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A number for each value together with how many equal ones stand before it in its text."""
    return mix(values + mix(occurrences(values, edges).astype(np.uint64)) * _BASE)


def order_minhash(values: np.ndarray, edges: np.ndarray, functions: int, sample: int) -> np.ndarray:
    """One number per text and function: of the ``sample`` occurrence-labelled values that the function ranks lowest,
    in their order in the text. Texts without values have zeros; those with few values take all of them."""
    tokens = labelled(values, edges)
    count = np.diff(edges)
    full = np.flatnonzero(count)
    out = np.zeros((len(count), functions), np.uint64)
    if not len(full):
        return out
    starts, sizes = edges[full], count[full]
    row = np.repeat(np.arange(len(full)), sizes)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    for f in range(functions):
        ranks = mix(tokens ^ mix(np.array([f + 1], np.uint64)))
        picked = np.full((len(full), sample), len(values), np.int64)
        for s in range(sample):
            lowest = np.minimum.reduceat(ranks, starts)
            hit = np.flatnonzero(ranks == lowest[row])
            hit = hit[ranks[hit] != none]
            picked[row[hit], s] = hit
            ranks[hit] = none
        picked.sort(axis=1)
        taken = np.append(tokens, np.uint64(0))[picked]
        total = np.full(len(full), np.uint64(f + 1))
        for s in range(sample):
            total = mix(total * _BASE + taken[:, s])
        out[full, f] = total
    return out
