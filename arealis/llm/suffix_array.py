"""Column-wise construction of the Burrows-Wheeler transform and common prefixes of a collection."""

from __future__ import annotations

import numpy as np


def collection(texts: list[bytes], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of all ``texts`` in order: text number, start, common prefix with the one before (at most ``most``).

    Round j inserts one symbol of each text that has j symbols left: the suffix of length j, whose place
    follows from the transform so far, since suffixes behind equal symbols keep their order. The common prefix
    with a neighbour behind the same symbol is one more than the smallest between the two that they extend.
    Ends of texts are smaller than any byte and ordered by text number.
    """
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(sizes)
    begins = ends - sizes

    def before(who: np.ndarray, length: int) -> np.ndarray:
        """The symbol before the suffix of that length; 0 before a whole text."""
        at = ends[who] - length - 1
        return np.where(at >= begins[who], symbols[np.maximum(at, 0)] if len(symbols) else 0, 0).astype(np.uint16)

    who = np.arange(n)
    bwt = before(who, 0)
    number, start = who.astype(np.int32), sizes.astype(np.int32)
    common = np.zeros(n, np.uint8)
    place = who.copy()  # where the last suffix of each text in ``active`` stands
    active = np.flatnonzero(sizes)
    place = place[active]
    length = 0
    while len(active):
        length += 1
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(bwt), np.int64)
        rank[order] = np.arange(len(bwt))
        ended = int(np.searchsorted(bwt[order], 1))  # whole texts: nothing stands before them
        spot = n - ended + rank[place]

        # neighbours behind the same symbol
        mine, last = bwt[place], len(order) - 1
        prior, later = order[np.maximum(rank[place] - 1, 0)], order[np.minimum(rank[place] + 1, last)]
        has_prior = (rank[place] > ended) & (bwt[prior] == mine)
        has_later = (rank[place] < last) & (bwt[later] == mine)
        up = np.where(has_prior, _least(common, prior, place, has_prior) + 1, 0)
        down = np.where(has_later, _least(common, place, later, has_later) + 1, 0)

        total = len(bwt) + len(active)
        old = np.ones(total, bool)
        old[spot] = False

        def merged(values: np.ndarray, new: np.ndarray, old: np.ndarray = old, spot: np.ndarray = spot) -> np.ndarray:
            out = np.empty(len(old), values.dtype)
            out[old], out[spot] = values, new
            return out

        bwt = merged(bwt, before(active, length))
        number = merged(number, active)
        start = merged(start, sizes[active] - length)
        common = merged(common, np.minimum(up, most))
        inside = spot + 1 < total
        common[spot[inside] + 1] = np.minimum(down[inside], most)
        more = sizes[active] > length
        active, place = active[more], spot[more]
    return number, start, common


def _least(common: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Smallest of common[low + 1 .. high] where wanted; 0 elsewhere."""
    out = np.zeros(len(low), np.int64)
    at = np.flatnonzero(wanted)
    if len(at):
        at = at[np.argsort(low[at], kind="stable")]
        edges = np.stack([low[at] + 1, high[at] + 1], 1).ravel()
        out[at] = np.minimum.reduceat(np.append(common, 255), edges)[::2]
    return out
