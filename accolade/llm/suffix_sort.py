"""Two-stage suffix sorting of short texts in one task, as deep as a given span.

Each text ends in a mark below all bytes.  Suffixes that are smaller than their successor (the
suffix one byte on) are sorted directly.  The rest is induced by one scan over the buckets of
first bytes in ascending order: a suffix larger than its successor takes the order of that
successor, which lies in a lower bucket or, in a run of one byte, earlier in its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Suffixes whose bytes are compared at a time.
ROWS = 1 << 14


def _rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; runs of one byte take what follows."""
    change = np.flatnonzero(text[:-1] != text[1:])
    following = change[np.searchsorted(change, np.arange(len(text) - 1)).clip(max=len(change) - 1)]
    return np.append(text[following + 1] > text[following], False)


def sorted_windows(texts: Sequence[bytes], span: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Places of all ``span``-byte windows in suffix order, their text, and the joined bytes.

    Windows with equal bytes are next to each other.  Every text has ``span`` bytes or more.
    """
    raw = b"\0".join(texts) + b"\0"
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1  # places of the end marks
    begins = ends - sizes
    text = np.frombuffer(raw, np.uint8).astype(np.int16) + 1
    text[ends] = 0
    rising = _rising(text)
    rising[ends] = True  # a known place in the order: the first bucket

    # Windows, and behind the last one of a text what its order is induced from.
    stops = np.flatnonzero(rising)
    last = stops[np.searchsorted(stops, ends - span)]
    needed = np.zeros(len(text) + 1, np.int32)
    np.add.at(needed, begins, 1)
    np.add.at(needed, last + 1, -1)
    needed = np.cumsum(needed[:-1]).astype(bool)

    direct = np.flatnonzero(needed & rising)
    owner = np.searchsorted(ends, direct)
    stop = np.minimum(direct + span, ends[owner])
    slices = [raw[a:b] for a, b in zip(direct.tolist(), stop.tolist(), strict=True)]
    direct = direct[sorted(range(len(direct)), key=slices.__getitem__)]
    direct = direct[np.argsort(text[direct], kind="stable")]
    induced = np.flatnonzero(needed & ~rising)
    induced = induced[np.argsort(text[induced], kind="stable")]

    rank, order = np.zeros(len(text), np.int64), []
    counted = 0

    def settle(places: np.ndarray) -> None:
        nonlocal counted
        rank[places] = np.arange(counted, counted + len(places))
        counted += len(places)
        order.append(places)

    heads, chars = text[direct], text[induced]
    for byte in np.unique(np.concatenate([heads, chars])):
        waiting = induced[np.searchsorted(chars, byte):np.searchsorted(chars, byte, "right")]
        ready = waiting[text[waiting + 1] < byte]
        waiting = waiting[text[waiting + 1] == byte]
        while len(ready):
            ready = ready[np.argsort(rank[ready + 1])]
            settle(ready)
            before = ready - 1  # one byte further out in a run
            ready = np.intersect1d(before, waiting, assume_unique=True)
        settle(direct[np.searchsorted(heads, byte):np.searchsorted(heads, byte, "right")])
    places = np.concatenate(order) if order else np.empty(0, np.int64)
    owner = np.searchsorted(ends, places)
    whole = places + span <= ends[owner]
    return places[whole], owner[whole], raw


def common_prefixes(places: np.ndarray, raw: bytes, span: int) -> np.ndarray:
    """Length, up to ``span``, of what each window shares with the one before it; 0 for the first."""
    out = np.zeros(len(places), np.int64)
    views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), span)
    for at in range(1, len(places), ROWS):
        a, b = views[places[at - 1:at + ROWS - 1]], views[places[at:at + ROWS]]
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        out[at:at + n] = np.where(differ.any(axis=1), differ.argmax(axis=1), span)
    return out


def repeated(texts: Sequence[bytes], span: int) -> list[np.ndarray]:
    """For each text, which of its windows occur elsewhere in any of the texts."""
    marks = [np.zeros(len(t) - span + 1, bool) for t in texts]
    places, owner, raw = sorted_windows(texts, span)
    same = common_prefixes(places, raw, span) >= span
    hit = same | np.append(same[1:], False)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    for o, at in zip(owner[hit].tolist(), (places[hit] - begins[owner[hit]]).tolist(), strict=True):
        marks[o][at] = True
    return marks
