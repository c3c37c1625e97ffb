"""Content-defined anchors: every window of a text names one of its short byte runs.

A window of ``window`` bytes names the run of ``ANCHOR`` bytes in it whose hash is smallest
(the first of equals). Equal windows name equal runs at equal places, so comparing the
windows that share a named run finds every repeat. Neighbouring windows mostly name the
same run; such a stretch of windows is one record.
"""

from __future__ import annotations

import numpy as np

from sensitext.llm.common import mix

ANCHOR = 12
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def word_view(raw: np.ndarray) -> np.ndarray:
    """Eight bytes from every place on, as integers; zeros follow the end."""
    padded = np.concatenate((raw, np.zeros(128, np.uint8)))
    return np.ndarray(len(raw) + 120, "<u8", padded, strides=(1,))


def anchor_hashes(view: np.ndarray, n: int) -> np.ndarray:
    low, high = view[:n], view[8 : n + 8] & np.uint64((1 << 8 * (ANCHOR - 8)) - 1)
    return mix(low * _SPREAD + mix(high))


def run_hashes(view: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``starts[i] : starts[i] + lengths[i]``."""
    out = lengths.astype(np.uint64) * _SPREAD
    for at in range(0, int(lengths.max(initial=0)), 8):
        left = np.clip(lengths - at, 0, 8).astype(np.uint64)
        keep = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
        # Nothing follows past the end, so the place may be anywhere.
        word = view[np.minimum(starts + at, len(view) - 1)] & keep
        out = np.where(left > 0, mix(out ^ word) * _SPREAD + np.uint64(at + 1), out)
    return mix(out)


def anchor_runs(raw: np.ndarray, bounds: np.ndarray, window: int):
    """``row, anchor hash, anchor place, first window, last window`` of each record.

    Places count from the start of ``raw``. Rows shorter than a window have no record.
    """
    n = len(raw)
    none = np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    if n < window or sizes.max() < window:
        return none, none.astype(np.uint64), none, none, none
    view = word_view(raw)
    hashes = anchor_hashes(view, n - ANCHOR + 1)
    bits = max(1, (n - 1).bit_length())
    low = np.uint64((1 << bits) - 1)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, width = window - ANCHOR + 1, 1
    while 2 * width <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[: -(span - width)], best[span - width :])
    # Windows that lie in one row.
    count = np.maximum(sizes - window + 1, 0)
    row = np.repeat(np.arange(len(sizes)), count)
    start = np.arange(len(row)) + np.repeat(bounds[:-1] - np.cumsum(count) + count, count)
    place = (best[start] & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((new[1:], [len(row)])) - 1
    place = place[new]
    # Smallest hashes crowd near 0, so they are spread again.
    return row[new], mix(hashes[place] + _SPREAD), place, start[new], start[last]
