"""Pixels to 1-D density profiles, and the fixed values of splitting by density."""

from __future__ import annotations

import numpy as np

#: Density up to which a position counts as empty; brightness step that counts as an edge (fixed values).
CLEAN, EDGE = 0.004, 25
#: Overlap of bands, snap window, span of tiles and height up to which a canvas isn't tiled, least height and
#: aspect of reader bands, in pixels; further tries for a span cap (fixed values).
OVERLAP, SNAP, TILE, UNTILED, BAND_MIN, BAND_RATIO, RETRIES = 200, 160, 1600, 4000, 900, 2.0, 8


def edge_profile(luma: np.ndarray, axis: str = "y") -> np.ndarray:
    """Share of edge pixels in each row (axis y) or column: brightness steps over ``EDGE`` to the right or below.

    The last row and column, which have no neighbour, hold no edges; shares are kept to 255 steps.
    """
    level = np.asarray(luma, np.int16)
    steps = np.maximum(np.abs(np.diff(level, axis=1))[:-1], np.abs(np.diff(level, axis=0))[:, :-1]) > EDGE
    along = 1 if axis == "y" else 0
    share = np.zeros(level.shape[1 - along])
    share[:-1] = steps.sum(axis=along) / level.shape[along]
    return np.rint(share * 255) / 255
