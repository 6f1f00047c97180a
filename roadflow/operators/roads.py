"""Roads as sorted arrays, which dead reckoning walks row by row: coordinate, heading and end of each road."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

#: The mainline's code, and the road rows that may be sent to every task (24 bytes each).
MAINLINE, MOST_ROWS = "K", 4_000_000


def bearings(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Initial bearing from the first points to the second, 0 to 360 degrees."""
    a, b, d = np.radians(lat1), np.radians(lat2), np.radians(lon2 - lon1)
    angle = np.degrees(np.arctan2(np.sin(d) * np.cos(b), np.cos(a) * np.sin(b) - np.sin(a) * np.cos(b) * np.cos(d)))
    return np.where(angle < 0, angle + 360, angle)


class Roads:
    """Rows of all roads, by road and sequence. On the mainline a vehicle goes up or down by mileage, between ``low`` and
    ``high``, and has the coordinate of the last row at its mileage or before it (of the first row, if there is none). On
    a ramp it goes ``2 * ceil(metres)`` rows on, as ramps have two rows a metre, and leaves the road with its last row."""

    def __init__(self, rows: Sequence[tuple[str, int, int, float, float]], low: int, high: int):
        rows = sorted(rows)
        self.low, self.high = low, high
        self.names = sorted({r[0] for r in rows})
        of = np.array([self.names.index(r[0]) for r in rows], np.int64)
        self.first = np.searchsorted(of, np.arange(len(self.names)))
        self.size = np.bincount(of, minlength=len(self.names)) if len(rows) else np.zeros(0, np.int64)
        self.mileage = np.array([r[2] for r in rows], np.int64)
        self.lon, self.lat = (np.array([r[k] for r in rows], np.float64) for k in (3, 4))
        self.main = self.names.index(MAINLINE) if MAINLINE in self.names else -1

    @classmethod
    def of(cls, road: DataFrame, low: int, high: int, most: int = MOST_ROWS) -> Roads:
        """Of a table ``road, road_seq, mileage, longitude, latitude``. More than ``most`` rows are an error: such a network
        is to be cut into regions, each with the points of its own roads."""
        rows = road.select("road", "road_seq", "mileage", "longitude", "latitude").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} road rows")
        return cls([tuple(r) for r in rows], low, high)

    def index(self, names: Sequence[str]) -> np.ndarray:
        """Numbers of roads; -1 for unknown ones, whose vehicles stay where they are known to have been last."""
        known = {n: k for k, n in enumerate(self.names)}
        return np.array([known.get(n, -1) for n in names], np.int64)

    def row(self, road: np.ndarray, mileage: np.ndarray) -> np.ndarray:
        """Row within its road of the last one at the mileage or before it."""
        out = np.zeros(len(road), np.int64)
        for k in np.unique(road[road >= 0]):
            here = road == k
            part = self.mileage[self.first[k] : self.first[k] + self.size[k]]
            out[here] = np.maximum(np.searchsorted(part, mileage[here], "right") - 1, 0)
        return out

    def step(self, road: np.ndarray, row: np.ndarray, mileage: np.ndarray, metres: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether vehicles are still on their road after so many metres, and their new rows and mileages."""
        main = (road == self.main) & (road >= 0)
        to = mileage + np.where(up | ~main, metres, -metres)
        ahead = row + 2 * np.ceil(metres).astype(np.int64)
        on = np.where(main, (to >= self.low) & (to <= self.high), (road >= 0) & (ahead < self.size[np.maximum(road, 0)] if len(self.size) else False))
        to = np.where(on, to, 0).astype(np.int64)
        return on, np.where(main, self.row(np.where(main, road, -1), to), ahead), to

    def place(self, road: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longitudes and latitudes of rows."""
        at = self.first[road] + row
        return self.lon[at], self.lat[at]
