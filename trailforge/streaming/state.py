"""State that streaming operators keep for a key, as plain objects that can be tested without a stream."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd


@dataclass
class Visit:
    """An open visit: pages so far, the time of the last one, and the latest page id that was seen."""

    depth: int = 0
    last_ms: int = 0
    page: str | None = None

    def closed(self) -> tuple[str, int, int] | None:
        return (self.page, self.depth, self.last_ms) if self.page is not None and self.depth else None


def follow(visit: Visit, rows: list[tuple[int, str | None, bool]], timeout_ms: int) -> tuple[Visit, list[tuple[str, int, int]]]:
    """The visit after rows (ms, page id or None, is a logout) in order, and (page, depth, last ms) of the visits that ended on the way."""
    done = []
    for ms, page, logout in rows:
        if visit.depth and ms - visit.last_ms > timeout_ms:
            done.append(visit.closed())
            visit = Visit()
        visit = Visit(visit.depth + 1, max(ms, visit.last_ms), page if page is not None else visit.page)
        if logout:
            done.append(visit.closed())
            visit = Visit()
    return visit, [d for d in done if d]


#: Columns of a sample's rows: the slot, the order in which visits ended, and the depth.
SAMPLE = ["slot", "end_ms", "session_id", "depth"]


def latest(sample: pd.DataFrame) -> pd.DataFrame:
    """The latest row of each slot.

    A sample of n slots in which every value takes a slot by hash, over the earlier value there, is the
    recency-biased reservoir of Aggarwal (VLDB 2006): a value stays with probability (1 - 1/n)
    for each later one, and goes into a sample that is k/n full over one of the k with probability k/n.
    """
    return sample.sort_values(SAMPLE[1:], kind="stable").drop_duplicates("slot", keep="last")


def depth_stats(depths: pd.Series) -> dict[str, object]:
    counts = depths.value_counts().sort_index()
    return {
        "bounce_rate": int((depths == 1).sum()) * 100 // len(depths),
        "depth_distr": ",".join(f"{d}:{n}" for d, n in counts.items()),
        "av_depth": int(depths.sum() / len(depths) + 0.5),
    }


def next_tick(now_ms: int, tick_ms: int) -> int:
    """The time of the first tick after now."""
    return (now_ms // tick_ms + 1) * tick_ms


def frame(**columns: list) -> pd.DataFrame:
    """A table whose texts are plain objects, which is what Arrow batches of state operators take."""
    return pd.DataFrame({name: pd.Series(v, dtype=object if any(isinstance(x, str) for x in v) else None) for name, v in columns.items()})
