"""Names and time geometry of a bar table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

MICROSECOND = timedelta(microseconds=1)


@dataclass(frozen=True)
class Series:
    """How the rows of a table form time series.

    ``keys`` identify one series (none: the whole table is one series), ``ts`` orders it, ``step``
is the distance of neighbouring bars; keys and times are not null. Order-dependent work runs on
    chunks of ``chunk_steps`` steps. What passes between chunks (one row per chunk, or for row frames at most
    as many rows as the frame is long) is combined in groups of ``group_chunks`` chunks, then over the groups.
    The largest ordered group thus has max(chunk_steps, group_chunks, chunks of the longest series /
    group_chunks) rows, the latter two times the frame's length for row frames. For 10**12 steps
    ``chunk_steps=1 << 14`` and ``group_chunks=1 << 13`` keep all three below 17,000. Unset it is 4,096, and
    ``fill_bars`` and ``bars_to_features`` take the chunks of a series, one row each, in one group: less
    work for series of up to some 10**10 steps.
    """

    ts: str = "Timestamp"
    keys: tuple[str, ...] = ()
    step: timedelta = timedelta(minutes=1)
    chunk_steps: int = 8192
    group_chunks: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(self.keys))
        if self.step <= timedelta(0) or self.chunk_steps < 1 or self.chunk_group < 1:
            raise ValueError("step, chunk_steps and group_chunks must be positive")

    @property
    def step_us(self) -> int:
        return self.step // MICROSECOND

    @property
    def chunk_group(self) -> int:
        return 4096 if self.group_chunks is None else self.group_chunks

    @property
    def span_us(self) -> int:
        """Length of one chunk in microseconds."""
        return self.step_us * self.chunk_steps

    @property
    def row_key(self) -> tuple[str, ...]:
        return (*self.keys, self.ts)


# Column names of the bar, feature and label columns in the exchanged CSV files.
@dataclass(frozen=True)
class Bars:
    open: str = "Open"
    high: str = "High"
    low: str = "Low"
    close: str = "Close"
    volume: str = "Volume_(BTC)"
    turnover: str = "Volume_(Currency)"
    weighted: str = "Weighted_Price"

    @property
    def prices(self) -> list[str]:
        return [self.open, self.high, self.low, self.close, self.weighted]

    @property
    def volumes(self) -> list[str]:
        return [self.volume, self.turnover]

    @property
    def all(self) -> list[str]:
        return [self.open, self.high, self.low, self.close, self.volume, self.turnover, self.weighted]


SMA_LENGTHS = (5, 10, 15)
VOLATILITY_LENGTH = 30
LAG_COUNT = 5
HORIZON = timedelta(minutes=15)
LABEL = "Target"
GK = "Feat_GK_Vol"
VOL_STD = "Feat_Vol_Std"


def sma_name(n: int) -> str:
    return f"Feat_SMA_{n}"


def lag_name(i: int) -> str:
    return f"Lag_{i}"


FEATURES = [*map(sma_name, SMA_LENGTHS), GK, VOL_STD]


def base_features(bars: Bars = Bars()) -> list[str]:
    """The 12 model inputs, in model order."""
    return [*bars.all, *FEATURES]


def lr_features(bars: Bars = Bars()) -> list[str]:
    """The 17 model inputs of the autoregressive logistic regression."""
    return [*base_features(bars), *(lag_name(i) for i in range(1, LAG_COUNT + 1))]
