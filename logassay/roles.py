"""Which column of a table plays which part in an audit."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Column names by role; defaults match the views in ``plans.inputs``.

    ``day`` holds a YYYYMMDD integer, ``wall_time`` a zone-less local timestamp,
    ``epoch`` UTC seconds as a double, and ``ratio`` = numerator / denominator.
    """

    user: str = "user_id"
    item: str = "item_id"
    day: str = "day"
    wall_time: str = "wall_time"
    epoch: str = "epoch_s"
    numerator: str = "played_ms"
    denominator: str = "length_ms"
    ratio: str = "ratio"

    @property
    def pair(self) -> list[str]:
        return [self.user, self.item]

    @property
    def day_pair(self) -> list[str]:
        return [self.day, self.user, self.item]

    @property
    def columns(self) -> list[str]:
        return [
            self.user, self.item, self.numerator, self.denominator,
            self.wall_time, self.day, self.epoch, self.ratio,
        ]
