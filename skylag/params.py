"""Parameters shared by the forecasting and monitoring jobs."""

from dataclasses import dataclass, field
from datetime import date, timedelta

from skylag.functions.airports import AIRPORT_IDS

LABELS = {"arr": "ARR_DELAY", "dep": "DEP_DELAY"}


def _as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


@dataclass(frozen=True)
class Params:
    """Airport, training span, inference date, direction and promotion flag.

    The inference date defaults to the day after the training end.
    """

    airport: str = "JFK"
    training_start: date | str = "2018-01-01"
    training_end: date | str = "2019-03-15"
    inference_date: date | str | None = None
    direction: str = "arr"
    promote: bool = False
    label: str = field(init=False)

    def __post_init__(self):
        if self.airport not in AIRPORT_IDS:
            raise ValueError(f"unknown airport {self.airport!r}")
        if self.direction not in LABELS:
            raise ValueError(f"direction must be one of {sorted(LABELS)}")
        start, end = _as_date(self.training_start), _as_date(self.training_end)
        if start > end:
            raise ValueError("training_start is after training_end")
        infer = end + timedelta(days=1) if self.inference_date is None else _as_date(self.inference_date)
        if infer <= end:
            raise ValueError("inference_date must be after training_end")
        for name, value in (("training_start", start), ("training_end", end), ("inference_date", infer)):
            object.__setattr__(self, name, value)
        object.__setattr__(self, "label", LABELS[self.direction])

    @property
    def airport_id(self) -> int:
        return AIRPORT_IDS[self.airport]
