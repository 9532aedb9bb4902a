"""Delay status buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket bounds in minutes and their labels.
HIGH_FROM = 60
SLIGHT_FROM = 15
STATUS_LABELS = {0: "On-time", 1: "Slight delay", 2: "High delay"}


def delay_status(delay: Column) -> Column:
    """0 on time, 1 slight, 2 high; the bound belongs to the later bucket, NULL stays NULL."""
    return F.when(delay >= HIGH_FROM, 2).when(delay >= SLIGHT_FROM, 1).when(delay <= SLIGHT_FROM, 0)


def status_label(status: Column) -> Column:
    return F.try_element_at(
        F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair]), status
    )
