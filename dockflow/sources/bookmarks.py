"""Where loads have got to: one small state file per load, replaced by a rename after the data is in place.

A run that dies before the rename has committed nothing: readers take committed batches only, and the next run starts from
the old bookmark and replaces what the dead one left.
"""

import json
from dataclasses import asdict, dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from dockflow.sources import sinks


@dataclass(frozen=True)
class Bookmark:
    """``batch_id`` is the last committed one (-1: none); ``high_water`` the largest datetime key that was extracted."""

    load: str
    batch_id: int = -1
    high_water: str | None = None
    rides: int = 0

    def after(self, batch_id: int, high_water: str | None, rides: int) -> "Bookmark":
        marks = [m for m in (self.high_water, high_water) if m is not None]
        return replace(self, batch_id=batch_id, high_water=max(marks, default=None), rides=self.rides + rides)


def _folder(target: str) -> str:
    return f"{target.rstrip('/')}-state"


def read(spark: SparkSession, target: str, load: str) -> Bookmark:
    """The bookmark of a load; a new one if it has never committed."""
    path = f"{_folder(target)}/{load}.json"
    if not sinks.matching(spark, path):
        return Bookmark(load)
    return Bookmark(**json.loads(sinks.pointed(spark, path)))


def commit(spark: SparkSession, target: str, bookmark: Bookmark) -> None:
    sinks.point(spark, f"{_folder(target)}/{bookmark.load}.json", json.dumps(asdict(bookmark)))


def every(spark: SparkSession, target: str) -> list[Bookmark]:
    """The bookmarks of all loads into the target: one per pipeline or checkpoint, so few."""
    return [Bookmark(**json.loads(sinks.pointed(spark, p))) for p in sinks.matching(spark, f"{_folder(target)}/*.json")]


def committed(spark: SparkSession, target: str) -> Column:
    """True for rows of committed batches, by their ``load`` and ``batch_id``."""
    done = [(F.col("load") == b.load) & (F.col("batch_id") <= b.batch_id) for b in every(spark, target)]
    return reduce(or_, done, F.lit(False))
