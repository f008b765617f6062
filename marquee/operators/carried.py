"""Chart movement carried from load to load.

Where a title stood last, per market and title, is all that the next week needs to know.
That state is a table of its own, far smaller than the history: a new week is
joined to it and merged in, and neither step reads an older week again.
:func:`marquee.operators.movement.with_prior` gives the same from the whole history.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources import files

KEY = ["region_id", "title_id"]
STATE = "region_id long, title_id long, last_date date, last_rank int"


def last_seen(weekly: DataFrame) -> DataFrame:
    """State behind any number of weeks: the newest place of each title in each market."""
    newest = F.max(F.struct(F.col("date_key").alias("last_date"), F.col("weekly_rank").alias("last_rank")))
    return weekly.groupBy(*KEY).agg(newest.alias("last")).select(*KEY, "last.*")


def merged(state: DataFrame, week: DataFrame) -> DataFrame:
    """The state with a week added; weeks may be merged in any order and more than once."""
    newest = F.max(F.struct("last_date", "last_rank"))
    return state.unionByName(last_seen(week)).groupBy(*KEY).agg(newest.alias("last")).select(*KEY, "last.*")


def with_carried(week: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of one week with ``prior_rank`` and ``prior_date`` from the state of the weeks before it."""
    prior = state.select(
        *(F.col(k).alias(f"_{k}") for k in KEY), F.col("last_rank").alias("prior_rank"), F.col("last_date").alias("prior_date")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    return week.join(prior, same[0] & same[1], "left").drop(*(f"_{k}" for k in KEY))


class Movement:
    """States kept under a folder, one version for each week loaded.

    A version is written whole before the one it follows is dropped, so a failed run leaves a state
    to go on from, and the newest week may be loaded again. Weeks must come in order.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        files.make(spark, self.folder)

    def weeks(self) -> list[date]:
        """Weeks that a version is kept for; their number is bounded by :meth:`load`."""
        names = files.names(self.spark, self.folder)
        done = [n for n in names if n.startswith("week=") and files.exists(self.spark, f"{self.folder}/{n}/_SUCCESS")]
        return sorted(date.fromisoformat(n.removeprefix("week=")) for n in done)

    def before(self, week: date) -> DataFrame:
        """The state that a week is compared with."""
        older = [w for w in self.weeks() if w < week]
        if not older:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.folder}/week={older[-1]}")

    def load(self, rows: DataFrame, week: date, keep: int = 2) -> DataFrame:
        """Merge the rows of ``week`` in; returns them with their prior places.

        ``keep`` versions stay. A week older than the newest loaded is refused, as later weeks have been compared without it.
        """
        known = self.weeks()
        if known and week < known[-1]:
            raise ValueError(f"{week} comes after {known[-1]} was loaded")
        state = self.before(week)
        path = f"{self.folder}/week={week}"
        merged(state, rows).write.mode("overwrite").parquet(path)
        for old in self.weeks()[:-keep]:
            files.remove(self.spark, f"{self.folder}/week={old}")
        return with_carried(rows, state)


def after(state: DataFrame) -> Column:
    """The first week the state knows nothing of, as a scalar."""
    return F.date_add(state.agg(F.max("last_date")).scalar(), 1)
