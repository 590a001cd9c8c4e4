"""Processing each sequence number once: intervals of processed numbers, gaps, and atomic commits.

Processed sequence numbers are kept as disjoint half-open intervals ``[lo, hi)``. A run subtracts them from the available
ranges, processes the gaps (late arrivals with smaller numbers are gaps like any other) and commits the merged intervals
together with its output by one atomic step. A run that dies before it has committed nothing; its numbers stay gaps.

All interval arithmetic works in blocks of ``width`` numbers, so that no window holds more than a block.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.plans.lineage import cut, enumerated
from weftgraph.plans.versions import Versions

#: Sequence numbers of one block; a window function sees at most this many rows or twice as many interval ends.
WIDTH = 1 << 20

INTERVALS = "lo bigint, hi bigint"


def islands(numbers: DataFrame, seq: str = "seq", width: int = WIDTH) -> DataFrame:
    """Disjoint intervals that hold exactly the numbers of ``seq``; nulls are ignored, repeats count once.

    No rows give no intervals.
    """
    block = F.floor(F.col("seq") / width)
    rows = numbers.select(F.col(seq).cast("bigint").alias("seq")).where(F.col("seq").isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy("block").orderBy("seq"))
    return (
        rows.withColumn("block", block)
        .withColumn("island", F.col("seq") - place)
        .groupBy("block", "island")
        .agg(F.min("seq").alias("lo"), (F.max("seq") + 1).alias("hi"))
        .select("lo", "hi")
    )


def _events(intervals: DataFrame, width: int, available: int, processed: int) -> DataFrame:
    """The ends of intervals, cut at block borders, as steps of two counters."""
    last = F.floor((F.col("hi") - 1) / width)
    pieces = (
        intervals.where(F.col("lo") < F.col("hi"))
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / width), last)))
        .select(
            "block",
            F.greatest("lo", F.col("block") * width).alias("lo"),
            F.least("hi", (F.col("block") + 1) * width).alias("hi"),
        )
    )
    ends = F.array(
        F.struct(F.col("lo").alias("at"), F.lit(available).alias("a"), F.lit(processed).alias("p")),
        F.struct(F.col("hi").alias("at"), F.lit(-available).alias("a"), F.lit(-processed).alias("p")),
    )
    return pieces.select("block", F.inline(ends))


def merged(intervals: DataFrame, width: int = WIDTH) -> DataFrame:
    """Disjoint intervals that cover what ``intervals`` cover; overlapping and touching ones become one within a block."""
    return subtracted(intervals, None, width)


def subtracted(available: DataFrame, processed: DataFrame | None, width: int = WIDTH) -> DataFrame:
    """Disjoint intervals of the numbers in ``available`` that are not in ``processed``.

    Empty intervals and repeats are harmless on either side. Results are cut at multiples of ``width``.
    """
    events = _events(available, width, 1, 0)
    if processed is not None:
        events = events.unionByName(_events(processed, width, 0, 1))
    steps = events.groupBy("block", "at").agg(F.sum("a").alias("a"), F.sum("p").alias("p"))
    order = Window.partitionBy("block").orderBy("at")
    open_now = steps.select(
        "block",
        "at",
        F.sum("a").over(order).alias("a"),
        F.sum("p").over(order).alias("p"),
        F.lead("at").over(order).alias("until"),
    )
    wanted = open_now.withColumn("wanted", (F.col("a") > 0) & (F.col("p") == 0) & F.col("until").isNotNull())
    starts = wanted.withColumn(
        "start", (F.col("wanted") & ~F.coalesce(F.lag("wanted").over(order), F.lit(False))).cast("int")
    ).withColumn("run", F.sum("start").over(order))
    return (
        starts.where("wanted")
        .groupBy("block", "run")
        .agg(F.min("at").alias("lo"), F.max("until").alias("hi"))
        .select("lo", "hi")
    )


def inside(rows: DataFrame, intervals: DataFrame, seq: str = "seq", width: int = WIDTH) -> DataFrame:
    """The rows whose number lies in one of the disjoint ``intervals``; rows without a number are in none.

    One sweep per block instead of a range join: each row looks back to the last interval that starts at or before it.
    Columns of ``rows`` are kept whatever their names are.
    """
    packed = rows.select(F.col(seq).cast("bigint").alias("at"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    packed = packed.where(F.col("at").isNotNull()).select(
        F.floor(F.col("at") / width).alias("block"), "at", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("hi"), "row"
    )
    bounds = (
        intervals.where(F.col("lo") < F.col("hi"))
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
        .select(
            "block",
            F.greatest("lo", F.col("block") * width).alias("at"),
            F.lit(0).alias("kind"),
            F.least("hi", (F.col("block") + 1) * width).alias("hi"),
        )
        .withColumn("row", F.lit(None).cast(packed.schema["row"].dataType))
    )
    order = Window.partitionBy("block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = packed.unionByName(bounds).withColumn("until", F.last("hi", ignorenulls=True).over(order))
    return swept.where((F.col("kind") == 1) & (F.col("at") < F.col("until"))).select("row.*")


class Ledger:
    """Committed runs of one pipeline in a shared folder, and the numbers of what they process.

    ``register`` gives each new state of a key a sequence number for good. ``run`` subtracts the processed intervals from the
    registered ones, processes the gaps and commits the merged intervals together with the output by publishing one version.
    A run that dies before that has committed nothing, and its numbers stay gaps. Of two runs that started from the same
    version only one can publish the next; the other raises ``Conflict`` and none of its output is part of the ledger.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._runs = Versions(spark, f"{self.folder}/runs")
        self._numberings = Versions(spark, f"{self.folder}/numberings")

    def _data(self) -> str:
        return f"{self.folder}/data/{uuid.uuid4().hex}"

    def runs(self) -> list[int]:
        """Numbers of the committed runs, in order."""
        return self._runs.numbers()

    def processed(self) -> DataFrame:
        """Merged intervals of all committed runs, which the last one holds; no rows before the first."""
        last = self._runs.latest()
        if last < 0:
            return self.spark.createDataFrame([], INTERVALS)
        return self.spark.read.schema(INTERVALS).parquet(f"{self._runs.read(last)}/intervals")

    def output(self, schema, runs: list[int] | None = None) -> DataFrame:
        """Output rows of the given runs, or of all."""
        found = [f"{self._runs.read(n)}/output" for n in (self.runs() if runs is None else runs)]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def registered(self, key: str, state: str, types: tuple[str, str] = ("string", "string")) -> DataFrame:
        """(key, state, seq) of all numbers given so far."""
        schema = f"{key} {types[0]}, {state} {types[1]}, seq bigint"
        folders = [self._numberings.read(n).split("\n")[0] for n in self._numberings.numbers()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def register(self, states: DataFrame, key: str, state: str) -> DataFrame:
        """(key, state, seq) for the present state of each key; ``states`` holds each key once, without nulls.

        A key whose state isn't the last one registered for it gets a new number, one that returns to an older state too.
        """
        types = tuple(states.schema[c].dataType.simpleString() for c in (key, state))
        last = self._numberings.latest()
        first = int(self._numberings.read(last).split("\n")[1]) if last >= 0 else 0
        known = self.registered(key, state, types).groupBy(key).agg(F.max(F.struct("seq", state)).alias("known"))
        joined = states.select(key, state).join(known, key, "left")
        fresh, total = enumerated(joined.where(~F.col(f"known.{state}").eqNullSafe(F.col(state))).select(key, state), start=first)
        if total:
            folder = self._data()
            fresh.write.parquet(folder)
            self._numberings.publish(last + 1, f"{folder}\n{first + total}")
        if last < 0:
            return fresh
        now = self.registered(key, state, types).groupBy(key).agg(F.max(F.struct("seq", state)).alias("now"))
        return states.select(key).join(now, key).select(key, F.col(f"now.{state}").alias(state), "now.seq")

    def gaps(self, available: DataFrame) -> DataFrame:
        """What no committed run has processed of the intervals in ``available``."""
        return subtracted(available, self.processed())

    def commit(self, intervals: DataFrame, output: DataFrame, after: int | None = None) -> int:
        """Publish ``output`` and the processed intervals with ``intervals`` added; returns the run's number.

        ``after`` is the last run that was known when the work began; raises ``Conflict`` if there is a later one by now.
        """
        number = (self._runs.latest() if after is None else after) + 1
        folder = self._data()
        both = intervals.select("lo", "hi").unionByName(self.processed())
        merged(both).write.parquet(f"{folder}/intervals")
        output.write.parquet(f"{folder}/output")
        self._runs.publish(number, folder)
        return number

    def run(self, rows: DataFrame, process, seq: str = "seq") -> int | None:
        """Process the rows that no committed run has processed; returns the run's number, or None where nothing is new.

        ``process`` maps the new rows to output rows. Rows with a null number can't be tracked and are left out.
        """
        after = self._runs.latest()
        gaps = cut(self.gaps(islands(rows, seq)))
        if gaps.isEmpty():
            return None
        return self.commit(gaps, process(inside(rows, gaps, seq)), after)
