"""Budgets on blocks: the unit of failure above the row, and runs that end as soon as too many blocks are lost.

A block is BLOCK_ROWS consecutive rows of a task; it is lost if all of its rows are. Tasks tell their lost blocks by
name, so a task that runs again tells nothing twice.
"""

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import AccumulatorParam, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.operators.quality import BudgetExceeded

BLOCK_ROWS = 50
POLL_SECONDS = 0.2


class _Names(AccumulatorParam):
    def zero(self, value: set) -> set:
        return set()

    def addInPlace(self, one: set, other: set) -> set:
        one |= other
        return one


class TaskBlocks:
    """Counts the lost blocks of one task, and ends it when it alone has lost more than the budget."""

    def __init__(self, budget: "BlockBudget"):
        self.budget, self.number, self.rows, self.lost, self.told = budget, 0, 0, 0, 0
        self.stage = TaskContext.get().stageId(), TaskContext.get().partitionId()

    def row(self, lost: bool) -> None:
        self.rows += 1
        self.lost += lost
        if self.rows == self.budget.rows:
            self.end()

    def end(self) -> None:
        if self.rows and self.lost == self.rows:
            self.budget.names.add({(*self.stage, self.number)})
            self.told += 1
            if self.told > self.budget.most:
                raise BudgetExceeded(f"more than {self.budget.most} blocks failed in one task")
        self.number, self.rows, self.lost = self.number + 1, 0, 0


class BlockBudget:
    """At most ``most`` lost blocks of ``rows`` rows in the jobs that run under ``watch``."""

    def __init__(self, spark: SparkSession, most: int, rows: int = BLOCK_ROWS):
        self.most, self.rows = most, rows
        self.names = spark.sparkContext.accumulator(set(), _Names())
        self._context = spark.sparkContext

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "_context"}

    def task(self) -> TaskBlocks:
        return TaskBlocks(self)

    def lost(self) -> int:
        """Blocks that tasks which ended have lost."""
        return len(self.names.value)

    @contextmanager
    def watch(self) -> Iterator[None]:
        """Cancel the jobs inside as soon as ended tasks have lost more blocks than the budget; then BudgetExceeded."""
        group, ended = f"blocks-{uuid.uuid4().hex}", threading.Event()
        before = self._context.getLocalProperty("spark.jobGroup.id")

        def poll() -> None:
            while not ended.wait(POLL_SECONDS):
                if self.lost() > self.most:
                    self._context.cancelJobGroup(group)

        watcher = threading.Thread(target=poll, daemon=True)
        self._context.setJobGroup(group, f"at most {self.most} lost blocks", interruptOnCancel=True)
        watcher.start()
        try:
            yield
        except Exception as failure:
            if self.lost() > self.most or BudgetExceeded.__name__ in str(failure):
                raise BudgetExceeded(f"more than {self.most} blocks failed") from failure
            raise
        finally:
            ended.set()
            watcher.join()
            self._context.setLocalProperty("spark.jobGroup.id", before)
        if self.lost() > self.most:
            raise BudgetExceeded(f"more than {self.most} blocks failed")


def block_report(df: DataFrame, block: str = "block", error: str = "error", max_bad: int | None = None) -> DataFrame:
    """One row: ``blocks``, those of which every row has an error, ``rows_lost`` in all, and whether they are within the budget."""
    blocks = df.groupBy(block).agg(F.count("*").alias("n"), F.count_if(F.col(error).isNotNull()).alias("lost"))
    bad = F.count_if(F.col("lost") == F.col("n"))
    ok = bad <= max_bad if max_bad is not None else F.lit(True)
    return blocks.agg(F.count("*").alias("blocks"), bad.alias("bad_blocks"), F.coalesce(F.sum("lost"), F.lit(0)).alias("rows_lost"), ok.alias("ok"))
