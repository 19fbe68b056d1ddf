"""The four stages alive at once, under periodic triggers, with supervision.

Each stage is a query with its own checkpoint that reads the durable log of the one before, so a
stage that fails takes nothing with it: the ones before it go on filling its log, the ones after it
wait on theirs.  ``tend`` starts a stage that ended again from its checkpoint.  A stage that ends more than
``restarts`` times without delivering a micro-batch in between is given up: what it delivered is
drained through the later stages, everything stops, and ``StageFailed`` names it with its cause.
``drain`` is the clean end: stage by stage, in order, each finishes what its predecessor delivered.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import contract as C
from ..plans.keyed import Files
from ..session import pin_utc, scratch_path
from ..sources import topics as tp
from . import jobs

EVERY = {"processingTime": "5 seconds"}


class StageFailed(RuntimeError):
    """A stage went on failing; ``stage`` names it, ``__cause__`` is what its query raised."""

    def __init__(self, stage: str, ends: int):
        super().__init__(f"stage {stage} ended {ends} times without a micro-batch in between")
        self.stage = stage


@dataclass
class Stage:
    name: str
    begin: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    ends: int = 0
    restarts: int = 0
    done: bool = False
    history: list[str] = field(default_factory=list)


class LivePipeline:
    def __init__(self, spark: SparkSession, topic_rows: DataFrame, root: str | None = None, trigger: dict | None = None,
                 restarts: int = 3, dedup_spread: int | None = 8, max_bytes_per_trigger: int | None = tp.BATCH_BYTES):
        self.spark, self.restarts = pin_utc(spark), restarts
        self.paths = paths = jobs.PipelinePaths(root or scratch_path(spark, "live"))
        every = trigger or EVERY

        def log(path: str, route: str | None = None) -> DataFrame:
            return tp.key_value_log(spark, path, route=route, max_bytes_per_trigger=max_bytes_per_trigger)

        self.stages = [
            Stage("validation", lambda: jobs.run_validation(topic_rows, paths.routed, paths.checkpoint("validation"), every)),
            Stage("deduplication", lambda: jobs.run_dedup(log(paths.routed, C.VALID), paths.unique,
                                                          paths.checkpoint("deduplication"), trigger=every,
                                                          spread=dedup_spread)),
            Stage("business", lambda: jobs.run_business(log(paths.unique), paths.states, paths.checkpoint("business"),
                                                        trigger=every)),
            Stage("history", lambda: jobs.run_history(log(paths.states), paths.history, paths.checkpoint("history"), every)),
        ]

    def stage(self, name: str) -> Stage:
        return next(s for s in self.stages if s.name == name)

    def start(self) -> LivePipeline:
        """Start every stage; a reader needs its log's folder, which the writer may not have made yet."""
        files = Files(self.spark, self.paths.root)
        for path in (self.paths.routed, self.paths.unique, self.paths.states):
            files.system.mkdirs(files.path(path))
        for stage in self.stages:
            stage.query = stage.begin()
        return self

    def tend(self) -> list[str]:
        """Start the stages that ended again; -> their names."""
        again = []
        for stage in (s for s in self.stages if not s.done):
            if stage.query.isActive:
                if stage.query.lastProgress is not None:
                    stage.ends = 0
                continue
            cause = stage.query.exception()
            stage.history.append(str(cause) if cause else "stopped")
            stage.ends += 1
            if stage.ends > self.restarts:
                self._give_up(stage, cause)
            stage.restarts += 1
            stage.query = stage.begin()
            again.append(stage.name)
        return again

    def run(self, seconds: float, poll: float = 0.5) -> None:
        """Tend the stages for a time (a driver that stays up calls it for as long as it lives)."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            self.tend()
            time.sleep(poll)

    def drain(self) -> None:
        """Let each stage finish, in order, then end it.  A stage that fails meanwhile is tended."""
        for stage in self.stages:
            self._finish(stage)

    def stop(self) -> None:
        """End everything at once; checkpoints hold where to go on."""
        for stage in self.stages:
            if stage.query is not None and stage.query.isActive:
                stage.query.stop()

    def _finish(self, stage: Stage) -> None:
        while True:
            self.tend()
            try:
                stage.query.processAllAvailable()
                if stage.query.isActive:
                    break
            except StreamingQueryException:
                pass  # the next round tends it
        stage.query.stop()
        stage.done = True

    def _give_up(self, stage: Stage, cause: Exception | None) -> None:
        at = self.stages.index(stage)
        for earlier in self.stages[:at]:
            if earlier.query.isActive:
                earlier.query.stop()
        for later in self.stages[at + 1:]:
            if later.query.isActive:
                try:
                    later.query.processAllAvailable()
                finally:
                    later.query.stop()
        raise StageFailed(stage.name, stage.ends) from cause
