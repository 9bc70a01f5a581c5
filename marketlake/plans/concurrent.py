"""Models built side by side, each as soon as what it reads is built.

Every model runs in a driver thread of its own, with its jobs tagged and in a pool of their own, so that
under the fair scheduler (``spark.scheduler.mode``, set before Spark starts) a large model does not
hold up the small ones. A model is checked before its table points to the new rows. One that fails is
noted and its table stays as it was; what reads it is skipped, and everything else is finished.
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from marketlake import contracts
from marketlake.operators.quality import check_model, require_pass
from marketlake.plans.build import model_query, select_models
from marketlake.plans.models import Model
from marketlake.sinks.tables import publish_table
from marketlake.sources.lake import Lake

BUILT, FAILED, SKIPPED, CANCELLED = "built", "failed", "skipped", "cancelled"


@dataclass(frozen=True)
class Outcome:
    """What became of a model, and why it was not built."""

    model: str
    outcome: str
    reason: str | None = None


class BuildFailure(Exception):
    """At least one model was not built; ``outcomes`` has one for every model."""

    def __init__(self, outcomes: list[Outcome]):
        told = "; ".join(f"{o.model} {o.outcome}: {o.reason}" for o in outcomes if o.outcome != BUILT)
        super().__init__(told)
        self.outcomes = outcomes


class ConcurrentBuild:
    """One build of the selected models, at most ``at_once`` of them at a time."""

    def __init__(
        self,
        lake: Lake,
        select: str | None = None,
        exclude: str | None = None,
        run_date: date | None = None,
        prefix: str = "",
        at_once: int = 4,
        skip_checks: bool = False,
    ):
        self.lake, self.run_date, self.prefix = lake, run_date, prefix
        self.models = {m.name: m for m in select_models(select, exclude)}
        self.at_once, self.skip_checks = at_once, skip_checks
        self.tag = f"build-{uuid.uuid4().hex}"
        self._stopped = threading.Event()

    def run(self) -> list[Outcome]:
        """Build all models; an outcome for each, in the order of the selection."""
        done: dict[str, Outcome] = {}
        waiting = dict(self.models)
        running: dict[Future, str] = {}
        with ThreadPoolExecutor(self.at_once, thread_name_prefix=self.tag) as threads:
            while waiting or running:
                for model in list(waiting.values()):
                    parent = model.parent if model.parent in self.models else None
                    if parent is not None and parent not in done:
                        continue
                    del waiting[model.name]
                    if parent is not None and done[parent].outcome != BUILT:
                        done[model.name] = Outcome(model.name, SKIPPED, f"{parent} was not built")
                        continue
                    # A thread takes over the local properties of the one that starts it.
                    build = inheritable_thread_target(self.lake.spark)(self._build)
                    running[threads.submit(build, model)] = model.name
                finished, _ = wait(running, return_when=FIRST_COMPLETED) if running else ((), ())
                for future in finished:
                    done[running.pop(future)] = future.result()
        return [done[name] for name in self.models]

    def require(self) -> list[Outcome]:
        """Build all models, and fail after the last one if any was not built."""
        outcomes = self.run()
        if any(o.outcome != BUILT for o in outcomes):
            raise BuildFailure(outcomes)
        return outcomes

    def cancel(self) -> None:
        """End the running models' jobs and start no more."""
        self._stopped.set()
        self.lake.spark.sparkContext.cancelJobsWithTag(self.tag)

    def _build(self, model: Model) -> Outcome:
        context = self.lake.spark.sparkContext
        if self._stopped.is_set():
            return Outcome(model.name, CANCELLED, "the build was cancelled")
        context.addJobTag(self.tag)
        context.setLocalProperty("spark.scheduler.pool", f"{model.layer}.{model.name}")
        context.setLocalProperty("spark.job.description", f"build {model.layer}.{model.name}")
        try:
            publish_table(
                self.lake,
                model_query(self.lake, model, self.run_date, self.prefix),
                model.layer,
                model.name,
                database=f"{self.prefix}{model.layer}",
                accept=None if self.skip_checks else lambda rows: self._check(model, rows),
            )
        except Exception as error:
            stopped = self._stopped.is_set()
            reason = "the build was cancelled" if stopped else str(error).strip().splitlines()[0]
            return Outcome(model.name, CANCELLED if stopped else FAILED, reason)
        finally:
            context.removeJobTag(self.tag)
            context.setLocalProperty("spark.scheduler.pool", None)
            context.setLocalProperty("spark.job.description", None)
        return Outcome(model.name, BUILT)

    def _check(self, model: Model, rows: DataFrame) -> None:
        if checks := contracts.CHECKS.get(model.name):
            require_pass(check_model(rows, model.name, checks))

