"""Run independent steps: go on after a failure, report all, raise at the end."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


class StepsFailed(RuntimeError):
    """Some steps failed; ``failed`` holds the reason per step, ``done`` what succeeded."""

    def __init__(self, done: list[str], failed: Mapping[str, Exception]):
        self.done, self.failed = done, dict(failed)
        reasons = "; ".join(f"{name}: {error}" for name, error in self.failed.items())
        super().__init__(f"{len(self.failed)} of {len(done) + len(self.failed)} failed: {reasons}")


def run_steps(steps: Mapping[str, Callable[[], object]], at_once: int = 1) -> list[str]:
    """Run the steps, up to ``at_once`` beside each other; the names of all, in order, if all succeed."""
    done, failed, session = [], {}, SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session else inheritable_thread_target
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(inherit(step)) for name, step in steps.items()}
    for name, step in running.items():
        error = step.exception()
        if error is None:
            done.append(name)
        else:  # kept per step and raised together below
            failed[name] = error
    if failed:
        raise StepsFailed(done, failed)
    return done


def report(
    spark: SparkSession,
    done: Mapping[str, int | None],
    failed: Mapping[str, Exception],
    skipped: Iterable[str] = (),
) -> DataFrame:
    """``(step, status, row_count, reason)``: what was stored, what failed, what was not tried."""
    rows = [(name, "OK", count, None) for name, count in done.items()]
    rows += [(name, "FAILED", None, str(error)) for name, error in failed.items()]
    rows += [(name, "SKIPPED", None, None) for name in skipped]
    return spark.createDataFrame(rows, "step string, status string, row_count bigint, reason string")
