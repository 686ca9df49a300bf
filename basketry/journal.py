"""A run's finished steps and what they read, so that a run that broke goes on where it broke."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from basketry import marks

DONE = "done.json"


@dataclass(frozen=True)
class Step:
    """A finished step: its own identity, which later steps name as what they read, and its result."""

    id: str
    result: dict


class Journal:
    """Steps of the attempts at one run.

    An attempt that was not finished is taken up again: steps it has finished, with the same inputs,
    are not repeated. After a finished attempt, or if ``fresh`` is asked for, a new one begins.
    """

    def __init__(self, spark: SparkSession, folder: str, fresh: bool = False):
        self.spark = spark
        attempts = marks.names(spark, folder)
        over = not attempts or fresh or DONE in marks.names(spark, f"{folder}/{attempts[-1]}")
        self.folder = f"{folder}/{len(attempts) + 1:06d}" if over else f"{folder}/{attempts[-1]}"
        self.repeated: list[str] = []

    def step(self, name: str, inputs: Mapping[str, str], work: Callable[[], dict]) -> Step:
        """The result of ``work``, done now or found in the journal. Results must be plain values.

        A step is noted after its work is done; one that breaks before that is done again, so work
        must be safe to repeat.
        """
        read = json.dumps(dict(sorted(inputs.items())))
        path = f"{self.folder}/{name.replace('/', '.')}-{hashlib.sha256(read.encode()).hexdigest()[:16]}.json"
        if (found := marks.get(self.spark, path)) is None:
            self.repeated.append(name)
            note = {"id": uuid.uuid4().hex, "step": name, "inputs": json.loads(read), "result": work()}
            found = json.dumps(note)
            marks.put(self.spark, path, found)
        note = json.loads(found)
        return Step(note["id"], note["result"])

    def finish(self) -> None:
        marks.put(self.spark, f"{self.folder}/{DONE}", "{}")
