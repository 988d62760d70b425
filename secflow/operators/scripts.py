"""User scripts that change or reject events.

A script is the body of a function without arguments.  It sees the event as the nested dict
``event``, may use ``lens`` to read and write dotted paths, and returns ``(event, keep)``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The helpers below travel with the task, so executors need nothing installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lens(path: str):
    """Accessor of a dotted path: read, ``value=`` write, or ``andThen=`` apply to what is there."""
    *parents, last = path.split(".")

    def access(node: dict, **how):
        if "value" in how:
            for name in parents:
                node = node.setdefault(name, {})
            node[last] = how["value"]
            return how["value"]
        found = node
        for name in (*parents, last):
            found = found.get(name) if isinstance(found, dict) else None
            if found is None:
                return None
        return how["andThen"](found) if "andThen" in how else found

    return access


class ScriptChain:
    """Scripts compiled once and run in order until one of them rejects the event."""

    def __init__(self, scripts: Iterable[tuple[str, str]]):
        self.scope: dict = {"lens": lens, "event": None}
        self.steps = []
        for name, body in scripts:
            source = f"def {name}():\n" + "\n".join("    " + line for line in body.splitlines())
            exec(compile(source, f"<script {name}>", "exec"), self.scope)  # noqa: S102
            self.steps.append(self.scope[name])

    def __call__(self, event: dict) -> tuple[dict, bool]:
        self.scope["event"] = event
        result = (event, True)
        for step in self.steps:
            result = step()
            if result[1] is not True:
                break
        return result[0], bool(result[1])


def run_one(chain: ScriptChain, text: str | None) -> tuple[str | None, bool | None, str | None]:
    """The rewritten value, whether it is kept, and why it could not be decided."""
    try:
        event = json.loads(text) if text is not None else None
        if not isinstance(event, dict):
            return text, None, "not a JSON object"
        event, keep = chain(event)
        return json.dumps(event, separators=(",", ":"), ensure_ascii=False), keep, None
    except Exception as error:  # noqa: BLE001 - a user's script may raise anything
        return text, None, f"{type(error).__name__}: {error}"


def apply_scripts(df: DataFrame, scripts: list[tuple[str, str]], value: str = "value") -> DataFrame:
    """Run (name, body) scripts over JSON events: ``value`` is rewritten and ``keep`` is added.

    Rows travel in Arrow batches and the scripts are compiled once per task.  Without scripts
    the frame passes through unchanged and everything is kept.  A value that is NULL or no JSON
    object, or a script that fails, leaves ``value`` as it was, ``keep`` NULL and the reason in
    ``script_error``; ``failed_scripts`` selects these rows.
    """
    if not scripts:
        return df.withColumns({"keep": F.lit(True), "script_error": F.lit(None).cast("string")})
    schema = T.StructType([
        *df.schema.fields, T.StructField("keep", T.BooleanType()), T.StructField("script_error", T.StringType())])
    steps = list(scripts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chain = ScriptChain(steps)
        for batch in batches:
            results = [run_one(chain, text) for text in batch[value]]
            batch[value] = [text for text, _, _ in results]
            batch["keep"] = pd.array([keep for _, keep, _ in results], dtype="boolean")
            batch["script_error"] = [error for _, _, error in results]
            yield batch

    return df.mapInPandas(run, schema)


def keep_approved(df: DataFrame) -> DataFrame:
    return df.where("keep").drop("keep", "script_error")


def failed_scripts(df: DataFrame) -> DataFrame:
    """Rows that no script could decide, with the reason."""
    return df.where(F.col("keep").isNull()).drop("keep")
