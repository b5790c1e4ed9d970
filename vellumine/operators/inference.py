"""Models as a stage: a backend per worker, prompts in, answers or errors out.

The stage is one mapInPandas; filters belong before it. Its answers cost much and may differ
from call to call, so ``infer`` writes them once and everything after reads the copy.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vellumine.session import cut


class Backend(Protocol):
    """Answers a batch of prompts, as many as there are prompts and in their order.

    Options are those of ``Sampling.options``; a backend takes what it knows.
    """

    def generate(self, prompts: list[str], **options) -> list[str]: ...


@dataclass(frozen=True)
class Sampling:
    """How a model draws its answer."""

    max_new_tokens: int = 1_024
    temperature: float = 0.0
    do_sample: bool = False

    def options(self) -> dict:
        """Keyword arguments of ``generate``; without sampling the temperature is 0."""
        return {"max_tokens": self.max_new_tokens, "temperature": self.temperature if self.do_sample else 0.0}


#: Short names of backends: name to "module:factory". Plug-ins add theirs.
BACKENDS: dict[str, str] = {"echo": "vellumine.operators.inference:EchoBackend"}


class EchoBackend:
    """A stand-in for a model: reads title and dates off the prompt by fixed rules."""

    def generate(self, prompts: list[str], **options) -> list[str]:
        import json
        import re

        out = []
        for p in prompts:
            filled = [line.strip() for line in p.split("\n") if line.strip()]
            days = re.findall(r"\b(\d{4}-\d{2}-\d{2})\b", p)
            record = {"title": filled[0][:200] if filled else None, "inventors": None, "assignees": None}
            record |= {"pub_date_application": days[0] if days else None, "pub_date_publication": days[-1] if len(days) > 1 else None, "pub_date_foreign": None}
            out.append("```json\n" + json.dumps(record, ensure_ascii=False) + "\n```")
        return out


def backend(name: str) -> Callable[[], Backend]:
    """The factory of a backend, by short name or as "module:factory"."""
    target = BACKENDS.get(name, name)
    module, _, attribute = target.partition(":")
    if not attribute:
        raise ValueError(f"unknown backend {name!r}; known: {', '.join(sorted(BACKENDS))}, or module:factory")
    return getattr(importlib.import_module(module), attribute)


def _answers(model: Backend, prompts: list[str], options: dict | None = None) -> list[tuple[str | None, str | None, str | None]]:
    """(answer, error type, error detail) of each prompt; a failing batch is tried again prompt by prompt."""
    try:
        got = model.generate(prompts, **(options or {}))
        if len(got) != len(prompts):
            raise RuntimeError(f"{len(got)} answers to {len(prompts)} prompts")
        return [(a, None, None) for a in got]
    except Exception as problem:
        if len(prompts) == 1:
            return [(None, type(problem).__name__, str(problem))]
        return [x for p in prompts for x in _answers(model, [p], options)]


def infer(prompts: DataFrame, prompt: str, name: str, batch: int = 32, sampling: Sampling = Sampling()) -> DataFrame:
    """prompts without the prompt, with the columns answer, error, error_type and error_detail.

    batch: prompts in one call. Prompts of an Arrow batch go longest first, so those of one
    call are about equally long. A worker builds its backend once, for its first batch. Only
    keys and answers are written, never the prompts.
    """
    make, options = backend(name), sampling.options()
    kept = [(n, t) for n, t in prompts.dtypes if n != prompt]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for rows in batches:
            model = model or make()
            rows = rows.iloc[rows[prompt].map(len).to_numpy().argsort(kind="stable")[::-1]]
            got: list[tuple[str | None, str | None, str | None]] = []
            texts = rows[prompt].tolist()
            for at in range(0, len(texts), batch):
                got += _answers(model, texts[at : at + batch], options)
            failed = [f"exception: {kind}" if kind else None for _, kind, _ in got]
            yield rows[[n for n, _ in kept]].assign(answer=[a for a, _, _ in got], error=failed, error_type=[k for _, k, _ in got], error_detail=[d for _, _, d in got])

    schema = ", ".join(f"`{n}` {t}" for n, t in kept) + ", answer string, error string, error_type string, error_detail string"
    return cut(prompts.mapInPandas(run, schema))


def checked(df: DataFrame, key: str, results: DataFrame) -> DataFrame:
    """Rows with their results; a row without one fails the job."""
    marked = results.withColumn("_has", F.lit(True))
    joined = df.join(marked, key, "left")
    return joined.withColumn("_has", F.when(F.col("_has").isNull(), F.raise_error(F.concat(F.lit("no result for "), F.col(key).cast("string")))).otherwise(True)).filter("_has").drop("_has")
