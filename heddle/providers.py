"""A reader of residues behind a protocol: absent by default, its answers cached by content and applied as a table."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import text as T
from .operators.skew import attach_by_key


class Provider(Protocol):
    """Answers a batch of questions; None where it has no answer."""

    name: str

    def answer(self, questions: list[str]) -> list[str | None]: ...


class NullProvider:
    """The complete configuration without a model: it answers nothing, so every deterministic result stands."""

    name = "none"

    def answer(self, questions: list[str]) -> list[str | None]:
        return [None] * len(questions)


def json_object(text: str | None) -> dict | None:
    """The first JSON object in an answer, found by the parser from each brace on; None if there is none."""
    decoder, at = json.JSONDecoder(), (text or "").find("{")
    while at >= 0:
        try:
            got, _ = decoder.raw_decode(text, at)
            if isinstance(got, dict):
                return got
        except json.JSONDecodeError:
            pass
        at = text.find("{", at + 1)
    return None


def ask(questions: DataFrame, provider: Provider, cache: DataFrame | None = None, batch: int = 50) -> DataFrame:
    """(question) to (digest, question, answer): each distinct question once, those of the cache not at all.

    ``cache`` is an earlier result; the digest covers the provider's name and the question. Null questions are left out.
    """
    q = questions.where(F.col("question").isNotNull()).select("question").distinct().withColumn("digest", T.stable_hash(F.lit(provider.name), F.col("question")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch):
                some = b.iloc[i : i + batch]
                yield some.assign(answer=provider.answer(some["question"].tolist()))[["digest", "question", "answer"]]

    new = q if cache is None else q.join(cache.where("answer IS NOT NULL").select("digest"), "digest", "left_anti")
    got = new.select("digest", "question").mapInPandas(run, "digest string, question string, answer string")
    return got if cache is None else got.unionByName(cache.join(q.select("digest"), "digest", "left_semi").where("answer IS NOT NULL").select("digest", "question", "answer"))


def apply_verdicts(rows: DataFrame, row_id: str, question: str, answers: DataFrame, into: str) -> DataFrame:
    """The rows with ``into`` replaced by the answer to their question where there is one, and where it came from."""
    facts = answers.where("answer IS NOT NULL").groupBy(F.col("question").alias(question)).agg(F.min("answer").alias("__h_answer"))
    got = attach_by_key(rows, facts, [question], [row_id], how="left")
    return got.withColumn("decided_by", F.when(F.col("__h_answer").isNotNull(), "reader").otherwise("rules")).withColumn(into, F.coalesce("__h_answer", into)).drop("__h_answer")
