"""Recognizers of mentions: anything that takes lines and gives entities.

A recognizer is a function over batches of texts, as a model behind Arrow batches would be; rule() makes one from a regular expression
and stays in built-in functions.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.schemas import LINE, MENTIONS


def by_rule(lines: DataFrame, pattern: str, label: str = "citation") -> DataFrame:
    """(source, title, line_index, label, start, end): matches of a pattern in code points."""
    found = F.regexp_extract_all("content", F.lit(pattern), F.lit(0))
    gaps = F.split(F.col("content"), pattern, -1)
    spans = F.transform(
        found,
        lambda hit, k: F.struct(
            (F.aggregate(F.slice(gaps, F.lit(1), k + 1), F.lit(0), lambda a, g: a + F.length(g)) + F.aggregate(F.slice(found, F.lit(1), k), F.lit(0), lambda a, h: a + F.length(h))).alias("start"),
            hit.alias("hit"),
        ),
    )
    each = lines.where(F.col("content").rlike(pattern)).select(*LINE, F.explode(spans).alias("s"))
    return each.select(*LINE, F.lit(label).alias("label"), F.col("s.start").alias("start"), (F.col("s.start") + F.length("s.hit")).alias("end"))


def _shape(entities: list[dict], text: str) -> str | None:
    """What is wrong with a model's answer to a text, if anything."""
    for e in entities:
        if not isinstance(e, dict) or set(e) - {"label", "range", "parts"} or not isinstance(e.get("label"), str) or not 0 < len(e["label"]) <= 200:
            return "label"
        inner = [(e.get("range"), len(text))] + [(p.get("range"), e["range"][1] - e["range"][0] if isinstance(e.get("range"), (list, tuple)) and len(e["range"]) == 2 else -1) for p in e.get("parts") or []]
        for span, size in inner:
            if not isinstance(span, (list, tuple)) or len(span) != 2 or not all(type(x) is int for x in span) or not 0 <= span[0] < span[1] <= size:
                return "range"
    return None


def _asked(model: Callable[[list[str]], list[list[dict]]], texts: list[str], tries: int) -> list[list[dict]]:
    """A model's answers. Lost connections and timeouts are asked again, each time after twice as long; a wrong answer is an error at once."""
    for k in range(tries):
        try:
            answers = model(texts)
            break
        except (ConnectionError, TimeoutError):
            if k + 1 == tries:
                raise
            time.sleep(2**k)
    if len(answers) != len(texts):
        raise ValueError(f"{len(answers)} answers to {len(texts)} texts")
    for text, entities in zip(texts, answers, strict=True):
        if problem := _shape(entities, text):
            raise ValueError(f"a wrong {problem} in the answer to {text[:80]!r}")
    return answers


def by_model(lines: DataFrame, load: Callable[[], Callable[[list[str]], list[list[dict]]]], batch: int = 150, tries: int = 3) -> DataFrame:
    """MENTIONS from a model that load() makes once per task and that answers `batch` texts at a time, one list of entities each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = []
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                answers = _asked(model, part["content"].fillna("").tolist(), tries)
                for (source, title, line), entities in zip(part[LINE].itertuples(index=False), answers, strict=True):
                    rows += [(source, title, line, e["label"], *e["range"], [(p["label"], *p["range"]) for p in e.get("parts") or []]) for e in entities]
            yield pd.DataFrame(rows, columns=MENTIONS.names)

    return lines.select(*LINE, "content").mapInPandas(run, MENTIONS)
