"""Slots for recognisers and aligners: DataFrame in, DataFrame out, with declared columns.

A model is any callable on a pandas batch; it runs in mapInPandas on the executors. Fakes give tests something to run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose words an aligner holds as Python objects at one time.
ALIGNED_AT_ONCE = 256
WORDS = "array<struct<word:string,start:double,end:double,score:double>>"


def apply_model(rows: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], adds: str, at_once: int | None = None) -> DataFrame:
    """M1 to M5: the rows with the model's columns; a batch that fails is retried by Spark as its task is.

    at_once: the model sees no more rows together, for results that are much larger than their rows."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), adds])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), at_once or max(len(b), 1)):
                yield model(b.iloc[k : k + (at_once or len(b))])

    return rows.mapInPandas(run, schema)


def transcribe(rows: DataFrame, model) -> DataFrame:
    return apply_model(rows, model, "hyp string")


def align(rows: DataFrame, model) -> DataFrame:
    """M4: words with times; a row that the model fails on has none, and the others of its batch keep theirs."""

    def one_by_one(batch: pd.DataFrame) -> pd.DataFrame:
        try:
            return model(batch)
        except Exception:  # noqa: BLE001  whatever the model raises belongs to a row
            words = []
            for i in range(len(batch)):
                try:
                    words.append(model(batch.iloc[[i]])["words"].iloc[0])
                except Exception:  # noqa: BLE001
                    words.append([])
            return batch.assign(words=pd.Series(words, index=batch.index, dtype=object))

    return apply_model(rows, one_by_one, f"words {WORDS}", at_once=ALIGNED_AT_ONCE)


def merged_regions(regions: Column, chunk_s: float = 30.0) -> Column:
    """M1: speech regions (start, end), in order -> chunks of at most `chunk_s` seconds: a region that would make the chunk longer
    begins the next one. A region longer than that is a chunk of its own."""
    kind = "struct<done:array<struct<start:double,end:double>>,start:double,end:double>"
    chunk = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))

    def step(state: Column, r: Column) -> Column:
        full = (r["end"] - state["start"] > chunk_s) & (state["end"] > state["start"])
        opened = F.struct(F.concat(state["done"], F.array(chunk(state))).alias("done"), r["start"].cast("double").alias("start"), r["end"].cast("double").alias("end"))
        longer = F.struct(state["done"].alias("done"), state["start"].alias("start"), r["end"].cast("double").alias("end"))
        return F.when(full, opened).otherwise(longer).cast(kind)

    none = F.array().cast("array<struct<start:double,end:double>>")
    first = F.coalesce(F.get(regions, F.lit(0))["start"].cast("double"), F.lit(0.0))
    start = F.struct(none.alias("done"), first.alias("start"), F.lit(0.0).alias("end")).cast(kind)
    merged = F.aggregate(regions, start, step, lambda s: F.concat(s["done"], F.array(chunk(s))))
    return F.when(F.size(regions) > 0, merged).otherwise(none)


def fake_transcriber(batch: pd.DataFrame) -> pd.DataFrame:
    """Repeats the text without every fifth word."""
    return batch.assign(hyp=batch["text"].map(lambda t: " ".join(w for i, w in enumerate((t or "").split()) if i % 5 != 4)))


def fake_aligner(batch: pd.DataFrame) -> pd.DataFrame:
    """Words of equal length over the duration."""

    def words(text, duration):
        ws = (text or "").split()
        d = (duration or 0.0) / max(1, len(ws))
        return [{"word": w, "start": round(i * d, 3), "end": round((i + 1) * d, 3), "score": 1.0} for i, w in enumerate(ws)]

    return batch.assign(words=[words(t, d) for t, d in zip(batch["text"], batch["duration"], strict=True)])
