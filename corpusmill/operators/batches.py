"""Masked-language-model batches: tokenise, mask, batch, pad, validate, average."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions import tokens
from corpusmill.operators import ordering
from corpusmill.session import ship_package

SEED = 42


def tokenize(df: DataFrame, text: str, max_length: int = tokens.MAX_LENGTH) -> DataFrame:
    """Replace the text by its token numbers."""
    return df.withColumn("input_ids", tokens.token_ids(F.col(text), max_length)).drop(text)


def mask(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Choose targets: ``labels`` names them, ``input_ids`` hides them."""
    labelled = df.withColumn("labels", tokens.labels(F.col("input_ids"), F.col(key), seed))
    return labelled.withColumn(
        "input_ids", tokens.masked_ids(F.col("input_ids"), F.col("labels"), F.col(key), seed)
    )


def into_batches(df: DataFrame, key: str, seed: int = SEED, size: int = ordering.ROWS_PER_BATCH) -> DataFrame:
    return ordering.batches(df, key, seed, size)


def pad(df: DataFrame) -> DataFrame:
    """Pad every row to the longest of its batch. A window holds one batch, which has a fixed size."""
    longest = F.max(F.size("input_ids")).over(W.partitionBy("batch"))
    return (
        df.withColumn("length", longest)
        .withColumn("attention_mask", tokens.attention_mask(F.col("input_ids"), F.col("length")))
        .withColumn("labels", tokens.pad_to(F.col("labels"), F.col("length"), tokens.IGNORED))
        .withColumn("input_ids", tokens.pad_to(F.col("input_ids"), F.col("length"), tokens.PAD))
    )


def batch_targets(df: DataFrame) -> DataFrame:
    """Per batch: rows, targets, and whether there is anything to learn from it."""
    return (
        df.groupBy("batch")
        .agg(
            F.count("*").alias("rows"),
            F.sum(tokens.target_count(F.col("labels"))).alias("targets"),
        )
        .withColumn("valid", F.col("targets") > 0)
    )


def valid_batches(df: DataFrame) -> DataFrame:
    return batch_targets(df).where("valid").drop("valid")


def mean_over_all(df: DataFrame, value: Column, digits: int = 4) -> DataFrame:
    """The mean with skipped (null) batches counted as zero in the sum but present in the divisor."""
    return df.agg(
        F.count("*").alias("batches"),
        F.count(value).alias("used"),
        F.round(F.sum(F.coalesce(value, F.lit(0.0))) / F.count("*"), digits).alias("mean"),
    )


def non_finite(df: DataFrame, values: str) -> DataFrame:
    """Per vector: whether it holds a NaN or an infinity, and its extremes."""
    return df.select(
        *[c for c in df.columns if c != values],
        tokens.has_non_finite(F.col(values)).alias("non_finite"),
        F.array_min(values).alias("lowest"),
        F.array_max(values).alias("highest"),
    )


def map_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, drop: tuple[str, ...] = ()
) -> DataFrame:
    """Apply a user function (such as a trained tokenizer) to Arrow batches of rows.

    ``drop`` names columns to leave out of the result.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    ship_package()
    return df.mapInPandas(run, schema).drop(*drop)


def collate_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str = "batch"
) -> DataFrame:
    """Apply a user function to each batch of rows; batches have a fixed number of rows.

    Rows are dealt by batch and sorted, and a task runs through its batches in one pass over Arrow batches, each
    converted once; the batch that an Arrow batch cuts off is carried over to the next.
    """
    ship_package()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            keys = frame[key].to_numpy()
            starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()] if len(keys) else [0]
            done = [function(frame.iloc[at:to]) for at, to in zip(starts[:-1], starts[1:], strict=True)]
            if done:
                yield pd.concat(done, ignore_index=True)
            held = frame.iloc[starts[-1] :]
        if held is not None and len(held):
            yield function(held)

    return df.repartition(key).sortWithinPartitions(key).mapInPandas(run, schema)
