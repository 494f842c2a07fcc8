"""Small helpers for batch functions and size-checked joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Ids that may be broadcast: 8 bytes each, so some 16 MB as a hash table.
BROADCAST_IDS = 500_000


def complete_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """(rows, group borders) from batches sorted by ``keys``; a group that spans batches comes out whole."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[keys].iloc[-1].to_numpy()
        same = np.ones(len(batch), bool)
        for k, v in zip(keys, last):
            same &= (batch[k] == v).to_numpy()
        cut = len(batch) - int(same.sum())
        if cut == 0 and held and (held[-1][keys].iloc[-1].to_numpy() == last).all():
            held.append(batch)
            continue
        done = pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
        held = [batch.iloc[cut:]]
        if len(done):
            yield done, borders(done, keys)
    if held:
        done = pd.concat(held, ignore_index=True)
        yield done, borders(done, keys)


def joined_batches(batches: Iterable[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches put together to about so many rows each; empty ones go."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += len(batch)
        if size >= rows:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def borders(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Start of each run of equal keys, and the row count at the end."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for k in keys:
        v = rows[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(rows))


def only_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in the one-column table ``ids`` (written, distinct).

    Few ids are broadcast, so the large side is filtered where it is scanned; more are joined by a shuffle.
    """
    return _by_ids(df, column, ids, "left_semi")


def without_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not in ``ids``; rows with a null there stay."""
    return _by_ids(df, column, ids, "left_anti")


def own_name(stem: str) -> str:
    """A column name that no input table has."""
    return f"{stem}_{uuid.uuid4().hex}"


def _by_ids(df: DataFrame, column: str, ids: DataFrame, how: str) -> DataFrame:
    few = ids.count() <= BROADCAST_IDS
    name = own_name("id")
    right = ids.select(F.col(ids.columns[0]).alias(name))
    return df.join(F.broadcast(right) if few else right, F.col(column) == F.col(name), how)
