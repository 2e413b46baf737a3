"""A user's own aggregation, with partial states on the map side.

Tasks fold the batches they read into one state per key and hand on states, not rows; states of a key are merged in
two steps, so no task meets more than a share of a hot key's states. The three functions are those of a reducer with
state: ``fold`` takes a state (or None) and a frame of one key's rows, ``merge`` two states, ``finish`` a state.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

#: Keys whose states a task holds before it hands them on, and shares of a key's states in the first merge.
HELD, SHARES = 10_000, 32


def aggregate_with(df: DataFrame, key: str, columns: list[str], fold: Callable[[Any, pd.DataFrame], Any],
                   merge: Callable[[Any, Any], Any], finish: Callable[[Any], pd.DataFrame], schema: str) -> DataFrame:
    """(``key``, ``schema``): the rows that ``finish`` gives for each key's state.

    ``columns`` are what ``fold`` gets to see. States are pickled between tasks. ``merge`` has to be associative and
    commutative, as rows come in no order. A null key is a key.
    """
    kind = df.schema[key].dataType.simpleString()
    out = StructType.fromDDL(schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[Any, Any] = {}
        share = TaskContext.get().partitionId() % SHARES
        type_ = None

        def taken() -> pa.RecordBatch:
            blobs = [pickle.dumps(s) for s in states.values()]
            keys = pa.array([k[0] for k in states], type=type_)
            states.clear()
            return pa.RecordBatch.from_arrays([keys, pa.array([share] * len(blobs), type=pa.int32()), pa.array(blobs, type=pa.binary())],
                                              names=["key", "share", "state"])

        for batch in batches:
            type_ = batch.schema.field("key").type
            names = pa.array(range(batch.num_rows))
            # Rows of a key by their places, so a null key and large whole numbers stay what they are.
            keys, places = batch.column("key").to_pylist(), names.to_pylist()
            by_key: dict[Any, list[int]] = {}
            for k, place in zip(keys, places):
                by_key.setdefault((k,), []).append(place)
            frame = batch.drop_columns(["key"]).to_pandas()
            for k, rows in by_key.items():
                states[k] = fold(states.get(k), frame.iloc[rows])
            if len(states) > HELD:
                yield taken()
        if states:
            yield taken()

    def merged(blobs: pd.Series) -> Any:
        state = pickle.loads(blobs.iloc[0])
        for blob in blobs.iloc[1:]:
            state = merge(state, pickle.loads(blob))
        return state

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": frame["key"].iloc[:1], "state": [pickle.dumps(merged(frame["state"]))]})

    def last(frame: pd.DataFrame) -> pd.DataFrame:
        rows = finish(merged(frame["state"]))[out.names]
        return pd.concat([pd.Series([frame["key"].iloc[0]] * len(rows), name="key", dtype=frame["key"].dtype), rows.reset_index(drop=True)], axis=1)

    rows = df.select(F.col(key).alias("key"), *columns)
    states = rows.mapInArrow(partial, f"key {kind}, share int, state binary")
    shared = states.groupBy("key", "share").applyInPandas(first, f"key {kind}, state binary")
    return shared.groupBy("key").applyInPandas(last, f"key {kind}, {schema}").withColumnRenamed("key", key)
