"""Enrichment from an external key-value service (J4 with real remote calls, G12).

When the dimension can be read as a table, use :func:`tidewater.operators.joins.lookup_enrich`
(a join). When it can only be *asked* (an HTTP/RPC/DB point lookup), each task
deduplicates the keys of each Arrow batch and sends those it has no answer to yet in batches of
``batch_size``. ``max_in_flight`` calls are under way at any time (the reference's async capacity): an
answer makes room for the next call, and so does a call that is ``timeout`` seconds old. The last
``cache_keys`` answers serve later batches of the task. Keys that time out or are not found get ``default`` (the
reference's client A) or null (client B). A call that fails fails the task, which Spark
retries: an error is no missing key. Rows stay in their partition: no shuffle.
"""

from __future__ import annotations

import collections
import queue
import threading
import time
from collections.abc import Callable, Iterable, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.functions import formats


def remote_lookup(df: DataFrame, key: str, fetch: Callable[[list], Mapping], out: str,
                  batch_size: int = 100, max_in_flight: int = 10, timeout: float = 1000.0,
                  on_missing: str = "default", default: str = formats.MISSING_NAME, cache_keys: int = 100_000) -> DataFrame:
    """Add ``out`` (string) = ``fetch(keys)[key]`` for every row.

    ``fetch`` receives a list of distinct keys and returns a mapping for the
    keys it knows; it runs on executors, so it must be picklable and open its
    own connections.
    """
    fallback = default if on_missing == "default" else None
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def ask(keys: list) -> dict:
        found: dict = {}
        waiting = collections.deque(keys[i:i + batch_size] for i in range(0, len(keys), batch_size))
        # Daemon threads: a call that never returns holds neither the task nor the worker's end.
        answers: queue.Queue = queue.Queue()
        flying: dict[int, float] = {}  # call -> its deadline
        number = 0
        while waiting or flying:
            while waiting and len(flying) < max_in_flight:
                flying[number] = time.monotonic() + timeout
                threading.Thread(target=call, args=(number, waiting.popleft(), answers), daemon=True).start()
                number += 1
            try:
                done, answer, error = answers.get(timeout=max(0.0, min(flying.values()) - time.monotonic()))
            except queue.Empty:
                now = time.monotonic()
                flying = {n: t for n, t in flying.items() if t > now}
                continue
            if error is not None:
                raise error
            if flying.pop(done, None) is not None:  # else it came too late
                found.update(answer or {})
        return found

    def call(number: int, keys: list, answers: queue.Queue) -> None:
        try:
            answers.put((number, fetch(keys), None))
        except BaseException as e:  # noqa: BLE001 - raised again in the task
            answers.put((number, None, e))

    def run(batches: Iterable[pd.DataFrame]):
        known: collections.OrderedDict = collections.OrderedDict()
        for pdf in batches:
            keys = [k for k in pd.unique(pdf[key]) if k is not None]
            found = {k: known[k] for k in keys if k in known}
            fresh = ask([k for k in keys if k not in found])
            found.update(fresh)
            values = [found.get(k, fallback) for k in pdf[key]]
            known.update(fresh)
            for k in found:
                known.move_to_end(k)
            while len(known) > cache_keys:
                known.popitem(last=False)
            yield pdf.assign(**{out: [None if v is None else str(v) for v in values]})

    return df.mapInPandas(run, schema)
