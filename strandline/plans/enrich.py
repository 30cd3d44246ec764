"""Enrichment of documents by an outside service, a batch of rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def _number(v):
    return int(v) if isinstance(v, str) and v.isdigit() else None if v is pd.NA or v is None else v


def enrich(docs: DataFrame, sent: dict[str, str], got: dict[str, str], call: Callable | None = None, many: Callable[[list[dict]], list[dict | None]] | None = None, at_once: int = 500) -> DataFrame:
    """docs with string columns filled by a service: sent maps columns to request keys, got maps answer keys to columns.

    ``many`` answers a list of requests at a time, in their order; ``call`` answers one. Digits go out as numbers. No answer, null and "null" change
    nothing.
    """
    if (call is None) == (many is None):
        raise ValueError("give either a call for one request or one for many")
    ask = many or (lambda requests: [call(q) for q in requests])
    new = [c for c in got.values() if c not in docs.columns]
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes] + [f"`{c}` string" for c in new])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = [dict(zip(sent.values(), map(_number, row), strict=True)) for row in zip(*[batch[c] for c in sent], strict=True)]
            answers = [a or {} for i in range(0, len(asked), at_once) for a in ask(asked[i : i + at_once])]
            for key, c in got.items():
                before = batch[c] if c not in new else [None] * len(batch)
                batch[c] = pd.Series([str(a[key]) if a.get(key) not in (None, "null") else b for a, b in zip(answers, before, strict=True)], index=batch.index, dtype=object)
            yield batch

    return docs.mapInPandas(run, schema)
