"""Checks of what was acquired against what was asked for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.geometry import box_parts
from ..operators.relational import duplicate_keys, roster_gaps


@dataclass
class Budget:
    """Bounds of one acquisition; spend raises before a bound is passed."""

    megabytes: float = 64
    features: int = 50_000
    pages: int = 2_000

    def spend(self, megabytes: float = 0, features: int = 0, pages: int = 0) -> None:
        if megabytes > self.megabytes or features > self.features or pages > self.pages:
            raise ValueError("acquisition budget exceeded")
        self.megabytes -= megabytes
        self.features -= features
        self.pages -= pages


def covers(outer: tuple, inner: tuple) -> bool:
    """Whether a received box covers a requested one; both may cross the dateline."""
    return all(any(w <= a and s <= b and e >= c and n >= d for w, s, e, n in box_parts(*outer)) for a, b, c, d in box_parts(*inner))


def check_receipt(receipt: dict, request: dict) -> None:
    """Raise unless a cached snapshot is of the same provider, version, selector and mask, and covers the requested box."""
    for key in ("provider", "version", "selector", "mask"):
        if receipt.get(key) != request.get(key):
            raise ValueError(f"cached snapshot differs in {key}")
    if receipt.get("bbox") is not None and not (request.get("bbox") and covers(tuple(receipt["bbox"]), tuple(request["bbox"]))):
        raise ValueError("cached snapshot doesn't cover the request")


def check_roster(expected: DataFrame, received: DataFrame, key: str) -> None:
    """Raise if received records repeat, are missing or weren't asked for, with up to five examples."""
    twice = duplicate_keys(received, [key]).limit(5).collect()
    gaps = roster_gaps(expected, received, key).limit(5).collect()
    if twice or gaps:
        raise ValueError(f"roster mismatch: repeated {[r[key] for r in twice]}, gaps {[(r[key], r['side']) for r in gaps]}")


def batches(ids: list[int], size: int) -> list[list[int]]:
    """Object ids in sorted batches; a batch that comes back short is asked for again in halves."""
    ids = sorted(set(ids))
    return [ids[i : i + size] for i in range(0, len(ids), size)]


def fetch_all(ids: list[int], fetch, size: int = 1000) -> list[dict]:
    """Records of all ids by fetch(batch); short batches are halved until one id alone comes back empty, which raises."""
    out, todo = [], batches(ids, size)
    while todo:
        batch = todo.pop()
        found = fetch(batch)
        if len(found) == len(batch):
            out += found
        elif len(batch) == 1:
            raise ValueError(f"record {batch[0]} was announced and not delivered")
        else:
            middle = len(batch) // 2
            todo += [batch[:middle], batch[middle:]]
    return out


def fetched(ids: DataFrame, key: str, fetch, schema: str, size: int = 1000) -> DataFrame:
    """The records of all distinct ids of a table, fetched by tasks: fetch(batch) returns records as dicts of the schema's fields.

    Ids are dealt out to tasks and asked for `size` at a time, in halves where a batch comes
    back short; an id that alone comes back empty is an error. Null ids are not asked for.
    Neither ids nor records pass the driver.
    """
    fields = T._parse_datatype_string(schema)

    def run(batches_):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(fields)
        for batch in batches_:
            wanted = sorted(batch.column(0).to_pylist())
            for at in range(0, len(wanted), size):
                yield pa.RecordBatch.from_pylist(fetch_all(wanted[at : at + size], fetch, size), kind)

    return ids.select(key).where(F.col(key).isNotNull()).distinct().mapInArrow(run, fields)
