"""User-function surface where a column expression is not enough.

* X4 rich function: set-up once per task, per-batch work, tear-down in
  ``finally`` -- ``mapInPandas`` over Arrow batches, never one row at a time.
* X6 aggregate function (create / add / merge / result): accumulators of
  user code, added to per task and merged in a second, keyed step.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


class RichMapper:
    """Lifecycle of a rich map: ``open`` before the first batch of a task,
    ``close`` after the last, ``partition`` = index of the running task."""

    def open(self, partition: int) -> None:  # pragma: no cover - default no-op
        pass

    def map(self, pdf: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:  # pragma: no cover - default no-op
        pass


def map_rich(df: DataFrame, mapper_factory: Callable[[], RichMapper], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        m = mapper_factory()
        m.open(ctx.partitionId() if ctx else 0)
        try:
            for pdf in batches:
                yield m.map(pdf)
        finally:
            m.close()
    return df.mapInPandas(run, schema)


class LengthMapper(RichMapper):
    """The reference's rich mapper: field -> string length."""

    def __init__(self, field: str = "url", out: str = "len"):
        self.field, self.out = field, out

    def map(self, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"seq": pdf["seq"], self.out: pdf[self.field].astype("string").str.len().astype("Int32")})


class UserAggregate:
    """An aggregate function of user code: create, add, merge, result.

    An accumulator may be any picklable object (numbers, a set, a sketch).
    ``merge`` must not depend on order or grouping, and may change its first argument."""

    def create(self):
        raise NotImplementedError

    def add(self, acc, rows: pd.DataFrame):
        """`acc` with the rows of one group added, a batch at a time."""
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc) -> tuple:
        """The values of the output columns after the keys."""
        raise NotImplementedError


#: Accumulators that a task holds before it hands them on.
MAX_GROUPS = 10_000


def aggregate_with(df: DataFrame, keys: list[str], agg: UserAggregate, schema: str, max_groups: int = MAX_GROUPS,
                   salts: int = 16) -> DataFrame:
    """Run ``agg`` over groups of ``keys`` (``schema``: keys, then results).

    1. Each task adds its rows to accumulators, at most ``max_groups`` at a time, and
       emits them as bytes: one row per group and task, whatever the group's size.
    2. Accumulators meet by (group, salt) and then by group, sorted, and are merged one
       after the other: a task holds one accumulator, never a group's rows, and a group
       that every task saw is first merged in ``salts`` places."""
    names = [f.name for f in df.select(*keys).schema]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    partial_schema = f"{types}, _salt int, _acc binary"

    def emit(held: dict, salt: int) -> pd.DataFrame:
        out = pd.DataFrame(list(held), columns=names, dtype=object)
        out["_salt"] = salt
        out["_acc"] = [pickle.dumps(a) for a in held.values()]
        return out

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        salt, held = (ctx.partitionId() if ctx else 0) % salts, {}
        for pdf in batches:
            for key, rows in pdf.groupby(names, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                held[key] = agg.add(held[key] if key in held else agg.create(), rows)
            if len(held) >= max_groups:
                yield emit(held, salt)
                held = {}
        if held:
            yield emit(held, salt)

    def merged(batches: Iterator[pd.DataFrame], last: bool) -> Iterator[pd.DataFrame]:
        now, acc, out = None, None, {}
        for pdf in batches:
            for *key, data in zip(*(pdf[c].tolist() for c in [*names, "_acc"])):
                key = tuple(None if pd.isna(k) else k for k in key)
                one = pickle.loads(data)
                if now is not None and key == now:
                    acc = agg.merge(acc, one)
                    continue
                if now is not None:
                    out[now] = acc
                now, acc = key, one
            if len(out) >= max_groups:
                yield finished(out) if last else emit(out, 0)
                out = {}
        if now is not None:
            out[now] = acc
            yield finished(out) if last else emit(out, 0)

    def finished(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*key, *agg.result(acc)) for key, acc in held.items()])

    parts = df.mapInPandas(partial, partial_schema)
    parts = parts.repartition(*names, "_salt").sortWithinPartitions(*names, "_salt")
    parts = parts.mapInPandas(lambda b: merged(b, False), partial_schema)
    parts = parts.repartition(*names).sortWithinPartitions(*names)
    return parts.mapInPandas(lambda b: merged(b, True), schema)


class PvUv(UserAggregate):
    """Page views, distinct visitors and their ratio; the accumulator is (count, set of users)."""

    def create(self):
        return 0, set()

    def add(self, acc, rows):
        return acc[0] + len(rows), acc[1].union(rows["user_id"].dropna().unique().tolist())

    def merge(self, a, b):
        return a[0] + b[0], a[1] | b[1]

    def result(self, acc):
        return acc[0], len(acc[1]), acc[0] / len(acc[1]) if acc[1] else None


def flatmap_udtf(user_value):
    """A general flatMap as a vectorized Python table function
    (``arrow_udtf``: ``eval`` receives Arrow record batches of its TABLE
    argument and returns whole batches).  Same rows as
    ``transforms.flatmap_conditional``; the column form is the fast path, this
    is the surface for logic no expression can state."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.functions import arrow_udtf

    @arrow_udtf(returnType="seq long, pos int, v string")
    class ConditionalFlatMap:
        def eval(self, batch: pa.RecordBatch):
            seq = batch.column("seq")
            u = pc.cast(batch.column("user_id"), pa.string())
            t = pc.cast(batch.column("ms"), pa.string())
            hit = pc.fill_null(pc.equal(batch.column("user_id"), user_value), False)
            m = hit.to_numpy(zero_copy_only=False)
            layers = [  # (rows, pos, value): user, timestamp for every row; url, ts first for hits
                (seq, np.where(m, 2, 0), u),
                (seq, np.where(m, 3, 1), t),
                (pc.filter(seq, hit), np.zeros(m.sum(), "int32"), pc.filter(batch.column("url"), hit)),
                (pc.filter(seq, hit), np.ones(m.sum(), "int32"), pc.filter(t, hit)),
            ]
            yield pa.table({
                "seq": pa.concat_arrays([x[0] for x in layers]),
                "pos": pa.array(np.concatenate([np.asarray(x[1], "int32") for x in layers])),
                "v": pa.concat_arrays([x[2] for x in layers]),
            })

    return ConditionalFlatMap
