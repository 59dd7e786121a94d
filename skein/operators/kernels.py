"""The boundary to model kernels: a kernel maps Arrow batches to columns, set up once a worker task, errors as data."""

from __future__ import annotations

import asyncio
import hashlib
import time
from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Kernel(Protocol):
    """Output columns as DDL; ``setup`` and ``destroy`` run once a task, ``run`` for each batch."""

    output: str

    def setup(self) -> None: ...

    def run(self, batch: pa.RecordBatch) -> list[pa.Array]: ...

    def destroy(self) -> None: ...


#: Bytes of answers that are handed on at once.
PART_BYTES = 1 << 20


def with_kernel(df: DataFrame, kernel: Kernel, batch_rows: int = 256, attempts: int = 1) -> DataFrame:
    """``df`` with the kernel's columns and ``kernel_error``: a batch that fails has nulls and the message there.

    The kernel gets ``batch_rows`` rows at a time; what it answers goes on in Arrow batches of their own size, so a
    kernel of single rows costs no batch a row. Only between two attempts is there a pause.
    """
    added = T.StructType.fromDDL(kernel.output)
    schema = T.StructType([*df.schema.fields, *added.fields, T.StructField("kernel_error", T.StringType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added.fields]

        def answered(b):
            for k in range(attempts):
                try:
                    made = kernel.run(b)
                    break
                except Exception as e:  # noqa: BLE001  failures of a kernel are data here
                    error = f"{type(e).__name__}: {e}"
                    if k + 1 < attempts:
                        time.sleep(0.01 * 2**k)
            else:
                return [*(pa.nulls(b.num_rows, k) for k in kinds), pa.array([error] * b.num_rows, pa.string())]
            if any(len(c) != b.num_rows for c in made):
                raise ValueError(f"{b.num_rows} rows went to the kernel, {[len(c) for c in made]} answers came back")
            return [*(c if c.type == k else c.cast(k) for c, k in zip(made, kinds, strict=True)), pa.nulls(b.num_rows, pa.string())]

        kernel.setup()
        try:
            for whole in batches:
                start, held, n_bytes = 0, [], 0
                for lo in range(0, whole.num_rows, batch_rows):
                    held.append(answered(whole.slice(lo, batch_rows)))
                    n_bytes += sum(c.nbytes for c in held[-1])
                    end = min(lo + batch_rows, whole.num_rows)
                    if n_bytes >= PART_BYTES or end == whole.num_rows:
                        yield pa.RecordBatch.from_arrays([*whole.slice(start, end - start).columns, *(pa.concat_arrays(c) for c in zip(*held))], names=schema.names)
                        start, held, n_bytes = end, [], 0
        finally:
            kernel.destroy()

    return df.mapInArrow(run, schema)


class HashEmbedding:
    """A deterministic stand-in for an embedding model: up to 32 numbers in [-1, 1), the bytes of the text's SHA-256."""

    output = "embedding array<float>"

    def __init__(self, column: str, size: int = 16, refuses: tuple[str, str] | None = None) -> None:
        """``refuses``: a column and a value of it that the kernel fails on."""
        self.column, self.size, self.refuses = column, size, refuses

    def setup(self) -> None: ...

    def destroy(self) -> None: ...

    def run(self, batch: pa.RecordBatch) -> list[pa.Array]:
        if self.refuses and self.refuses[1] in batch.column(self.refuses[0]).to_pylist():
            raise ValueError(f"no {self.refuses[1]}")
        made = [np.frombuffer(hashlib.sha256((t or "").encode()).digest()[: self.size], np.uint8).astype(np.float32) / 128 - 1 for t in batch.column(self.column).to_pylist()]
        return [pa.array(made, pa.list_(pa.float32()))]


class Rowwise:
    """A kernel of one function from a row's columns to a row of answers; for stand-ins and light work."""

    def __init__(self, output: str, function: Callable, *columns: str) -> None:
        """``function`` gets the columns' values and returns one value for each output column."""
        from pyspark.sql.pandas.types import to_arrow_type

        self.output, self.function, self.columns = output, function, columns
        self.kinds = [to_arrow_type(f.dataType) for f in T.StructType.fromDDL(output).fields]

    def setup(self) -> None: ...

    def destroy(self) -> None: ...

    def run(self, batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [self.function(*values) for values in zip(*(batch.column(c).to_pylist() for c in self.columns))]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(self.kinds)]


class AsyncCalls:
    """Calls an async function for every value, at most ``width`` at once; each failure is its row's own error."""

    output = "answer string, answer_error string"

    def __init__(self, column: str, call: Callable, width: int = 8, attempts: int = 2) -> None:
        self.column, self.call, self.width, self.attempts = column, call, width, attempts

    def setup(self) -> None: ...

    def destroy(self) -> None: ...

    def run(self, batch: pa.RecordBatch) -> list[pa.Array]:
        async def one(gate, value):
            async with gate:
                for k in range(self.attempts):
                    try:
                        return await self.call(value), None
                    except Exception as e:  # noqa: BLE001  failures of a call are data here
                        error = f"{type(e).__name__}: {e}"
                        if k + 1 < self.attempts:
                            await asyncio.sleep(0.01 * 2**k)
                return None, error

        async def all_():
            gate = asyncio.Semaphore(self.width)
            return await asyncio.gather(*(one(gate, v) for v in batch.column(self.column).to_pylist()))

        made = asyncio.run(all_())
        return [pa.array([a for a, _ in made], pa.string()), pa.array([e for _, e in made], pa.string())]


def compared(left: DataFrame, right: DataFrame, key: str, tolerance: float = 0.0) -> DataFrame:
    """(field, n_rows, n_different) of two runs' rows, numbers equal within the tolerance; rows in one only count as ``_row``."""
    names = [c for c in left.columns if c != key]
    both = left.select(key, F.struct(*names).alias("l")).join(right.select(key, F.struct(*names).alias("r")), key, "full_outer")
    kinds = dict(left.dtypes)

    def differs(c):
        a, b = F.col(f"l.{c}"), F.col(f"r.{c}")
        near = F.abs(a - b) <= tolerance if kinds[c] in ("double", "float") else F.lit(False)
        return F.when(F.col("l").isNull() | F.col("r").isNull(), False).otherwise(~(a.eqNullSafe(b) | F.coalesce(near, F.lit(False))))

    lone = F.struct(F.lit("_row").alias("field"), (F.col("l").isNull() | F.col("r").isNull()).alias("d"))
    fields = F.array(lone, *(F.struct(F.lit(c).alias("field"), differs(c).alias("d")) for c in names))
    return both.select(F.inline(fields)).groupBy("field").agg(F.count("*").alias("n_rows"), F.count_if("d").alias("n_different"))
