"""Texts packed into rows of about 2 MB, in a table that joins what is found of them without moving them again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bucketed, lean

#: Bytes of a pack, and of a bucket of the table; and rows of a pack.
PACK_BYTES, TABLE_BYTES, PACK_ROWS = 2 << 20, 24 << 20, 1 << 17


def longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype="<i8")


def texts_of(row: object) -> list[bytes]:
    ends = np.cumsum(longs(row.lengths)).tolist()
    return [row.texts[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def known_column(columns: list[str]) -> str:
    """The name of rest's column that says which texts aren't null; no other column has it."""
    return "text" + "_known" * (1 + sum(c.lower().startswith("text_known") for c in columns))


def packed(docs: DataFrame) -> tuple[DataFrame, int]:
    """The table of packs (pack, ids, lengths, texts, rest) and the bytes of all texts. rest holds the other columns, and
    ``known_column``."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    known = F.col("text").isNotNull().alias(known_column(docs.columns))
    ordered = docs.select("doc_id", "text", *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")], known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            rest = batch.select([i for i in range(batch.num_columns) if i != 1])
            start, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= PACK_BYTES or i == len(texts) - 1 or i + 1 - start == PACK_ROWS:
                    some = texts[start : i + 1]
                    ids = rest.column(0).slice(start, i + 1 - start).cast(pa.int64())
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rest.schema) as stream:
                        stream.write_batch(rest.slice(start, i + 1 - start))
                    # a null id comes after all others, where it takes nothing from them
                    known = np.array([x if x is not None else np.iinfo(np.int64).max for x in ids.to_pylist()], dtype="<i8")
                    row = {"pack": [number], "ids": [known.tobytes()], "lengths": [np.array([len(t) for t in some], dtype="<i8").tobytes()], "texts": [b"".join(some)], "rest": [sink.getvalue().to_pybytes()]}
                    yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("pack", pa.int64()), *((c, pa.binary()) for c in ("ids", "lengths", "texts", "rest"))]))
                    number, start, size = number + 1, i + 1, 0

    packs = ordered.mapInArrow(lean(run), "pack long, ids binary, lengths binary, texts binary, rest binary")
    return bucketed(packs, "pack", -(-total // TABLE_BYTES)), total
