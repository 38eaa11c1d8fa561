"""Input columns of the operators."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: Sequence[str] = ()) -> DataFrame:
    """The columns an operator reads, under fixed names, and those it is asked to hand on. Other
    columns, whatever their names, are left out before anything is shuffled."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"),
                       *[F.col(f"`{c}`") for c in keep if c not in ("doc_id", "text")])


def handed_on(docs: DataFrame, result: str, keep: Sequence[str]) -> tuple[str, list[str]]:
    """(result schema with the kept columns, their names). The id is always in a result; a kept
    column with the name of a result column is an error of the call."""
    own = [c.split()[0] for c in result.split(", ") if " " in c]
    names = [c for c in keep if c != "doc_id"]
    if clash := set(names) & set(own):
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    kinds = {c: docs.schema[c].dataType.simpleString() for c in names}
    return ", ".join([result, *(f"`{c}` {kinds[c]}" for c in names)]), names


def with_columns(batch: pa.RecordBatch, source: pa.RecordBatch, names: Sequence[str]) -> pa.RecordBatch:
    """A result batch with columns of the rows it was made from."""
    return pa.RecordBatch.from_arrays([*batch.columns, *(source.column(c) for c in names)],
                                      [*batch.schema.names, *names])
