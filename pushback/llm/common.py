"""Shared pieces of the training-data operators.

Words are maximal runs of characters other than U+0020 and U+0009-U+000D
(``bytes.split()`` on UTF-8 splits at exactly these). Every operator selects
the columns it is told to use by name, so other columns never clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOWER_AZ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` before it as no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_hash(id_col: str) -> Column:
    """crc32 of the id written as text (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def normal_words(raw: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased (null: none)."""
    return raw.translate(LOWER_AZ).split() if raw else []


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_rows(df: DataFrame, fn, schema: T.StructType, batch_rows: int = 2000) -> DataFrame:
    """``mapInArrow`` of ``fn``: an iterator of input rows (tuples in column
    order) to an iterator of output rows; output batches stay small."""
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = arrow_schema(schema)

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, batch_rows):
                    part = batch.slice(at, batch_rows)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        buffer = []
        for row in fn(rows()):
            buffer.append(row)
            if len(buffer) >= batch_rows:
                yield _batch(buffer, names, out_schema)
                buffer = []
        if buffer:
            yield _batch(buffer, names, out_schema)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=schema.field(n).type) for n, c in zip(names, columns, strict=True)], schema=schema)


def labelled_ids(docs: DataFrame, labels: DataFrame, *, label: str, train: Column,
                 id_col: str = "doc_id") -> DataFrame:
    """(_id, _y): ids of ``docs`` that may be learned from, with their label (the larger of two)."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).where(train)
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_y")))
    present = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    return known.join(present, "_id", "left_semi")


def labelled_texts(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _y, text) of the ids of ``known``, texts whole (null: empty); of
    rows that share an id the smallest text counts."""
    return (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
            .join(known, "_id").groupBy("_id", "_y").agg(F.min("_text").alias("text")))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, label: str, train: Column, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rank, text, y): at most ``per_class`` labelled training texts of each
    class, whole.

    ``train`` tells by id which rows may be learned from; rows are taken in
    the order of a hash of the id, so the sample does not depend on layout.
    Of rows that share an id the smallest text counts.
    """
    known = labelled_ids(docs, labels, label=label, train=train, id_col=id_col)
    picked = None
    for y in (0, 1):
        one = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    return (labelled_texts(docs, F.broadcast(picked), id_col=id_col, text_col=text_col)
            .select(F.xxhash64("_id", "_y").alias("rank"), "text", F.col("_y").alias("y")))


def fit_in_task(sample: DataFrame, fit: Callable[[list[tuple[str, int]]], object]) -> object:
    """``fit`` of the (text, y) rows of a bounded sample, run in one task; only
    the model comes to the driver."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("rank", "ascending"), ("text", "ascending")])
        model = fit(list(zip(rows["text"].to_pylist(), rows["y"].to_pylist(), strict=True)))
        return pa.table({"model": pa.array([pickle.dumps(model)], type=pa.binary())})

    row = sample.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([])


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal values."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
