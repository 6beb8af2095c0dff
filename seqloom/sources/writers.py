"""Sinks: delimited text, FASTA, Parquet datasets, chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(frame: DataFrame, path: str, digits: int | None = 4) -> None:
    """Tab-separated text with a header; numbers with a fixed number of digits; an empty result is a header alone."""
    shown = frame
    if digits is not None:
        shown = frame.select(*[F.format_string(f"%.{digits}f", c).alias(c) if k in ("double", "float") else F.col(c) for c, k in frame.dtypes])
    flat = shown.select(*[F.to_json(c).alias(c) if k.startswith(("array", "map", "struct")) else F.col(c) for c, k in shown.dtypes])
    flat.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


def fasta_lines(frame: DataFrame, identifier: str, sequence: str) -> DataFrame:
    return frame.select(F.concat(F.lit(">"), F.col(identifier).cast("string"), F.lit("\n"), F.col(sequence)).alias("value"))


def write_fasta(frame: DataFrame, path: str, identifier: str, sequence: str) -> None:
    fasta_lines(frame, identifier, sequence).write.mode("overwrite").text(path)


def write_dataset(frame: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Columnar dataset in place of wide binary frames; partition columns prune later scans."""
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def chunk(frame: DataFrame, order: Sequence[str], chunks: int) -> DataFrame:
    """Round-robin chunk number of every row in an order."""
    from seqloom.operators.graph import ordered_index

    return ordered_index(frame, order, "__i").withColumn("chunk", (F.col("__i") % chunks).cast("int")).drop("__i")


def chunks_of(frame: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Chunk number for chunks of a size."""
    from seqloom.operators.graph import ordered_index

    return ordered_index(frame, order, "__i").withColumn("chunk", F.floor(F.col("__i") / size).cast("int")).drop("__i")


def merged(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts of differing columns under each other; what a part lacks is null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
