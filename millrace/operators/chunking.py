"""Documents to overlapping chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as tx

# Window size, overlap and the length below which a chunk is dropped.
CHUNK_SIZE = 200
CHUNK_OVERLAP = 40
MIN_CHARS = 20


def chunk_documents(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """(source_doc, text) to (source_doc, chunk_idx, chunk_id, text).

    Pieces are stripped, empty ones dropped, and the rest numbered from 0 within
    their document. Everything happens inside the document's own row, so there
    is no shuffle and no window function.
    """
    pieces = F.filter(
        F.transform(tx.windows(F.col("text"), size, overlap), tx.strip),
        lambda piece: F.length(piece) > 0,
    )
    return documents.select("source_doc", F.posexplode(pieces).alias("chunk_idx", "text")).select(
        "source_doc",
        "chunk_idx",
        F.concat("source_doc", F.lit("_chunk"), "chunk_idx").alias("chunk_id"),
        "text",
    )


def drop_tiny(chunks: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Leave out short chunks; the others keep their numbers."""
    return chunks.where(F.length("text") >= min_chars)


def snippet(column: str = "text", chars: int = 100):
    return F.substring(F.col(column), 1, chars)
