"""Packing by power-of-two decomposition.

Each document's ids (with the end id) are cut into pieces of power-of-two length: as many full
pieces of ``max_length`` as fit, then the binary digits of the rest, longest first.  Each piece is a
sequence of its own, so no sequence crosses documents and, all lengths being powers of two, none
needs padding.  Sequences are numbered by (length, document, start): equal lengths form one
contiguous bucket of ids, ready to be batched without padding.

Defined results: a null or empty text is one piece, the end id; a null id is kept as null and its
pieces are numbered among the others (nulls first); repeated rows are packed one by one; an empty
table gives no pieces.  Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_row_index
from ..session import checkpoint_dir
from .common import token_binary

MAX_LENGTH = 2048


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           max_length: int = MAX_LENGTH, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids
    (the piece's ids as little-endian unsigned 32-bit integers)."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    encoded = (docs.select(F.col(id_col).alias("doc_id"), token_binary(tokenizer, end_id)(F.col(text_col)).alias("raw"))
               .withColumn("n", F.expr("cast(length(raw) div 4 as bigint)")))
    top = max_length.bit_length() - 1
    # full pieces, then one for each binary digit of the rest; `n - n % 2^(k+1)` is where digit k starts
    digits = ", ".join(f"if(n & {1 << k} != 0, struct(n - n % {1 << (k + 1)} as start, {1 << k}L as length), null)"
                       for k in range(top - 1, -1, -1))
    full = (f"transform(sequence(0L, n div {max_length}), i -> if(i < n div {max_length}, "
            f"struct(i * {max_length} as start, {max_length}L as length), null))")
    cut = f"array_compact(concat({full}, array({digits})))" if top else f"array_compact({full})"
    piece = "crc32(substring(raw, cast(4 * x.start + 1 as int), cast(4 * x.length as int))) as ids_crc32"
    if with_ids:
        piece += ", substring(raw, cast(4 * x.start + 1 as int), cast(4 * x.length as int)) as ids"
    each = encoded.select("doc_id", F.col("n").alias("doc_tokens"),
                          F.explode(F.expr(f"transform({cut}, x -> struct(x.start, x.length, {piece}))")).alias("p"))
    return each.select("doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", *(["p.ids"] if with_ids else []))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   max_length: int = MAX_LENGTH, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id (dense, by length, then document, then start) and offset.

    The pieces are checkpointed before they are numbered, so each text is encoded once."""
    checkpoint_dir(docs.sparkSession)
    cut = pieces(docs, tokenizer, id_col, text_col, max_length, end_id, with_ids).checkpoint()
    out = with_row_index(cut, ["length", "doc_id", "start", "ids_crc32"], "sequence_id")
    return out.withColumn("offset", F.lit(0).cast("long"))
