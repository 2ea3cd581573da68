"""Packing by concatenate and cut.

All documents' token ids, each document closed by an end id, form one long stream that is cut every
`window` ids. Only the last sequence can be short, so padding is below one window for the whole corpus.

Two passes: the first encodes each document once and writes its ids with the running total inside its
partition; the totals per partition (one row per partition) are prefix-summed; the second adds the
partition's base to each document's place and cuts at multiples of the window. Nothing but the
per-partition totals is gathered anywhere, and no row is shuffled.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import split_words, written

ID_BYTES = 4
# A worker's memory of encoded words, kept from task to task; it is emptied when full, so it bounds
# memory and loses nothing.
CACHED_WORDS = 1_500_000


class WordEncoder:
    """Ids of whole texts, one word at a time, each distinct word encoded once.

    Exact for tokenizers whose normalizer and pre-tokenizer treat ASCII white space as a boundary and
    drop it: then a text's ids are the ids of its words, joined.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def ids(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        words, known = split_words(text), self.known
        missing = list(set(words).difference(known))
        if missing:
            if len(known) + len(missing) > CACHED_WORDS:
                known.clear()
                missing = list(set(words))
            found = self.tokenizer.encode_batch_fast(
                [w.decode() for w in missing], add_special_tokens=False
            )
            for word, encoding in zip(missing, found):
                ids = encoding.ids
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(known.__getitem__, words))


@lru_cache(maxsize=1)
def encoder_for(path: str) -> WordEncoder:
    return WordEncoder(path)


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, start_in_part, doc_id, doc_tokens, ids): every document's ids and its place in its partition."""
    end = np.array([end_id], "<u4").tobytes()
    schema = StructType(
        [
            StructField("part", IntegerType()),
            StructField("start_in_part", LongType()),
            StructField("doc_id", docs.schema[id_col].dataType),
            StructField("doc_tokens", LongType()),
            StructField("ids", BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = encoder_for(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                blobs = [encoder.ids(t) + end for t in piece.column(1).to_pylist()]
                lengths = [len(b) // ID_BYTES for b in blobs]
                starts = start + np.cumsum([0, *lengths])
                start = int(starts[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(blobs), pa.int32()),
                        pa.array(starts[:-1], pa.int64()),
                        piece.column(0),
                        pa.array(lengths, pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(encode, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document in a sequence; every id lies in exactly one piece.

    Columns: doc_id, start (ids of the document before the piece), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), doc_tokens (end id included), sequence_id, offset (place
    in the sequence), starts_document, ends_document.

    A null or empty text is a document of the end id alone. Repeated rows and repeated or null
    doc_ids are packed row by row. An empty table gives no rows. Other columns are ignored.
    """
    stream = written(encoded(docs, tokenizer_path, end_id, id_col, text_col), "encoded")
    totals = stream.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    # One row per partition of the input: small enough for one task, and for a broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    placed = stream.join(F.broadcast(bases), "part").select(
        "doc_id", "doc_tokens", (F.col("base") + F.col("start_in_part")).alias("place"), "ids"
    )
    schema = StructType(
        [StructField("doc_id", stream.schema["doc_id"].dataType)]
        + [StructField(n, LongType()) for n in
           ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, places = (batch.column(i).to_numpy() for i in (1, 2))
            first, last = places // window, (places + tokens - 1) // window
            pieces = last - first + 1
            row = np.repeat(np.arange(batch.num_rows), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] + nth
            begin = np.maximum(places[row], sequence * window)
            stop = np.minimum(places[row] + tokens[row], (sequence + 1) * window)
            start, length = begin - places[row], stop - begin
            blobs, crcs = batch.column(3), np.empty(len(row), np.int64)
            for i, (r, s, n) in enumerate(zip(row.tolist(), start.tolist(), length.tolist())):
                ids = blobs[r].as_buffer()
                crcs[i] = zlib.crc32(ids.slice(ID_BYTES * s, ID_BYTES * n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row))]
                + [pa.array(x, pa.int64()) for x in
                   (start, length, crcs, tokens[row], sequence, begin - sequence * window)],
                names=schema.names,
            )

    return placed.mapInArrow(cut, schema).withColumns(
        {
            "starts_document": F.col("start") == 0,
            "ends_document": F.col("start") + F.col("length") == F.col("doc_tokens"),
        }
    )
