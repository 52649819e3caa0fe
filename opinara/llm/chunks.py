"""Texts as chunks: a dictionary of distinct tokens per chunk, and the positions as indexes into it.

A per-token value that needs the whole corpus (a count, an encoding) is then
found by shuffling each chunk's *distinct* tokens once by token and once back
by chunk, instead of every token of every text. A chunk keeps its distinct
tokens in hash buckets, each packed into a few bytes per token, so they can
travel bucket by bucket. A chunk is bounded; a longer text is one of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.common import text_or_empty
from opinara.session import materialize

#: Characters of text in a chunk.
CHUNK_CHARS = 16_000_000
#: Hash buckets for each shuffle partition: what a task holds of one bucket is a fraction of its share.
BUCKETS_PER_PARTITION = 2


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(data)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes: those below 255 take one, others follow apart, byte plane by byte plane."""
    numbers = np.asarray(numbers).astype("<u4")
    short = _squeeze(np.minimum(numbers, 255).astype(np.uint8).tobytes())
    long = np.ascontiguousarray(numbers[numbers >= 255].view(np.uint8).reshape(-1, 4).T)
    return len(short).to_bytes(4, "little") + short + _squeeze(long.tobytes())


def unpack(data: bytes) -> np.ndarray:
    at, read = 4 + int.from_bytes(data[:4], "little"), zstandard.ZstdDecompressor().decompress
    numbers = np.frombuffer(read(data[4:at]), np.uint8).astype("<u4")
    long = np.frombuffer(read(data[at:]), np.uint8).reshape(4, -1)
    numbers[numbers == 255] = np.ascontiguousarray(long.T).view("<u4").ravel()
    return numbers


def pack_tokens(tokens: list[bytes]) -> bytes:
    """Tokens as one compressed block: their number, their lengths, their bytes."""
    lengths = pack(np.fromiter(map(len, tokens), np.uint32, len(tokens)))
    return (len(lengths).to_bytes(4, "little") + lengths
            + _squeeze(b"".join(tokens)))


def unpack_tokens(block: bytes) -> list[bytes]:
    at = 4 + int.from_bytes(block[:4], "little")
    ends = np.cumsum(unpack(block[4:at]), dtype=np.int64).tolist()
    data = zstandard.ZstdDecompressor().decompress(block[at:])
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def chunk_texts(docs: DataFrame, id_column: str, text_column: str,
                splitter: Callable[[], Callable[[str], list]], chunk_chars: int | None = None) -> DataFrame:
    """``chunk, ids, sizes, indexes, buckets, blocks``: one written row per chunk.

    ``splitter()`` makes, inside the task, the function that cuts a text into
    tokens (str or bytes). ``ids`` and ``sizes`` hold the ids and token counts
    of the chunk's rows in order, ``blocks`` its distinct tokens, one packed block
    for each hash bucket, ``indexes`` all tokens of its texts as packed ranks (the
    commonest token has rank 0) and ``buckets`` the packed bucket of every rank.
    ``indexes_of`` reads them. A null text counts as empty.
    """
    chunk_chars = chunk_chars or CHUNK_CHARS
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("sizes", T.ArrayType(T.IntegerType())),
                           T.StructField("indexes", T.BinaryType()), T.StructField("buckets", T.BinaryType()),
                           T.StructField("blocks", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        number = TaskContext.get().partitionId() << 32
        ids, sizes, parts, known, chars = [], [], [], {}, 0

        def flush():
            indexes = np.concatenate(parts)
            ranked = np.argsort(-np.bincount(indexes, minlength=len(known)), kind="stable")
            rank = np.empty(len(ranked), np.uint32)
            rank[ranked] = np.arange(len(ranked))
            tokens = list(known)
            tokens = [t if isinstance(t, bytes) else t.encode() for t in map(tokens.__getitem__, ranked.tolist())]
            bucket = np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            order = order.tolist()
            blocks = [pack_tokens([tokens[i] for i in order[a:b]]) for a, b in zip(cuts, cuts[1:])]
            id_values = pa.concat_arrays(ids)
            one = lambda values: pa.ListArray.from_arrays([0, len(values)], values)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), one(id_values), one(pa.array(sizes, pa.int32())),
                 pa.array([pack(rank[indexes])], pa.binary()), pa.array([pack(bucket)], pa.binary()),
                 one(pa.array(blocks, pa.binary()))],
                ["chunk", "ids", "sizes", "indexes", "buckets", "blocks"])

        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if sizes and chars + len(text) > chunk_chars:
                    yield flush()
                    number += 1
                    ids, sizes, parts, known, chars = [], [], [], {}, 0
                tokens = split(text)
                add = known.setdefault
                parts.append(np.array([add(t, len(known)) for t in tokens], np.uint32))
                sizes.append(len(tokens))
                ids.append(batch.column(0).slice(i, 1))
                chars += len(text)
        if sizes:
            yield flush()

    return materialize(rows.mapInArrow(run, schema), "text-chunks")


def indexes_of(indexes: bytes, buckets: bytes) -> np.ndarray:
    """Every token of a chunk's texts as its place among the tokens of all blocks."""
    order = np.argsort(unpack(buckets), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[unpack(indexes)]


def chunk_blocks(chunks: DataFrame) -> DataFrame:
    """``chunk, at, block``: the distinct tokens of every chunk; equal tokens are in blocks of equal ``at``."""
    return chunks.select("chunk", F.posexplode("blocks").alias("at", "block"))


def with_values(chunks: DataFrame, values: DataFrame) -> DataFrame:
    """The chunks with ``values``, an array in the order of ``at``, from rows ``chunk, at, value``."""
    lists = values.groupBy("chunk").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))),
                                                    lambda s: s["value"]).alias("values"))
    return chunks.join(lists, "chunk", "left")
