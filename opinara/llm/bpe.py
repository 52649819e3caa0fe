"""Byte-level BPE over distinct pre-tokens.

Texts are cut by the vocabulary's pattern into pre-tokens with positions; every
distinct pre-token is shuffled, encoded once, and its ids go back to the chunks
that hold it, where they are put together by position. Decoding looks ids up in
the table of token bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from opinara.llm.chunks import chunk_blocks, chunk_texts, indexes_of, pack, unpack, unpack_tokens, with_values

#: Characters in a chunk: the larger, the fewer distinct tokens travel.
CHUNK_CHARS = 32_000_000
#: One pre-token is never split again.
WHOLE = r"[\s\S]+"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a blank and its id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def unicode_spaces(pattern: str) -> str:
    """The pattern with ``\\s`` as Unicode's White_Space, whichever class the engine at hand uses."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two in (r"\s", r"\S"):
            name = "White_Space" if two == r"\s" else "^White_Space"
            out.append(rf"\p{{{name}}}")
            i += 2
        else:
            out.append(two if two[0] == "\\" else two[0])
            i += len(out[-1])
    return "".join(out)


def encode_distinct(blocks: DataFrame, ranks) -> DataFrame:
    """``chunk, at, value`` from ``chunk, at, block``: per block how many ids its tokens have, and the ids, packed.

    Equal tokens of all chunks meet in one bucket, where each is encoded once; a
    task holds the distinct tokens of one bucket at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tiktoken.Encoding("pre-token", pat_str=WHOLE, mergeable_ranks=ranks.value, special_tokens={})
        bucket, known = -1, {}
        for batch in batches:
            values = []
            for at, block in zip(batch.column(1).to_pylist(), batch.column(2)):
                if at != bucket:
                    bucket, known = at, {}
                tokens = unpack_tokens(block.as_py())
                new = [t for t in tokens if t not in known]
                known.update(zip(new, (np.array(encoder.encode_ordinary(t.decode()), "<u4") for t in new)))
                ids = [known[t] for t in tokens]
                counts = pack(np.fromiter(map(len, ids), np.uint32, len(ids)))
                values.append(len(counts).to_bytes(4, "little") + counts
                              + pack(np.concatenate(ids) if ids else np.zeros(0, "<u4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.binary())],
                                             ["chunk", "at", "value"])

    return blocks.repartition("at").sortWithinPartitions("at").mapInArrow(run, "chunk long, at int, value binary")


def _codes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all distinct tokens of a chunk, one after the other, and how many each token has."""
    counts, ids = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
    for value in values:
        at = 4 + int.from_bytes(value[:4], "little")
        counts.append(unpack(value[4:at]))
        ids.append(unpack(value[at:]))
    return np.concatenate(ids), np.concatenate(counts).astype(np.int64)


def encode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id",
           text_column: str = "text", with_ids: bool = True, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``token_ids`` per row.

    A null text is an empty one and has no tokens. Repeated rows, null ids and
    very long texts come out as they went in; no rows give none; other columns
    are ignored. The driver reads the rank file; it is of fixed size and broadcast.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    compiled = unicode_spaces(pattern)
    chunks = chunk_texts(docs, id_column, text_column, lambda: regex.compile(compiled).findall, chunk_chars)
    coded = with_values(chunks, encode_distinct(chunk_blocks(chunks), ranks))
    id_type = chunks.schema["ids"].dataType.elementType
    out = f"id {id_type.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b""] * (max(ranks.value.values(), default=-1) + 1)
        for token, rank in ranks.value.items():
            table[rank] = token
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                indexes = indexes_of(row["indexes"].as_py(), row["buckets"].as_py())
                flat, lengths = _codes(row["values"].as_py())
                begins = np.cumsum(lengths) - lengths
                columns, at = ([], [], [], []), 0
                for size in row["sizes"].as_py():
                    part = indexes[at:at + size]
                    at += size
                    n = lengths[part]
                    shift = np.cumsum(n) - n
                    ids = flat[np.repeat(begins[part] - shift, n) + np.arange(n.sum())]
                    decoded = b"".join(map(table.__getitem__, ids.tolist()))
                    for values, value in zip(columns, (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                                                       hashlib.sha256(decoded).hexdigest(), ids if with_ids else None)):
                        values.append(value)
                arrays = [row["ids"].values, pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2])]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays.append(pa.array(columns[3], pa.list_(pa.int64())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return (coded.select("ids", "sizes", "indexes", "buckets", "values")
            .mapInArrow(run, out + (", token_ids array<long>" if with_ids else "")))
