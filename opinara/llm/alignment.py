"""Cross-tokenizer alignment: token streams of two tokenizers as an associative monoid of fragments.

A byte range of a text holds the tokens of both tokenizers that end in it. Its
fragment is an open prefix (all up to the first place where tokens of both
end), closed groups between such places, and an open suffix. Fragments compose
associatively: suffix and next prefix close to one group. Short texts are
composed where they are encoded; a long one is cut into pieces, encoded in as
many tasks, and its fragments are composed in rounds of a tree.

Counts of linked token pairs need all texts: every chunk of texts sends each of
its distinct pairs once to a grouped sum and gets the sums back.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, count, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.chunks import pack, unpack
from opinara.llm.common import text_or_empty
from opinara.session import materialize

#: Characters of a text encoded in one task, bytes of a fragment's range, fragments composed in a round.
PIECE_CHARS, RANGE_BYTES, FAN = 65_536, 16_384, 8
#: Characters encoded and links collected at once in a task.
CHARS_AT_ONCE, LINKS_AT_ONCE = 400_000, 2_000_000
#: Words whose ids a task remembers.
REMEMBERED = 200_000
#: How a byte-level BPE of this kind splits a text before its merges; fixed value.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space between two visible characters: pre-tokens of a byte-level BPE and pieces that hold U+2581 only in front
#: both start here, so the texts on its sides are encoded independently.
_CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
_PLAIN = re.compile(r"(?s)[\w!-~](?:.*[\w!-~])?")
NONE = np.zeros(0, np.int64)


def _byte_of_character() -> dict[str, int]:
    """Byte-level alphabets show a printable byte as itself and the others, in order, from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Tokenizer A (byte-level BPE, space in front of the text) and B (pieces, which adds that space itself).

    A is read from its file as byte ranks. That is the same encoding as by its
    merges exactly when merge number i makes the i-th id after the bytes, which is checked.
    """

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken

        with open(byte_path, encoding="utf-8") as file:
            shown = json.load(file)["model"]
        vocabulary, merges = shown["vocab"], [m.split(" ") if isinstance(m, str) else m for m in shown["merges"]]
        if [vocabulary["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("tokenizer A needs a vocabulary in the order of its merges")
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        byte_of = _byte_of_character()
        ranks = {bytes(byte_of[c] for c in token): number for token, number in vocabulary.items()
                 if all(c in byte_of for c in token) and number < 256 + len(merges)}
        self.a = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (256 + len(merges))
        for token, number in ranks.items():
            self.a_bytes[number] = token
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                        for p in pieces]
        self.lengths = [np.fromiter(map(len, table), np.int64, len(table)) for table in (self.a_bytes, self.b_bytes)]
        # Decimal ids with the sign that follows them: inside a group, and at its end.
        self.shown = [np.array([f"{i}," for i in range(len(table))] + [f"{i}{end}" for i in range(len(table))], object)
                      for table, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))]

        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.unlike: set[int] = set()
        self.known = [_Lists(), _Lists()]

    def _a_ids(self, text: str) -> list[int] | None:
        ids = self.a.encode_ordinary(" " + text)
        return ids if b"".join(map(self.a_bytes.__getitem__, ids)) == (" " + text).encode() else None

    def _learn(self, words: list[str], first: int) -> None:
        """Encode words not met before, numbered from ``first``. Those that may stand side by side go through A in one text."""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        ids = self._a_ids(" ".join(plain)) if plain else []
        found: dict[str, list[int]] = {}
        if ids:
            ends = np.cumsum(self.lengths[0][ids])
            word_ends = np.cumsum([len(w.encode()) + 1 for w in plain])
            places = np.searchsorted(ends, word_ends)
            if np.array_equal(ends[places], word_ends):
                places = [0, *(places + 1).tolist()]
                found = {w: ids[i:j] for w, i, j in zip(plain, places, places[1:])}
        a_lists, b_lists = [], []
        for number, (word, b) in enumerate(zip(words, self.b.encode(words, num_threads=1)), first):
            a = found.get(word) or self._a_ids(word)
            if a is None or b"".join(map(self.b_bytes.__getitem__, b)) != (" " + word).encode():
                self.unlike.add(number)
                a = b = []
            a_lists.append(a)
            b_lists.append(b)
        for known, lists in zip(self.known, (a_lists, b_lists)):
            known.extend(lists)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Token ids of both for each text; None where the bytes of either differ from space and text.

        A text is cut into words wherever both tokenizers start anew, and a word is encoded once.
        """
        if len(self.numbers) > REMEMBERED:
            self.forget()
        split, n = [_CUT.split(t) for t in texts], len(self.numbers)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        flat = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if len(self.numbers) > n:
            self._learn(list(islice(self.numbers, n, None)), n)
        bounds = np.cumsum(sizes)[:-1]
        a, b = ([known.of(part) for part in np.split(flat, bounds)] for known in self.known)
        if not self.unlike:
            return list(zip(a, b))
        bad = np.isin(flat, list(self.unlike))
        return [None if part.any() else pair for part, pair in zip(np.split(bad, bounds), zip(a, b))]


class _Lists:
    """Short lists of ids by number, laid end to end."""

    def __init__(self):
        self.ids, self.starts, self.sizes = NONE, NONE, NONE

    def extend(self, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))))

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The lists of these numbers, one after the other."""
        sizes = self.sizes[numbers]
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


@lru_cache(maxsize=2)
def encoders(byte_path: str, piece_path: str) -> Encoders:
    return Encoders(byte_path, piece_path)


class Fragment(NamedTuple):
    """The tokens that end in a byte range. Without a place where both end (``cut``) all are in the head.

    ``head_*`` are the ids up to the first such place, ``closed`` the groups
    between the first and the last as text, each with a semicolon, ``links`` their last tokens
    (A's id in the upper half), ``tail_*`` the ids after the last.
    """

    cut: bool
    head_a: np.ndarray
    head_b: np.ndarray
    closed: str
    links: np.ndarray
    tail_a: np.ndarray
    tail_b: np.ndarray
    n_a: int
    n_b: int


IDENTITY = Fragment(False, NONE, NONE, "", NONE, NONE, NONE, 0, 0)


def _packed(f: Fragment | None) -> bytes:
    return pickle.dumps(f and tuple(f))


def _unpacked(data: bytes) -> Fragment | None:
    fields = pickle.loads(data)
    return fields and Fragment(*fields)


def _group(a: np.ndarray, b: np.ndarray) -> tuple[str, int]:
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))};", int(a[-1]) << 32 | int(b[-1])


def fragment_of(coders: Encoders, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of tokens with these ids and end offsets."""
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    if not len(shared):
        return Fragment(False, a, b, "", NONE, NONE, NONE, len(a), len(b))
    # Where the groups end among A's and B's tokens; the first group is the head.
    a_at, b_at = np.searchsorted(a_ends, shared) + 1, np.searchsorted(b_ends, shared) + 1
    closed, links = "", NONE
    if len(shared) > 1:
        a0, a1, b0, b1 = a_at[0], a_at[-1], b_at[0], b_at[-1]
        a_last, b_last = np.zeros(a1 - a0, bool), np.zeros(b1 - b0, bool)
        a_last[a_at[1:] - a0 - 1] = b_last[b_at[1:] - b0 - 1] = True
        a_sizes, b_sizes = np.diff(a_at), np.diff(b_at)
        out = np.empty(a1 - a0 + b1 - b0, object)
        out[np.arange(a1 - a0) + np.repeat(np.cumsum(b_sizes) - b_sizes, a_sizes)] = \
            coders.shown[0][a[a0:a1] + len(coders.a_bytes) * a_last]
        out[np.arange(b1 - b0) + np.repeat(np.cumsum(a_sizes), b_sizes)] = \
            coders.shown[1][b[b0:b1] + len(coders.b_bytes) * b_last]
        closed = "".join(out.tolist())
        links = a[a_at[1:] - 1] << 32 | b[b_at[1:] - 1]
    return Fragment(True, a[:a_at[0]], b[:b_at[0]], closed, links, a[a_at[-1]:], b[b_at[-1]:], len(a), len(b))


def compose(fragments: Iterable[Fragment | None]) -> Fragment | None:
    """Adjacent fragments as one. None, a text that can't be aligned, makes the whole None."""
    cut, head_a, head_b = False, NONE, NONE
    open_a, open_b, closed, links, n_a, n_b = [NONE], [NONE], [], [NONE], 0, 0
    for f in fragments:
        if f is None:
            return None
        n_a, n_b = n_a + f.n_a, n_b + f.n_b
        open_a.append(f.head_a)
        open_b.append(f.head_b)
        if f.cut:
            a, b = np.concatenate(open_a), np.concatenate(open_b)
            if cut:
                text, link = _group(a, b)
                closed.append(text)
                links.append(np.array([link], np.int64))
            else:
                cut, head_a, head_b = True, a, b
            closed.append(f.closed)
            links.append(f.links)
            open_a, open_b = [f.tail_a], [f.tail_b]
    a, b = np.concatenate(open_a), np.concatenate(open_b)
    if not cut:
        return Fragment(False, a, b, "", NONE, NONE, NONE, n_a, n_b)
    return Fragment(True, head_a, head_b, "".join(closed), np.concatenate(links), a, b, n_a, n_b)


def fragment_texts(coders: Encoders, texts: list[str], span: int) -> list[Fragment | None]:
    """One fragment per text (without its leading space), composed from those of its ranges of ``span`` bytes."""
    found = []
    for coded in coders.encode(texts):
        if coded is None:
            found.append(None)
            continue
        a, b = coded
        a_ends, b_ends = np.cumsum(coders.lengths[0][a]), np.cumsum(coders.lengths[1][b])
        edges = np.arange(span, int(a_ends[-1]) if len(a) else 0, span)
        a_at = [0, *np.searchsorted(a_ends, edges, side="right").tolist(), len(a)]
        b_at = [0, *np.searchsorted(b_ends, edges, side="right").tolist(), len(b)]
        parts = [fragment_of(coders, a[i:j], b[k:m], a_ends[i:j], b_ends[k:m])
                 for i, j, k, m in zip(a_at, a_at[1:], b_at, b_at[1:])]
        found.append(parts[0] if len(parts) == 1 else compose(parts))
    return found


def finish(whole: Fragment | None) -> tuple[int, int, str, np.ndarray]:
    """``n_a, n_b, digest, links`` of a whole text; zeros and no digest without tokens."""
    if whole is None or not whole.n_a:
        return 0, 0, "", NONE
    text, link = _group(whole.head_a, whole.head_b)
    groups = (text + whole.closed)[:-1]
    return whole.n_a, whole.n_b, hashlib.sha256(groups.encode()).hexdigest(), np.concatenate(([link], whole.links))


def pieces_of(text: str, size: int) -> list[str]:
    """The text cut at spaces into pieces of ``size`` characters or more, without these spaces; where no cut is possible a piece goes on."""
    pieces, start = [], 0
    while len(text) - start > size:
        place = _CUT.search(text, start + size)
        if place is None:
            break
        pieces.append(text[start:place.start()])
        start = place.end()
    return [*pieces, text[start:]]


_CHUNK = [("chunk", T.LongType()), ("ids", None), ("n_a", T.ArrayType(T.LongType())), ("n_b", T.ArrayType(T.LongType())),
          ("n_links", T.ArrayType(T.LongType())), ("digests", T.ArrayType(T.StringType())),
          ("pairs", T.ArrayType(T.LongType())), ("counts", T.ArrayType(T.LongType())), ("indexes", T.BinaryType())]


def _chunk_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t or T.ArrayType(id_type)) for n, t in _CHUNK])


class _Chunk:
    """Aligned texts as one row: their figures, the distinct pairs with counts, and the place of every link among these."""

    def __init__(self):
        self.ids, self.rows, self.n_links = [], [], 0

    def add(self, one_id: pa.Array, whole: Fragment | None) -> None:
        row = finish(whole)
        self.ids.append(one_id)
        self.rows.append(row)
        self.n_links += len(row[3])

    def columns(self, number: int) -> list[pa.Array]:
        links = [r[3] for r in self.rows]
        pairs, indexes, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        one = lambda values: pa.ListArray.from_arrays([0, len(values)], values)
        return [pa.array([number], pa.int64()), one(pa.concat_arrays(self.ids)),
                one(pa.array([r[0] for r in self.rows], pa.int64())), one(pa.array([r[1] for r in self.rows], pa.int64())),
                one(pa.array(list(map(len, links)), pa.int64())), one(pa.array([r[2] for r in self.rows], pa.string())),
                one(pa.array(pairs[order])), one(pa.array(counts[order].astype(np.int64))),
                pa.array([pack(rank[indexes])], pa.binary())]


def _aligned(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Written rows of two kinds: chunks of aligned texts, and the pieces ``doc, id, piece, pieces, text`` of long ones."""
    id_type = docs.schema["id"].dataType
    chunk_schema = _chunk_schema(id_type)
    piece_fields = [T.StructField("doc", T.LongType()), T.StructField("id", id_type), T.StructField("piece", T.IntegerType()),
                    T.StructField("pieces", T.IntegerType()), T.StructField("text", T.StringType())]
    schema = T.StructType([*chunk_schema.fields, *piece_fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = encoders(byte_path, piece_path)
        names = schema.fieldNames()
        n_chunk, number, doc = len(chunk_schema), TaskContext.get().partitionId() << 32, TaskContext.get().partitionId() << 32
        chunk, waiting, chars, kinds = _Chunk(), [], 0, None

        def drain():
            nonlocal waiting, chars
            for (one_id, _), whole in zip(waiting, fragment_texts(coders, [t for _, t in waiting], RANGE_BYTES)):
                chunk.add(one_id, whole)
            waiting, chars = [], 0

        def row(columns, first):
            rest = [pa.nulls(len(columns[0]), k) for k in (kinds[n_chunk:] if first else kinds[:n_chunk])]
            return pa.RecordBatch.from_arrays([*columns, *rest] if first else [*rest, *columns], names)

        for batch in batches:
            if kinds is None:
                one_id = batch.column(0).type
                kinds = [pa.int64(), pa.list_(one_id), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()),
                         *[pa.list_(pa.int64())] * 2, pa.binary(), pa.int64(), one_id, pa.int32(), pa.int32(), pa.string()]
            for i, text in enumerate(batch.column(1)):
                text, one_id = text.as_py(), batch.column(0).slice(i, 1)
                if not text:
                    chunk.add(one_id, None)
                    continue
                pieces = pieces_of(text, PIECE_CHARS)
                if len(pieces) > 1:
                    n = len(pieces)
                    for at, piece in enumerate(pieces):
                        yield row([pa.array([doc]), one_id, pa.array([at], pa.int32()), pa.array([n], pa.int32()),
                                   pa.array([piece])], False)
                    doc += 1
                    continue
                waiting.append((one_id, text))
                chars += len(text)
                if chars > CHARS_AT_ONCE:
                    drain()
                if chunk.n_links > LINKS_AT_ONCE:
                    yield row(chunk.columns(number), True)
                    number, chunk = number + 1, _Chunk()
        drain()
        if chunk.rows:
            yield row(chunk.columns(number), True)

    return materialize(docs.mapInArrow(run, schema), "alignment")


def _long_chunks(pieces: DataFrame, most: int, byte_path: str, piece_path: str) -> DataFrame:
    """Chunks of the texts that came in pieces: encoded piece by piece anywhere, composed in rounds of ``FAN``."""
    id_type = pieces.schema["id"].dataType
    kept = T.StructType([T.StructField("doc", T.LongType()), T.StructField("id", id_type),
                         T.StructField("piece", T.IntegerType()), T.StructField("fragment", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = encoders(byte_path, piece_path)
        for batch in batches:
            for i, text in enumerate(batch.column(3)):
                whole = fragment_texts(coders, [text.as_py()], RANGE_BYTES)[0]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in range(3)),
                                                  pa.array([_packed(whole)], pa.binary())], kept.fieldNames())

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        whole = compose(map(_unpacked, table["fragment"].to_pylist()))
        first = table.slice(0, 1)
        return first.set_column(3, "fragment", pa.array([_packed(whole)], pa.binary())).set_column(
            2, "piece", pa.array([first["piece"][0].as_py() // FAN], pa.int32()))

    parts = pieces.select("doc", "id", "piece", "text").repartition("doc", "piece").mapInArrow(encode, kept)
    while most > 1:
        parts = parts.groupBy("doc", F.floor(F.col("piece") / FAN).alias("slot")).applyInArrow(join, kept)
        most = -(-most // FAN)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers apart from those of the other chunks.
        number, chunk, names = 1 << 62 | TaskContext.get().partitionId() << 32, _Chunk(), [n for n, _ in _CHUNK]
        for batch in batches:
            for i, data in enumerate(batch.column(3)):
                chunk.add(batch.column(1).slice(i, 1), _unpacked(data.as_py()))
                if chunk.n_links > LINKS_AT_ONCE:
                    yield pa.RecordBatch.from_arrays(chunk.columns(number), names)
                    number, chunk = number + 1, _Chunk()
        if chunk.rows:
            yield pa.RecordBatch.from_arrays(chunk.columns(number), names)

    return materialize(parts.mapInArrow(gather, _chunk_schema(id_type)), "alignment-long")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, total, best``: the links of every id pair in all texts, and whether none of the same B id has more."""
    pairs = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    counts = materialize(pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("total")), "alignment-pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    # A B id has at most as many pairs as A has ids.
    highest = counts.groupBy(b.alias("b")).agg(F.max("total").alias("highest"))
    return counts.withColumn("b", b).join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    A null or empty text, and one whose joined token bytes differ from space and
    text in A or B, has zeros and an empty digest. Long texts are encoded in
    pieces and composed again; a text without any space between visible
    characters is one piece. Repeated rows all count; null and repeated ids are kept
    apart, other columns are ignored, no rows give none.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    written = _aligned(rows, byte_path, piece_path)
    names = [n for n, _ in _CHUNK]
    chunks = written.where("chunk IS NOT NULL").select(names)
    pieces = written.where("doc IS NOT NULL").select("doc", "id", "piece", "pieces", "text")
    most = pieces.agg(F.max("pieces")).first()[0]
    if most:
        chunks = chunks.unionByName(_long_chunks(pieces, most, byte_path, piece_path))
    counts = pair_counts(chunks)
    sent = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    # One row per chunk and pair on the left, one per pair on the right: a common pair has no more rows than there are chunks.
    back = (sent.join(counts, "pair").groupBy("chunk")
            .agg(F.sort_array(F.collect_list(F.struct("at", "total", "best"))).alias("v"))
            .select("chunk", F.col("v.total").alias("totals"), F.col("v.best").alias("bests")))
    joined = chunks.select("chunk", "ids", "n_a", "n_b", "n_links", "digests", "indexes").join(back, "chunk", "left")
    whole = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *(T.StructField(n, T.LongType()) for n in whole),
                           T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
                flat = {n: cell[n].values for n in ("ids", "n_a", "n_b", "n_links", "digests")}
                sizes = flat["n_links"].to_numpy()
                indexes = unpack(cell["indexes"].as_py()).astype(np.int64)
                bounds = np.concatenate(([0], np.cumsum(sizes)))

                def sums(name):
                    values = cell[name].values
                    found = np.zeros(0, np.int64) if values is None else np.array(values.to_numpy(zero_copy_only=False), np.int64)
                    total = np.concatenate(([0], np.cumsum(found[indexes])))
                    return pa.array(total[bounds[1:]] - total[bounds[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [flat["ids"], flat["n_a"], flat["n_b"], flat["n_links"], flat["n_links"], sums("bests"), sums("totals"),
                     flat["digests"]], schema.fieldNames())

    return joined.mapInArrow(run, schema)
