"""Fuzzy line deduplication by MinHash. DataFrame functions only.

Equal lines meet as one. Every line has a set of character
shingles: nine characters from every place of the line (words joined by one
space), as 64-bit hashes. Their minima in classes are banded; inside a band's bucket a few leaders at a time are compared, by exact
Jaccard similarity, with the lines not yet connected to them, until what is left
is known to be connected, so no connection is lost and a group of copies costs
a few rows a line instead of all its pairs. Linked lines form components by
union-find over written tables; the first line of each stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import SPACE_CLASS, SPACES, components, look_up, text_or_empty
from opinara.session import materialize

#: Per cent, so that the limit is compared in whole numbers.
SIMILARITY = 80
#: At 0.8 a pair shares a band with probability 1 - (1 - 0.8 ** 3) ** 6 = 0.986.
BANDS, ROWS = 6, 3
#: Classes of hashes, one for each minimum, so that a hash meets one minimum only. Where a line has no hash of a class, the nearest
#: class that has one stands in; those of a band lie side by side, so a short line's bands follow different shingles.
CLASSES = BANDS * ROWS
#: Leaders of a bucket in the first round; every further one has four times as many, up to the second number.
LEADERS, MOST_LEADERS = 8, 1024
#: Characters of a shingle.
SHINGLE = 9
#: Bytes of a character as it is cut, the same for all, so that a place is found without reading what is before it.
WIDE = 4
#: Shingles of a piece, so that a long line's places are not listed all at once.
PIECE = 4096
#: 64-bit words of a sketch.
SKETCH = 8


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def digest_of(line: Column) -> Column:
    return F.unhex(F.md5(line))


def has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(SPACES)) != ""


def folded(line: Column) -> Column:
    """The line's words joined by one space."""
    trimmed = F.btrim(line, F.lit(SPACES))
    # Most lines are joined by single blanks already; plain searches find those that are not.
    uneven = reduce(Column.__or__, [F.contains(line, F.lit(x)) for x in ["  ", *SPACES[1:]]])
    return F.when(uneven, F.regexp_replace(trimmed, SPACE_CLASS + "+", " ")).otherwise(trimmed)


def wide(line: Column) -> Column:
    """The folded line with ``WIDE`` bytes for every character."""
    return F.encode(folded(line), "UTF-32")


def starts(text: Column, step: int = 1) -> Column:
    """Every ``step``-th place (in bytes, from 1) of a wide text at which a shingle begins; a shorter text is one shingle."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(text) - (SHINGLE * WIDE - 1), F.lit(1)), F.lit(step * WIDE))


def shingle_at(text: Column, place: Column) -> Column:
    return F.xxhash64(F.substring(text, place, F.lit(SHINGLE * WIDE)))


def hashes(line: Column) -> Column:
    """The 64-bit hashes of the nine characters at every place of the line."""
    # A text that a function's inner step reads is made once where it comes as that function's argument.
    return F.get(F.transform(F.array(wide(line)), lambda text: F.transform(starts(text), lambda i: shingle_at(text, i))), F.lit(0))


def shingles(line: Column) -> Column:
    """The distinct ones."""
    return F.array_distinct(hashes(line))


def alike(x: Column, size_x: Column, y: Column, size_y: Column) -> Column:
    """Whether two lists reach the Jaccard similarity of their sets, which have these sizes."""
    return F.size(F.array_intersect(x, y)) * (100 + SIMILARITY) >= (size_x + size_y) * SIMILARITY


def sizes_allow(x: Column, y: Column) -> Column:
    """Whether sets of these sizes can reach it: the smaller one holds at most all that they share."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * SIMILARITY


def sketches(lines: DataFrame) -> DataFrame:
    """``line_id, size, sketch``: the distinct hashes, and for each of 64 * SKETCH classes whether their number is odd."""
    words = [F.expr(f"coalesce(bit_xor(bit) FILTER (WHERE word = {i}), 0L)") for i in range(SKETCH)]
    return (lines.select("line_id", F.explode(shingles(F.col("line"))).alias("h"))
            .select("line_id", "h", F.expr("shiftleft(1L, int(h & 63))").alias("bit"),
                    F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(SKETCH - 1)).alias("word")).groupBy("line_id")
            .agg(F.count("h").cast("int").alias("size"), F.array(*words).alias("sketch")))


def sketches_allow(x: Column, size_x: Column, y: Column, size_y: Column) -> Column:
    """Whether sets with these sketches can reach it: every class that differs holds a hash that only one set has."""
    apart = reduce(Column.__add__, [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH)])
    return apart * (100 + SIMILARITY) <= (size_x + size_y) * (100 - SIMILARITY)


def band_keys(lines: DataFrame) -> DataFrame:
    """``line_id, key``: one number per band from the minima of its classes of hashes.

    A line's shingles are exploded and their minima grouped, which stays in
    compiled code and combines before the shuffle. The filters leave a hash's
    other minima untouched.
    """
    text = lines.select("line_id", wide(F.col("line")).alias("text"))
    cut = (text.select("line_id", "text", F.explode(starts(F.col("text"), PIECE)).alias("at"))
           .select("line_id", F.substring("text", F.col("at"), F.lit((PIECE + SHINGLE - 1) * WIDE)).alias("text")))
    hashed = (cut.select("line_id", "text", F.explode(starts(F.col("text"))).alias("at"))
              .select("line_id", shingle_at(F.col("text"), F.col("at")).alias("h")))
    least = hashed.withColumn("class", F.pmod("h", F.lit(CLASSES))).groupBy("line_id").agg(
        *[F.expr(f"min(h) FILTER (WHERE class = {i})").alias(f"m{i}") for i in range(CLASSES)])
    near = lambda i: sorted(range(CLASSES), key=lambda j: (min((j - i) % CLASSES, (i - j) % CLASSES), (j - i) % CLASSES))
    least = least.select("line_id", *[F.coalesce(*[f"m{j}" for j in near(i)]).alias(f"m{i}") for i in range(CLASSES)])
    keys = [F.xxhash64(F.lit(b), *[f"m{i}" for i in range(b * ROWS, (b + 1) * ROWS)]) for b in range(BANDS)]
    return least.select("line_id", F.explode(F.array(*keys)).alias("key"))


def similar(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Of the pairs ``a, size_a, b, size_b`` those whose sets reach the similarity; lines are cut where two meet, as text is smaller."""
    counted = pairs.groupBy("a").agg(F.count("b").alias("n"))
    # Ids go into hash tables, so that texts are not sorted.
    leaders = lines.withColumnsRenamed({"line_id": "a", "line": "line_a"}).join(counted.hint("shuffle_hash"), "a")
    met = lines.withColumnsRenamed({"line_id": "b", "line": "line_b"}).join(pairs.hint("shuffle_hash"), "b")
    both = look_up(met, leaders, ["a"], "n", pairs.count())
    return both.where(alike(hashes(F.col("line_a")), F.col("size_a"), hashes(F.col("line_b")), F.col("size_b"))).select("a", "b")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` after further links ``a, b``: only the roots that these touch are connected anew."""
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias("own"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("own", end)).drop("own")
    merged = materialize(components(links.select("a", "b"), "line-components"), "line-merged")
    moved = roots.join(merged.withColumnsRenamed({"root": "to", "node": "root"}), "root", "left")
    return moved.select("node", F.coalesce("to", "root").alias("root")).unionAll(
        merged.join(roots, "node", "left_anti").select("node", "root"))


def line_roots(lines: DataFrame) -> DataFrame:
    """``digest, root`` of every line that is linked to another; ``line_id, line`` may repeat a line and comes straight from the texts.

    The id is a hash of the line. Should two lines have the same, one of them stays without links.

    Every round compares a few leaders of each bucket with the bucket's lines that
    are not yet connected to them through any bucket; leaders then leave, and so
    do buckets whose lines are all connected. Lines without a link lead first, so
    a large group needs no further leaders once the lines apart from it have led.
    """
    keyed = materialize(band_keys(lines), "line-bands")
    sizes = keyed.groupBy("key").agg(F.count("line_id").alias("n")).where("n > 1")
    # Few keys have two lines: a hash table of them spares sorting all others.
    shared = materialize(look_up(keyed, sizes.hint("shuffle_hash"), ["key"], "n", keyed.count()).where("n is not null")
                         .select("key", "line_id"), "line-shared")
    # Most lines share no bucket; those that do are read by every round. Only they are sorted to leave one of equal lines.
    copies = lines.groupBy("line_id").agg(F.count("line_id").alias("n"))
    copies = materialize(copies.join(shared.select("line_id").distinct(), "line_id"), "line-copies")
    texts = materialize(look_up(lines, copies.hint("shuffle_hash"), ["line_id"], "n", max(1, lines.count())).where("n is not null")
                        .groupBy("line_id").agg(F.min("line").alias("line")), "line-texts")
    # ``label``: the root of a line that is linked, null for others.
    state = materialize(shared.join(sketches(texts), "line_id").select(
        "key", "line_id", "size", "sketch", F.lit(None).cast("long").alias("label")), "line-state")
    roots = texts.select(F.col("line_id").alias("node"), F.col("line_id").alias("root")).where("false")
    mine, a_round = F.coalesce("label", "line_id"), 0
    while total := state.count():
        # More leaders a round instead of more rounds: at most four times the comparisons that are needed anyway.
        places = min(LEADERS << 2 * a_round, MOST_LEADERS)
        best = (state.groupBy("key", F.pmod(F.xxhash64("line_id", F.lit(a_round)), F.lit(places)).alias("place"))
                .agg(F.min(F.struct(F.col("label").isNotNull().alias("x"), "line_id", "label", "size", "sketch")).alias("l"),
                     F.count("line_id").alias("n")))
        leaders = best.groupBy("key").agg(
            F.collect_list(F.struct(F.col("l.line_id").alias("id"), F.coalesce("l.label", "l.line_id").alias("label"),
                                    F.col("l.size").alias("size"), F.col("l.sketch").alias("sketch"))).alias("leaders"),
            F.sum("n").alias("n"))
        met = look_up(state, leaders, ["key"], "n", total)
        others = F.filter("leaders", lambda l: (l["label"] != mine) & sizes_allow(l["size"], F.col("size")) & sketches_allow(
            l["sketch"], l["size"], F.col("sketch"), F.col("size")))
        tried = met.select(F.col("line_id").alias("b"), F.col("size").alias("size_b"), F.inline(F.transform(
            others, lambda l: F.struct(l["id"].alias("a"), l["size"].alias("size_a")))))
        pairs = materialize(tried.distinct(), "line-pairs")
        links = materialize(similar(pairs, texts), "line-links")
        if not links.isEmpty():
            roots = materialize(joined(roots, links), "line-roots")
        left = met.where(~F.exists("leaders", lambda l: l["id"] == F.col("line_id"))).select("key", "line_id", "size", "sketch")
        left = materialize(left.join(roots.withColumnsRenamed({"node": "line_id", "root": "label"}), "line_id", "left")
                           .select("key", "line_id", "size", "sketch", "label"), "line-state")
        open_ = left.groupBy("key").agg(F.count("line_id").alias("n"), F.count("label").alias("k"), F.min("label").alias("lo"),
                                        F.max("label").alias("hi")).where("k < n or lo < hi").where("n > 1")
        state = materialize(look_up(left, open_.select("key", "n"), ["key"], "n", max(1, left.count()))
                            .where("n is not null").select("key", "line_id", "size", "sketch", "label"), "line-state")
        a_round += 1
    return texts.join(roots.withColumnRenamed("node", "line_id"), "line_id").select(digest_of(F.col("line")).alias("digest"), "root")


def fuzzy_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_lines, n_kept, dropped`` per row; ``dropped`` holds the numbers (from 0) of lines that go.

    Of each component of similar lines the first stays, by id, row and line
    number; a null id comes last. Lines without a word are never dropped. A null
    text is one empty line. Repeated rows lose their lines as any copy does; no
    rows give none; other columns are ignored.
    """
    text = text_or_empty(text_column)
    digest = lambda line: F.when(has_word(line), digest_of(line))
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
                                   F.transform(lines_of(text), digest).alias("digests")), "line-digests")
    places = rows.select("row", "id", F.posexplode("digests").alias("at", "digest")).where("digest is not null")
    order = F.struct(F.col("id").isNull().alias("x"), F.col("id").alias("id"), F.col("row").alias("row"), F.col("at").alias("at"))
    # Texts are cut into lines again where these are hashed: no table of all lines is written or shuffled.
    lines = docs.select(F.explode(lines_of(text)).alias("line")).where(has_word(F.col("line")))
    roots = line_roots(lines.select(F.xxhash64("line").alias("line_id"), "line"))
    # Only lines with a copy or a link can lose a place.
    known = places.groupBy("digest").agg(F.min(order).alias("first"), F.count("at").alias("n"))
    grouped = materialize(known.join(roots, "digest", "left").where("n > 1 or root is not null"), "line-grouped")
    keep = grouped.where("root is not null").groupBy("root").agg(F.min("first").alias("keep"))
    table = materialize(grouped.join(keep, "root", "left").select("digest", "n", F.coalesce("keep", "first").alias("keep")),
                        "line-keepers")
    total = places.count()
    gone = (look_up(places.select("row", "at", "digest"), table.hint("shuffle_hash"), ["digest"], "n", total)
            .where("keep is not null and not (keep.row = row and keep.at = at)")
            .groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("dropped")))
    none = F.array().cast("array<int>")
    n_lines = F.size("digests").cast("long")
    return (rows.join(gone, "row", "left").select(
        "id", "row", n_lines.alias("n_lines"), (n_lines - F.coalesce(F.size("dropped"), F.lit(0))).alias("n_kept"),
        F.coalesce("dropped", none).alias("dropped")))


def without_lines(text: Column, dropped: Column) -> Column:
    """The text that is left."""
    return F.array_join(F.filter(F.transform(lines_of(text), lambda line, i: F.when(~F.array_contains(dropped, i), line)),
                                 lambda line: line.isNotNull()), "\n")
