import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(tools, rows):
    """Whole texts, byte by byte, without fragments."""
    a, b = tools
    hidden = [x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174)]
    back = {chr(256 + i): x for i, x in enumerate(hidden)}
    result, links_of, counts = [], [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            coded = a.encode(" " + text, add_special_tokens=False)
            a_parts = [(i, bytes(back.get(c, ord(c) & 255) for c in t)) for i, t in zip(coded.ids, coded.tokens)]
            b_parts = []
            for i in b.encode(text):
                p = b.id_to_piece(i)
                b_parts.append((i, bytes.fromhex(p[3:5]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()))
            if all(b"".join(x for _, x in parts) == (" " + text).encode() for parts in (a_parts, b_parts)):
                ends = {}
                for side, parts in enumerate((a_parts, b_parts)):
                    at = 0
                    for i, x in parts:
                        at += len(x)
                        ends.setdefault(at, [None, None])[side] = i
                group = ([], [])
                for at in sorted(ends):
                    for side in (0, 1):
                        if ends[at][side] is not None:
                            group[side].append(ends[at][side])
                    if None not in ends[at]:
                        groups.append(group)
                        group = ([], [])
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        links_of.append(links)
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        result.append([doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(groups), 0, 0,
                       hashlib.sha256(shown.encode()).hexdigest() if groups else ""])
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    for row, links in zip(result, links_of):
        row[5] = sum(counts[x] == best[x[1]] for x in links)
        row[6] = sum(counts[x] for x in links)
    return sorted(map(tuple, result), key=str)


ROWS = [(1, "The quick brown fox, don't jump  over   it.\n\nNew line\ttab"), (2, None), (3, ""), (4, " "), (5, "   lead and trail  "),
        (6, "naïve café – “quoted” … 東京は日本の首都です。 😀👍🏽 0123456789 3.14"), (7, "a▁b"), (8, "<|endoftext|> <s> </s> <unk> <0x41>"),
        (9, "x" * 300), (10, "Straße " * 60), (11, " nbsp　wide \x00 nul \x1c fs"), (12, "é combining ﬁ ligature"),
        (13, "The quick brown fox, don't jump  over   it.\n\nNew line\ttab"), (None, "no id"), (1, "id again"),
        (14, "word . , ; 'tis we'll ... a-b_c/d  e" * 20), (15, "漢字かな交じり文" * 40)]


@pytest.mark.parametrize("piece, span", [(65_536, 16_384), (24, 7), (60, 64), (5, 1)])
def test_against_brute_force(spark, tools, monkeypatch, piece, span):
    monkeypatch.setattr(alignment, "PIECE_CHARS", piece)
    monkeypatch.setattr(alignment, "RANGE_BYTES", span)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in ROWS], "doc_id long, text string, n_a int, chunk string")
    got = alignment.align(docs, A, B)
    assert sorted(map(tuple, got.collect()), key=str) == brute(tools, ROWS)


def test_many_pieces_and_small_chunks(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE_CHARS", 20)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 10)
    monkeypatch.setattr(alignment, "CHARS_AT_ONCE", 30)
    rows = [(i, " ".join(f"word{j} tokenization's" for j in range(i * 13))) for i in range(9)]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B)
    assert sorted(map(tuple, got.collect()), key=str) == brute(tools, rows)


def test_shipped_documents(spark, tools, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, alignment.align(docs, A, B).collect()), key=str) == brute(tools, rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.align(blank, A, B).collect()} == {(0, 0, 0, 0, 0, 0, "")}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab' \n.é東", max_size=60), st.lists(st.integers(1, 80), max_size=6), st.integers(0, 6))
def test_any_bracketing_gives_the_same(text, edges, at):
    coders = alignment.encoders(A, B)
    coded = coders.encode([text])[0]
    if coded is None:
        return
    a, b = coded
    a_ends, b_ends = (np.cumsum(n[x]) for n, x in zip(coders.lengths, (a, b)))
    parts, low = [], 0
    for high in [*sorted(set(edges)), 10_000]:
        in_a, in_b = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
        parts.append(alignment.fragment_of(coders, a[in_a], b[in_b], a_ends[in_a], b_ends[in_b]))
        low = high
    whole = alignment.compose(parts)
    at = min(at, len(parts))
    other = alignment.compose([alignment.compose(parts[:at]), alignment.IDENTITY, alignment.compose(parts[at:])])
    for x, y in zip(whole, other):
        assert np.array_equal(x, y)
    one = alignment.fragment_of(coders, a, b, a_ends, b_ends)
    assert [str(x) for x in alignment.finish(one)] == [str(x) for x in alignment.finish(whole)]
