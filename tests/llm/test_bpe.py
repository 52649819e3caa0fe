"""Encoding against the tiktoken library on whole texts, and the round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from opinara.llm import bpe, chunks

DOCS = "doc_id long, text string, id string, chunk string"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_encoding(spark):
    random.seed(4)
    alphabet = "ab Zé'ß \t\n\r\x0b\x0c\x1c\x1f\x85  　漢字١²½🙂é.,!don't's﻿​<|endoftext|>"
    texts = [None, "", " ", "   \n\n  x", "I'll don't 'S", "<|endoftext|>", "a" * 20_000, " " * 5000 + "x", "!?" * 4000]
    texts += ["".join(random.choice(alphabet) for _ in range(random.randint(1, 400))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, texts[3])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS).repartition(3)
    got = bpe.encode(spark, df, PATH, public_tokenizers.PATTERN, chunk_chars=3000).collect()
    encoder = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                                special_tokens={})
    assert len(got) == len(rows)
    for r in got:
        text = ("no id" if r.id is None else texts[r.id]) or ""
        ids = encoder.encode_ordinary(text)
        assert r.token_ids == ids, repr(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(spark, df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_packing():
    for values in ([], [0], [1, 300, 70_000, 2 ** 32 - 1]):
        assert chunks.unpack(chunks.pack(np.array(values, np.uint32))).tolist() == values
