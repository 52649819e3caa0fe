"""The pipeline's own run: every stage against brute force over the rows it was given."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from opinara.llm.bpe import read_ranks
from opinara.llm.simhash import RADIUS, fingerprint


def test_stages(spark, data, monkeypatch):
    seen = {}

    def watched(name, stage):
        def call(session, docs, folder):
            seen[name] = (docs.columns, docs.collect())
            return stage(session, docs, folder)
        return name, call
    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    last = corpus_pipeline.run(spark, data).collect()
    names = list(seen)
    assert names == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "bpe"]
    assert all(seen[n][0] == seen["toxicity"][0] for n in names)
    rows = {n: Counter(tuple(r) for r in seen[n][1]) for n in names}
    text = {n: {r.doc_id: r.text or "" for r in seen[n][1]} for n in names}

    # Toxicity: rows go or stay as they are, and those labelled clean stay.
    assert not rows["exact_dedup"] - rows["toxicity"]
    clean = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("toxic = 0").collect()}
    assert len(clean & set(text["exact_dedup"])) >= 0.95 * len(clean & set(text["toxicity"]))

    # Exact copies: the largest id of every text.
    best = {}
    for i, t in text["exact_dedup"].items():
        best[t] = max(i, best.get(t, i))
    assert set(text["simhash_dedup"]) == set(best.values())

    # Near copies: one row of every component of linked fingerprints.
    ids = sorted(text["simhash_dedup"])
    prints = [fingerprint(text["simhash_dedup"][i]) for i in ids]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= RADIUS:
                root[find(i)] = find(j)
    number = {x: find(k) for k, x in enumerate(ids)}
    kept = [number[i] for i in text["mixing"]]
    assert len(kept) == len(set(kept)) == len(set(number.values()))

    # The mix repeats whole rows, at most three times.
    copies = Counter(r.doc_id for r in seen["bpe"][1])
    assert copies and max(copies.values()) <= 3 and set(rows["bpe"]) <= set(rows["mixing"])

    # Tokens: as the public library encodes them, and back.
    coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)))
    assert Counter(r.doc_id for r in last) == copies
    for r in last:
        codes = np.array(coder.encode_ordinary(text["bpe"][r.doc_id]), "<u4")
        assert r.n_tokens == len(codes) and r.ids_sha256 == hashlib.sha256(codes.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text["bpe"][r.doc_id].encode()).hexdigest()
