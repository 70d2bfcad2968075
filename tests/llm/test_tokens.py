"""Token counts and packing against the tokenizer library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weirstone.llm import packing, token_counts

ODD = [None, "", " ", "a\x1cb \x1d c  \x85 x​　 <|endoftext|> it's\n\n foo  \tbar''d  ", "ΟΣ İx ſt ﬁ é aaaa aaaaa aaaaaa", "<|startoftext|>Ab<|endoftext|>", "日本語 ١٢٣ ½ ᾳ \U0001f600\U0001f600", " x﻿y\xa0z᠎_", "a" * 5000]


def sample(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    letters = "ab'sS \n\t.,!1éß̇́Σσ漢"
    rng = random.Random(3)
    return ODD + texts + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_counts_equal_the_library(spark):
    texts = sample(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    counted = frame(spark, texts).select("doc_id", token_counts.token_counter(path)("text").alias("n")).collect()
    assert [r.n for r in sorted(counted)] == expected
    forgetful = token_counts.Counter(token_counts.rules(path), kept=3)
    assert [forgetful([t])[0] for t in texts[:60]] == expected[:60]


@pytest.mark.parametrize("limit", [16, 2048])
def test_packing_is_a_round_trip(spark, limit):
    texts = sample(spark) + ["same text"] * 50
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    packed = packing.pack(frame(spark, texts), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, limit=limit).collect()
    by_sequence, by_doc = {}, {}
    for r in packed:
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    for doc, parts in by_doc.items():
        assert [p for p, _, _ in sorted(parts)] == list(range(len(parts)))
        assert [(s, n) for _, s, n in sorted(parts)] == packing.cut(len(ids[doc]), limit)
        assert len(parts) == 1 or all(n == limit for _, _, n in sorted(parts)[1:])
    assert set(by_doc) == set(range(len(texts)))
    total = sum(map(len, ids))
    assert len(by_sequence) <= -(-total // limit) * 1.02 + 2


def test_packing_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {}).count() == 0


def test_two_pieces_replace_the_smallest():
    # greedy: 6 + 3 leaves 1 of 10 free; 6 + 2 + 2 fills it
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == ([(6, 1), (2, 2)], 1)
    assert sum(n for _, n in packing.plan({2048: 10**12, 1: 10**12})) == 10**12 + -(-(10**12) // 2048)
