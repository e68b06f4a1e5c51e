import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedwright.llm.bpe import Encoder, Vocabulary, decode_column, encode_column, merge_all, round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(seed, n=1500):
    r = random.Random(seed)
    pool = [chr(c) for c in range(0x250)] + list("\u0085  　​﻿ 日本🙂٠½̀")
    out = ["", " ", "\n\n  x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "'s 'll 'x", "a" * 5000, "é" * 3000, "ab " * 3000]
    for _ in range(n):
        out.append("".join(r.choice(r.choice([pool, " '\n\tsretvmlld", "  \n", "the of and "])) for _ in range(r.randint(0, 40))))
    return out


def test_equals_the_library(library):
    with open(PATH, encoding="utf-8") as file:
        encoder = Encoder(Vocabulary.from_json(file.read()))
    every = texts(1)
    for text, ids in zip(every, encoder.encode_batch(every)):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_ties_merge_from_the_left():
    merges = {(0, 0): (0, 1), (1, 1): (1, 2)}
    assert merge_all([0] * 5, merges) == [2, 0] and merge_all([0], merges) == [0] and merge_all([], merges) == []


def test_columns(spark, library):
    every = texts(2, 200)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(every)] + [(None, "x", ""), (3, None, ""), (3, None, "")], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in round_trip(df.where("doc_id <> 3"), PATH).collect()}
    for i, t in enumerate(every):
        if i != 3:
            ids = library.encode(t, add_special_tokens=False).ids
            assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    coded = encode_column(df, PATH)
    assert coded.where("doc_id = 3").count() == 3 and coded.where("doc_id IS NULL").first().ids is not None
    back = {r.doc_id: r.text for r in decode_column(coded.where("doc_id <> 3"), PATH).collect()}
    assert all(back[i] == t for i, t in enumerate(every) if i != 3)
    assert round_trip(df.limit(0), PATH).count() == 0


def test_a_million_characters_without_a_space(library):
    with open(PATH, encoding="utf-8") as file:
        encoder = Encoder(Vocabulary.from_json(file.read()))
    r = random.Random(9)
    text = "".join(r.choice("etaoinshrdlu") for _ in range(1_000_000))
    assert encoder.encode_batch([text])[0] == library.encode(text, add_special_tokens=False).ids
