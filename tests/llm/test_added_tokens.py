"""Texts with the strings of added tokens get the ids that the library gives for the whole text."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlake.llm import direct_codes, packing
from reviewlake.llm.library_tokens import LibraryEncoder

TEXTS = [
    "one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b<|startoftext|> c", "plain words", "",
    "<|ENDOFTEXT|> <|endof text|> <|endoftext |>", "x <|startoftext|>", "  <|endoftext|>\n\n<|endoftext|>'s", None,
]


@pytest.mark.parametrize("name,encode,token", [
    ("word_bpe_49k.json", LibraryEncoder.by_words, 49407), ("byte_bpe_50k.json", LibraryEncoder.by_pieces, 50256),
])
def test_encoder(name, encode, token):
    path = public_tokenizers.path(name)
    texts = [text or "" for text in TEXTS] * 2
    wanted = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(LibraryEncoder(path), texts)] == wanted
    assert wanted[1] == [token]


def test_queries(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    library, start = Tokenizer.from_file(path), 0
    for row in sorted(direct_codes.write_and_read(docs, path, 2).collect(), key=lambda r: r["start"]):
        ids = [*library.encode(TEXTS[row["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"], bytes(row["ids"])) == (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for row in packing.placements(docs, path, 0, 256).collect():
        ids = [*library.encode(TEXTS[row["doc_id"]] or "", add_special_tokens=False).ids, 0]
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
