"""Texts that hold the content of an added token get the ids of a plain call."""

import zlib

import numpy as np

from sluice.llm import packing, token_files, tokens
from sluice.llm.queries import QUERIES

TEXTS = ["one text <|endoftext|> another", "<|endoftext|>", "a<|endoftext|>b c", "no token, here.", "tab\t<|endoftext|>\n x", "x <|endoftext|", None]


def plain(text):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokens.default_tokenizer())
    return found.encode(text, add_special_tokens=False).ids if text else []


def test_encoder_and_queries_follow_the_plain_call(spark, tmp_path):
    assert plain(TEXTS[0]) == [505, 2420, 220, 50256, 1194]
    got = tokens.Encoder(tokens.default_tokenizer(), added_tokens=True).encode(TEXTS)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(t) for t in TEXTS]
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def crc(text, end):
        return zlib.crc32(np.array([*plain(text), end], "<u4").tobytes())

    six = QUERIES["op6_rans_token_files"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in six} == {i: crc(t, token_files.END_ID) for i, t in enumerate(TEXTS)}
    eight = QUERIES["op8_genetic_packing"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in eight} == {i: crc(t, packing.END_ID) for i, t in enumerate(TEXTS)}
