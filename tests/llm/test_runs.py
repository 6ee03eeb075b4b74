"""Ids of many texts in one call: those of a plain call, each text with its end."""

import numpy as np
import pyarrow as pa

from sluice.llm import tokens

END = 7
TEXTS = [
    "One word, two words. Ça, où.\nNext line, it's 12, (x), end.",
    None,
    "two  blanks",
    "",
    "a",
    "a\n\nb",
    " in front",
    "behind ",
    "tab\there",
    "nbsp here",
    "one <|endoftext|> two",
    "\n",
    "中, ß, Д, ٣, ×, a,, ., ,",
    "last, line.\nOne word, two words.",
]


def plain(tokenizer, text):
    return [*(tokenizer.encode(text, add_special_tokens=False).ids if text else []), END]


def runs_of(encoder, texts):
    ids, sizes = encoder.runs(pa.array(texts, pa.string()), END)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_runs_are_those_of_plain_calls():
    for added in (False, True):
        encoder = tokens.Encoder(tokens.default_tokenizer(), max_pieces=20, added_tokens=added)
        for some in (TEXTS, TEXTS[:1], TEXTS[1:4], TEXTS[::-1], TEXTS[4:5]):
            assert runs_of(encoder, some) == [plain(encoder.tokenizer, t) for t in some]


def test_slice_of_a_column_and_no_texts():
    encoder = tokens.Encoder(tokens.default_tokenizer())
    ids, sizes = encoder.runs(pa.array(TEXTS, pa.string()).slice(4, 2), END)
    assert ids.tolist() == plain(encoder.tokenizer, "a") + plain(encoder.tokenizer, "a\n\nb")
    assert sizes.tolist() == [len(plain(encoder.tokenizer, t)) for t in TEXTS[4:6]]
    assert [len(x) for x in encoder.runs(pa.array([], pa.string()), END)] == [0, 0]


def test_frequent_pieces_are_encoded_once(monkeypatch):
    """Words that recur stay known although many others come between."""
    encoder = tokens.Encoder(tokens.default_tokenizer(), max_pieces=100)
    given, real = [], encoder.tokenizer

    class Spy:
        def encode_batch_fast(self, texts, **more):
            given.extend(texts)
            return real.encode_batch_fast(texts, **more)

        def encode(self, text, **more):
            return real.encode(text, **more)

    monkeypatch.setattr(encoder, "tokenizer", Spy())
    for k in range(30):
        often = "often seen, " * 20 + "x" if k % 6 == 0 else "x"
        text = f"{often} " + " ".join(f"w{k}q{i}" for i in range(40))
        assert encoder.encode([text])[0] == np.array(plain(real, text)[:-1], "<u4").tobytes()
    assert sum(t.split().count("seen") for t in given) == 1
