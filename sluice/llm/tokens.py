"""Token ids of whole texts with a public byte-level tokenizer."""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NEW_LINE = 198
#: places where a blank or a line feed may not start a piece of its own; texts that hold any are encoded whole
UNEVEN = (
    r"  |\n\n| \n|\n |\A[ \n]|[ \n]\z|"
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: a word of letters and the comma or stop after it; a letter is one here that every version of Unicode has as one
ENDED = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{400}-\x{481}][,.]\z"
NO_IDS = pa.scalar(b"", pa.large_binary())


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts as little-endian unsigned 32-bit ids.

    The tokenizer splits a text before it merges bytes, and a blank before a
    visible character always starts a new piece, as does a line feed between
    two visible ones.  Of the pieces between such places the different ones of
    a call are looked up among those kept, and the others are encoded once.
    Above ``max_pieces`` the less frequent half of the kept ones is forgotten.
    Texts with any other white space are given to the tokenizer whole.  Empty
    and null texts have no ids.

    With ``added_tokens`` a text that holds the content of an added token, as
    of <|endoftext|>, gets the id of it there, as in a plain call of the
    tokenizer, and is given to it whole; else the content is text like any other.
    """

    def __init__(self, path: str, max_pieces: int = 600_000, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.max_pieces = max_pieces
        #: the pieces kept, their ids and how often each was met; one without a line feed stands for itself after a blank
        self.known = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.met = np.zeros(0, np.int64)
        self.marks = [pa.scalar(self._whole(c).tobytes(), pa.large_binary()) for c in ",."]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, new: pa.LargeStringArray) -> list[pa.LargeBinaryArray]:
        """The ids of pieces that are not known, encoded as lines of one text."""
        found = []
        for first in range(0, len(new), 1 << 15):
            group = new[first : first + (1 << 15)]
            own = pc.starts_with(group, "\n")
            text = pc.binary_join_element_wise(pc.if_else(own, _text(""), _text("\n ")), group, _text(""))
            text = "".join(text.to_pylist())
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(ids == NEW_LINE)
            # the line feed is left to the pieces that have one
            foreign = ~own.to_numpy(zero_copy_only=False)
            bounds = np.append(starts, len(ids)) - np.concatenate([[0], np.cumsum(foreign)])
            data = np.delete(ids, starts[foreign])
            found.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(group), [None, pa.py_buffer(bounds.astype(np.int64) * 4), pa.py_buffer(data)]))
        return found

    def _look_up(self, words: pa.LargeStringArray, counts: np.ndarray) -> pa.LargeBinaryArray:
        """The ids of different pieces, met so often."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(at.is_null())
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(new))
        if len(new):
            self.ids = pa.concat_arrays([self.ids, *self._learn(new)])
            self.known = pa.concat_arrays([self.known, new])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.met[at] += counts
        found = self.ids.take(pa.array(at))
        if len(self.known) > self.max_pieces:
            keep = np.sort(np.argsort(-self.met, kind="stable")[: self.max_pieces // 2])
            self.known, self.ids, self.met = self.known.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.met[keep] // 2
        return found

    def _pieces(self, pieces: pa.DictionaryArray) -> pa.LargeBinaryArray:
        """The ids of each piece."""
        words, places = pieces.dictionary, pieces.indices
        # a word and the comma or stop after it are separate pieces
        ended = pc.match_substring_regex(words, ENDED)
        stems = pc.if_else(ended, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        counts = np.bincount(stems.indices, np.bincount(places, minlength=len(words)), len(stems.dictionary)).astype(np.int64)
        found = self._look_up(stems.dictionary, counts).take(stems.indices)
        mark = pc.if_else(ended, pc.if_else(pc.ends_with(words, ","), *self.marks), NO_IDS)
        return pc.binary_join_element_wise(found, mark, NO_IDS).take(places)

    def _even(self, texts: pa.LargeStringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``runs`` of texts that are cut into pieces."""
        # each text gets a line feed in front, whose id gives way to the end of the text before
        spaced = pc.binary_join_element_wise(_text(""), pc.replace_substring(texts, "\n", " \n"), _text("\n"))
        pieces = pc.split_pattern(spaced, " ")
        found = self._pieces(pieces.values.dictionary_encode())
        _, offsets, data = found.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(found) + 1)[pieces.offsets.to_numpy()] // 4
        ids = np.empty(bounds[-1], "<u4")
        ids[:-1] = np.frombuffer(data, "<u4", len(ids))[1:]
        ids[bounds[1:] - 1] = end_id
        return ids, np.diff(bounds)

    def runs(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each text ended by ``end_id``, and how many each has with it."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        uneven = pc.or_(pc.equal(pc.binary_length(texts), 0), pc.match_substring_regex(texts, UNEVEN))
        for content in self.added:
            uneven = pc.or_(uneven, pc.match_substring(texts, content))
        even = texts.filter(pc.invert(uneven))
        ids, sizes = self._even(even, end_id) if len(even) else (np.empty(0, "<u4"), np.empty(0, np.int64))
        if len(even) == len(texts):
            return ids, sizes
        end = np.array([end_id], "<u4")
        cut = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        parts = [np.concatenate([self._whole(t), end]) if whole else next(cut) for t, whole in zip(texts.to_pylist(), uneven.to_pylist())]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        ids, sizes = self.runs(pa.array(texts, pa.large_string()), 0)
        data, ends = ids.tobytes(), (np.cumsum(sizes) * 4).tolist()
        return [data[a : b - 4] for a, b in zip([0, *ends], ends)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """This process's encoder for a vocabulary file; its pieces serve later tasks too."""
    if (path, added_tokens) not in _encoders:
        _encoders[path, added_tokens] = Encoder(path, added_tokens=added_tokens)
    return _encoders[path, added_tokens]
