"""Token ids of whole texts, encoded by chunks that no token crosses.

A space between two other characters always ends a pre-token of both public vocabularies used
here, and so does a full stop or comma after a letter. A text is cut at its spaces, and a worker
has the tokenizers library encode each distinct chunk once. A text that has a space next to other
white space is encoded as a whole where the vocabulary keeps white space.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import held_by_worker
from .word_table import Lists, WordTable, spaced_chunks, text_bytes

MOST_CHUNKS = 1_000_000  # a worker forgets its chunks beyond this number
LATIN = "ɐ"  # letters below this one have the same class and lower case in every Unicode version
LETTER = np.zeros(256, bool)  # bytes that end an ASCII letter
LETTER[65:91] = LETTER[97:123] = True
PLAIN = np.zeros(256, bool)  # bytes of ASCII characters that are not white space
PLAIN[33:127] = True


class ChunkEncoder:
    """Encodes batches of texts; ``keep_space``: the vocabulary keeps white space (byte-level)."""

    def __init__(self, path: str, keep_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # for words of letters only: the same model in memory, without the pattern that would find them whole
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        if keep_space and self.tokenizer.normalizer is not None:
            self.plain.normalizer = self.tokenizer.normalizer
        self.keep_space = keep_space
        self.reset()

    @classmethod
    def get(cls, path: str, keep_space: bool) -> "ChunkEncoder":
        return held_by_worker((cls, path, keep_space), lambda: cls(path, keep_space))

    def reset(self) -> None:
        self.words, self.ids, self.unsafe = WordTable(), Lists(), set()
        self.stops = [self.tokenizer.encode(c, add_special_tokens=False).ids[0] for c in ".,"]  # one id each

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of words without a stop at their end."""
        simple = [bool(p) and max(p) < LATIN and (p[1:] if p[0] == " " else p).isalpha() for p in pieces]
        letters = [p for p, s in zip(pieces, simple) if s]
        if not self.keep_space:
            letters = [p.strip(" ").lower() for p in letters]
        out = {True: iter(self.plain.encode_batch_fast(letters, add_special_tokens=False)),
               False: iter(self.tokenizer.encode_batch_fast([p for p, s in zip(pieces, simple) if not s], add_special_tokens=False))}
        return [next(out[s]).ids for s in simple]

    def _learn(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: int) -> None:
        """Ids of new chunks, numbered from ``first``."""
        raw = buf.tobytes()
        ends = starts + lengths
        stop = (lengths > 2) & np.isin(buf[ends - 1], (44, 46)) & LETTER[buf[np.maximum(ends - 2, 0)]]
        bodies, fresh = self.words.lookup(buf, starts[stop], lengths[stop] - 1)
        numbers = np.concatenate([first + np.flatnonzero(~stop), bodies[fresh]])
        begin = np.concatenate([starts[~stop], starts[stop][fresh]])
        end = np.concatenate([ends[~stop], ends[stop][fresh] - 1])
        todo = [raw[a:b].decode() for a, b in zip(begin.tolist(), end.tolist())]
        if self.keep_space:
            inner = begin + (buf[begin] == 32)
            odd = (inner >= end) | ~PLAIN[buf[inner]] | ~PLAIN[buf[end - 1]]
            for k in np.flatnonzero(odd).tolist():
                body = todo[k][1:] if todo[k][0] == " " else todo[k]
                if not body or body[0].isspace() or body[-1].isspace():
                    self.unsafe.add(int(numbers[k]))
        for at in range(0, len(todo), 2_000):
            ids = self._encode(todo[at:at + 2_000])
            self.ids.put(numbers[at:at + 2_000], np.fromiter(map(len, ids), np.int64, len(ids)),
                         np.fromiter(chain.from_iterable(ids), np.int32))
        if stop.any():
            flat, sizes = self.ids.get(bodies)
            marks = np.where(buf[ends[stop] - 1] == 46, self.stops[0], self.stops[1])
            self.ids.put(first + np.flatnonzero(stop), sizes + 1, np.insert(flat, np.cumsum(sizes), marks))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (each text's and ``end_id``), and where each text's begin (one more at the end)."""
        if self.words.n > MOST_CHUNKS:
            self.reset()
        buf, offsets = text_bytes(texts)
        starts, lengths, first = spaced_chunks(buf, offsets)
        before = self.words.n
        numbers, new = self.words.lookup(buf, starts, lengths)
        if len(new):
            self._learn(buf, starts[new], lengths[new], before)
        flat, sizes = self.ids.get(numbers)
        ends = np.concatenate([[0], np.cumsum(sizes)])[first]
        whole = self._whole(numbers, first)
        if not whole:
            places = ends[1:]
            out = np.insert(flat, places, np.int32(end_id))
            return out, ends + np.arange(len(ends))
        docs = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for k in whole:
            text = buf[offsets[k]:offsets[k + 1]].tobytes().decode()
            docs[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        last = np.array([end_id], np.int32)
        out = np.concatenate([p for d in docs for p in (d, last)])
        return out, np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])

    def _whole(self, numbers: np.ndarray, first: np.ndarray) -> list[int]:
        """Texts that hold a chunk with white space at its ends."""
        if not self.unsafe:
            return []
        at = np.flatnonzero(np.isin(numbers, np.fromiter(self.unsafe, np.int64)))
        return np.unique(np.searchsorted(first, at, side="right") - 1).tolist()
