"""Fast exact encoding with a byte-level BPE tokenizer.

Byte-level BPE first cuts a text into words by a pattern and then encodes each word alone. A cut
before a single space between two visible characters, or before ASCII punctuation that follows an
ASCII letter, always falls between two such words. So the pieces between these cuts can be encoded
one by one: a chunk's distinct pieces are found by Arrow's dictionary encoding and looked up by hash, and
compared, among those that the worker keeps. The others are strung together, where the same cuts fall
between them, and encoded as a few texts; the tokens' bytes tell where each piece's ids end.

The tokenizer's added tokens are taken out of a text before it is cut into words, so each of them is
a piece of its own. A text with one that also takes in what stands around it is one piece.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recordflow.llm.common import text_bytes
from recordflow.llm.tally import span_hashes

#: Pieces that a worker keeps, and the bytes of the longest; others are encoded anew in each chunk.
CACHE = 400_000
CACHED_BYTES = 48
#: Pieces that are encoded as one text.
JOINED = 1_000

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
# Lead bytes of two-byte letters. 0xC2 and three-byte leads also begin Unicode white space.
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = _VISIBLE & ~_LETTER
_PUNCTUATION[0x30:0x3A] = False
# Pieces that can be strung together: each begins with a space, or with punctuation and is given a letter before.
_SEEN = r"[\x21-\x7E\x{C0}-\x{7FF}]"
_JOINT = rf"(?s)\A(?: {_SEEN}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])(?:.*{_SEEN})?\z"
_LETTER_BEFORE = " a"


def piece_starts(data: np.ndarray, offsets: np.ndarray, spans: np.ndarray | None = None) -> np.ndarray:
    """Where the pieces of all texts begin, ascending. Each of the spans (begin, end) is one piece."""
    if not len(data):
        return np.zeros(0, np.int64)
    cut = np.zeros(len(data), bool)
    if len(data) > 2:
        visible, lead = _VISIBLE[data], _LEAD[data]
        ends = visible.copy()  # the last byte of a visible character
        ends[1:] |= lead[:-1]
        cut[1:-1] = (data[1:-1] == 0x20) & ends[:-2] & (visible | lead)[2:]
        cut[1:] |= _PUNCTUATION[data[1:]] & _LETTER[data[:-1]]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    if spans is not None and len(spans):
        for begin, end in spans:
            cut[begin:end] = False
        cut[spans[:, 0]] = True
        cut[spans[spans[:, 1] < len(data), 1]] = True
    return np.flatnonzero(cut)


def gathered(ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all spans, one after the other, and the offsets of the spans in them."""
    sizes = end - begin
    after = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(begin - after[:-1], sizes) + np.arange(after[-1])], after


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # The longest of the tokens that begin at a place is the one that counts.
        contents = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(re.escape(c) for c in contents)) if contents else None
        #: Added tokens end where their strings end and are all looked for at the same time.
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for t in added) and (
            len({t.normalized for t in added}) < 2
        )
        self.vocabulary = self.tokenizer.get_vocab_size()
        # In a byte-level vocabulary a character stands for a byte.
        tokens = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(tokens.values(), default=0) + 1, np.int64)
        self.bytes[list(tokens.values())] = [len(t) for t in tokens]
        #: The pieces that are kept, by ascending hash, their ids with offsets, and how often each was met.
        self.hashes, self.known = np.zeros(0, np.uint64), pa.array([], pa.string())
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)

    def _encode(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and the offsets of the pieces in them."""
        joint = np.asarray(pc.match_substring_regex(pieces, _JOINT))
        found = self._encode_joint(pieces.filter(pa.array(joint)).to_pylist()) if joint.any() else None
        if found is None:
            joint, found = np.zeros(len(pieces), bool), (np.zeros(0, np.uint32), *np.zeros((2, 0), np.int64))
        rest = pieces.filter(pa.array(~joint)).to_pylist()
        alone = [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        bounds = len(found[0]) + np.cumsum([0, *map(len, alone)])
        begin, end = np.zeros((2, len(pieces)), np.int64)
        begin[joint], end[joint] = found[1:]
        begin[~joint], end[~joint] = bounds[:-1], bounds[1:]
        return gathered(np.concatenate([found[0], *alone]), begin, end)

    def _encode_joint(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of pieces that are strung together, and each one's begin and end in them.

        None if a token reaches over pieces, or if the tokens are not the bytes of the text.
        """
        led = np.array([p[0] != " " for p in pieces])
        strung = [_LETTER_BEFORE + p if x else p for p, x in zip(pieces, led.tolist())]
        texts = ["".join(strung[i : i + JOINED]) for i in range(0, len(strung), JOINED)]
        if self.added is not None and any(self.added.search(t.encode()) for t in texts):
            return None
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, np.uint32) for e in encoded])
        ends = np.cumsum(pc.binary_length(pa.array(strung, pa.large_string())).to_numpy())
        begins = np.concatenate([[0], ends[:-1]]) + led * len(_LETTER_BEFORE)
        at = np.concatenate([[0], np.cumsum(self.bytes[ids])])
        begin, end = np.searchsorted(at, begins), np.searchsorted(at, ends)
        if at[-1] != ends[-1] or (at[begin] != begins).any() or (at[end] != ends).any():
            return None
        return ids, begin, end

    def _places(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces with their offsets, and the number that each of the given pieces has there."""
        coded = pieces.dictionary_encode()
        distinct, number = coded.dictionary, coded.indices.to_numpy()
        times = np.bincount(number, minlength=len(distinct))
        data, offsets = text_bytes(distinct)
        hashes = span_hashes(data, offsets[:-1], offsets[1:])
        place, n = np.searchsorted(self.hashes, hashes), len(self.hashes)
        same = place < n
        same[same] = self.hashes[place[same]] == hashes[same]
        taken = same.copy()  # of two pieces with one hash, the first is kept
        same[taken] = np.asarray(pc.equal(self.known.take(pa.array(place[taken])), distinct.filter(pa.array(taken))))
        self.met[place[same]] += times[same]
        place[~same] = n + np.arange(n_new := int((~same).sum()))
        encoded, bounds = self._encode(distinct.filter(pa.array(~same)))
        ids, ends = np.concatenate([self.ids, encoded]), np.concatenate([self.ends, self.ends[-1] + bounds[1:]])
        if n_new:
            pool = pa.concat_arrays([self.known, distinct.filter(pa.array(~same))])
            short = ~taken[~same] & (offsets[1:] - offsets[:-1] <= CACHED_BYTES)[~same]
            self._keep(pool, np.concatenate([self.hashes, hashes[~same]]), ids, ends, np.concatenate([self.met, times[~same]]), n + np.flatnonzero(short))
        return ids, ends, place[number]

    def _keep(self, pool: pa.StringArray, hashes: np.ndarray, ids: np.ndarray, ends: np.ndarray, met: np.ndarray, new: np.ndarray) -> None:
        """Add the ``new`` ones of the pool to those that are kept; of too many, the half that was met most stays."""
        stay = np.concatenate([np.arange(len(self.hashes)), new])
        if len(stay) > CACHE:
            stay = stay[np.argsort(-met[stay], kind="stable")[: CACHE // 2]]
            met = met // 2
        stay = stay[np.unique(hashes[stay], return_index=True)[1]]
        self.hashes, self.known, self.met = hashes[stay], pool.take(pa.array(stay)), met[stay]
        self.ids, self.ends = gathered(ids, ends[stay], ends[stay + 1])

    def _spans(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Begin and end of the added tokens in the texts, or of the texts that hold some."""
        whole = np.ascontiguousarray(data).data
        if self.added is None or not self.added.search(whole):
            return np.zeros((0, 2), np.int64)
        found, at = [], 0
        while match := self.added.search(whole, at):
            doc = int(np.searchsorted(offsets, match.start(), side="right")) - 1
            begin, end = int(offsets[doc]), int(offsets[doc + 1])
            # No token crosses texts: the search is in this text alone.
            own = [m.span() for m in self.added.finditer(whole, max(at, begin), end)]
            found += own if self.plain or not own else [(begin, end)]
            at = end
        return np.array(found, np.int64).reshape(-1, 2)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of the texts in them."""
        starts = piece_starts(data, offsets, self._spans(data, offsets))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        bounds = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))
        )
        ids, ends, place = self._places(pieces)
        # Each piece's ids are one binary value, so that Arrow copies them piece by piece.
        coded = pa.BinaryArray.from_buffers(
            pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids)]
        ).take(pa.array(place))
        _, ends, flat = coded.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(starts) + 1] // 4
        return np.frombuffer(flat, np.uint32)[: ends[-1]], ends[np.searchsorted(starts, offsets)].astype(np.int64)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    n = len(offsets) - 1
    out = np.empty(len(ids) + n, np.uint32)
    at = offsets[1:] + np.arange(n)
    mask = np.ones(len(out), bool)
    mask[at] = False
    out[at] = end_id
    out[mask] = ids
    return out, offsets + np.arange(n + 1)
