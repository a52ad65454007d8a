"""Byte-level BPE ids of whole texts, for the operators that encode or pack them.

A text is cut at each single space between two characters that are no white
space.  No pre-token of this vocabulary crosses such a cut, so a part can be
encoded on its own, with its leading space.  Arrow splits a block of texts and
numbers its different parts; only those are encoded, and numpy lays their ids
out again in the order of the texts.  A block is bounded in bytes; a text that
has other white space at a cut, or holds the special token, is encoded whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

BPE_NAME = "byte_bpe_50k"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
BLOCK_BYTES = 12 << 20

#: Encodes strings, each with a space before it or (False) as it is; gives all
#: their ids, one after another, and the number of each.
Encode = Callable[[pa.Array, bool], tuple[np.ndarray, np.ndarray]]
_SPACE = r"[\s\p{Z}\x1c-\x1f\x{85}]"


def ranks_path() -> str:
    return public_tokenizers.path(f"{BPE_NAME}.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES`` of text, one long text at least."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        yield start, stop
        start = stop


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each count, one after another."""
    ends = np.cumsum(counts)
    places = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        first, last = starts[full], starts[full] + counts[full] - 1
        places[0] = first[0]
        places[ends[full][:-1]] = first[1:] - last[:-1]
    return np.cumsum(places, out=places)


def encode_block(texts: pa.Array, encode: Encode) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after another, and where each text's ids end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.split_pattern(texts, " ")
    offsets = parts.offsets.to_numpy()
    first = offsets[:-1] - offsets[0]
    coded = pc.dictionary_encode(parts.flatten())
    index = coded.indices.to_numpy().astype(np.int64)
    names = coded.dictionary

    def flags(pattern: str) -> np.ndarray:
        return pc.match_substring_regex(names, pattern).to_numpy(zero_copy_only=False)

    ends_odd = flags(_SPACE + "$")
    odd = (flags("^" + _SPACE + "|^$") | ends_odd)[index]
    odd[first] = ends_odd[index[first]]
    whole = np.logical_or.reduceat(odd, first)
    whole |= pc.match_substring(texts, SPECIAL).to_numpy(zero_copy_only=False)
    used = np.zeros(len(names), bool)
    inner = np.ones(len(index), bool)
    inner[first] = False
    if whole.any():
        inner &= ~np.repeat(whole, np.diff(offsets))
    used[index[inner]] = True

    inner_ids, inner_counts = encode(names.filter(pa.array(used)), True)
    head_ids, head_counts = encode(names.take(pa.array(index[first])), False)
    ids = np.concatenate([inner_ids, head_ids])
    counts = np.zeros(len(names) + len(first), np.int64)
    counts[: len(names)][used] = inner_counts
    counts[len(names) :] = head_counts
    starts = np.cumsum(counts) - counts
    index[first] = len(names) + np.arange(len(first))
    inner[first] = True
    index = index[inner]
    each = counts[index]
    ends = np.cumsum(each)[np.cumsum(np.add.reduceat(inner, first, dtype=np.int64)) - 1]
    ids = ids[spread(starts[index], each)]
    if whole.any():
        own = np.split(ids, ends[:-1])
        for i in np.flatnonzero(whole):
            own[i] = _with_special(texts[int(i)].as_py(), encode)
        ids, ends = np.concatenate(own), np.cumsum([len(x) for x in own])
    return ids, ends


def _with_special(text: str, encode: Encode) -> np.ndarray:
    """A whole text; the special token's string gives its own id."""
    ids, counts = encode(pa.array(text.split(SPECIAL), pa.large_string()), False)
    return np.insert(ids, np.cumsum(counts)[:-1], SPECIAL_ID)


class JoinedEncoder:
    """Encodes many strings with one call of the tiktoken library.

    Parts of texts begin and end with a character that is no white space, so
    the ids of the joined text fall apart at the parts' ends.
    """

    def __init__(self, path: str):
        import tiktoken

        ranks = load_ranks(path)
        self._coder = tiktoken.Encoding(
            os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._length[rank] = len(token)

    def __call__(self, names: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """``spaced``: different parts of texts; else strings of any kind."""
        if not spaced:
            each = [np.array(self._coder.encode_ordinary(n), np.uint32) for n in names.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(x) for x in each], np.int64)
        parts = pa.LargeListArray.from_arrays([0, len(names)], names)
        text = " " + pc.binary_join(parts, pa.scalar(" ", pa.large_string()))[0].as_py()
        ids = np.array(self._coder.encode_ordinary(text if len(names) else ""), np.uint32)
        ends = np.cumsum(pc.binary_length(names).to_numpy().astype(np.int64) + 1)
        last = np.searchsorted(np.cumsum(self._length[ids]), ends)
        return ids, np.diff(last, prepend=-1)
