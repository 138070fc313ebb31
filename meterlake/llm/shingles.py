"""Word shingles of texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from meterlake.llm.text import Texts, codes_of, mix64, slice_hashes

SIZE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: Texts, size: int = SIZE, rank=None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document, ascending, and their offsets.
    ``rank`` maps the hashes one to one to what they are replaced and ordered by.

    Words are runs of bytes that are not ASCII white space, with A-Z lowered.
    A document with fewer words than a shingle has its whole sequence as one;
    one without words has none. A hash depends on the words alone.
    """
    texts.lower_ascii()
    starts, lengths = texts.words()
    ends = texts.per_doc(starts)
    n_words = np.diff(ends)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    codes, first = codes_of(texts.data, starts, lengths)
    word = slice_hashes(texts.data, starts[first], lengths[first])[codes]
    doc = np.repeat(np.arange(len(texts)), n_words)
    left = np.repeat(ends[1:], n_words) - np.arange(len(word))  # words from here to the end
    whole = np.flatnonzero((left >= size) | ((np.arange(len(word)) == ends[:-1][doc]) & (n_words[doc] < size)))
    count = np.minimum(left[whole], size)
    hashed = mix64(count.astype(np.uint64))
    for k in range(size):
        at = np.minimum(whole + k, len(word) - 1)
        hashed = np.where(k < count, mix64(hashed * _STEP + word[at]), hashed)
    owner = doc[whole]
    hashed = hashed if rank is None else rank(hashed)
    order = np.argsort(hashed)
    if len(texts) <= 1 << 16:
        order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(owner[order], kind="stable")]
    owner, hashed = owner[order], hashed[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(texts)))])
