"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

The pre-tokenisation pattern of the byte-level vocabularies is run as a
finite-state transducer. Each code point becomes a symbol (its class, with
the one or two code points after it already looked at), each symbol is a
function from states to states, and the state before every position comes
from an associative scan over those functions: rows of ``_ROW`` symbols are
scanned side by side, the rows' totals are scanned in the same way, and the
carried states are put in. No regular expression runs.

Equal tokens of a chunk share a code; only distinct ones are merged, once per
worker while the cache holds them.
"""

from __future__ import annotations

import base64
import json
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

from meterlake.llm.text import Texts, WordTable, codes_of, ragged, two_words

# --- classes and symbols ------------------------------------------------------

LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE = range(6)

# The code points with the Unicode property White_Space.
WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005,
    0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# The suffixes the pattern splits off after an apostrophe.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
# Letters and numbers that Unicode 16 added (first and last code point);
# the interpreter's tables end with an earlier version.
UNICODE_16_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
UNICODE_16_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, from the Unicode general category (version 16)."""
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    for kind, runs in ((LETTER, UNICODE_16_LETTERS), (NUMBER, UNICODE_16_NUMBERS)):
        for first, last in runs:
            table[first : last + 1] = kind
    table[list(WHITE_SPACE)] = SPACE
    table[0x20] = BLANK
    table[ord("'")] = QUOTE
    return table


# Symbols: what a code point does to the transducer.
_S_LETTER, _S_NUMBER, _S_OTHER, _S_SUFFIX1, _S_SUFFIX2, _S_INNER, _S_BLANK, _S_SPACE = range(8)
# Symbol of each class, before looking ahead.
_SYMBOL = np.array([_S_LETTER, _S_NUMBER, _S_OTHER, _S_SPACE, _S_BLANK, _S_OTHER], np.uint8)
_IS_SPACE = np.array([False, False, False, True, True, False])
# States: what the last code point left behind.
_FRESH, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _IN_SPACES, _AFTER_BLANK, _ONE_MORE, _TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this code point."""
    if symbol == _S_LETTER:
        if state == _TWO_MORE:
            return _ONE_MORE, False
        if state == _ONE_MORE:
            return _FRESH, False
        return _IN_LETTERS, state not in (_IN_LETTERS, _AFTER_BLANK)
    if symbol == _S_NUMBER:
        return _IN_NUMBERS, state not in (_IN_NUMBERS, _AFTER_BLANK)
    if symbol == _S_OTHER or (symbol in (_S_SUFFIX1, _S_SUFFIX2) and state in (_IN_OTHERS, _AFTER_BLANK)):
        return _IN_OTHERS, state not in (_IN_OTHERS, _AFTER_BLANK)
    if symbol == _S_SUFFIX1:
        return _ONE_MORE, True
    if symbol == _S_SUFFIX2:
        return _TWO_MORE, True
    if symbol == _S_INNER:  # white space with white space or the end after it
        return _IN_SPACES, state != _IN_SPACES
    return (_AFTER_BLANK if symbol == _S_BLANK else _FRESH), True  # the last of its run


@lru_cache(maxsize=1)
def _machine():
    """(function of each symbol, composition table, application table, start table).

    Symbols 8..15 are those of a document's first code point: they forget the
    state before. Function 0 is the identity.
    """
    functions: list[tuple[int, ...]] = [tuple(range(8))]
    starts = np.zeros((8, 16), bool)
    of_symbol = np.zeros(16, np.uint8)
    for symbol in range(16):
        steps = [_step(_FRESH if symbol >= 8 else state, symbol % 8) for state in range(8)]
        starts[:, symbol] = [True if symbol >= 8 else s[1] for s in steps]
        f = tuple(s[0] for s in steps)
        if f not in functions:
            functions.append(f)
        of_symbol[symbol] = functions.index(f)
    grown = 0
    while grown < len(functions):  # close the set under composition
        f = functions[grown]
        for g in list(functions):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in functions:
                    functions.append(h)
        grown += 1
    m = len(functions)
    index = {f: i for i, f in enumerate(functions)}
    compose = np.array([[index[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint8)
    return of_symbol, compose.reshape(-1), m, np.array(functions, np.uint8).reshape(-1), starts.reshape(-1)


_ROW = 64


def _states_before(functions: np.ndarray) -> np.ndarray:
    """State before each position: blocked associative scan of the functions."""
    _, compose, m, apply, _ = _machine()
    n = len(functions)
    if n <= _ROW:
        out, state = np.empty(n, np.uint8), _FRESH
        for i, f in enumerate(functions.tolist()):
            out[i] = state
            state = apply[f * 8 + state]
        return out
    rows = -(-n // _ROW)
    grid = np.zeros((_ROW, rows), np.uint8)  # one column per row of symbols
    flat = np.zeros(rows * _ROW, np.uint8)
    flat[:n] = functions
    grid[:] = flat.reshape(rows, _ROW).T
    prefix = np.empty_like(grid)  # composition of the row's functions before each position
    prefix[0] = 0
    wide = np.empty(rows, np.uint16)
    for j in range(1, _ROW):
        np.multiply(prefix[j - 1], np.uint16(m), out=wide, dtype=np.uint16)
        wide += grid[j - 1]
        prefix[j] = compose[wide]
    total = compose[prefix[-1].astype(np.uint16) * np.uint16(m) + grid[-1]]
    carried = _states_before(total)
    states = apply[prefix.astype(np.uint16) * np.uint16(8) + carried]
    return states.T.reshape(-1)[:n]


def token_starts(cps: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Positions (in code points) at which a token starts, in all documents."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    of_symbol, _, _, _, starts = _machine()
    kind = np.take(class_table(), cps)
    space = _IS_SPACE[kind]
    first = np.unique(docs[:-1][docs[:-1] < docs[1:]])
    inner = np.empty(n, bool)
    inner[:-1] = space[1:]
    inner[docs[1:][docs[1:] > docs[:-1]] - 1] = True
    symbols = _SYMBOL[kind]
    symbols[space & inner] = _S_INNER
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        end = docs[np.searchsorted(docs, quotes, side="right")]
        one, two = np.minimum(quotes + 1, n - 1), np.minimum(quotes + 2, n - 1)
        for suffix in SUFFIXES:
            hit = (quotes + len(suffix) < end) & (cps[one] == ord(suffix[0]))
            if len(suffix) == 2:
                hit &= cps[two] == ord(suffix[1])
            symbols[quotes[hit]] = _S_SUFFIX1 if len(suffix) == 1 else _S_SUFFIX2
    symbols[first] += 8
    states = _states_before(of_symbol[symbols])
    return np.flatnonzero(starts[states.astype(np.uint16) * np.uint16(16) + symbols])


def token_slices(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and lengths of all pre-tokens, and their offsets by document."""
    cps, at, docs = texts.codepoints()
    begin = token_starts(cps, docs)
    starts = at[begin]
    lengths = np.diff(np.append(starts, texts.size))
    return starts, lengths, texts.per_doc(starts)


NO_PAIR = 1 << 60

# --- vocabularies ---------------------------------------------------------------


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins for bytes in JSON vocabularies: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ranks:
    """Merges of a vocabulary. ``pair``: left id << 20 | right id -> rank << 20 | new id;
    ``single``: id of each byte; ``tokens``: bytes of each id; ``special``: added tokens."""

    def __init__(self, tokens: dict[int, bytes], pair: dict[int, int], special: dict[bytes, int]):
        self.tokens, self.pair, self.special = tokens, pair, special
        by_bytes = {t: i for i, t in tokens.items()}
        self.single = [by_bytes[bytes([b])] for b in range(256)]
        # The same pairs as an open-addressing table for whole arrays.
        self._bits = max(10, int(np.ceil(np.log2(max(1, len(pair)) * 8))))
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._values = np.full(1 << self._bits, NO_PAIR, np.int64)
        keys = np.fromiter(pair.keys(), np.int64, len(pair))
        values = np.fromiter(pair.values(), np.int64, len(pair))
        slot = self._slot(keys)
        while len(keys):
            empty = self._keys[slot] < 0
            self._keys[slot[empty]] = keys[empty]  # of several in one slot the last one stays
            mine = self._keys[slot] == keys
            self._values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & (len(self._keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 20 | new id of each pair, ``NO_PAIR`` where it does not merge."""
        keys = (left.astype(np.int64) << 20) | right
        slot = self._slot(keys)
        there = self._keys[slot]
        out = np.where(there == keys, self._values[slot], NO_PAIR)
        more = np.nonzero((there != keys) & (there >= 0))
        while len(more[0]):
            slot[more] = (slot[more] + 1) & (len(self._keys) - 1)
            there = self._keys[slot[more]]
            hit = there == keys[more]
            found = tuple(x[hit] for x in more)
            out[found] = self._values[slot[found]]
            more = tuple(x[~hit & (there >= 0)] for x in more)
        return out


def load_tiktoken(raw: bytes) -> Ranks:
    """Rank file: a pair merges if its joined bytes are a token; rank = id.

    Every split of a token into two tokens is a pair that may merge."""
    ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
    pair = {}
    for token, i in ids.items():
        for k in range(1, len(token)):
            if token[:k] in ids and token[k:] in ids:
                pair[ids[token[:k]] << 20 | ids[token[k:]]] = i << 20 | i
    return Ranks({i: t for t, i in ids.items()}, pair, {})


def load_json(raw: bytes) -> Ranks:
    """Tokenizer file: the listed merges in their order, and its added tokens."""
    spec = json.loads(raw)
    stand_in = byte_symbols()
    ids = spec["model"]["vocab"]
    pair: dict[int, int] = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        pair.setdefault(ids[left] << 20 | ids[right], rank << 20 | ids[left + right])
    tokens = {i: bytes(stand_in[c] for c in t) for t, i in ids.items()
              if all(c in stand_in for c in t)}
    special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", []) if t["content"]}
    return Ranks(tokens, pair, special)


def merge_heap(ranks: Ranks, piece: bytes) -> tuple[int, list[int]]:
    """Heap-and-linked-list merging: pop the lowest-rank adjacent pair (leftmost
    on ties), join it, push its new neighbours; O(n log n) for any length.

    Returns the number of merges and the symbols (-1 where merged away).
    """
    get, single = ranks.pair.get, ranks.single
    symbol = [single[b] for b in piece]
    n = len(symbol)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    joined = [get(symbol[i] << 20 | symbol[i + 1]) for i in range(n - 1)]  # of the pair that starts here
    joined.append(None)
    # An entry is rank, then position: ranks are unique, so the pair's value is one to one with its rank.
    heap = [(v >> 20) << 40 | i for i, v in enumerate(joined) if v is not None]
    heapify(heap)
    merges = 0
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFFFF
        value = joined[i]
        if value is None or value >> 20 != top >> 40:
            continue  # one of the two has been merged meanwhile
        merges += 1
        j = after[i]
        new = symbol[i] = value & 0xFFFFF
        symbol[j], joined[j] = -1, None
        k = after[i] = after[j]
        value = None
        if k < n:
            before[k] = i
            value = get(new << 20 | symbol[k])
            if value is not None:
                heappush(heap, (value >> 20) << 40 | i)
        joined[i] = value
        h = before[i]
        if h >= 0:
            value = joined[h] = get(symbol[h] << 20 | new)
            if value is not None:
                heappush(heap, (value >> 20) << 40 | h)
    return merges, symbol


def merge_many(ranks: Ranks, data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many distinct tokens of ``size`` bytes at once, and their counts.

    A row per token; each turn joins every row's lowest-rank pair (leftmost
    on ties), so all rows that still merge have the same number of symbols.
    """
    symbols = np.asarray(ranks.single, np.int64)[data[starts[:, None] + np.arange(size)]]
    counts = np.full(len(starts), size, np.int64)
    out = np.zeros((len(starts), size), np.uint32)
    rows = np.arange(len(starts))
    value = ranks.lookup(symbols[:, :-1], symbols[:, 1:]) if size > 1 else np.zeros((len(starts), 0), np.int64)
    while True:
        width = symbols.shape[1]
        at = value.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
        best = value[np.arange(len(rows)), at] if width > 1 else np.full(len(rows), NO_PAIR)
        done = best == NO_PAIR
        out[rows[done], :width] = symbols[done]
        counts[rows[done]] = width
        go = ~done
        if not go.any():
            return out, counts
        symbols, value, rows, at, best = symbols[go], value[go], rows[go], at[go], best[go]
        each = np.arange(len(rows))
        symbols[each, at] = best & 0xFFFFF
        column = np.arange(width - 1)
        symbols = np.take_along_axis(symbols, column + (column > at[:, None]), axis=1)
        if width > 2:
            column = column[:-1]
            value = np.take_along_axis(value, column + (column >= at[:, None]), axis=1)
            left, right = at > 0, at < width - 2
            value[each[left], at[left] - 1] = ranks.lookup(symbols[each[left], at[left] - 1], symbols[each[left], at[left]])
            value[each[right], at[right]] = ranks.lookup(symbols[each[right], at[right]], symbols[each[right], at[right] + 1])
        else:
            value = np.zeros((len(rows), 0), np.int64)


# --- chunks of texts ---------------------------------------------------------------

CACHE_ENTRIES = 1_000_000  # distinct tokens kept per worker; emptied when full
CACHE_BYTES = 64  # longer tokens are not kept
WIDE = 32  # longer tokens are merged one at a time with the heap


class Encoder:
    """Ids of whole chunks; distinct tokens are merged once and cached.

    ``special``: also give the vocabulary's added tokens their ids where their
    text occurs (the default of the tokenizers library)."""

    def __init__(self, ranks: Ranks, special: bool = False):
        self.ranks = ranks
        self.special = ranks.special if special else {}
        size = max(ranks.tokens) + 1
        parts = [ranks.tokens.get(i, b"") for i in range(size)]
        self.token_data = np.frombuffer(b"".join(parts), np.uint8)
        self.token_len = np.array([len(p) for p in parts], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)[:-1]])
        self._empty()

    def _empty(self) -> None:
        self.table = WordTable(CACHE_ENTRIES)  # token of up to 15 bytes -> its entry in at, size
        self.cache: dict[bytes, int] = {}  # the same for longer tokens
        self.pool = np.zeros(1 << 16, np.uint32)  # ids of all entries
        self.used = 0
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.entries = 0

    def _add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries for merged tokens given one after another."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.entries + len(size) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
        self.pool[self.used : self.used + len(ids)] = ids
        new = np.arange(self.entries, self.entries + len(size))
        self.at[new] = self.used + np.concatenate([[0], np.cumsum(size)[:-1]])
        self.size[new] = size
        self.used += len(ids)
        self.entries += len(size)
        return new

    def _entries(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Pool entries of distinct tokens."""
        if self.entries + len(starts) > CACHE_ENTRIES and self.entries:
            self._empty()
        entry = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths < 16)
        low, high = two_words(data, starts[short], lengths[short])
        entry[short] = found = self.table.get(low, high)
        long = np.flatnonzero(lengths >= 16)
        body = data.tobytes() if len(long) else b""
        pieces = {r: body[s : s + k] for r, s, k in zip(long.tolist(), starts[long].tolist(), lengths[long].tolist(), strict=True)}
        for row, piece in pieces.items():
            entry[row] = self.cache.get(piece, -1)
        missing = np.flatnonzero(entry < 0)
        sizes = lengths[missing]
        for size in np.unique(sizes[sizes <= WIDE]).tolist():
            rows = missing[sizes == size]
            ids, counts = merge_many(self.ranks, data, starts[rows], size)
            entry[rows] = self._add(ids[np.arange(size) < counts[:, None]], counts)
        for row in missing[sizes > WIDE].tolist():
            ids = np.array([s for s in merge_heap(self.ranks, pieces[row])[1] if s >= 0], np.uint32)
            entry[row] = self._add(ids, np.array([len(ids)]))[0]
        new = found < 0
        if len(starts) <= CACHE_ENTRIES:
            self.table.put(low[new], high[new], entry[short[new]])
            for row in missing[(sizes >= 16) & (sizes <= CACHE_BYTES)].tolist():
                self.cache[pieces[row]] = int(entry[row])
        return entry

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after another, and their offsets by document."""
        parts = split_special(texts, self.special)
        starts, lengths, docs = token_slices(parts)
        if not len(starts):
            ids, offsets = np.zeros(0, np.uint32), np.zeros(len(docs), np.int64)
        else:
            codes, first = codes_of(parts.data, starts, lengths)
            entry = self._entries(parts.data, starts[first], lengths[first])[codes]
            size = self.size[entry]
            ids = self.pool[ragged(self.at[entry], size)]
            offsets = np.concatenate([[0], np.cumsum(size)])[docs]
        return parts.join_ids(ids, offsets) if isinstance(parts, Parts) else (ids, offsets)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all documents one after another, and their offsets."""
        size = self.token_len[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        if not len(ids):
            return np.zeros(0, np.uint8), ends[offsets]
        return self.token_data[ragged(self.token_at[ids], size)], ends[offsets]


class Parts(Texts):
    """Texts cut at special tokens: parts are encoded as documents of their own."""

    def __init__(self, texts: Texts, pieces: list[list]):
        self.pieces = pieces
        bodies = [p for doc in pieces for p in doc if isinstance(p, bytes)]
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64) if bodies else np.zeros(1, np.int64)
        self.size = int(self.offsets[-1])
        self.data = np.frombuffer(b"".join(bodies) + b"\0" * 32, np.uint8)

    def join_ids(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, ends, part = [], [0], 0
        for doc in self.pieces:
            total = 0
            for p in doc:
                if isinstance(p, bytes):
                    got = ids[offsets[part] : offsets[part + 1]]
                    part += 1
                else:
                    got = np.array([p], np.uint32)
                out.append(got)
                total += len(got)
            ends.append(ends[-1] + total)
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.array(ends, np.int64)

    def join_counts(self, counts: np.ndarray) -> np.ndarray:
        """Counts by document: those of its parts, and one per special token."""
        each = iter(counts.tolist())
        return np.array([sum(next(each) if isinstance(p, bytes) else 1 for p in doc) for doc in self.pieces], np.int64)


def split_special(texts: Texts, special: dict[bytes, int]) -> Texts:
    """The same texts if no special token occurs in them, else cut parts."""
    if not special:
        return texts
    body = texts.data[: texts.size].tobytes()
    if not any(s in body for s in special):
        return texts
    pieces = []
    for i in range(len(texts)):
        rest, doc = texts.text_bytes(i), []
        while True:  # the leftmost, and of those the longest
            hits = [(rest.find(s), -len(s), s) for s in special if s in rest]
            if not hits:
                break
            at, _, s = min(hits)
            doc += [rest[:at], special[s]]
            rest = rest[at + len(s) :]
        pieces.append([p for p in [*doc, rest] if p != b""])
    return Parts(texts, pieces)
