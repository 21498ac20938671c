"""Token ids of texts by a public tokenizer file, encoded by the tokenizers library.

For byte-level BPE files the library encodes distinct pre-tokens and the ids are joined, which gives the same ids as encoding whole
texts: BPE never crosses a pre-token. Pre-tokens are encoded many to a call: those that begin with a space follow each other, the
others are put on lines of their own, and the library's pre-tokenizer parts them again. A worker remembers those used lately, in arrays, up to
a bound in bytes. Other files, texts with characters outside the blocks that the splitting pattern below covers, and texts
with the content of an added token that counts, go to the library whole.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import parts_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of pre-tokens and their ids that a worker remembers, about.
CACHE_BYTES = 40 << 20
#: What an entry takes besides its characters and ids: hash, number, where both begin and end, and when it was last used.
ENTRY_BYTES = 44
#: Pre-tokens in one call of the library.
AT_ONCE = 2000
#: Characters of texts whose pre-tokens are looked up together.
GROUP_CHARS = 500_000
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))
#: Pre-tokens end before white space that follows anything else, so texts can be cut there.
_GAP = re.compile(r"(?<=\S)\s")
#: Characters up to here have had stable categories for long; texts beyond are encoded whole.
COVERED = 0x530


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Classes of characters that the splitting pattern tells apart.
OTHER, LETTER, NUMBER, SPACE, BETWEEN = range(5)
#: Stands between texts that are split together; texts that hold it are encoded whole.
SEPARATOR = "\x1c"


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each covered character, by its general category."""
    of = np.zeros(COVERED, np.uint8)
    for i in range(COVERED):
        of[i] = SPACE if re.match(r"\s", chr(i)) else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(i))[0], OTHER)
    of[ord(SEPARATOR)] = BETWEEN
    return of


def pre_tokens(codes: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts (as code points, SEPARATOR between them, as a token of its own) start: what the pattern of byte-level BPE matches, that is
    's, 't, 're, 've, 'm, 'll, 'd, or a run of letters, numbers or other characters with a space before it, or white space but for that space."""
    kind = _classes()[codes]
    start = np.concatenate([[True], kind[1:] != kind[:-1]])
    # White space before other characters gives its last one away: a space to what follows, anything else to itself.
    after = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] < SPACE)) + 1
    start[after - 1] = True
    start[after[codes[after - 1] == 0x20]] = False
    # An apostrophe by itself takes certain letters with it.
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    mark = np.flatnonzero((codes == 0x27) & start)
    one, two = padded[mark + 1], padded[mark + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.isin(one.astype(np.int64) << 16 | two, [ord(c) << 16 | ord(d) for c, d in ("re", "ve", "ll")])
    for held, size in ((mark[short], 2), (mark[long], 3)):
        start[held + 1] = False
        start[(held + size)[held + size < len(start)]] = True
    return np.flatnonzero(start)


def _apart(joined: str, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pre-token comes first, and which one each is, by their characters: for groups in which two different ones have the same hash."""
    number: dict[str, int] = {}
    which = np.fromiter((number.setdefault(joined[a : a + n], len(number)) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)), np.int64, len(starts))
    return np.unique(which, return_index=True)[1], which


class _Growing:
    """An array that takes more values at its end."""

    def __init__(self, dtype):
        self.all, self.n = np.zeros(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.all):
            self.all = np.concatenate([self.all[: self.n], np.zeros(need - self.n + need // 4, self.all.dtype)])
        self.all[self.n : need] = values
        self.n = need


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at starts, one after the other."""
    upto = np.cumsum(lengths)
    return np.repeat(starts - (upto - lengths), lengths) + np.arange(upto[-1] if len(upto) else 0)


class _Words:
    """Pre-tokens and their ids, found by hash and compared in full; all is held in arrays, so that many fit in few bytes.

    Beyond `limit` bytes, what has not been used since that happened last is forgotten (or all, if that would not halve it).
    """

    def __init__(self, tokenizer, limit: int | None = None):
        self.limit, self.clock, self.since = limit or CACHE_BYTES, 0, 0
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        size = max(vocabulary.values(), default=0) + 1
        self.spaced = np.zeros(size, bool)  # tokens that begin with a space
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        newline = tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None
        self.empty()

    def empty(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted by hash
        self.chars, self.ids = _Growing(np.uint16), _Growing("<u4")  # covered characters are below 2^16
        self.char_at, self.chars_n, self.id_at, self.ids_n, self.used = _Growing(np.int64), _Growing(np.int32), _Growing(np.int64), _Growing(np.int32), _Growing(np.int32)

    @property
    def held(self) -> int:
        return ENTRY_BYTES * len(self.hashes) + 2 * self.chars.n + 4 * self.ids.n

    def forget(self) -> None:
        keep = np.flatnonzero(self.used.all[: self.used.n] > self.since)
        chars_n, ids_n, used = self.chars_n.all[keep], self.ids_n.all[keep], self.used.all[keep]
        chars = self.chars.all[_ragged(self.char_at.all[keep], chars_n)]
        ids = self.ids.all[_ragged(self.id_at.all[keep], ids_n)]
        place = np.full(self.used.n, -1, np.int32)
        place[keep] = np.arange(len(keep), dtype=np.int32)
        numbers = place[self.numbers]
        hashes, numbers = self.hashes[numbers >= 0], numbers[numbers >= 0]
        self.empty()
        self.since = self.clock
        if ENTRY_BYTES * len(keep) + 2 * len(chars) + 4 * len(ids) <= self.limit // 2:
            self.hashes, self.numbers = hashes, numbers
            for to, values in ((self.chars, chars), (self.ids, ids), (self.char_at, np.cumsum(chars_n) - chars_n), (self.chars_n, chars_n), (self.id_at, np.cumsum(ids_n) - ids_n), (self.ids_n, ids_n), (self.used, used)):
                to.add(values)

    def look_up(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, text: str) -> np.ndarray | None:
        """The numbers of distinct pre-tokens (sorted hashes, and where each lies in codes and text); None if a known one has the hash of another."""
        if self.held > self.limit:
            self.forget()
        self.clock += 1
        at = np.searchsorted(self.hashes, hashes)
        hit = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        hit[inside] = self.hashes[at[inside]] == hashes[inside]
        numbers = np.zeros(len(hashes), np.int32)
        numbers[hit] = self.numbers[at[hit]]
        known, places = numbers[hit], starts[hit]
        if (self.chars_n.all[known] != lengths[hit]).any():
            return None
        if (self.chars.all[_ragged(self.char_at.all[known], lengths[hit])] != codes[_ragged(places, lengths[hit])]).any():
            return None
        new = np.flatnonzero(~hit)
        if len(new):
            numbers[new] = np.arange(self.used.n, self.used.n + len(new), dtype=np.int32)
            words = [text[a : a + n] for a, n in zip(starts[new].tolist(), lengths[new].tolist(), strict=True)]
            made = self.made(words)
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
            self.char_at.add(self.chars.n + np.cumsum(lengths[new], dtype=np.int64) - lengths[new])
            self.chars_n.add(lengths[new])
            self.chars.add(codes[_ragged(starts[new], lengths[new])])
            self.id_at.add(self.ids.n + np.cumsum(sizes) - sizes)
            self.ids_n.add(sizes)
            self.ids.add(np.frombuffer(b"".join(made), "<u4"))
            self.used.add(np.zeros(len(new), np.int32))
            self.hashes, self.numbers = np.insert(self.hashes, at[new], hashes[new]), np.insert(self.numbers, at[new], numbers[new])
        self.used.all[numbers] = self.clock
        return numbers

    def made(self, words: list[str]) -> list[bytes]:
        """The ids of each of distinct pre-tokens; a separator has none."""
        found = self.make([w for w in words if w[0] != SEPARATOR])
        return list(map(found.get, words, itertools.repeat(b"")))

    def make(self, words: list[str]) -> dict[str, bytes]:
        """Pre-tokens and their ids."""
        kinds: tuple[list[str], list[str], list[str]] = ([], [], [])
        for word in words:
            kinds[2 if word[-1].isspace() or self.newline is None else 0 if word[0] == " " else 1].append(word)
        found = {w: _packed(e.ids) for w, e in zip(kinds[2], self.tokenizer.encode_batch_fast(kinds[2], add_special_tokens=False), strict=True)}
        for kind, mark in ((0, ""), (1, "\n")):
            for some in itertools.batched(kinds[kind], AT_ONCE):
                ids = np.array(self.tokenizer.encode_batch_fast([mark + mark.join(some)], add_special_tokens=False)[0].ids, "<u4")
                starts = np.flatnonzero(self.spaced[ids]) if kind == 0 else np.flatnonzero(ids == self.newline) + 1
                if len(starts) != len(some):  # parted in another way than expected: one by one
                    found.update((w, _packed(e.ids)) for w, e in zip(some, self.tokenizer.encode_batch_fast(list(some), add_special_tokens=False), strict=True))
                    continue
                ends, raw = [*(4 * (starts[1:] - kind)).tolist(), 4 * len(ids)], ids.tobytes()
                found.update(zip(some, map(raw.__getitem__, map(slice, (4 * starts).tolist(), ends)), strict=True))
        return found


class Encoder:
    """added: the content of special tokens in a text gives their ids, as the library does by default; else it is ordinary text."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        pre = self.tokenizer.pre_tokenizer
        pre = json.loads(pre.__getstate__()) if pre is not None else {}
        byte_level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.by_word = self.tokenizer.normalizer is None and type(self.tokenizer.model).__name__ == "BPE" and byte_level
        known = self.tokenizer.get_added_tokens_decoder().values()
        contents = [re.escape(t.content) for t in known if t.content and (added or not t.special)]
        self.added = re.compile("|".join(contents) or r"(?!)")
        self.words = _Words(self.tokenizer) if self.by_word else None
        self.uncovered = re.compile(f"[\x1c-\x1f{chr(COVERED)}-\U0010ffff]")  # Python counts four controls as white space, the library doesn't

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            if not self.by_word or self.uncovered.search(text) or self.added.search(text):
                out[i].append(_packed(self.tokenizer.encode(text, add_special_tokens=False).ids))
                continue
            for part in parts_of(text, gap=_GAP):
                group.append((i, part))
                size += len(part)
                if size >= GROUP_CHARS:
                    self._join(group, out)
                    group, size = [], 0
        self._join(group, out)
        return [b"".join(x) for x in out]

    def _join(self, group: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        """Add the ids of texts to out: their pre-tokens are split and told apart together, and each distinct one is looked up once."""
        joined = SEPARATOR.join(part for _, part in group)
        if not joined:
            return
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = pre_tokens(codes).astype(np.int32)
        lengths, every = np.diff(np.append(starts, len(codes))).astype(np.int32), np.arange(len(codes), dtype=np.int32)
        hashed = np.add.reduceat((codes + np.uint64(1)) * _POWERS[every - np.repeat(starts, lengths) & len(_POWERS) - 1], starts)
        distinct, first, which = np.unique(hashed ^ lengths.astype(np.uint64) << np.uint64(48), return_index=True, return_inverse=True)
        same = first[which]
        apart = bool((lengths[same] != lengths).any()) or bool((codes[every + np.repeat(starts[same] - starts, lengths)] != codes).any())
        if apart:
            first, which = _apart(joined, starts, lengths)
        numbers = None if apart else self.words.look_up(distinct, codes, starts[first], lengths[first], joined)
        if numbers is not None:
            begins, sizes, flat = self.words.id_at.all[numbers], self.words.ids_n.all[numbers], self.words.ids.all
        else:
            found = self.words.made([joined[a : a + n] for a, n in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)])
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            flat, begins = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        many = sizes[which]
        upto = np.cumsum(many)
        ids = flat[_ragged(begins[which], many)]
        # Where each text's pre-tokens, and so its ids, end.
        text_ends = np.cumsum([len(part) + 1 for _, part in group]) - 1
        cuts = np.concatenate([[0], upto])[np.searchsorted(starts, text_ends)].tolist()
        for (i, _), a, b in zip(group, [0, *cuts], cuts, strict=False):
            out[i].append(ids[a:b].tobytes())


@lru_cache(maxsize=1)
def encoder(path: str | None = None, added: bool = False) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    return Encoder(path or default_path(), added)


def encoded(texts: pa.Array, path: str | None, end_id: int, at_once: int = 256, added: bool = False) -> Iterator[bytes]:
    """Yield the ids of each text with the end id, as little-endian unsigned 32-bit integers; null counts as empty."""
    coder, end = encoder(path, added), int(end_id).to_bytes(4, "little")
    for i in range(0, len(texts), at_once):
        for ids in coder.encode([t or "" for t in texts.slice(i, at_once).to_pylist()]):
            yield ids + end
