"""Hashed word features for the classifiers; they see the text alone."""

from __future__ import annotations

import re
import zlib
from collections import Counter

from .caches import Generations
from .common import parts_of

_WORD = re.compile(r"[^\W\d_]+")
#: Bytes of words and their buckets that a task remembers, about; and what Python needs for a word and for a bucket.
CACHE_BYTES, WORD_BYTES, BUCKET_BYTES = 24 << 20, 120, 40
#: A feature is dense in a text where it occurs twice, and in this share of the words.
DENSE = 0.003


class WordBuckets(Generations):
    """Lower-cased word to the buckets of itself and its leading 3 to 8 letters; only those of the features in `chosen`, if given.

    Feature b says that bucket b occurs in a text, feature b + buckets that it is dense there.
    """

    def __init__(self, buckets: int, chosen: list[int] | None = None, prefixes: tuple[int, ...] = (3, 4, 5, 6, 7, 8)):
        super().__init__(CACHE_BYTES)
        self.buckets, self.prefixes = buckets, prefixes
        self.place = None if chosen is None else {f: i for i, f in enumerate(chosen)}
        self.used = None if chosen is None else {f % buckets for f in chosen}

    def weigh(self, entries: dict[str, tuple[int, ...]]) -> int:
        return WORD_BYTES * len(entries) + sum(map(len, entries)) + BUCKET_BYTES * sum(map(len, entries.values()))

    def make(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        return {w: self._buckets(w) for w in words}

    def _buckets(self, word: str) -> tuple[int, ...]:
        data = [b"w" + word.encode("utf-8", "replace"), *[b"p" + word[:n].encode("utf-8", "replace") for n in self.prefixes if len(word) >= n]]
        found = {zlib.crc32(x) % self.buckets for x in data}
        return tuple(found if self.used is None else found & self.used)

    def features(self, text: str) -> list[int]:
        """The features of a text; with `chosen`, their places there. No more than the distinct words of a long text is held."""
        words: Counter[str] = Counter()
        for part in parts_of(text):
            words.update(_WORD.findall(part.lower()))
        self.learn(words)
        counts: dict[int, int] = {}
        for word, n in words.items():
            for bucket in self.known[word]:
                counts[bucket] = counts.get(bucket, 0) + n
        least = max(2, DENSE * words.total()) if counts else 2
        found = [*counts, *[b + self.buckets for b, n in counts.items() if n >= least]]
        return found if self.place is None else [self.place[f] for f in found if f in self.place]
