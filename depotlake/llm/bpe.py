"""Byte-level BPE encoding and decoding.

A text is cut at the special tokens, each part is cut into words by the pre-tokenizer's pattern, and each word
becomes ids: one array holds the parts of the word, a second one the merge rank of every two neighbours. The
smallest rank is found by a scan, its boundary is deleted and the two ranks beside it are looked up again. Words
beyond ``LONG_WORD`` bytes take the same merges in the same order from a heap, as scans would be quadratic there.

Defined results: a NULL or empty text has no ids; NULL ids decode to the empty text; ids that the vocabulary
does not have are skipped; bytes that are no UTF-8 decode to U+FFFD. Repeated rows are encoded alike.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_WORD = 256
#: Bytes of words and ids that a generation of known words may take, with ``WORD_BYTES`` for each entry's own objects.
CACHED_BYTES = 24 << 20
WORD_BYTES = 200
NO_RANK = (1 << 31) - 1
BLOCK_CHARS = 1 << 20

# Fixed: the pre-tokenizer's pattern of byte-level BPE vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that a vocabulary file writes for each byte: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (byte for byte in range(256) if byte not in printable)
    letters = {chr(byte): byte for byte in printable}
    return letters | {chr(256 + k): byte for k, byte in enumerate(others)}


def _content(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def token_bytes(content: dict) -> dict[int, bytes]:
    """The bytes that each id stands for: all that decoding needs of a vocabulary file."""
    letters = byte_letters()
    table = {number: bytes(letters[c] for c in token) for token, number in content["model"]["vocab"].items()}
    return table | {token["id"]: token["content"].encode() for token in content["added_tokens"]}


class Vocabulary:
    """Ids, merge ranks and special tokens of one vocabulary file: all that encoding needs."""

    def __init__(self, path: str, content: dict | None = None):
        content = content or _content(path)
        letters = byte_letters()
        ids = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.of_byte = [0] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = ids[letter]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(content["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.merged.append(ids[left + right])

        pairs = np.array(list(self.ranks), np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.pair_ranks = np.arange(len(pairs), dtype=np.int32)[order]
        self.merged_ids = np.array(self.merged, np.int32)
        self.byte_ids = np.array(self.of_byte, np.int32)

    def merge(self, word: bytes) -> list[int]:
        if len(word) > LONG_WORD:
            return self._merge_long([self.of_byte[byte] for byte in word])
        return np.frombuffer(self.merge_all([word])[0], np.int32).tolist()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of neighbours; ``NO_RANK`` for what does not merge."""
        if not len(self.pairs):
            return np.full(left.shape, NO_RANK, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], NO_RANK).astype(np.int32)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids as little-endian int32 of short words, all words of one length at a time.

        Each row of ``parts`` is a word and each row of ``ranks`` its rank array. A step scans every row for its
        least rank, deletes that boundary and looks up the ranks on both sides; rows without any rank are done.
        As each step takes one boundary from each row left, all of them keep the same number of parts.
        """
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_length.setdefault(len(word), []).append(k)
        for length, places in by_length.items():
            if not length:
                continue
            letters = np.frombuffer(b"".join(words[k] for k in places), np.uint8).reshape(-1, length)
            parts, rows = self.byte_ids[letters], np.array(places)
            ranks = self._rank(parts[:, :-1], parts[:, 1:])
            while True:
                at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
                every = np.arange(len(rows))
                least = ranks[every, at] if ranks.shape[1] else np.full(len(rows), NO_RANK, np.int32)
                done = least == NO_RANK
                if done.any():
                    for row, ids in zip(rows[done].tolist(), parts[done]):
                        out[row] = ids.tobytes()
                    going = ~done
                    parts, ranks, rows, at, least = parts[going], ranks[going], rows[going], at[going], least[going]
                    if not len(rows):
                        break
                    every = np.arange(len(rows))
                columns = np.arange(parts.shape[1] - 1)
                parts[every, at] = self.merged_ids[least]
                parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
                columns = columns[:-1]
                ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
                right, left = at < ranks.shape[1], at > 0
                r, c = every[right], at[right]
                ranks[r, c] = self._rank(parts[r, c], parts[r, c + 1])
                r, c = every[left], at[left]
                ranks[r, c - 1] = self._rank(parts[r, c - 1], parts[r, c])
        return out

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank_of, count = self.ranks.get, len(parts)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = [(rank, at) for at in range(count - 1)
                if (rank := rank_of(parts[at] << 32 | parts[at + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if parts[at] < 0 or right >= count or rank_of(parts[at] << 32 | parts[right]) != rank:
                continue
            parts[at], parts[right] = self.merged[rank], -1
            after[at] = following = after[right]
            if following < count:
                before[following] = at
            for left in (before[at], at):
                if left >= 0 and (near := after[left]) < count:
                    new = rank_of(parts[left] << 32 | parts[near])
                    if new is not None:
                        heapq.heappush(heap, (new, left))
        return [part for part in parts if part >= 0]


class Encoder:
    """Texts to ids as little-endian int32.

    The words of late are kept in two generations of fixed size; a word still in use moves to the young one.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0
        self.words = regex.compile(WORDS).findall
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None

    def _pieces(self, text: str) -> list[str]:
        """Words and special tokens; both are looked up alike, as no word contains a special token."""
        special = self.vocabulary.special
        if self.cut is None or not any(token in text for token in special):
            return self.words(text)
        out: list[str] = []
        for part in self.cut(text):
            out.extend([part] if part in special else self.words(part))
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words; those of long words are returned only, as they are not kept."""
        vocabulary, found, new, long = self.vocabulary, {}, [], {}
        for word in words:
            known = self.old.get(word)
            if known is not None:
                found[word] = known
            elif word in vocabulary.special:
                found[word] = np.int32(vocabulary.special[word]).tobytes()
            else:
                new.append(word)
        raw = [word.encode("utf-8", "replace") for word in new]
        for word, letters in zip(new, raw):
            if len(letters) > LONG_WORD:
                long[word] = np.array(vocabulary.merge(letters), np.int32).tobytes()
        short = [(word, letters) for word, letters in zip(new, raw) if len(letters) <= LONG_WORD]
        found.update(zip([word for word, _ in short], vocabulary.merge_all([letters for _, letters in short])))
        self.young.update(found)
        self.size += sum(map(len, found)) + sum(map(len, found.values())) + WORD_BYTES * len(found)
        return long

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        if self.size >= CACHED_BYTES:
            self.old, self.young, self.size = self.young, {}, 0
        pieces = [self._pieces(text) if text else [] for text in texts]
        long, young = self._learn(set().union(*pieces).difference(self.young)), self.young
        return [b"".join([young[word] if word in young else long[word] for word in words] if long
                         else map(young.__getitem__, words)) for words in pieces]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; new words of about ``BLOCK_CHARS`` letters of texts are merged together."""
        out: list[bytes] = []
        start = size = 0
        for k, text in enumerate(texts):
            size += len(text) if text else 0
            if size >= BLOCK_CHARS:
                out.extend(self._encode(texts[start:k + 1]))
                start, size = k + 1, 0
        return out + self._encode(texts[start:])


class Loaded:
    """What a Python worker keeps of one vocabulary, each part from its first use on."""

    def __init__(self, path: str):
        self.path = path

    @functools.cached_property
    def encoder(self) -> Encoder:
        return Encoder(Vocabulary(self.path))

    @functools.cached_property
    def table(self) -> dict[int, bytes]:
        return token_bytes(_content(self.path))


_loaded: dict[str, Loaded] = {}


def _load(path: str) -> Loaded:
    """One vocabulary for each Python worker, so its words outlast a batch; another one takes its place."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Loaded(path)
    return _loaded[path]


def _ids_array(parts: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(part) // 4 for part in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _text(ids: list[int], table: dict[int, bytes]) -> str:
    try:
        joined = b"".join(map(table.__getitem__, ids))
    except KeyError:
        joined = b"".join(table.get(number, b"") for number in ids)
    return joined.decode("utf-8", "replace")


def encoded(text: Column, path: str) -> Column:
    """The ids of ``text`` as array<int>. ``path`` names the vocabulary, present on every executor."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _ids_array(_load(path).encoder.encode_all(texts.to_pylist()))

    # Marked so that the optimizer never runs it again inside an expression over its result.
    return encode.asNondeterministic()(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of an array of ids."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        table = _load(path).table
        values = (lists[k].values for k in range(len(lists)))
        return pa.array([_text(one.to_numpy(zero_copy_only=False).tolist() if one is not None else [], table)
                         for one in values], pa.string())

    return decode(ids)


def round_trip(text: Column, path: str) -> Column:
    """struct<ids: array<int>, text: string>: the ids of ``text`` and the text that these ids decode to.

    Equal to ``encoded`` and ``decoded`` after it, in one Python worker for each task instead of two.
    """

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def both(texts: pa.Array) -> pa.Array:
        known = _load(path)
        parts = known.encoder.encode_all(texts.to_pylist())
        back = [_text(np.frombuffer(part, np.int32).tolist(), known.table) for part in parts]
        return pa.StructArray.from_arrays([_ids_array(parts), pa.array(back, pa.string())], names=["ids", "text"])

    return both.asNondeterministic()(text)
