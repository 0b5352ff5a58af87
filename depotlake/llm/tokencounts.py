"""Token counts of texts by a public tokenizer, without keeping any token.

An Arrow function gets the texts of a record batch, cuts long ones into pieces at safe boundaries, packs the pieces
into batches of about ``BATCH_BYTES`` and lets the library encode one batch at a time; only lengths are kept, so
memory follows the size of a batch, not that of a text or of a record batch. Where a blank is a safe boundary wherever it
follows a letter, digit or sign, a piece is encoded word by word, and a word that came before is counted from memory.

A boundary is safe if the library makes the same tokens of both sides apart as of the whole:

* Byte-level BPE cuts words by its pattern before it merges. No word of the pattern goes on from a letter or a digit
  to anything of another class, nor from a sign to white space or a digit, and none looks back. A sign before a letter is no
  boundary (contractions), nor is any place inside a special token. So a piece is cut into words that take the white space
  before them along, unless it holds a special token or a blank beyond ASCII, which classes may tell otherwise.
* A sentencepiece vocabulary without pieces that hold a blank behind another letter never merges across a blank
  between two ASCII letters or digits. The blank goes, as the library puts one before each text.

A text without safe boundary is one piece. For any other kind of vocabulary texts are never cut.

Defined results: a NULL or empty text has no tokens; special strings inside a text are what the library takes them
for; bytes that are no UTF-8 count as U+FFFD each; equal texts have equal counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 18
PIECE_CHARS = 1 << 16
# Longest stretch in which one step looks for a boundary; without one the search goes on in the next stretch.
STRETCH = 4_096
# Words whose counts a worker remembers, and the longest of them; a full memory starts anew.
MAX_WORDS = 400_000
WORD_CHARS = 64

# White space before a word goes with it, as in the pattern of byte-level BPE; Latin letters end before an ASCII sign.
WORDS = re.compile(r"[ \t\n\r\x0b\x0c]*+(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f]++(?=[!-/:-@\[-`{-~])|[^ \t\n\r\x0b\x0c]++)"
                   r"|[ \t\n\r\x0b\x0c]++")
# Blanks beyond these, and letters that some classify as blanks.
ODD_BLANKS = re.compile("[%s]" % "".join(
    letter for letter in map(chr, range(sys.maxunicode + 1)) if letter not in " \t\n\r\x0b\x0c" and (
        letter.isspace() or unicodedata.category(letter) in ("Zs", "Zl", "Zp")
        or letter in "\u180e\u200b\u200c\u200d\u2060\ufeff")))


def _kind(letter: str) -> str:
    """The class that the pattern of byte-level BPE sees: letter, digit, blank or sign."""
    if letter.isascii():
        return "L" if letter.isalpha() else "N" if letter.isdigit() else "Z" if letter in " \t\n\r\x0b\x0c" else "S"
    kind = unicodedata.category(letter)[0]
    # What Unicode tables of other versions may classify otherwise is never the side of a boundary.
    return kind if kind in "LN" else "?"


def _byte_level_cut(text: str, at: int) -> bool:
    before, after = _kind(text[at - 1]), _kind(text[at])
    if before in "LN":
        return after != before and after != "?"
    return before == "S" and after in "ZN"


def _blank_cut(text: str, at: int) -> bool:
    near = text[at - 1:at + 2]
    return len(near) == 3 and near[1] == " " and near[0].isascii() and near[0].isalnum() and (
        near[2].isascii() and near[2].isalnum())


def pieces(text: str, safe: Callable[[str, int], bool] | None, special: list[str], drop: int = 0) -> Iterator[str]:
    """``text`` in pieces of ``PIECE_CHARS`` letters or more, cut at the first safe place beyond that."""
    start, at = 0, PIECE_CHARS
    reach = max(map(len, special), default=0)
    while safe is not None and at < len(text):
        end = min(at + STRETCH, len(text))
        for place in range(at, end):
            if safe(text, place):
                around = text[max(start, place - reach + 1):place + reach - 1]
                middle = place - max(start, place - reach + 1)
                if not any(_spans(around, token, middle) for token in special):
                    yield text[start:place]
                    start, end = place + drop, place + drop + PIECE_CHARS
                    break
        at = end
    yield text[start:]


def _spans(text: str, token: str, middle: int) -> bool:
    """Whether ``token`` occurs in ``text`` across the place ``middle``."""
    at = text.find(token)
    while at >= 0:
        if at < middle < at + len(token):
            return True
        at = text.find(token, at + 1)
    return False


class Counter:
    """Numbers of tokens by the library of one vocabulary file."""

    def __init__(self, path: str):
        self.safe: Callable[[str, int], bool] | None = None
        self.special: list[str] = []
        self.drop = 0
        self.known: dict[str, int] | None = None
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            known = (model.id_to_piece(k) for k in range(model.get_piece_size()))
            if not any("▁" in piece.lstrip("▁") for piece in known):
                self.safe, self.drop = _blank_cut, 1
        else:
            # One core a task: the library's own threads would take those of other tasks.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encode = lambda texts: list(map(len, model.encode_batch_fast(texts, add_special_tokens=False)))
            with open(path, encoding="utf-8") as file:
                content = json.load(file)
            words = content.get("pre_tokenizer") or {}
            added = content["added_tokens"]
            if (words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
                    and content.get("normalizer") is None and not any(
                        token["lstrip"] or token["rstrip"] or token["single_word"] for token in added)):
                self.safe, self.special = _byte_level_cut, [token["content"] for token in added]
                if not content["model"].get("dropout"):  # merges left out at random make other counts each time
                    self.known = {}

    def _encoded(self, batch: list[str]) -> list[int]:
        """The numbers of tokens of pieces."""
        if self.known is None:
            return self.encode(batch)
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        known = self.known
        cut = [None if ODD_BLANKS.search(piece) or any(token in piece for token in self.special) else WORDS.findall(piece)
               for piece in batch]
        new = list(set().union(*(words for words in cut if words)).difference(known))
        whole = [piece for piece, words in zip(batch, cut) if words is None]
        found = self.encode(new + whole)
        known.update(zip(new, found))
        rest = iter(found[len(new):])
        counts = [next(rest) if words is None else sum(map(known.__getitem__, words)) for words in cut]
        for word in new:
            if len(word) > WORD_CHARS:
                del known[word]
        return counts

    def count(self, texts: list[str | None]) -> list[int]:
        counts = [0] * len(texts)
        batch: list[str] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            for owner, number in zip(owners, self._encoded(batch)):
                counts[owner] += number
            batch.clear()
            owners.clear()

        for owner, text in enumerate(texts):
            for piece in pieces(text, self.safe, self.special, self.drop) if text else ():
                weight = len(piece) if piece.isascii() else len(piece.encode("utf-8", "replace"))
                if batch and size + weight > BATCH_BYTES:
                    flush()
                    size = 0
                batch.append(piece)
                owners.append(owner)
                size += weight
        if batch:
            flush()
        return counts


def _strings(texts: pa.Array) -> list[str | None]:
    try:
        return texts.to_pylist()
    except UnicodeDecodeError:
        return [None if raw is None else raw.decode("utf-8", "replace") for raw in texts.cast(pa.binary()).to_pylist()]


_loaded: dict[str, Counter] = {}


def n_tokens(text: Column, path: str) -> Column:
    """The number of tokens of ``text`` as long. ``path`` names a vocabulary file that every executor has."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if path not in _loaded:
            _loaded.clear()  # one vocabulary at a time in a worker
            _loaded[path] = Counter(path)
        for texts in batches:
            yield pa.array(_loaded[path].count(_strings(texts)), pa.int64())

    # Marked so that a condition on the number never makes the optimizer count twice.
    return count.asNondeterministic()(text)
