"""Token ids of whole texts, for use inside tasks.

A text is cut wherever a space or a line feed follows a character that is no white space.
No pattern of the vocabularies used here matches across such a place, so the ids of a text
are the ids of its pieces in a row, and a piece seen before needs no second encoding. Texts
that hold the string of an added token, such as <|endoftext|>, are encoded whole. The memory for known pieces is bounded: pieces that were not met for a while are forgotten.
"""

from __future__ import annotations

import ctypes
import os
import re
import sys
from array import array
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Known pieces per worker, of about 170 bytes each with their ids.
KNOWN_PIECES = 200_000
#: Half of the pieces that are kept for oddly spaced texts; about 250 bytes each.
KNOWN_APART = 50_000
#: Pieces of more characters are encoded each time instead of being kept.
LONGEST_KEPT = 100
#: Bytes of text treated at a time.
SLICE_BYTES = 6 << 20
#: The same while texts are encoded: in a longer slice fewer of the words are new.
ENCODED_BYTES = 12 << 20
#: White space other than single spaces and line feeds between other characters.
ODD_SPACE = (
    r"  |^[ \n]|[ \n]$| \n|\n |\n\n|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

_cut = re.compile(r"(?<=\S)(?=[ \n])").split
_other_space = re.compile(r"[^\S \n]").search
#: Letters that normalisation leaves alone, or turns into one such letter. Others may end in a combining mark,
#: which then belongs to the unit of the mark behind it.
STABLE = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_stable = re.compile(f"{STABLE}+").fullmatch
#: Signs; any run of them behind such a letter and at a piece's end is a unit of its own.
SIGN = r"[!-/:-@\[-`{-~]"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones as they are."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in kept)}
    return [others.get(b, chr(b)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class TextEncoder:
    """Encodes texts with one ``tokenizers`` vocabulary; ids come as little-endian uint32 bytes."""

    def __init__(self, path: str, known_pieces: int = KNOWN_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Their strings become their ids. In another case too: texts are made lower-case before they are cut.
        self._added = [re.escape(token.content) for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._holds_added = re.compile("|".join(self._added) or "(?!)", re.IGNORECASE).search
        self._model = self._tokenizer.model
        self._known_pieces = known_pieces
        self.forget()
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._letters = _byte_letters()
        self._high_letters = {c: "".join([self._letters[b] for b in chr(c).encode()]) for c in range(128, 256)}
        self._spaced = self._plain(" a") != self._plain("a")  # whether a space belongs to the word after it
        self._line_feed = self._whole("\n") if self._spaced else []
        self._mark = {mark: self._whole(mark) for mark in (".", ",")}
        self._lower = self._plain("A") == self._plain("a")

    def _whole(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _plain(self, text: str) -> bytes:
        return _packed(self._whole(text))

    def _one_word(self, space: str, word: str) -> list[int]:
        """A word is one unit of every vocabulary here, so its merges can be asked for directly."""
        unit = word.lower() if self._lower else word
        if not unit.isascii():
            unit = "".join([self._letters[b] for b in unit.encode()])
        if self._spaced and space:
            unit = self._letters[32] + unit
        return [t.id for t in self._model.tokenize(unit)]

    def _piece(self, piece: str) -> bytes:
        """``piece`` stands behind a space unless it begins with a line feed."""
        ids = self._known.get(piece)
        if ids is None:
            ids = self._older.get(piece)
            if ids is None:
                ids = _packed(self._learn(piece))
            if len(piece) <= LONGEST_KEPT:
                self._known[piece] = ids
        return ids

    def _learn(self, piece: str) -> list[int]:
        if piece.isalpha() and (piece.isascii() or _stable(piece)):
            return self._one_word(" ", piece)
        if piece[-1:] in self._mark and _stable(piece[-2:-1]):  # a mark behind a letter is a unit of its own
            return self._learn(piece[:-1]) + self._mark[piece[-1]]
        if piece[:1] == "\n":
            word = piece[1:]
            if not self._spaced and word and not word[0].isspace():
                return self._learn(word)  # white space is dropped
            if word.isalpha() and (word.isascii() or _stable(word)):
                return self._line_feed + self._one_word("", word)
            return self._whole(piece)
        return self._whole(" " + piece)

    def forget(self) -> None:
        """Drop the known pieces."""
        self._known, self._older = {}, {}
        self._index: dict[str, int] = {}  # known pieces of evenly spaced texts: the places of their ids
        self._store = _Store()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self._holds_added(text):
            return self._plain(text)
        if self._lower and text.isascii():
            text = text.lower()  # so that fewer pieces differ
        odd = _other_space(text) or text[0] in " \n" or text[-1] in " \n"
        if odd or any(run in text for run in ("  ", " \n", "\n ", "\n\n")):
            return b"".join(map(self._raw, _cut(text)))  # runs of white space stay in one piece
        pieces = text.replace("\n", " \n").split(" ")  # the same cuts, found faster
        if len(self._known) > KNOWN_APART:
            self._known, self._older = {}, self._known
        found = list(map(self._known.get, pieces))
        found[0] = self._plain(pieces[0])
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._piece(pieces[k])
        return b"".join(found)

    def _raw(self, chunk: str) -> bytes:
        if chunk[0] == "\n" or chunk[0] == " " and len(chunk) > 1 and not chunk[1].isspace():
            return self._piece(chunk if chunk[0] == "\n" else chunk[1:])
        return self._plain(chunk)

    def encode_all(self, texts: pa.Array) -> list[bytes | memoryview]:
        """The ids of each text of an Arrow array; NULL is empty. Equal pieces are looked up once."""
        result: list[bytes | memoryview] = [b""] * len(texts)
        odd = pc.fill_null(pc.match_substring_regex(texts, ODD_SPACE), False).to_numpy(zero_copy_only=False)
        if self._added:
            added = pc.match_substring_regex(texts, "|".join(self._added), ignore_case=True)
            odd = odd | pc.fill_null(added, False).to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(odd).tolist():
            result[row] = self.encode(texts[row].as_py())
        rows = np.flatnonzero(~odd & texts.is_valid().to_numpy(zero_copy_only=False))
        if len(rows):
            for row, ids in zip(rows.tolist(), self._evenly_spaced(texts.take(pa.array(rows)))):
                result[row] = ids
        return result

    def _evenly_spaced(self, texts: pa.Array) -> list[memoryview]:
        if self._lower:
            texts = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
        # A line feed marks its piece, unless the vocabulary drops white space anyway.
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n" if self._spaced else " "), " ")
        begins, pieces = lists.offsets.to_numpy(), lists.values
        coded = pieces.dictionary_encode()
        words, indices = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        store, places, new = self._places(coded.dictionary, words)
        kept, at = store, places[indices]
        if self._spaced:  # no space stands before the first piece
            first = [self._whole(piece) for piece in pieces.take(pa.array(begins[:-1])).to_pylist()]
            at[begins[:-1]] = np.arange(len(store.sizes), len(store.sizes) + len(first))
            store = store.with_more(first)
        sizes = store.sizes[at]
        data = memoryview(_gathered(store.ids, store.begins[at], sizes)).cast("B")
        bounds = (4 * np.append(0, np.cumsum(sizes))[begins]).tolist()
        self._remember(kept, words, places, new[np.bincount(indices, minlength=len(words))[new] > 1])
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _places(self, pieces: pa.Array, words: list[str]) -> tuple[_Store, np.ndarray, np.ndarray]:
        """Ids, where each of the different pieces stands in them, and which pieces were not known."""
        at = np.fromiter(map(self._index.get, words, repeat(-1)), np.int64, len(words))
        missing, store = np.flatnonzero(at < 0), self._store
        if len(missing):
            new = pieces.take(pa.array(missing))
            simple = pc.match_substring_regex(new, f"^{STABLE}+{SIGN}*$").to_numpy(zero_copy_only=False)
            for some, learn in ((simple, self._learn_simple), (~simple, self._learn_others)):
                at[missing[some]] = np.arange(len(store.sizes), len(store.sizes) + some.sum())
                store = learn(store, new.filter(pa.array(some)))
        return store, at, missing

    def _remember(self, store: _Store, words: list[str], places: np.ndarray, often: np.ndarray) -> None:
        """Keep new pieces that a slice has more than once; most others will not come again."""
        if len(self._index) + len(often) > self._known_pieces:
            self.forget()
        here = len(self._store.sizes)
        self._index.update(zip([words[k] for k in often.tolist()], range(here, here + len(often))))
        at = places[often]
        self._store = self._store.joined(_gathered(store.ids, store.begins[at], store.sizes[at]), store.sizes[at])

    def _learn_others(self, store: _Store, pieces: pa.Array) -> _Store:
        return store.with_more([self._learn(piece) for piece in pieces.to_pylist()])

    def _learn_simple(self, store: _Store, pieces: pa.Array) -> _Store:
        """Words of plain letters, some with signs behind them: each different word is encoded once, as one unit."""
        coded = pc.replace_substring_regex(pieces, f"{SIGN}+$", "").dictionary_encode()
        signs = pc.replace_substring_regex(pieces, f"^{STABLE}+", "").dictionary_encode()
        stems, tokenize = coded.dictionary.to_pylist(), self._model.tokenize
        if self._lower:
            stems = [stem.lower() for stem in stems]
        space = self._letters[32] if self._spaced else ""
        stems = [space + (stem if stem.isascii() else stem.translate(self._high_letters)) for stem in stems]
        found = [[t.id for t in tokenize(unit)] for unit in stems]
        own = _Store().with_more([*found, *(self._whole(run) if run else [] for run in signs.dictionary.to_pylist())])
        parts = np.stack([coded.indices.to_numpy(), signs.indices.to_numpy() + len(found)], 1)
        ids = _gathered(own.ids, own.begins[parts].ravel(), own.sizes[parts].ravel())
        return store.joined(ids, own.sizes[parts].sum(1))


@dataclass(frozen=True)
class _Store:
    """Runs of ids, one behind the other."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, "<u4"))
    begins: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def joined(self, ids: np.ndarray, sizes: np.ndarray) -> _Store:
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        return _Store(np.append(self.ids, ids), np.append(self.begins, begins), np.append(self.sizes, sizes))

    def with_more(self, runs: list[list[int]]) -> _Store:
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        return self.joined(np.fromiter(chain.from_iterable(runs), "<u4", int(sizes.sum())), sizes)


def _gathered(ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """ids[begin:begin + size] of all, one behind the other."""
    ends = np.cumsum(sizes)
    every = np.repeat(begins - (ends - sizes), sizes)
    every += np.arange(len(every))
    return ids[every]


def release() -> None:
    """Give freed memory back to the machine: a worker that is idle stays beside other stages."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``size`` bytes of its text column; a longer text is a part of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(sizes // size)) + 1).tolist(), len(sizes)]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def shared_encoder(path: str) -> TextEncoder:
    """This worker process's encoder: later tasks go on with the pieces that earlier ones met."""
    encoders = vars(sys).setdefault("_feedweave_encoders", {})
    if path not in encoders:
        encoders[path] = TextEncoder(path)
    return encoders[path]
