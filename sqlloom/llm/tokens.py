"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words."""

from __future__ import annotations

import re
import string
import unicodedata

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from sqlloom.llm.common import caches

#: Words in a generation of the cache. A full generation becomes the old one, the old one goes, and words
#: that are met again move on; so what is frequent stays.
CACHED_WORDS = 250_000
#: New words sent to the library in one text, parted by a special token or a space.
WORDS_A_CALL = 500

#: Characters whose lower case depends on their place or has two characters.
PLACED_CASE = re.compile("[\u0130\u03a3]")

#: Byte-level vocabularies show a byte by its Latin-1 character if that is visible, else by the next
#: of the characters from 256 on.
_hidden = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
SHOWN = np.arange(256, dtype="<u4")
SHOWN[_hidden] = 256 + np.arange(len(_hidden))
SHOWN[ord(" ")] = ord(" ")  # parts words

#: Kinds of bytes. The first part words; words are parted too where the second meet the third.
BLANK, LETTER, PLAIN = 1, 2, 4

_encoders: dict[str, WordEncoder] = {}


def id_type(vocabulary: int) -> np.dtype:
    """Two little-endian bytes an id where they hold the vocabulary, else four."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def encoder(path: str) -> WordEncoder:
    """One encoder a worker and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    """``tokenizers`` over the words between spaces and line feeds, parted once more where a letter a-z
    meets an ASCII mark or digit.

    For lower-casing tokenizers whose pre-tokenizer drops white space, never joins characters across
    it and parts letters from marks and digits (but for an apostrophe's), so the ids of a text are those
    of its words one after the other (checked against the library's ids of whole texts in the tests).
    The words of a batch of texts are numbered by Arrow, and only each distinct one is looked up. Those
    that are not cached are sent to the library: words of letters to its model, which is what they come
    to after the pre-tokenizer, others through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = id_type(size)
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.mark_id = next(((t.content.encode(), i) for i, t in special.items() if t.special), (b"", -1))
        #: Marks and digits next to which a word is parted: none that a special token is made of.
        self.plain = "".join({*string.punctuation, *string.digits} - {"'"} - {c for t in special.values() for c in t.content}).encode()
        self.kinds = np.zeros(256, np.uint8)
        for kind, characters in ((BLANK, b" \n"), (LETTER, string.ascii_lowercase.encode()), (PLAIN, self.plain)):
            self.kinds[list(characters)] = kind
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = CharDelimiterSplit(" ")
        #: Ids that end a word.
        self.last = np.zeros(size, bool)
        if suffix := self.tokenizer.model.end_of_word_suffix:
            self.last[[i for token, i in self.model.get_vocab().items() if token.endswith(suffix)]] = True
        caches.append(self)
        self.forget()

    def forget(self) -> None:
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Raw ids of each text; null counts as empty."""
        return self.records(texts).to_pylist()

    def records(self, texts: list[str | None], end: bytes = b"") -> pa.LargeBinaryArray:
        """Raw ids of each text and ``end`` behind them; null counts as empty."""
        words, stops = self._words([self._lowered(text).encode() if text else b"" for text in texts])
        numbered = words.dictionary_encode()
        known = self._known(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        # The end of a text is one more word.
        at = np.insert(numbered.indices.to_numpy(zero_copy_only=False), stops, len(known))
        ids = pa.array([*known, end], pa.large_binary()).take(pa.array(at))
        _, offsets, data = ids.buffers()
        bounds = np.frombuffer(offsets, np.int64)[np.append(0, stops + np.arange(1, len(stops) + 1))]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), data or pa.py_buffer(b"")])

    def _words(self, texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Words of all texts, one after the other, and how many there are up to the end of each text."""
        raw = np.frombuffer(b"".join(x for text in texts for x in (text, b" ")), np.uint8)
        kinds = self.kinds[raw]
        blank = kinds == BLANK
        edge = blank.copy()  # a word ends in front of this byte
        edge[1:] |= (kinds[1:] | kinds[:-1]) == (LETTER | PLAIN)
        at = np.flatnonzero(edge)
        dropped = blank[at]
        offsets = np.zeros(len(at) + 1, np.int64)
        offsets[1:] = at - np.cumsum(dropped) + dropped
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~blank])])
        stops = np.cumsum(np.array([len(text) + 1 for text in texts], np.int64)) - 1
        return words, np.searchsorted(at, stops, "right")

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Raw ids of distinct words."""
        if len(self.cache) > CACHED_WORDS:
            self.old, self.cache = self.cache, {}
        cache, old, letters, others, parted = self.cache, self.old, {}, {}, []
        known = [*map(cache.get, words)]
        new = [i for i, ids in enumerate(known) if ids is None]
        for word in map(words.__getitem__, new):
            if word in old:
                cache[word] = old[word]
            elif _is_letters(word):
                letters[word] = None
            elif _is_letters(stem := word.rstrip(self.plain)):
                parted.append((word, stem, word[len(stem) :]))
                letters[stem] = others[word[len(stem) :]] = None
            else:
                others[word] = None
        some = [w for w in letters if w not in cache]
        for at in range(0, len(some), WORDS_A_CALL):
            ids = np.array(self._model_ids(some[at : at + WORDS_A_CALL]), self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            self._keep(some[at : at + WORDS_A_CALL], ids, np.append(0, ends[:-1]), ends)
        some = [w for w in others if w not in cache and self.mark and self.mark not in w]
        for at in range(0, len(some), WORDS_A_CALL):
            ids = np.array(self._ids(self.mark.join(some[at : at + WORDS_A_CALL])), self.dtype)
            marks = np.flatnonzero(ids == self.mark_id)
            self._keep(some[at : at + WORDS_A_CALL], ids, np.append(0, marks + 1), np.append(marks, len(ids)))
        for word in (*letters, *others):
            if word not in cache:  # holds the mark itself, or can't be told apart
                cache[word] = np.array(self._ids(word), self.dtype).tobytes()
        for word, stem, tail in parted:
            cache[word] = cache[stem] + cache[tail]
        for i in new:
            known[i] = cache[words[i]]
        return known

    def _keep(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Cache the words of one call by where their ids lie, if each has its place."""
        if len(ends) == len(words):
            raw, size = ids.tobytes(), self.dtype.itemsize
            places = zip((starts * size).tolist(), (ends * size).tolist())
            self.cache.update((word, raw[a:b]) for word, (a, b) in zip(words, places))

    def _lowered(self, text: str) -> str:
        """Lower case where that is what the tokenizer makes of each character by itself; a text that
        may hold a special token stays as it is."""
        return text if "<|" in text or not text.isascii() and PLACED_CASE.search(text) else text.lower()

    def _model_ids(self, words: list[bytes]) -> list[int]:
        """Ids of pre-tokens, by the library's model over their bytes."""
        text = b" ".join(words)
        shown = text.decode() if text.isascii() else SHOWN[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le")
        return self.model.encode(shown, add_special_tokens=False).ids

    def _ids(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids


def _is_letters(word: bytes) -> bool:
    """Whether a word is one pre-token that the tokenizer's normalizer leaves alone."""
    if word.isascii():
        return word.isalpha() and word.islower()
    text = word.decode()
    return text.isalpha() and unicodedata.is_normalized("NFC", text) and text == text.lower()
