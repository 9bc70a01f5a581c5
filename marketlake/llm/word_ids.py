"""Token ids of whole texts through a tokenizer that ends words, one look-up per word.

Words between ASCII white space are encoded once per Python worker and looked up afterwards. This
gives the ids of encoding whole texts, as the tokenizer drops white space and lower-cases before it
splits words. Its special tokens are matched in the untouched text, so a text that holds one, in any
case, is encoded whole.
"""

from __future__ import annotations

import string
from codecs import charmap_decode
from collections.abc import Sequence
from itertools import repeat
from operator import is_

import numpy as np

#: Words that a worker holds; as many older ones wait to be asked for again before they go.
HELD_WORDS = 250_000
#: Words beyond the head that have numbers in a worker.
HELD_NUMBERS = 200_000

#: Letters up to here in Unicode stand alone: nothing composes with them within a word.
LATIN_END = "ɐ"
SIGNS = string.punctuation.encode()


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as its Latin-1 sign if that is visible, and the others
    in order from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 0x100 + k for k, b in enumerate(hidden)}


def simple(letters: str) -> bool:
    return letters.isalpha() and (letters.isascii() or max(letters) < LATIN_END)


class _Held(dict):
    """Ids by word. What is not there comes from the older words or is learnt."""

    def __init__(self, owner: WordIds, older: dict[bytes, bytes]):
        super().__init__()
        self.owner, self.older = owner, older

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.owner.learn(word)
        self[word] = ids
        return ids


class WordIds:
    """The ids of texts as bytes, 4 an id, little-endian."""

    def __init__(self, tokenizer_path: str, held_words: int = HELD_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.letters = "".join(chr(letter) for _, letter in sorted(_byte_letters().items()))
        self.held_words = held_words
        ids = self.tokenizer.get_vocab()
        self.four_bytes = [k.to_bytes(4, "little") for k in range(max(ids.values()) + 1)]
        self.ends_word = np.zeros(max(ids.values()) + 1, bool)
        self.ends_word[[k for token, k in ids.items() if token.endswith("</w>")]] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.lower() for token in added]
        if not all(token.startswith("<|") for token in self.special):
            raise ValueError("special tokens are looked for by their first signs")
        self.held = _Held(self, {})

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encode_split(t, t.encode("utf-8", "replace").lower().split()) for t in texts]

    def holds_special(self, text: str) -> bool:
        return "<|" in text and any(token in text.lower() for token in self.special)

    def encode_split(self, text: str, words: list[bytes]) -> bytes:
        """The same for a text whose words, in lower case (A-Z), are known."""
        if self.holds_special(text):
            return self.whole(text)
        ids = b"".join(map(self.held.__getitem__, words))
        if len(self.held) > self.held_words:
            self.held = _Held(self, dict(self.held))
        return ids

    def learn(self, word: bytes) -> bytes:
        """Letters, then signs, are pieces of their own; any other word is encoded as a text."""
        text = word.decode("utf-8")
        lower = text.lower()
        letters = lower.rstrip(string.punctuation)
        if not simple(letters):
            return self.whole(text)
        if signs := lower[len(letters) :]:
            return self.held[letters.encode()] + self.held[signs.encode()]
        ids = self.four_bytes
        return b"".join([ids[token.id] for token in self.model.tokenize(self.spelt(letters))])

    def spelt(self, letters: str) -> str:
        return letters if letters.isascii() else charmap_decode(letters.encode(), "strict", self.letters)[0]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


class WordNumbers(dict):
    """Numbers of words: those of ``head`` by their place there, others as they are met.

    ``words`` and ``ids`` (as bytes, 2 an id) are lists by number. Words beyond the head that were
    met once go when there are too many.
    """

    def __init__(self, encoder: WordIds, head: Sequence[bytes], held_words: int = HELD_NUMBERS):
        super().__init__()
        self.encoder, self.held_words, self.tokenize = encoder, held_words, encoder.model.tokenize
        self.two_bytes = [ids[:2] for ids in encoder.four_bytes]
        self.head = {word: number for number, word in enumerate(head)}
        self.words: list[bytes] = list(head)
        # Words of the head are learnt when they are met.
        self.ids: list[bytes] = [b""] * len(self.words)
        self.times = np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        ids = self._learn(word)
        number = self.head.get(word)
        if number is None:
            number = len(self.words)
            self.words.append(word)
            self.ids.append(ids)
        else:
            self.ids[number] = ids
        self[word] = number
        return number

    def _learn(self, word: bytes) -> bytes:
        """As ``WordIds.learn``, but parts of words get numbers too."""
        if word.isalpha() and word.islower():
            spelt = word.decode()
        else:
            letters = word.rstrip(SIGNS)
            lower = letters.decode().lower()
            if not simple(lower):
                return np.frombuffer(self.encoder.learn(word), "<u4").astype("<u2").tobytes()
            if letters != word:
                return self.ids[self[letters]] + self.ids[self[word[len(letters) :]]]
            spelt = self.encoder.spelt(lower)
        two = self.two_bytes
        return b"".join([two[token.id] for token in self.tokenize(spelt)])

    def of(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words; they hold until the next ``forget``."""
        numbers = list(map(self.get, words))
        # Unknown words are learnt one after the other, which keeps the tokenizer's tables in the cache.
        for place in np.flatnonzero(np.fromiter(map(is_, numbers, repeat(None)), bool, len(words))).tolist():
            numbers[place] = self[words[place]]
        numbers = np.array(numbers, np.int64)
        times = np.bincount(numbers, minlength=len(self.words))
        times[: len(self.times)] += self.times
        self.times = times
        return numbers

    def forget(self) -> None:
        first = len(self.head)
        if len(self.words) - first <= self.held_words:
            return
        keep = (first + np.flatnonzero(self.times[first:] > 1)[: self.held_words // 2]).tolist()
        for word in self.words[first:]:
            self.pop(word, None)
        self.words[first:] = [self.words[k] for k in keep]
        self.ids[first:] = [self.ids[k] for k in keep]
        self.update(zip(self.words[first:], range(first, len(self.words)), strict=True))
        self.times = np.zeros(0, np.int64)


_ENCODERS: dict[str, WordIds] = {}


def encoder(tokenizer_path: str) -> WordIds:
    """One per Python worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = WordIds(tokenizer_path)
    return _ENCODERS[tokenizer_path]


_NUMBERS: dict[tuple[str, str], WordNumbers] = {}


def numbers(tokenizer_path: str, key: str, head: Sequence[bytes]) -> WordNumbers:
    """One per Python worker, for the last ``head`` it was asked for, which ``key`` stands for."""
    if (tokenizer_path, key) not in _NUMBERS:
        _NUMBERS.clear()
        _NUMBERS[tokenizer_path, key] = WordNumbers(encoder(tokenizer_path), head)
    return _NUMBERS[tokenizer_path, key]


def drop_numbers() -> None:
    """Gives back the memory of this worker's ``numbers``, which later tasks do not need."""
    _NUMBERS.clear()
