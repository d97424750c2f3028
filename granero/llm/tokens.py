"""Encoding with a public tokenizer, each distinct word once per worker."""

from __future__ import annotations

import unicodedata

import numpy as np

from granero.llm.caches import held

SEPARATOR = "<|endoftext|>"
_MOST_WORDS = 1_000_000  # of the worker's memory of words; it is emptied beyond that, results don't depend on it
_NOTHING, _END = "", "\n"  # words 0 and 1: no ids, and the end of a document


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, others from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in own]
    return {byte: chr(byte) for byte in own} | {byte: chr(256 + k) for k, byte in enumerate(rest)}


class _Memory(dict):
    """Numbers for words; a new word gets the next number and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Exactly the ids ``Tokenizer.encode`` gives for whole texts, without special tokens added.

    The vocabulary's normalizer, added tokens and pre-tokenizer never look across a space or line end, so the
    ids of a text are those of its parts between them, one after another. A new part that is one lower-case
    Latin word goes straight to the vocabulary's merges; others are encoded a hundred at a time, joined by a
    special token whose id then marks the cuts.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.separator_id = self.tokenizer.token_to_id(SEPARATOR)
        self.end_id = end_id
        self.byte_characters = _byte_characters()
        self._forget()

    def _forget(self) -> None:
        self.memory = _Memory()
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.full(1 << 16, self.end_id, np.uint32), 1
        self.memory[_NOTHING], self.memory[_END] = 0, 1
        self.sizes[1] = 1

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word_ids(self, word: str) -> list[int] | None:
        """Ids of a word that is one pre-token and its own normal form, else None."""
        if not word.isalpha():
            return None
        if not word.isascii():
            if max(word) >= "ɐ" or not unicodedata.is_normalized("NFC", word):
                return None
            if word.lower() != word:
                return None
            word = word.encode().decode("latin-1").translate(self.byte_characters)
        elif not word.islower():
            return None
        return [token.id for token in self.model.tokenize(word)]

    def _store(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        numbers = np.fromiter(map(self.memory.__getitem__, words), np.int64, len(words))
        while len(self.memory) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.sizes[numbers] = sizes
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _learn_parts(self, words: list[str]) -> None:
        """Ids of words that are not taken apart any further."""
        done: list[str] = []
        ids: list[int] = []
        sizes: list[int] = []
        mixed: list[str] = []
        for word in words:
            if (own := self._word_ids(word)) is not None:
                done.append(word)
                ids += own
                sizes.append(len(own))
            elif "<|" in word or self.separator_id is None:
                own = self._ids(word)
                done.append(word)
                ids += own
                sizes.append(len(own))
            else:
                mixed.append(word)
        self._store(done, np.array(ids, np.uint32), np.array(sizes, np.int64))
        if mixed:
            # The separator also ends each string, so that it closes every word.
            strings = (SEPARATOR.join([*mixed[k : k + 100], ""]) for k in range(0, len(mixed), 100))
            joined = np.concatenate([np.array(self._ids(string), np.uint32) for string in strings])
            cuts = np.flatnonzero(joined == self.separator_id)
            self._store(mixed, joined[joined != self.separator_id], np.diff(cuts, prepend=-1) - 1)

    def _learn(self) -> None:
        """Fill in the new words. A full stop or comma after a letter or digit is a token of its own, and ASCII case
        never counts, so most words are a known one and a known ending."""
        memory = self.memory
        words, memory.new = memory.new, []
        whole, composed, cores, tails = [], [], [], []
        special = "<|" in _END.join(words)
        for word in words:
            core, tail = word, _NOTHING
            if not (special and "<|" in word):
                if word[-1] in ".," and word[-2:-1].lower()[-1:].isalnum():
                    core, tail = word[:-1], word[-1]
                if core.isascii():
                    core = core.lower()
            if core == word:
                whole.append(word)
            else:
                composed.append(word)
                cores.append(core)
                tails.append(tail)
        for core, tail in zip(cores, tails):
            memory[core], memory[tail]  # numbers those not seen yet
        self._learn_parts(whole + memory.new)
        memory.new = []
        if composed:
            which = np.empty((len(composed), 2), np.int64)
            which[:, 0] = np.fromiter(map(memory.__getitem__, cores), np.int64, len(cores))
            which[:, 1] = np.fromiter(map(memory.__getitem__, tails), np.int64, len(tails))
            self._store(composed, self._gather(which.ravel()), self.sizes[which].sum(axis=1))

    def _gather(self, which: np.ndarray) -> np.ndarray:
        sizes = self.sizes[which]
        first = np.repeat(self.starts[which] - (np.cumsum(sizes) - sizes), sizes)
        first += np.arange(len(first))
        return self.flat[first]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and where each starts and the last one ends."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if len(self.memory) > _MOST_WORDS:
            self._forget()
        words: list[str] = []
        ends = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                words += text.replace(_END, " ").split(" ")
            words.append(_END)
            ends[k] = len(words)
        which = np.fromiter(map(self.memory.__getitem__, words), np.int64, len(words))
        if self.memory.new:
            self._learn()
        return self._gather(which), np.concatenate(([0], np.cumsum(self.sizes[which])[ends - 1]))


def encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder per worker process, kept between tasks."""
    return held(("tokens", path, end_id), lambda: WordEncoder(path, end_id))
