"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has one encoding, hence one last token. An automaton with suffix links over the
vocabulary lists the tokens that end at each position, longest first; the last token is the one whose start is
a prefix with a last token that is compatible with it. Two neighbouring tokens are compatible when the merges
that build them never meet an earlier merge across their border. Following the last tokens back from the end
of the word gives exactly the ids that applying the merges in order would give.

The vocabulary file's own normalizer and pre-tokenizer cut into words what is not plain
Latin text, where one pattern gives the same words. Words are encoded once and remembered: the memory has two
halves of bounded size, of which the older one goes when the younger is full, and longer words are never kept.

Defined results: a null or empty text has no ids and decodes to the empty text. Repeated rows and ids are each
encoded for themselves; a null id stays null. Strings of added tokens inside a text get their ids. Columns other
than ``doc_id`` and ``text`` (``ids`` in ``decode``) are not read. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granero.llm.caches import held
from granero.llm.texts import slices

ENCODED_SCHEMA = "doc_id long, n_tokens long, ids binary"
DECODED_SCHEMA = "doc_id long, decoded string"
LONGEST_KEPT, MOST_WORDS, MOST_PAIRS = 100, 400_000, 600_000  # bounds of the memories; results don't depend on them
_END_SHIFT = 1 << 12  # a word's last character is another symbol than the same character inside a word
_LATIN = [chr(code) for code in range(128, 592)]
_LETTERS = "a-z" + "".join(c for c in _LATIN if c.isalpha())
_NUMBERS = "0-9" + "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\t-\\r \\x85\\xa0{_LETTERS}{_NUMBERS}]+")
_NOT_LATIN = re.compile("[^\\x00-\u024f]")
_NEVER = 1 << 40
_WRITTEN = "\U0010ffff"  # begins a word that is already in byte characters


class PrefixEncoder:
    """A vocabulary of merges with word ends, as the dynamic programme needs it.

    Raises ``ValueError`` for vocabularies whose words may hold spaces, have unknown tokens or no word ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, suffix = described["model"], described["model"].get("end_of_word_suffix")
        steps = described["pre_tokenizer"].get("pretokenizers", [])
        if model["type"] != "BPE" or not suffix or [s["type"] for s in steps] != ["Split", "ByteLevel"] or "\\s" not in steps[0]["pattern"]["Regex"]:
            raise ValueError("this encoder needs byte-pair merges with word ends over words without spaces")
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.added = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None

        vocabulary: dict[str, int] = model["vocab"]
        self.symbols: dict[int, str] = {}
        for text, token in vocabulary.items():
            if len(text) == 1:
                self.symbols[token] = text
            elif len(text) == 1 + len(suffix) and text.endswith(suffix):
                self.symbols[token] = chr(ord(text[0]) + _END_SHIFT)
        # A merged token's age is the rank of its merge; single symbols were there before all merges.
        self.age = dict.fromkeys(self.symbols, -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if whole in self.age:
                raise ValueError("this encoder needs one merge for each token")
            self.merges[a, b], self.halves[whole], self.age[whole] = rank, (a, b), rank
            self.symbols[whole] = self.symbols[a] + self.symbols[b]
        self._link()

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [byte for byte in range(256) if byte not in printable]
        self.byte_characters = {byte: chr(byte) for byte in printable} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}
        names = {token: text for text, token in (vocabulary | self.added).items()}
        # Without a decoder the library joins the tokens' own strings by spaces, and leaves out unknown ids.
        self.names = pa.array([f"{names[token]} " if token in names else "" for token in range(max(names) + 1)], pa.large_string())
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _link(self) -> None:
        """The automaton: steps by symbol, the longest proper suffix of each state, and the longest token among its suffixes."""
        steps: list[dict[str, int]] = [{}]
        self.token = [-1]
        for token, symbols in self.symbols.items():
            # A token that merging its own symbols would not give is never the last one of a prefix.
            if token in self.halves and not self._apart(*self.halves[token], self.age[token]):
                continue
            state = 0
            for symbol in symbols:
                if symbol not in steps[state]:
                    steps[state][symbol] = len(steps)
                    steps.append({})
                    self.token.append(-1)
                state = steps[state][symbol]
            self.token[state] = token
        self.steps, self.suffix, self.ends, self.shorter = steps, [0] * len(steps), [0] * len(steps), [0] * len(steps)
        waiting = list(steps[0].values())
        for state in waiting:  # shorter ones first
            self.shorter[state] = self.ends[self.suffix[state]]
            self.ends[state] = state if self.token[state] >= 0 else self.shorter[state]
            for symbol, after in steps[state].items():
                back = self.suffix[state]
                while back and symbol not in steps[back]:
                    back = self.suffix[back]
                self.suffix[after] = steps[back].get(symbol, 0)
                waiting.append(after)
        self.lengths = {token: len(symbols) for token, symbols in self.symbols.items()}

    def _apart(self, left: int, right: int, until: int = _NEVER) -> bool:
        """Whether these tokens, built side by side, stay two until the merge of rank ``until``.

        The tokens are taken apart again along their common border, the younger one first. At each moment the two
        symbols at the border must not have a merge that comes before the one that used up either of them; of equal
        merges the left one comes first.
        """
        left_ends = right_ends = until
        while True:
            rank = self.merges.get((left, right))
            if rank is not None and rank < left_ends and (rank <= right_ends if right_ends < until else rank < until):
                return False
            left_age, right_age = self.age[left], self.age[right]
            if left_age > right_age:
                left_ends, left = left_age, self.halves[left][1]
            elif right_age >= 0:
                right_ends, right = right_age, self.halves[right][0]
            else:
                return True

    def _compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[left << 20 | right] = self._apart(left, right)
        return known

    def _last(self, end: int, longest: list[int], last: list[int]) -> int:
        """The last token of the prefix that ends with character ``end``; noted in ``last``."""
        found = longest[end]
        while True:
            token = self.token[found]
            start = end - self.lengths[token]
            if start < 0:
                break
            before = last[start]
            if before < 0:
                before = self._last(start, longest, last)
            apart = self.pairs.get(before << 20 | token)
            if apart is None:
                apart = self._compatible(before, token)
            if apart:
                break
            found = self.shorter[found]
        last[end] = token
        return token

    def word(self, characters: str) -> bytes:
        """Ids of one word, written in the vocabulary's byte characters.

        Prefixes that no token leads back to are left out; in long words all are done in order, for a flat stack.
        """
        word = characters[:-1] + chr(ord(characters[-1]) + _END_SHIFT)
        steps, ends = self.steps, self.ends
        longest, state = [], 0
        for symbol in word:
            after = steps[state].get(symbol)
            while after is None and state:
                state = self.suffix[state]
                after = steps[state].get(symbol)
            state = steps[0][symbol] if after is None else after
            longest.append(ends[state])
        size = len(word)
        last = [-1] * size
        for end in range(0 if size > LONGEST_KEPT else size - 1, size):
            self._last(end, longest, last)
        ids, end = [], size - 1
        while end >= 0:
            ids.append(last[end])
            end -= self.lengths[last[end]]
        ids.reverse()
        return array("I", ids).tobytes()

    def _split(self, text: str) -> list[str]:
        """The words of a text without added tokens, plain Latin ones as they are, others in byte characters."""
        lower = text.lower()
        if not _NOT_LATIN.search(text) and not _NOT_LATIN.search(lower) and unicodedata.is_normalized("NFC", text):
            return _WORDS.findall(lower)
        if " " in text:  # none of the file's rules looks across a space
            return [word for part in text.split(" ") if part for word in self._split(part)]
        words = [word for word, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]
        return [word if word.isascii() else _WRITTEN + word for word in words]

    def _learn(self, word: str) -> bytes:
        ids = self.words.get(word) or self.older.get(word)
        if ids is None:
            if word in self.added:
                ids = self.added[word].to_bytes(4, "little")
            elif word.isascii() and word.isprintable():
                ids = self.word(word)
            elif word[0] == _WRITTEN:
                ids = self.word(word[1:])
            else:
                ids = self.word(word.encode().decode("latin-1").translate(self.byte_characters))
        if len(word) <= LONGEST_KEPT:
            if len(self.words) >= MOST_WORDS:
                self.words, self.older = {}, self.words
            self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split_added and "<|" in text:
            pieces = self.split_added.split(text)
            words = [word for piece in pieces if piece for word in ([piece] if piece in self.added else self._split(piece))]
        else:
            words = self._split(text)
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._learn(word) if ids is None else ids for word, ids in zip(words, found)]
        return b"".join(found)

    def decode(self, many: list[bytes]) -> pa.Array:
        """The texts that the library's ``decode(ids, skip_special_tokens=False)`` gives for these ids."""
        ids = np.frombuffer(b"".join(many), "<u4").astype(np.int64)
        if len(ids) and ids.max() >= len(self.names):
            ids = np.where(ids < len(self.names), ids, -1)
        taken = self.names.take(pa.array(ids, mask=ids < 0)).fill_null("")
        edges = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        whole = memoryview(taken.buffers()[2]) if len(ids) and taken.buffers()[2] is not None else memoryview(b"")
        bounds = edges[np.cumsum([0, *(len(one) // 4 for one in many)])].tolist()
        return pa.array([str(whole[a : max(a, b - 1)], "utf-8") for a, b in zip(bounds, bounds[1:])], pa.string())


def encoder(path: str) -> PrefixEncoder:
    """One encoder per worker process, kept between tasks."""
    return held(("prefixes", path), lambda: PrefixEncoder(path))


def _encode_batches(path: str, with_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, "text"):
            coded = [own.encode(text) for text in batch.column("text").to_pylist()]
            columns = {
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                "ids": pa.array(coded, pa.binary()),
            }
            if with_text:
                columns["decoded"] = own.decode(coded)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of whole texts, row by row.

    ``with_text`` adds ``decoded``, the text that the ids decode to, without a second pass.
    """
    read = docs.selectExpr("cast(doc_id as long) AS doc_id", "text")
    return read.mapInArrow(_encode_batches(path, with_text), ENCODED_SCHEMA + (", decoded string" if with_text else ""))


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``decoded`` of rows with ``doc_id`` and ``ids``; null ids decode to the empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, "ids"):
            many = [ids or b"" for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "decoded": own.decode(many)})

    return coded.selectExpr("cast(doc_id as long) AS doc_id", "ids").mapInArrow(run, DECODED_SCHEMA)
