"""BPE encoding and decoding by a walk over the trie of distinct words.

A prefix of a word is encoded by the encoding of a shorter prefix and its own last token,
so a trie node needs that last token only. Sorted distinct words are the depth-first order
of their trie: the path to the current word is a stack, cut back to what the next word
shares with it, and shared prefixes are encoded once. A last token is the one suffix token
that does not merge with the token before it, which two tokens decide between them: no merge
may cross their border at any time while both are being built.

Texts of ASCII and Latin characters are cut into words by patterns. Any other text is
normalised and cut by the tokenizers library itself, whose Unicode version need not be that
of Python or of another package.

Each task encodes the distinct words of its documents; nothing is shuffled or broadcast.
The vocabulary is a file that each node has (its path is a parameter): BPE over bytes with
word ends, lower case, white space dropped.

Defined results: null or empty text, or white space alone, has no tokens and decodes to an
empty text. Strings of special tokens become their ids, wherever they stand. Repeated rows
each get their own row; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from gaugeflow.llm import common

#: Known words a worker keeps; when there are more, it forgets them and encodes anew.
KNOWN_WORDS = 500_000
#: Pairs of tokens a worker remembers to merge or not.
KNOWN_BORDERS = 1_000_000
#: Characters whose words are encoded together.
CHUNK_CHARS = 4_000_000

_WORD_END = "</w>"
_NEVER = 1 << 60

# How the vocabulary file's pre-tokenizer cuts words.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORDS_ASCII = re.compile(_CONTRACTIONS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_LETTERS_LATIN = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_NUMBERS_LATIN = "0-9²³¹¼½¾"
_WORDS_LATIN = re.compile(
    _CONTRACTIONS + f"|[{_LETTERS_LATIN}]+|[{_NUMBERS_LATIN}]"
    rf"|[^\t-\r \x85\xa0{_LETTERS_LATIN}{_NUMBERS_LATIN}]+"
)
# The lower case of the letter left out lies beyond, too.
_BEYOND_LATIN = re.compile("[^\x00-\u012f\u0131-\u017f]")


def _byte_symbols() -> dict[int, str]:
    """The printable symbol of each byte: itself where it prints, else the next from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class TrieEncoder:
    """Encodes words; remembers them as packed ids and as their tokens' text."""

    def __init__(self, path: str, decodes: bool = True):
        self._open(Tokenizer.from_file(path), decodes)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            pair = vocab[left], vocab[right]
            self.rank[pair] = rank
            self.parts[vocab[left + right]] = (*pair, rank)
        self.borders: dict[int, bool] = {}
        sound: dict[int, bool] = {}
        for token in sorted(self.tokens, key=lambda t: self.parts.get(t, (0, 0, -1))[2]):
            if token in self.parts:
                left, right, _ = self.parts[token]
                sound[token] = sound[left] and sound[right] and self._border(left, right) == 1
            else:
                sound[token] = True
        # Tokens that the merges do build from their own symbols, and so can end a prefix.
        self.usable = {t: i for t, i in vocab.items() if sound[i]}
        self.length = {
            i: len(t.removesuffix(_WORD_END)) or len(t) for t, i in self.usable.items()
        }
        self.longest = max(self.length.values(), default=1)
        self.tokens |= {ids[0]: t for t, ids in self.fixed.items()}
        for word, ids in self.fixed.items():
            self.know(word, ids)

    def _open(self, library: Tokenizer, decodes: bool) -> None:
        """What cutting texts and remembering words needs."""
        self.decodes = decodes
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.symbols = _byte_symbols()
        self.fixed = {t.content: [i] for i, t in library.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, self.fixed))) if self.fixed else None
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, str] = {}

    def make_room(self, words: set[str]) -> None:
        """Forget words if there are too many, but for the specials and those of now."""
        if len(self.ids) + len(words) > KNOWN_WORDS:
            ids, text = self.ids, self.text
            self.ids = {w: ids[w] for w in words if w in ids}
            self.text = {w: text[w] for w in words if w in text}
            for word, special in self.fixed.items():
                self.know(word, special)

    def mapped(self, word: str) -> str:
        """The word in the vocabulary's symbols for bytes."""
        if word.isascii() and word.isprintable():
            return word
        return word.encode().decode("latin-1").translate(self.symbols)

    def know(self, word: str, ids: list[int]) -> None:
        self.ids[word] = struct.pack(f"<{len(ids)}I", *ids)
        if self.decodes:
            self.text[word] = " ".join([self.tokens[i] for i in ids])

    @functools.cache  # noqa: B019  one encoder lives as long as its worker
    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at an edge of a token while it is built, and until which rank."""
        edge, until = [], _NEVER
        while True:
            edge.append((token, until))
            if token not in self.parts:
                return edge[::-1]
            until = self.parts[token][2]
            token = self.parts[token][side]

    def _border(self, a: int, b: int) -> int:
        """0: no merge crosses the border of a and b; 1: the two merge whole; 2: earlier."""
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = self.rank.get((x, y), _NEVER)
            if rank < x_until and rank <= y_until:
                return 1 if x_until == y_until == _NEVER else 2
            if x_until == y_until == _NEVER:
                return 0
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _apart(self, key: int) -> bool:
        if len(self.borders) > KNOWN_BORDERS:
            self.borders.clear()
        self.borders[key] = apart = self._border(key >> 20, key & 0xFFFFF) == 0
        return apart

    def _last(self, word: str, end: int, states: list[int], suffix: str) -> int:
        """The last token of ``word[:end] + suffix``; states[n] is that of ``word[:n]``."""
        usable, borders = self.usable, self.borders
        start = max(0, end - self.longest)
        last = word[start:end] + suffix
        if start == 0 and last in usable:
            return usable[last]
        for cut in range(start == 0, end - start):
            token = usable.get(last[cut:])
            if token is not None:
                key = states[start + cut] << 20 | token
                apart = borders.get(key)
                if apart is None:
                    apart = self._apart(key)
                if apart:
                    return token
        raise ValueError(f"no token ends {word[:end]!r}")

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet."""
        self.make_room(words)
        todo = sorted((self.mapped(w), w) for w in words - self.ids.keys())
        states: list[int] = [-1]
        before = ""
        for word, original in todo:
            shared, most = 0, min(len(states) - 1, len(word))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del states[shared + 1:]
            for end in range(len(states), len(word)):
                states.append(self._last(word, end, states, ""))
            end = len(word)
            ids = [self._last(word, end, states, _WORD_END)]
            end -= self.length[ids[0]]
            while end:
                ids.append(states[end])
                end -= self.length[ids[-1]]
            self.know(original, ids[::-1])
            before = word

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens included, as the vocabulary cuts them."""
        if self.special and self.special.search(text):
            found, at = [], 0
            for match in self.special.finditer(text):
                found += self._plain_words(text[at:match.start()])
                found.append(match[0])
                at = match.end()
            return found + self._plain_words(text[at:])
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return _WORDS_ASCII.findall(text.lower())
        if not _BEYOND_LATIN.search(text):  # then it is in normal form, too
            return _WORDS_LATIN.findall(text.lower())
        text = self.normalizer.normalize_str(text)
        return [text[start:end] for _, (start, end) in self.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Packed ids (little-endian, 32 bits each) of each text, and its tokens joined by spaces
        (an empty text where the encoder does not decode)."""
        at = 0
        while at < len(texts):
            lists, chars = [], 0
            while at < len(texts) and (not lists or chars + len(texts[at]) <= CHUNK_CHARS):
                chars += len(texts[at])
                lists.append(self.words(texts[at]))
                at += 1
            self.learn(set().union(*lists))
            ids, text = self.ids.__getitem__, self.text.__getitem__
            for found in lists:
                decoded = " ".join(map(text, found)) if self.decodes else ""
                yield b"".join(map(ids, found)), decoded


@functools.cache
def encoder(path: str, decodes: bool = True) -> TrieEncoder:
    """One encoder for each worker and vocabulary."""
    return TrieEncoder(path, decodes)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array<int>) and the text that the ids decode to."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, decoded = zip(*encoder(vocabulary).encode(batch.column(1).to_pylist()))
        ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
        values = np.frombuffer(b"".join(ids), "<i4")
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(ends, values), pa.array(decoded, pa.string())],
            ["doc_id", "ids", "decoded"],
        )

    return common.map_batches(
        common.texts(docs), run, "doc_id long, ids array<int>, decoded string"
    )
