"""Token ids of whole texts with a public tokenizer, one Arrow slice at a time.

The word tokenizers treated here never form a token across white space, nor
from a letter to an ASCII mark behind it, so the ids of a text are the ids of
its chunks between spaces, line feeds and such places. Arrow cuts, lower-cases
and dictionary-encodes the chunks of a slice; each distinct chunk is encoded by
the tokenizers library once, plain words many at a time (their last token ends
with the suffix of a word's end), and kept in a bounded cache of the Python
worker; numpy lays the ids out in text order.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Chunks that one worker's cache holds before a slice begins; a full one starts anew.
CACHE_ENTRIES = 400_000
# Plain words that the library gets as one text.
WORDS_A_TEXT = 500

# Latin letters that are stable under NFC and lower-cased one by one, and ASCII
# punctuation without apostrophes: the tokenizer always cuts between them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"


def default_tokenizer() -> str:
    """Path of the public word tokenizer (looked up where the task runs)."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # for lower-case words, which the normalizer and the splitter leave as they are
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)           # tokens that end a word
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # control tokens are found before anything else and hold letters and marks
        self.control = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}                                      # chunk -> its row in first and size
        self.first = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str], plain: bool = False) -> list[list[int]]:
        return [e.ids for e in (self.plain if plain else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of lower-case words."""
        joined = [" ".join(words[i:i + WORDS_A_TEXT]) for i in range(0, len(words), WORDS_A_TEXT)]
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in self._encode(joined, plain=True))])
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(words):                                        # a vocabulary without such a suffix
            return self._chunks(words)
        return ids, np.diff(ends, prepend=-1)

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._encode(chunks)
        return (np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in found)]),
                np.fromiter(map(len, found), np.int64, len(found)))

    def _learn(self, words: list[str], chunks: list[str]) -> None:
        """Add words and other chunks that are not yet in the cache, in this order."""
        for names, (ids, size) in ((words, self._words(words)), (chunks, self._chunks(chunks))):
            self.row.update(zip(names, range(len(self.row), len(self.row) + len(names))))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, offset of each text in it plus the end)."""
        spaced = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), "\n", " ")
        if not (self.control and pc.any(pc.match_substring_regex(spaced, self.control)).as_py()):
            spaced = pc.replace_substring_regex(spaced, f"([{_LETTERS}])([{_MARKS}])", r"\1 \2")
        split = pc.split_pattern(spaced, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        is_word = pc.match_substring_regex(coded.dictionary, f"^[{_LETTERS}]+$")
        lower = pc.if_else(is_word, pc.utf8_lower(coded.dictionary), coded.dictionary).dictionary_encode()
        names = lower.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.row) > CACHE_ENTRIES:
            self._clear()
        row = np.fromiter(map(self.row.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(row < 0)
        if len(new):                                                       # words first, then the others
            word = pc.match_substring_regex(lower.dictionary.take(pa.array(new)), f"^[{_LETTERS}]+$").to_numpy(zero_copy_only=False)
            words, chunks = new[word], new[~word]
            row[np.concatenate([words, chunks])] = len(self.row) + np.arange(len(new))
            self._learn([names[k] for k in words.tolist()], [names[k] for k in chunks.tolist()])
        row = row[lower.indices.to_numpy(zero_copy_only=False)][coded.indices.to_numpy(zero_copy_only=False)]
        n = self.size[row]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.first[row] - ends[:-1], n) + np.arange(ends[-1])
        return self.flat[at], ends[offsets - offsets[0]]


@lru_cache(maxsize=2)
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer and cache for each Python worker."""
    return ChunkTokenizer(path)
