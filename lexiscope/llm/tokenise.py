"""Token ids of whole texts by a public tokenizer file, word by word.

The tokenizer splits at white space, and between letters and marks, before anything
else, so the ids of a text are the ids of its words in order.  A worker keeps the ids of the words it
has met: at most ``CACHE_WORDS``; when these are full and when a task ends, only the ``KEEP_WORDS`` it met first, which
changes speed only.  A word is known by 128 bits: a hash and a check.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from lexiscope.llm.word_hash import byte_chunks, find_words

CACHE_WORDS = 1_500_000  # about 60 bytes each
KEEP_WORDS = 250_000
RUN_BYTES = 1 << 20
SPECIAL = b"<|"  # begins the special tokens
DEFAULT_FILE = "word_bpe_49k.json"

_LOADED: dict = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_FILE)


class WordTokenizer:
    """Ids of texts, two bytes an id where the vocabulary allows it.

    Words are found and hashed without an object for each; only the distinct words of a run of
    texts are looked up, and those not met before go to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.forget()

    def forget(self) -> None:
        self.keys, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order; their numbers
        self.check = np.zeros(0, np.uint64)  # in the same order
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, self.dtype)  # ids of all numbered words

    def shrink(self, keep: int = KEEP_WORDS) -> None:
        """Keeps the first ``keep`` words."""
        if len(self.begin) <= keep:
            return
        old = self.number < keep
        self.keys, self.check, self.number = self.keys[old], self.check[old], self.number[old]
        self.pool = self.pool[:int(self.begin[keep])].copy()
        self.begin, self.size = self.begin[:keep].copy(), self.size[:keep].copy()

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ids of a text column in runs of rows: ``(first row, last row + 1, ids, where each row's begin)``;
        a null counts as empty."""
        for i, j, data, bounds in byte_chunks(column, RUN_BYTES):
            raw = data.tobytes()
            # Letters and marks are separate pre-tokens, and A-Z are lower-cased, but for special tokens.
            h, check, s, e, where = find_words(data, bounds, fold=SPECIAL not in raw, split_marks=True)
            distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
            if (check[first][back] != check).any():  # words of one hash: each goes to the tokenizer, and none is kept
                yield i, j, *self._plain(raw, s, e, where)
                continue
            number = self._numbers(distinct, check[first])
            if (number < 0).any():
                if len(self.keys) + len(distinct) > CACHE_WORDS:
                    self.shrink()
                    number = self._numbers(distinct, check[first])
                new = np.flatnonzero(number < 0)
                words = self._words(raw, s[first[new]], e[first[new]])
                number[new] = self._add(distinct[new], check[first[new]], words)
            size = self.size[number][back].astype(np.int64)
            after = np.cumsum(size)
            ids = self.pool[np.repeat(self.begin[number][back] - after + size, size)
                            + np.arange(int(after[-1]) if len(after) else 0)]
            yield i, j, ids, np.concatenate([[0], after])[where]

    @staticmethod
    def _words(raw: bytes, begin: np.ndarray, end: np.ndarray) -> list[str]:
        return [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begin.tolist(), end.tolist())]

    def _plain(self, raw: bytes, s: np.ndarray, e: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a run, and where each row's begin, without the table."""
        words = self._words(raw, s, e)
        got = [self._encode_all(words[k:k + 2048]) for k in range(0, len(words), 2048)]
        size = np.concatenate([np.zeros(0, np.int64), *(n for _, n in got)])
        return (np.concatenate([np.zeros(0, self.dtype), *(ids for ids, _ in got)]),
                np.concatenate([[0], np.cumsum(size)]).astype(np.int64)[where])

    def _numbers(self, keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes and checks; -1 for new ones."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[at] == keys
        if (same & (self.check[at] != check)).any():  # another word of that hash is known
            self.forget()
            return np.full(len(keys), -1, np.int32)
        return np.where(same, self.number[at], np.int32(-1))

    def _add(self, keys: np.ndarray, check: np.ndarray, words: list[str]) -> np.ndarray:
        """Numbers of new words (given by ordered hashes), whose ids go to the pool."""
        got = [self._encode_all(words[k:k + 2048]) for k in range(0, len(words), 2048)]
        numbers, size = (len(self.begin) + np.arange(len(keys))).astype(np.int32), np.concatenate([n for _, n in got])
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.pool = np.concatenate([self.pool, *(ids for ids, _ in got)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.number = np.insert(self.keys, at, keys), np.insert(self.number, at, numbers)
        self.check = np.insert(self.check, at, check)
        return numbers

    def _encode_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, and how many each has, by one call: an id belongs to the word in which its
        text begins."""
        found = self.model.encode(" ".join(words), add_special_tokens=False)
        begins = np.array([a for a, _ in found.offsets], np.int64)
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        return np.array(found.ids, self.dtype), np.diff(np.searchsorted(begins, after), prepend=0)

    def encode(self, text: str | None) -> bytes:
        """Ids of one text, as little-endian bytes."""
        return b"".join(ids.tobytes() for _, _, ids, _ in self.encode_column(pa.array([text], pa.string())))


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for ``path``, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def until_done(run: Callable, path: str) -> Callable:
    """``run`` as a task; when it ends, the reused worker gives up free Arrow memory and all but the first words."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            tokenizer(path).shrink()
            pa.default_memory_pool().release_unused()
    return task


def texts(tok: WordTokenizer, column: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each text of a column."""
    for i, j, ids, where in tok.encode_column(column):
        for k in range(j - i):
            yield ids[where[k]:where[k + 1]]
