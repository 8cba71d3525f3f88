"""Token ids of whole texts, for tasks that work through Arrow batches."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Distinct words in a generation of a worker's memory, of which there are two, and characters of a longer word.
REMEMBERED_WORDS, REMEMBERED_LENGTH = 600_000, 64
#: Characters of text that are looked up together.
TOGETHER = 1 << 20

#: ASCII punctuation that ends a word. A vocabulary that splits letters, digits and other characters apart gives the
#: same ids with a blank before it, and words repeat more often without it. Only after letters that normalising leaves
#: letters: a dotted capital I, for one, would end in a mark that belongs with the punctuation.
_LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_ENDING = re.compile(r"(?<=[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f])[!-/:-@\[-^`{-~]+(?=[ \t\r\n]|\Z)")


class TokenIds:
    """Ids of texts under a vocabulary file of the ``tokenizers`` library, without special tokens.

    The vocabularies in use split at white space before anything else, so the ids
    of a text are those of its blank-separated words in order. Words repeat far
    more than texts do: each is encoded once and remembered. When the memory is
    full, words not seen since it was last full go. ``tests/llm`` compares the ids
    with those of encoding whole texts at once.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already keeps every core busy
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        how = self._tokenizer.__getstate__().decode()
        self._lower = '"Lowercase"' in how
        self._apart = "[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in how and '"behavior":"Removed"' in how
        self._ends = None
        if self._apart and '"end_of_word_suffix":"</w>"' in how:
            vocabulary = self._tokenizer.get_vocab()
            self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self._ends[[at for token, at in vocabulary.items() if token.endswith("</w>")]] = True
        self._remembered = remembered
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._job: str | None = None

    def begin(self, job: str) -> None:
        """A task of ``job`` begins: with the first one in this process the older words go, so that jobs do not add up in idle workers."""
        if job != self._job:
            self._job, self._known, self._older = job, {}, self._known

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            waiting.append(self._words(text or ""))
            size += len(text or "")
            if size >= TOGETHER:
                yield from self._ids(waiting)
                waiting, size = [], 0
        yield from self._ids(waiting)

    def _words(self, text: str) -> list[str]:
        if "<|" not in text:  # else it may spell a special token
            if self._lower and text.isascii():  # as the vocabulary does, so that fewer words differ
                text = text.lower()
            if self._apart:
                text = _ENDING.sub(r" \g<0>", text)
        return text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")

    def _encode_apart(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of each word, encoded as one text and split where words end in it."""
        plain, others = [], []
        if self._ends is not None:
            for word in words:
                (plain if _LETTERS.fullmatch(word) else others).append(word)
        if plain:
            ids = np.array(self._tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self._ends[ids]) + 1).tolist()
            if len(ends) == len(plain):  # each word of letters is one piece with one end
                yield from zip(plain, (ids[b:e].tobytes() for b, e in zip([0, *ends], ends)))
                words = others
        if not words:
            return
        encoded = self._tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.cumsum([0] + [len(word) + 1 for word in words[:-1]])
        ids = np.array(encoded.ids, "<u4")
        begins = np.fromiter((begin for begin, _ in encoded.offsets), np.int64, len(ids))
        last = np.append(np.searchsorted(begins, starts[1:]), len(ids)).tolist()
        yield from zip(words, (ids[b:e].tobytes() for b, e in zip([0, *last], last)))

    def _ids(self, texts: list[list[str]]) -> Iterator[bytes]:
        known, older = self._known, self._older
        missing = []
        for word in set().union(*texts).difference(known):
            ids = older.get(word)
            if ids is None:
                missing.append(word)
            else:
                known[word] = ids
        for at in range(0, len(missing), 5000):
            known.update(self._encode_apart(missing[at:at + 5000]))
        for words in texts:
            yield b"".join(map(known.__getitem__, words))
        for word in missing:
            if len(word) > REMEMBERED_LENGTH:
                del known[word]
        if len(known) > self._remembered:
            self._known, self._older = {}, known


@lru_cache(maxsize=2)
def shared(path: str) -> TokenIds:
    """The encoder of a vocabulary that the tasks of a worker process share, so that each finds the words of those before."""
    return TokenIds(path)

