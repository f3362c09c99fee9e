"""Token ids from public vocabulary files, computed inside tasks.

Splitting at spaces and line feeds before encoding changes nothing for a vocabulary that drops white space, so each worker
keeps a bounded table from such chunks to ids and asks the tokenizer only for chunks it hasn't met. Marks behind a word are
looked up apart, and new words are encoded in one call.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

#: Chunks kept by a worker (about 200 bytes each); a full table is emptied, which costs time and changes nothing.
MOST_CHUNKS = 800_000


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: ASCII marks that the vocabulary's pattern splits from a word before them; the apostrophe may begin a suffix and isn't one.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The last piece of every word ends so.
WORD_END = "</w>"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for piece, number in tokenizer.get_vocab().items():
        ends[number] = piece.endswith(WORD_END)
    return tokenizer, ends, {}


def _learn_words(tokenizer, ends: np.ndarray, words: list[str], known: dict[str, bytes]) -> list[str]:
    """Encode pure words in one go and cut the ids behind each word's last piece; returns the words if that can't be told."""
    ids = np.array(tokenizer.encode(" ".join(words), add_special_tokens=False).ids, np.uint32)
    cuts = np.flatnonzero(ends[ids]) + 1
    if len(cuts) != len(words):
        return words
    data, at = ids.tobytes(), 0
    for word, cut in zip(words, (4 * cuts).tolist(), strict=True):
        known[word] = data[at:cut]
        at = cut
    return []


def _learn(tokenizer, ends: np.ndarray, fresh: set[str], known: dict[str, bytes]) -> None:
    split, words, rest = [], set(), []
    for chunk in fresh:
        word = chunk.rstrip(MARKS)
        if word.isalpha() and (word.isascii() or word.lower().isalpha()):  # lower-casing may split a letter
            marks = chunk[len(word) :]
            if word.isascii():
                word = word.lower()
            if marks or word != chunk:
                split.append((chunk, word, marks))
                if marks and marks not in known:
                    rest.append(marks)
            if word not in known:
                words.add(word)
        else:
            rest.append(chunk)
    if words:
        rest += _learn_words(tokenizer, ends, list(words), known)
    for chunk, made in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
        known[chunk] = np.array(made.ids, np.uint32).tobytes()
    known[""] = b""
    for chunk, word, marks in split:
        known[chunk] = known[word] + known[marks]


def encoded(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, for the vocabulary with word ends, which drops white space."""
    tokenizer, ends, known = _tokenizer(path)
    if len(known) > MOST_CHUNKS:
        known.clear()
    split = [t.replace("\n", " ").split(" ") for t in texts]
    fresh = set().union(*split).difference(known)
    if fresh:
        _learn(tokenizer, ends, fresh, known)
    get = known.__getitem__
    return [np.frombuffer(b"".join(map(get, chunks)), np.uint32) for chunks in split]


def counted(texts: list[str], path: str) -> np.ndarray:
    return np.array([len(ids) for ids in encoded(texts, path)], np.int64)
