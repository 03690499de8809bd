"""Token ids of whole texts by a public tokenizer, with words remembered between texts."""

from __future__ import annotations

import json
import re
from itertools import compress, islice, repeat
from operator import is_

import numpy as np
import pyarrow as pa

from salesflow.llm.words import Lookup, buffers, spelled

#: Words a Python worker remembers at most; others are encoded anew each time.
REMEMBERED_WORDS = 250_000
#: The same for tables of hashes, which take less memory.
REMEMBERED_HASHES = 1_200_000
WORDS_AT_ONCE = 1000
#: Characters of unseen words encoded at once.
ENCODE_CHARS = 1 << 20

#: White space at the ends of a word, runs of it, and other kinds than the newline.
_ODD = re.compile(r"^\s|\s$|\s\s|[^\S\n]")
_encoders: dict = {}
_tables: dict = {}


class Encoder:
    """Encodes batches of texts to uint32 ids, equal to ``tokenizer.encode(text, add_special_tokens=False)``.

    Both families of tokenizers here never join characters over a space that
    follows and precedes other characters, so each " word" is encoded once and
    remembered. Texts with runs of white space, tabs or special tokens' strings
    are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that each begin with a space, encoded together and cut at the words' bounds."""
        found: dict[str, bytes] = {}
        lo = 0
        while lo < len(words):
            size, hi = 0, lo
            while hi < len(words) and (hi == lo or size + len(words[hi]) <= ENCODE_CHARS):
                size += len(words[hi])
                hi += 1
            chunk = words[lo:hi]
            encoding = self.tokenizer.encode("".join(chunk), add_special_tokens=False)
            ids = np.array(encoding.ids, "<u4")
            begins = np.fromiter((a for a, _ in encoding.offsets), np.int64, len(ids))
            ends = np.cumsum([len(w) for w in chunk])
            cuts = np.searchsorted(begins, ends).tolist()
            at = 0
            for word, stop in zip(chunk, cuts, strict=True):
                found[word] = ids[at:stop].tobytes()
                at = stop
            lo = hi
        return found

    def _odd(self, word: str) -> bool:
        """Whether a word has white space or a special token's string that may join over its bounds."""
        body = word[1:]
        return not body or _ODD.search(body) is not None or any(x in word for x in self.special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known, split, unseen = self.known, [], set()
        for text in texts:
            # The zero byte goes before each space, so that a word keeps its space.
            words = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
            words[0] = "\n" + words[0]  # never equal to a word after a space
            got = list(map(known.get, words))
            if None in got:
                unseen.update(compress(words, map(is_, got, repeat(None))))
            split.append(words)
        fresh: dict[str, bytes | bool] = dict.fromkeys(unseen, False)
        plain = [w for w in unseen if not self._odd(w)]
        fresh.update(self._learn([w for w in plain if w[0] == " "]))
        firsts = [w for w in plain if w[0] == "\n"]
        for w, e in zip(
            firsts,
            self.tokenizer.encode_batch_fast([w[1:] for w in firsts], add_special_tokens=False),
            strict=True,
        ):
            fresh[w] = np.array(e.ids, "<u4").tobytes()
        room = REMEMBERED_WORDS - len(known)
        known.update(islice((x for x in fresh.items() if x[0][0] == " "), max(room, 0)))
        out = []
        for text, words in zip(texts, split, strict=True):
            got = list(map(known.get, words))
            if None in got:
                got = [fresh[w] if g is None else g for w, g in zip(words, got, strict=True)]
            ids = self._whole(text) if False in got else b"".join(got)
            out.append(np.frombuffer(ids, "<u4"))
        return out


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.size = np.zeros(1024, kind), 0

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.size]

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            self.held = np.concatenate([self.held, np.zeros(size - len(self.held) + size // 2, self.held.dtype)])
        self.held[self.size : size] = values
        self.size = size

    def cut(self, size: int) -> None:
        self.size = size


class WordTable:
    """Encodes batches of texts by a tokenizer that drops white space, word by word.

    Words are told apart by 64-bit hashes of their bytes and looked up in arrays; only
    words not met before are encoded. The same ids as for whole texts, for tokenizers that
    split at every run of white space and keep nothing of it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Which ids end a word; none if the tokenizer does not mark them.
        self.ending = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ending[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        #: Known hashes, in a large and a small table, each with the words' numbers.
        self.tables = [Lookup(np.zeros(0, np.uint64)), Lookup(np.zeros(0, np.uint64))]
        self.numbers = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        #: By number: where a word's ids start and how many they are.
        self.starts, self.lengths = Growing(np.int64), Growing(np.int32)
        self.pool = Growing(np.uint16 if len(self.ending) <= 1 << 16 else np.uint32)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each)."""
        plain = [w.isalpha() for w in words]
        lengths = np.zeros(len(words), np.int64)
        parts: list[np.ndarray | None] = [None] * len(words)
        alone = [k for k, p in enumerate(plain) if not p]
        letters = [k for k, p in enumerate(plain) if p]
        groups = [letters[lo : lo + WORDS_AT_ONCE] for lo in range(0, len(letters), WORDS_AT_ONCE)]
        joined = self.tokenizer.encode_batch_fast(
            [" ".join([words[k] for k in g]) for g in groups], add_special_tokens=False
        )
        for group, encoding in zip(groups, joined, strict=True):
            ids = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self.ending[ids]) + 1
            # A word of letters ends once, unless lower-casing or the like splits it.
            if len(ends) == len(group) and (not len(ids) or ends[-1] == len(ids)):
                for k, piece in zip(group, np.split(ids, ends[:-1]), strict=True):
                    parts[k] = piece
            else:
                alone.extend(group)
        for k, encoding in zip(
            alone,
            self.tokenizer.encode_batch_fast([words[k] for k in alone], add_special_tokens=False),
            strict=True,
        ):
            parts[k] = np.array(encoding.ids, np.uint32)
        lengths[:] = [len(p) for p in parts]
        return np.concatenate([np.zeros(0, np.uint32), *parts]), lengths

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch's texts in order, and each text's bounds in them."""
        data, bounds = buffers(column)
        hashes, first, sizes, ends = spelled(data, bounds)
        at = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for table, numbers in zip(self.tables, self.numbers, strict=True):
            found = table.find(hashes[left])
            hit = found >= 0
            at[left[hit]] = numbers[found[hit]]
            left = left[~hit]
        known = len(self.starts.all), len(self.pool.all)
        if len(left):
            new, one, back = np.unique(hashes[left], return_index=True, return_inverse=True)
            places = left[one]
            words = [
                data[a : a + n].tobytes().decode("utf-8", "replace")
                for a, n in zip(first[places].tolist(), sizes[places].tolist(), strict=True)
            ]
            del hashes, first, sizes, places, one
            ids, counts = self._learn(words)
            del words
            at[left] = known[0] + back
            self.starts.add(known[1] + np.cumsum(counts) - counts)
            self.lengths.add(counts)
            self.pool.add(ids)
            if known[0] + len(new) <= REMEMBERED_HASHES:
                self._insert(1, new, known[0] + np.arange(len(new), dtype=np.int32))
                if len(self.numbers[1]) > max(1 << 16, len(self.numbers[0]) // 8):
                    self._insert(0, self.tables[1].hashes, self.numbers[1])
                    self.tables[1], self.numbers[1] = Lookup(new[:0]), self.numbers[1][:0]
        counts = self.lengths.all[at]
        stops = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])
        take = np.repeat(self.starts.all[at] - stops[:-1], counts) + np.arange(stops[-1])
        out = self.pool.all[take]
        if len(self.starts.all) > REMEMBERED_HASHES:
            # What did not fit is forgotten again.
            self.starts.cut(known[0])
            self.lengths.cut(known[0])
            self.pool.cut(known[1])
        return out, stops[ends]

    def _insert(self, k: int, hashes: np.ndarray, numbers: np.ndarray) -> None:
        old = self.tables[k].hashes
        where = np.searchsorted(old, hashes)
        self.tables[k] = Lookup(np.insert(old, where, hashes))
        self.numbers[k] = np.insert(self.numbers[k], where, numbers)


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def word_table(path: str) -> WordTable:
    """One table per worker and file."""
    if path not in _tables:
        _tables[path] = WordTable(path)
    return _tables[path]
