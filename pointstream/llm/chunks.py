"""Texts to token ids at the speed of dictionary look-ups.

The byte-level vocabularies here split a text by one pattern before any merge.  A white-space run
together with the run of other characters behind it can be split on its own: no match goes from other
characters into white space, and what a match sees ahead ends with that run.  So a text is cut into such
chunks, each distinct chunk is encoded once by the real tokenizer and kept in a bounded cache."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import Generations

#: The characters with Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: White space besides blank and line feed, or what other code takes for it.
OTHER_WHITE = re.compile("[\t\v-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Entries of a cache's generation in a worker, of which there are two, and characters of a chunk in it: an entry has
#: about 200 bytes, 600 at the most.
CACHED, KEPT_CHARACTERS = 600_000, 64
#: New chunks that the tokenizer gets as one text.
TOGETHER = 2000
#: Text bytes whose chunks are numbered together.
PART_BYTES = 12 << 20


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split(texts: list[str]) -> tuple[pa.Array, list[int], np.ndarray]:
    """All texts' chunks as keys of the cache; the texts' numbers in the order of their chunks; and how many chunks there
    are before each of these, and in all.

    Nearly all chunks are words behind one blank or one line feed.  Texts where all are come first, split at
    blanks: "x" stands for " x", "\nx" for itself.  What such a text begins with, and other texts' chunks, get a tab."""
    plain, others = [], []
    for k, x in enumerate(texts):
        if x:
            uneven = "  " in x or "\n\n" in x or " \n" in x or "\n " in x or x[0] in " \n" or x[-1] in " \n" or OTHER_WHITE.search(x)
            (others if uneven else plain).append(k)
    words = pc.split_pattern(pa.array(["\t" + texts[k].replace("\n", " \n") for k in plain], pa.large_string()), " ")
    chunks = [CHUNK.findall(texts[k]) for k in others]
    sizes = [0, *pc.list_value_length(words).to_pylist(), *map(len, chunks)]
    return pa.concat_arrays([words.flatten(), pa.array(["\t" + c for some in chunks for c in some], pa.large_string())]), plain + others, np.cumsum(sizes)


def chunk(key: str) -> str:
    """What a key of ``split`` stands for."""
    return key[1:] if key[0] == "\t" else key if key[0] == "\n" else " " + key


def joined(values: pa.Array, ends: np.ndarray) -> Iterator[bytes]:
    """The values (with 64-bit offsets, none null) from each of ``ends`` to the next, one after the other."""
    at, data = np.frombuffer(values.buffers()[1], np.int64)[values.offset + ends].tolist(), memoryview(values.buffers()[2])
    return (bytes(data[a:b]) for a, b in zip(at, at[1:]))


class ChunkEncoder:
    """Ids as the tokenizers library gives them, without special tokens: the end marker's own string in a text is ordinary text."""

    def __init__(self, path: str, most: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cache = Generations(most)
        # bytes of each token; in the byte-level alphabet a character stands for one
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.sizes[k] = len(token)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit integers.

        Arrow numbers the chunks of all, so only distinct ones are looked up one by one."""
        self.cache.turn()
        chunks, where, ends = split(texts)
        if not len(chunks):
            return [b""] * len(texts)
        numbered = chunks.dictionary_encode()
        keys = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        entries = list(map(self.cache.get, keys))
        if missing := [n for n, x in enumerate(entries) if x is None]:
            unseen = [keys[n] for n in missing]
            older = list(map(self.cache.old.get, unseen))
            new = iter(self.learn([k for k, x in zip(unseen, older) if x is None]))
            for n, x in zip(missing, older):
                entries[n] = next(new) if x is None else x
            self.cache.update((keys[n], entries[n]) for n in missing if len(keys[n]) <= KEPT_CHARACTERS)
        ids = pa.array(entries, pa.large_binary()).take(numbered.indices)
        found = [b""] * len(texts)
        for k, x in zip(where, joined(ids, ends)):
            found[k] = x
        return found

    def learn(self, keys: list[str]) -> list[bytes]:
        """The ids of each key's chunk."""
        plain = [k[0] != "\t" and len(k) <= KEPT_CHARACTERS for k in keys]
        words, others = self.words(compress(keys, plain)), self.others(k for k, x in zip(keys, plain) if not x)
        return [next(words if x else others) for x in plain]

    def words(self, keys: Iterator[str]) -> Iterator[bytes]:
        """For chunks of one blank or line feed and characters that aren't white space.

        A text of many has their ids one after the other, and tokens have as many bytes as their chunk."""
        while some := list(islice(keys, TOGETHER)):
            text = (" " + " ".join(some)).replace(" \n", "\n")
            data, ids = np.frombuffer(text.encode(), np.uint8), self.ids([text])[0]
            starts = np.flatnonzero((data == 32) | (data == 10))
            before = np.cumsum(self.sizes[ids]) - self.sizes[ids]
            cuts, raw = [*(4 * np.searchsorted(before, starts)).tolist(), None], ids.tobytes()
            yield from (raw[a:b] for a, b in zip(cuts, cuts[1:]))

    def others(self, keys: Iterator[str]) -> Iterator[bytes]:
        while some := list(islice(keys, TOGETHER)):
            yield from (x.tobytes() for x in self.ids(list(map(chunk, some))))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One for each worker process, which Spark uses again for later tasks."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
