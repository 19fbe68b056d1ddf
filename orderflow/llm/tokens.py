"""Batched token encoding with the public tokenizers, shared by operators 4 and 7.

A byte-pair tokenizer splits a text into pieces before it merges, so white-space-separated
chunks encode independently of each other.  ``ChunkEncoder`` therefore asks the library once per
distinct chunk and keeps the answer for the worker's life (bounded; when full, chunks that did not
come again are forgotten).  A text whose white space or special strings could make chunks depend on
each other goes to the library whole, so the ids always are those the library gives for the whole text.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks kept per worker; when they are more, those that came once are forgotten (about 300 bytes a chunk).
KEPT_CHUNKS = 800_000
#: Texts are encoded together up to this many characters.
BATCH_CHARS = 2_000_000
#: New chunks that the library is asked for in one text (longer ones cost it more a chunk).
ROW_CHUNKS = 100


def byte_alphabet() -> dict[int, int]:
    """Code point that stands for each byte: itself where visible, else the next from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


ALPHABET = byte_alphabet()


class ChunkEncoder:
    """Ids (``byte_level``) or counts of whole texts under one tokenizer file.

    Byte-level vocabularies attach a preceding blank to the next chunk; a line feed between two
    chunks is a token of its own; so the library encodes many new chunks in one text, and the ids
    tell where each begins.  Other vocabularies drop white space, and new chunks are texts of their own.
    """

    def __init__(self, path: str, most: int = KEPT_CHUNKS):
        import os
        import re

        from tokenizers import Tokenizer

        self.most = most
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        # asked for piece by piece: the whole description as Python objects would be tens of MB a worker
        self.byte_level = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a chunk with one of these inside sends its text to the library whole
        self.odd = re.compile("|".join([r"\s", r"[\x1c-\x1f]", *map(re.escape, added)]))
        if self.byte_level:
            # ids that begin a chunk in a row of chunks parted by single blanks, or by line feeds
            size = self.tokenizer.get_vocab_size()
            self.begins = {mark: np.zeros(size, bool) for mark in " \n"}
            for number in range(size):
                for mark, begins in self.begins.items():
                    begins[number] = (self.tokenizer.id_to_token(number) or " ")[0] == chr(ALPHABET[ord(mark)])
        self.forget()

    def forget(self) -> None:
        # empty chunks (doubled, leading or trailing blanks) and bare line feeds are irregular
        self.known: dict[str, int] = {"": -2, "\n": -2}
        self.pool = np.zeros(1 << 20, np.uint32)
        self.starts = np.zeros(1 << 17, np.int64)
        self.sizes = np.zeros(1 << 17, np.int64)
        self.met = np.zeros(1 << 17, bool)  # again after the texts that they were learnt from
        self.used, self.kept = 0, 0

    def thin(self) -> None:
        """Forget the chunks not met again since they were learnt or last kept; all, if too many are left."""
        again = np.flatnonzero(self.met[:self.kept])
        if len(again) > self.most // 2:
            self.forget()
            return
        kept = set(again.tolist())
        chunks = [c for c, number in self.known.items() if number in kept]  # by number, as they were stored
        sizes = self.sizes[again]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[again] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        self.forget()
        self._store(chunks, ids, sizes)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of whole texts."""
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, texts: list[str]) -> pa.ListArray:
        """The chunks of each text: what single blanks part."""
        if not self.byte_level:
            lines = [t.replace("\n", " ") for t in texts]
        else:  # a chunk after a line feed keeps it and has no blank; the first one is made alike
            lines = ["\n" + t.replace("\n", " \n") for t in texts]
        return pc.split_pattern(pa.array(lines, pa.large_string()), " ")

    def _store(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep new chunks; ``ids`` are those of all chunks in a row."""
        n, k = len(ids), self.kept
        while self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        while k + len(chunks) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
            self.sizes = np.concatenate([self.sizes, np.zeros(len(self.sizes), np.int64)])
            self.met = np.concatenate([self.met, np.zeros(len(self.met), bool)])
        self.pool[self.used:self.used + n] = ids
        self.starts[k:k + len(chunks)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[k:k + len(chunks)] = sizes
        self.known.update(zip(chunks, range(k, k + len(chunks))))
        self.used, self.kept = self.used + n, k + len(chunks)

    def _in_a_row(self, bodies: list[str], mark: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks in rows, each after ``mark`` (a blank or a line feed), and how many each has.

        A piece never goes across a mark: a blank begins the piece after it, a line feed is one by
        itself.  No body has white space, so an id that begins with the mark begins a chunk.
        """
        ids = np.concatenate(self.whole([mark + mark.join(bodies[i:i + ROW_CHUNKS]) for i in range(0, len(bodies), ROW_CHUNKS)]))
        starts = np.flatnonzero(self.begins[mark][ids])
        if len(starts) != len(bodies):
            raise ValueError("chunks of a row cannot be told apart")
        return ids, np.diff(np.append(starts, len(ids)))

    def _learn(self, chunks: list[str]) -> np.ndarray:
        """Ask the library for new chunks, all of a kind at once: their numbers.  Odd ones are remembered as such."""
        kinds = {" ": chunks}
        at = {" ": np.arange(len(chunks))}
        if self.byte_level:
            feed = np.fromiter([c[0] == "\n" for c in chunks], bool, len(chunks))
            at = {" ": np.flatnonzero(~feed), "\n": np.flatnonzero(feed)}
            kinds = {" ": [chunks[i] for i in at[" "].tolist()], "\n": [chunks[i] for i in at["\n"].tolist()]}
        numbers = np.full(len(chunks), -2, np.int64)
        for mark, some in kinds.items():
            bodies = [c[1:] for c in some] if mark == "\n" else some
            if self.odd.search("\0".join(bodies)):
                odd = [bool(self.odd.search(body)) for body in bodies]
                self.known.update((c, -2) for c, o in zip(some, odd, strict=True) if o)
                some, bodies = ([c for c, o in zip(x, odd, strict=True) if not o] for x in (some, bodies))
                at[mark] = at[mark][~np.array(odd)]
            if not some:
                continue
            numbers[at[mark]] = np.arange(self.kept, self.kept + len(some))
            if self.byte_level:
                self._store(some, *self._in_a_row(bodies, mark))
            else:
                lists = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                self._store(some, np.fromiter(chain.from_iterable(lists), np.uint32),
                            np.fromiter(map(len, lists), np.int64, len(lists)))
        return numbers

    def _look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk numbers of all texts, chunks per text, and which texts are irregular."""
        lists = self._chunks(texts)
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        # each distinct chunk is looked up once
        coded = lists.flatten().dictionary_encode()
        whole = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        chunks = pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        found = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        self.met[found[found >= 0]] = True
        missing = np.flatnonzero(found == -1).tolist()
        if missing:
            found[missing] = self._learn([chunks[i] for i in missing])
        numbers = found[coded.indices.to_numpy()]
        owner = np.repeat(np.arange(len(texts)), per_text)
        irregular = np.bincount(owner[numbers == -2], minlength=len(texts)) > 0
        return numbers, per_text, irregular

    def _groups(self, texts: list[str]):
        start, chars = 0, 0
        for i, t in enumerate(texts):
            chars += len(t)
            if chars >= BATCH_CHARS:
                yield texts[start:i + 1]
                start, chars = i + 1, 0
        if start < len(texts):
            yield texts[start:]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each whole text."""
        out = [np.zeros(0, np.int64)]
        for group in self._groups(texts):
            if self.kept > self.most:
                self.thin()
            numbers, per_text, irregular = self._look_up(group)
            sizes = np.where(numbers >= 0, self.sizes[numbers], 0)
            first = np.cumsum(per_text) - per_text
            n = np.add.reduceat(sizes, first)
            if self.byte_level:
                n = n - 1  # the line feed put before the first chunk
            odd = np.flatnonzero(irregular).tolist()
            if odd:
                n[odd] = [len(x) for x in self.whole([group[i] for i in odd])]
            out.append(n)
        return np.concatenate(out)

    def ids(self, texts: list[str]):
        """The ids of each whole text, in order."""
        for group in self._groups(texts):
            if self.kept > self.most:
                self.thin()
            numbers, per_text, irregular = self._look_up(group)
            good = np.where(numbers >= 0, numbers, 0)
            sizes = np.where(numbers >= 0, self.sizes[good], 0)
            ends = np.cumsum(sizes)
            flat = self.pool[np.repeat(self.starts[good] - (ends - sizes), sizes) + np.arange(ends[-1])]
            last = np.cumsum(per_text)
            text_end = ends[last - 1].tolist()
            text_start = (ends - sizes)[last - per_text].tolist()
            lead = 1 if self.byte_level else 0
            for i, text in enumerate(group):
                if irregular[i]:
                    yield self.whole([text])[0]
                else:
                    yield flat[text_start[i] + lead:text_end[i]]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str, most: int = KEPT_CHUNKS) -> ChunkEncoder:
    """The worker's encoder of a tokenizer file, kept between tasks; it remembers ``most`` chunks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    _ENCODERS[path].most = most
    return _ENCODERS[path]
