"""Byte-level BPE encoding and decoding with a contiguous array of adjacent ranks.

A short word is held as two parallel arrays: its parts (ids, whose boundaries they are)
and the rank of each adjacent pair. The minimum of the rank array is looked for again and
again; the boundary at it is deleted and the two neighbouring ranks are looked up anew.
Words that a worker has not met before go through this together, one row of a matrix each.
Words longer than ``LONG_WORD`` bytes would make it quadratic and go through a heap over
linked parts instead, with the same result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import map_batches, remember, type_of, whole_text

#: Fixed value: the published word pattern of byte-level BPE vocabularies of this kind.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_WORD = 64
NO_RANK = np.iinfo(np.int32).max
#: Bytes of words and ids that a worker remembers in each of two generations, and about what
#: an entry takes besides its own. Results don't depend on it.
REMEMBERED, ENTRY = 32 << 20, 200
#: Words per matrix, and characters of text split at a time.
ROWS, CHARACTERS = 2048, 1 << 21


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder of one vocabulary file in the tokenizers library's JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, pre = content["model"], content["pre_tokenizer"] or {}
        plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not plain or content["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        vocab, self.path = model["vocab"], path
        characters = byte_characters()
        to_byte = {c: b for b, c in enumerate(characters)}
        self.first = np.array([vocab[c] for c in characters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        #: by rank: the id of both parts together
        self.merged = np.array([vocab["".join(m)] for m in merges] or [0], np.int64)
        keys, rank = np.unique(left << 32 | right, return_index=True)
        #: sorted (left id << 32 | right id), closed by a key that no pair has, and ranks
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.append(rank, NO_RANK).astype(np.int32)
        self.pairs = dict(zip(keys.tolist(), rank.tolist()))
        self.special = {}
        for token in content["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"{path}: unsupported added token {token['content']!r}")
            self.special[token["content"]] = token["id"]
        self.bytes = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for word, number in vocab.items():
            self.bytes[number] = bytes(to_byte[c] for c in word) if all(c in to_byte for c in word) else word.encode()
        for word, number in self.special.items():
            self.bytes[number] = word.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.word_pattern = regex.compile(WORD_PATTERN)
        self.packed: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.known: set[str] = set()
        self._library = None

    def forget(self) -> None:
        self.packed, self.older, self.held = {}, {}, 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NO_RANK`` where there is none or an id is negative."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NO_RANK)

    def _by_ranks(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of short words."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        parts = np.full((len(words), width + 1), -1, np.int64)
        parts[:, :width][np.arange(width) < lengths[:, None]] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        of, column, out = np.arange(len(words)), np.arange(width), [b""] * len(words)
        while len(of):
            at = ranks.argmin(1)
            row = np.arange(len(of))
            least = ranks[row, at]
            over = least == NO_RANK
            done, step = parts[over].astype("<u4").tobytes(), 4 * (width + 1)
            for i, (n, size) in enumerate(zip(of[over].tolist(), lengths[over].tolist())):
                out[n] = done[i * step : i * step + 4 * size]
            of, parts, ranks, lengths, at, least = (x[~over] for x in (of, parts, ranks, lengths, at, least))
            row = np.arange(len(of))
            moved = np.minimum(column + (column > at[:, None]), width)
            parts[:, :-1] = np.take_along_axis(parts, moved, 1)
            ranks = np.take_along_axis(ranks, np.minimum(column + (column >= at[:, None]), width - 1), 1)
            ranks[:, -1] = NO_RANK
            lengths = lengths - 1
            parts[row, at] = merged = self.merged[least]
            ranks[row, at] = self.rank(merged, parts[row, at + 1])
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.rank(parts[inner, at[inner] - 1], merged[inner])
        return out

    def _remember(self, words: Iterable[list[str]]) -> None:
        """Encode the words that are not remembered."""
        if self.held > REMEMBERED:
            self.older, self.packed, self.held = self.packed, {}, 0
        new = set().union(*words).difference(self.packed)
        known = new.intersection(self.older)
        for word in known:
            self.packed[word] = self.older[word]
        self.held += sum(ENTRY + 5 * len(word) for word in new)
        new = sorted(new - known, key=len)  # rows of a matrix are of about one length
        for start in range(0, len(new), ROWS):
            short, long = [], []
            for word in new[start : start + ROWS]:
                (short if len(word.encode()) <= LONG_WORD else long).append(word)
            if short:
                self.packed.update(zip(short, self._by_ranks([w.encode() for w in short])))
            for word in long:
                parts = self.first[np.frombuffer(word.encode(), np.uint8)].tolist()
                self.packed[word] = np.array(self._by_heap(parts), "<u4").tobytes()

    def _by_heap(self, parts: list[int]) -> list[int]:
        pairs, n = self.pairs, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n and (found := pairs.get(parts[left] << 32 | parts[right])) is not None:
                heapq.heappush(heap, (found, left, parts[left], parts[right]))

        for left in range(n - 1):
            offer(left)
        while heap:
            found, left, a, b = heapq.heappop(heap)
            right = after[left]
            if parts[left] != a or right >= n or parts[right] != b:
                continue  # one of the two has been merged meanwhile
            parts[left], parts[right] = int(self.merged[found]), -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [p for p in parts if p >= 0]

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens.

        Unicode versions differ in what they call a letter. Texts with a character that
        Python does not know are split by the library the vocabulary belongs to.
        """
        if not text.isascii() and not self.known.issuperset(text):
            new = set(text) - self.known
            unknown = {c for c in new if unicodedata.category(c) == "Cn"}
            self.known |= new - unknown
            if unknown:
                if self._library is None:
                    from tokenizers import Tokenizer

                    self._library = Tokenizer.from_file(self.path).pre_tokenizer
                return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return self.word_pattern.findall(text)

    def segments(self, text: str) -> list[list[str] | int]:
        """Lists of words between special tokens, and the ids of those."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return [self.words(text)]
        out, at = [], 0
        for found in self.special_pattern.finditer(text):
            out += [self.words(text[at : found.start()]), self.special[found[0]]]
            at = found.end()
        return [*out, self.words(text[at:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        out, start = [], 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= CHARACTERS):
                size += len(texts[end])
                end += 1
            split = [self.segments(t) for t in texts[start:end]]
            self._remember(words for segments in split for words in segments if isinstance(words, list))
            packed = self.packed.__getitem__
            for segments in split:
                out.append(b"".join(b"".join(map(packed, s)) if isinstance(s, list) else s.to_bytes(4, "little") for s in segments))
            start = end
        return out

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """The vocabulary at ``path``, once per worker process."""
    return ByteBpe(path)


def encode_decode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns per row: ``key``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` (of the decoded text in UTF-8) and
    ``round_trip`` (the decoded text is the input); with ``with_ids`` also ``ids`` (binary)
    and ``decoded``. A null text is an empty one with 0 tokens; null and repeated ids are
    kept as they are, one row out for each row in; other columns are not read. Rows are
    independent: no shuffle, and a lost task repeats only its own rows.
    ``vocabulary`` is a path that every executor can open.
    """

    def make():
        model = load(vocabulary)
        remember("bpe", model.forget)

        def run(columns: dict) -> dict:
            ids = model.encode(columns["text"])
            decoded = [model.decode(i) for i in ids]
            out = {
                "key": columns["key"],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for d in decoded],
                "round_trip": [d == t for d, t in zip(decoded, columns["text"])],
            }
            return out | ({"ids": ids, "decoded": decoded} if with_ids else {})

        return run

    plain = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    ddl = f"key {type_of(docs, key)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return map_batches(plain, make, ddl + (", ids binary, decoded string" if with_ids else ""), "bpe").withColumnRenamed("key", key)
