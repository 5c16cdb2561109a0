"""Byte-level BPE encoding and decoding in batched merge rounds.

The words of a chunk of texts are encoded together: the symbols of all new words lie
in one flat array, the rank of a neighbouring pair is found by binary search over the
sorted pair keys of the vocabulary, and each round merges the lowest-ranked pair of
every word at once. A merge can only make pairs of higher rank than its own, so all
places of a word's lowest pair are merged in the same round, from the left.

Texts are whole. Null counts as empty; an empty text has no tokens. The strings of
added tokens stand for their ids wherever they occur, as in the library.

Rows may repeat; an empty table gives an empty table. Other columns pass through; the added ``ids`` and ``decoded``
replace the caller's. A long text is a chunk of its own, in memory some tens of times its size.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import chunks, widened

# Fixed value: the split pattern of byte-level BPE vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.iinfo(np.int64).max
REMEMBERED_WORDS = 200_000
REMEMBERED_BYTES = 16 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: itself if printable, else the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Sorted pair keys, their ranks and products, and the bytes of every token. Its size is the vocabulary's."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, alphabet = spec["model"]["vocab"], byte_alphabet()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*ids.values(), *added.values()])
        tokens = [b""] * self.size
        for token, i in ids.items():
            tokens[i] = bytes(alphabet[c] for c in token)
        for token, i in added.items():
            tokens[i] = token.encode()
        self.added = added
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.symbol = np.zeros(256, np.int64)
        for shown, byte in alphabet.items():
            self.symbol[byte] = ids[shown]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.products = np.array([ids[a + b] for a, b in pairs], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and the end of each word in it."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        ranks = np.full(len(symbols), NO_RANK)
        inner = np.flatnonzero(word[1:] == word[:-1])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(ranks, first)
            spread = np.repeat(lowest, np.diff(np.append(first, len(word))))
            over = spread == NO_RANK
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                going = ~over
                symbols, word, ranks, spread = symbols[going], word[going], ranks[going], spread[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == spread)
            new_run = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (word[at[1:]] != word[at[:-1]])])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]  # in "aaa" only the first pair
            symbols[at] = self.products[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            moved = (np.cumsum(keep) - 1)[at]
            symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
            changed = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            ranks[changed] = NO_RANK
            inside = changed[changed + 1 < len(word)]
            inside = inside[word[inside] == word[inside + 1]]
            ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        all_words = np.concatenate([np.zeros(0, np.int64), *done_words])
        order = np.argsort(all_words, kind="stable")
        ends = np.cumsum(np.bincount(all_words, minlength=len(words)))
        return np.concatenate([np.zeros(0, np.int64), *done_symbols])[order], ends

    def spans(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Positions start, start + 1, … of every span, one after the other."""
        skip = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return np.arange(len(skip)) + skip

    def decode(self, ids: np.ndarray, row_sizes: np.ndarray) -> list[str]:
        starts, sizes = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        data = self.bytes[self.spans(starts, sizes)].tobytes()
        token_ends = np.concatenate([[0], np.cumsum(sizes)])
        row_ends = token_ends[np.concatenate([[0], np.cumsum(row_sizes)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(row_ends, row_ends[1:])]


class Encoder:
    """A vocabulary with the words it has met; the memory is emptied before it outgrows its bounds."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(SPLIT).findall
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, added)) + ")").split if added else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.held = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def words(self, text: str) -> list[str]:
        if self.apart is None:
            return self.split(text)
        pieces = self.apart(text)
        if len(pieces) == 1:
            return self.split(text)
        words: list[str] = []
        for i, piece in enumerate(pieces):
            words += [piece] if i % 2 else self.split(piece)
        return words

    def learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if not new:
            return
        added = self.vocabulary.added
        plain = [w for w in new if w not in added]
        special = [w for w in new if w in added]
        ids, ends = self.vocabulary.merge([w.encode() for w in plain])
        for i, word in enumerate([*plain, *special], len(self.known)):
            self.known[word] = i
        base = self.starts[-1]
        own = np.array([added[w] for w in special], np.int64)
        self.ids = np.concatenate([self.ids, ids, own]).astype(np.int32)
        self.starts = np.concatenate([self.starts, base + ends, base + len(ids) + 1 + np.arange(len(own))])
        self.held += sum(map(len, new))

    def encode(self, texts: list[str]) -> pa.ListArray:
        if len(self.known) > REMEMBERED_WORDS or self.held > REMEMBERED_BYTES:
            self.forget()
        split = [self.words(t) for t in texts]
        words = [w for ws in split for w in ws]
        self.learn(words)
        known = self.known
        which = np.fromiter((known[w] for w in words), np.int64, len(words))
        starts, sizes = self.starts[which], self.starts[which + 1] - self.starts[which]
        ids = self.ids[self.vocabulary.spans(starts, sizes)]
        token_ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = token_ends[np.concatenate([[0], np.cumsum([len(ws) for ws in split])]).astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


Batches = Iterator[pa.RecordBatch]


def _encoding(vocabulary: Vocabulary, text: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encoder = Encoder(vocabulary)
        for batch, texts in chunks(batches, text):
            ids = encoder.encode([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return run


def _decoding(vocabulary: Vocabulary) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            step = max(1, batch.num_rows * (1 << 19) // max(1, len(batch.column("ids").values)))
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                lists = part.column("ids")
                sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                texts = vocabulary.decode(lists.flatten().to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``ids``: the tokens of every whole text.

    ``path`` names a tokenizer file the driver can read; the vocabulary, whose size does not
    depend on the data, travels to the tasks with the function.
    """
    kept = docs.drop("ids")
    return kept.mapInArrow(_encoding(Vocabulary(path), text), widened(kept, ids="array<int>"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text its ``ids`` stand for."""
    kept = encoded.drop("decoded")
    return kept.mapInArrow(_decoding(Vocabulary(path)), widened(kept, decoded="string"))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``decode`` of ``encode``, without the text: one Python worker a task does both, and ids pass from one to the other."""
    vocabulary, kept = Vocabulary(path), docs.drop("ids", "decoded")

    def run(batches: Batches) -> Batches:
        ids = (batch.drop_columns([text]) for batch in _encoding(vocabulary, text)(batches))
        yield from _decoding(vocabulary)(ids)

    return kept.mapInArrow(run, widened(kept.drop(text), ids="array<int>", decoded="string"))


def digests(docs: DataFrame, path: str, *keys: str) -> DataFrame:
    """Per row of ``docs`` its ``keys``, the number of tokens, and digests of the ids and of the decoded text."""
    coded = round_trip(docs.select(*keys, "text"), path)
    return coded.select(
        *keys,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
