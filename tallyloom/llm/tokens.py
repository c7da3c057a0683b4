"""Encoding a corpus with a public byte-level BPE vocabulary by replaying its merges over all different words at once.

Texts are split into words by the JVM (the vocabulary's own split pattern), sent as Arrow lists, and dictionary-encoded.
The different words of a batch that were not met before form one symbol array. An inverted index maps every token pair to
the positions where it stands; merges are applied in rank order, each touching only the positions listed for its pair and
the two neighbours of each, whose new pairs enter the index. Ids of texts are then gathered by word code.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as the vocabulary's splitter has it, as a Java character class body.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split pattern of the byte-level vocabularies. Every character of a text falls into exactly one word.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + "]+"
)
#: Words kept in a worker's memory between batches; beyond that the memory is emptied, which changes no result.
CACHE_WORDS = 1_000_000


def vocabulary_file(name: str = "byte_bpe_50k") -> str:
    """The place of a public vocabulary: the folder in TOKENIZER_DIR, else the installed package of vocabularies."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, f"{name}.json")
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json")


def _printable_bytes() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next letter from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class MergeReplay:
    """A vocabulary with its merges, and the ids of all words met so far."""

    byte_ids: np.ndarray
    pair_keys: np.ndarray  # sorted left << 32 | right
    pair_ranks: np.ndarray
    merged: list[int]  # by rank
    token_bytes: list[bytes]
    ranks: dict[int, int]
    codes: dict[str, int] = field(default_factory=dict)
    flat: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def encode_words(self, words: list[str]) -> np.ndarray:
        """The place of each word in flat/starts; words not met before are encoded together."""
        if len(self.codes) > CACHE_WORDS:
            self.codes, self.flat, self.starts = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        new = [w for w in words if w not in self.codes]
        if new:
            base = len(self.codes)
            self.codes.update((w, base + i) for i, w in enumerate(new))
            ids, starts = self._replay([w.encode("utf-8", "surrogatepass") for w in new])
            self.starts = np.concatenate([self.starts, starts[1:] + self.starts[-1]])
            self.flat = np.concatenate([self.flat, ids])
        return np.fromiter((self.codes[w] for w in words), np.int64, len(words))

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joined = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n = len(joined)
        first = self.byte_ids[joined]
        word_last = np.zeros(n, bool)
        word_last[ends - 1] = True
        # the inverted index: for each pair, by its rank, the positions of its left token
        keys = (first[:-1].astype(np.int64) << 32) | first[1:]
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == keys) & ~word_last[:-1]
        places, ranks = np.nonzero(known)[0], self.pair_ranks[at[known]]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        groups = np.flatnonzero(np.diff(ranks, prepend=-1))
        index = {int(r): p.tolist() for r, p in zip(ranks[groups], np.split(places, groups[1:]))} if len(ranks) else {}

        sym = first.tolist()
        right = np.where(word_last, -1, np.arange(1, n + 1)).tolist()
        word_first = np.concatenate([[True], word_last[:-1]]) if n else word_last
        left = np.where(word_first, -1, np.arange(-1, n - 1)).tolist()
        heap = list(index)
        heapq.heapify(heap)
        rank_of, merged, heads = self.ranks, self.merged, self.heads
        while heap:
            rank = heapq.heappop(heap)
            new = merged[rank]
            a, b = heads[rank]
            for p in sorted(index.pop(rank)):
                q = right[p]
                if sym[p] != a or q < 0 or sym[q] != b:
                    continue  # a merge nearby took one of the two
                after, before = right[q], left[p]
                sym[p], sym[q] = new, -1
                right[p] = after
                if after >= 0:
                    left[after] = p
                    r = rank_of.get(new << 32 | sym[after])
                    if r is not None:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            heapq.heappush(heap, r)
                if before >= 0:
                    r = rank_of.get(sym[before] << 32 | new)
                    if r is not None:
                        if r in index:
                            index[r].append(before)
                        else:
                            index[r] = [before]
                            heapq.heappush(heap, r)
        out = np.array(sym, np.int32)
        kept = out >= 0
        counts = np.concatenate([[0], np.cumsum(kept)])
        return out[kept], counts[np.concatenate([[0], ends])]

    @functools.cached_property
    def token_sizes(self) -> np.ndarray:
        """The bytes of each token."""
        return np.fromiter(map(len, self.token_bytes), np.int64, len(self.token_bytes))

    @functools.cached_property
    def heads(self) -> list[tuple[int, int]]:
        pairs = np.empty(len(self.pair_keys), np.int64)
        pairs[self.pair_ranks] = self.pair_keys
        return [(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in pairs]


@functools.lru_cache(maxsize=4)
def replay(path: str) -> MergeReplay:
    """The vocabulary in a tokenizer file, read once in each worker process."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, letters = model["vocab"], _printable_bytes()
    byte_ids = np.zeros(256, np.int64)
    token_bytes = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        token_bytes[i] = bytes(letters.get(c, 0) for c in token)
        if len(token) == 1 and token in letters:
            byte_ids[letters[token]] = i
    ranks: dict[int, int] = {}
    merged: list[int] = []
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        ranks[vocab[a] << 32 | vocab[b]] = rank
        merged.append(vocab[a + b])
    keys = np.fromiter(ranks, np.int64, len(ranks))
    order = np.argsort(keys)
    return MergeReplay(byte_ids, keys[order], np.fromiter(ranks.values(), np.int64, len(ranks))[order], merged, token_bytes, ranks)


def ship_vocabulary(spark: SparkSession, path: str) -> str:
    """Sends the tokenizer file to the executors, once a context, and returns the name they know it by."""
    name = os.path.basename(path)
    if (id(spark.sparkContext), path) not in _SENT:
        spark.sparkContext.addFile(path)
        _SENT.add((id(spark.sparkContext), path))
    return name


_SENT: set[tuple[int, str]] = set()


def sent_replay(name: str) -> MergeReplay:
    """The vocabulary of a file that was sent, in a worker process."""
    return replay(SparkFiles.get(name))


def gather(flat: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches flat[starts[c]:starts[c + 1]] of all codes c one after another, and the end of each."""
    sizes = starts[codes + 1] - starts[codes]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[codes] - (ends - sizes), sizes) + np.arange(total)], ends


@dataclass
class EncodedBatch:
    """Words of a batch of texts: row_words[i]:row_words[i + 1] are those of row i."""

    row_words: np.ndarray
    words: list[str]  # the different ones
    word: np.ndarray  # which of them, by word position
    code: np.ndarray  # place in the replay, by different word


def encode_batch(words: pa.Array, model: MergeReplay) -> EncodedBatch:
    sizes = np.array([0] * len(words)) if not len(words) else np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    different = coded.dictionary.to_pylist()
    return EncodedBatch(np.concatenate([[0], np.cumsum(sizes)]), different, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), model.encode_words(different))


def words_of(text: Column) -> Column:
    """The words of a text, by the JVM."""
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def encode_corpus(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids): the token ids of each text, without special tokens; names of special tokens in a text are ordinary text.

    ids is [] for an empty text and for a null one. Each row of df gives one row, repeated keys and null keys as well; other
    columns are not read. Rows are encoded where they lie, without a shuffle; a text may be of any length.
    """
    name = ship_vocabulary(df.sparkSession, path or vocabulary_file())
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent_replay(name)
        kind = pa.list_(pa.field("element", pa.int32(), False))
        for batch in batches:
            e = encode_batch(batch.column(1), model)
            ids, ends = gather(model.flat, model.starts, e.code[e.word])
            offsets = np.concatenate([[0], ends])[e.row_words].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), type=kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=schema.names)

    return df.select(F.col(key), words_of(F.col(text)).alias("words")).mapInArrow(encode, schema)


def count_tokens(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, n_tokens): the number of tokens of each text, 0 for an empty or null one; the same replay without its ids."""
    name = ship_vocabulary(df.sparkSession, path or vocabulary_file())
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType(), False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent_replay(name)
        for batch in batches:
            e = encode_batch(batch.column(1), model)
            sizes = model.starts[e.code + 1] - model.starts[e.code]
            upto = np.concatenate([[0], np.cumsum(sizes[e.word])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(upto[e.row_words]), pa.int64())], names=schema.names)

    return df.select(F.col(key), words_of(F.col(text)).alias("words")).mapInArrow(count, schema)
