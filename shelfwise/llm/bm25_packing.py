"""Packing documents into training windows by lexical retrieval.

Documents are tokenised once and stored. Range partitions of a min-hash of their rarer tokens bring like documents together
and are read as shards of bounded size. A shard has an index with BM25 weights from counts over all documents:
each seed document, with all its terms, retrieves its nearest unused neighbours, which fill its window greedily; the last one is cut
to fit and its rest opens the next window, so only the last window of a partition is padded.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import small_batches, stored, tidy

WINDOW = 4096
END_ID = 2
#: Tokens of one index shard; a shard is held in memory by one task.
SHARD_TOKENS = 1 << 21
K1, B = 1.2, 0.75
#: Words and their pieces whose ids a Python worker remembers for good; it remembers as many again for a while.
CACHE_WORDS = 200_000
#: Byte-pair ids grow rarer with their number; those from here on make the min-hash.
RARE_FROM = 2_000
PUNCTUATION = b"!#$%&*+,-./:;<=>?@\\^_`|~()[]{}"


def default_tokenizer() -> str:
    """Contents of the tokenizer file used by default."""
    import public_tokenizers

    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


def _lower_letters(word: str) -> bool:
    return word.isalpha() and word == word.lower() and unicodedata.is_normalized("NFC", word)


class Encoder:
    """Ids of whole texts. The tokenizer drops white space and never joins across it, so words are looked up one by one.

    It also lower-cases and splits punctuation from letters: a word not seen before is put together from its
    letters and the punctuation behind them, each encoded once. Words of letters are encoded many in one text, where the
    tokenizer's mark for the end of a word tells them apart.
    """

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # ids of words and of what words are put together from: a word of one piece has its ids, so one table holds both
        self.known: dict[bytes, bytes] = {}
        # for words of lower-case letters in normal form neither normaliser nor splitting by character class changes anything
        plain = json.loads(tokenizer_json)
        suffix = plain["model"].get("end_of_word_suffix")
        plain |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
        self.letters = Tokenizer.from_str(json.dumps(plain))
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = bool(suffix) and token.endswith(suffix)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _each(self, words: list[bytes]) -> None:
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.known.update(zip(words, (self._bytes(e.ids) for e in encoded), strict=True))

    def _learn_pieces(self, words: list[bytes]) -> None:
        plain = [w for w in words if w.isalpha() or not w.isascii() and _lower_letters(w.decode())] if self.ends.any() else []
        for start in range(0, len(plain), 1000):
            part = plain[start:start + 1000]
            ids = np.array(self.letters.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, self.dtype)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                data, places = ids.tobytes(), [0, *(cuts * self.dtype.itemsize).tolist()]
                self.known.update((w, data[i:j]) for w, i, j in zip(part, places, places[1:], strict=False))
            else:
                self._each(part)
        self._each([w for w in words if w not in self.known])

    def _learn(self, words: list[bytes]) -> None:
        parts = []
        for word in words:
            if b"<|" in word:  # may hold a special token, which is matched before lower-casing
                parts.append((word, b""))
                continue
            low = word.lower()
            core = low.rstrip(PUNCTUATION)
            # behind anything but a letter or digit the punctuation may belong to a longer run
            parts.append((core, low[len(core):]) if core[-1:].isalnum() else (low, b""))
        unseen = {x for pair in parts for x in pair if x}.difference(self.known)
        self._learn_pieces(list(unseen))
        self.known[b""] = b""
        self.known.update((word, self.known[a] + self.known[b]) for word, (a, b) in zip(words, parts, strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``dtype``, the end id last; null counts as empty."""
        parts = [(text or "").encode().split() for text in texts]
        end = self._bytes([END_ID])
        out = []
        for start in range(0, len(parts), 512):
            group = parts[start:start + 512]
            there = set().union(*group)
            unseen = there.difference(self.known)
            if len(self.known) + len(unseen) > 2 * CACHE_WORDS:  # frequent words come early: what came late is forgotten
                self.known = dict(islice(self.known.items(), CACHE_WORDS))
                unseen = there.difference(self.known)
            if unseen:
                self._learn(list(unseen))
            out.extend(b"".join(map(self.known.__getitem__, found)) + end for found in group)
        return out


@lru_cache(maxsize=2)
def _encoder(tokenizer_json: str) -> Encoder:
    return Encoder(tokenizer_json)


def _signature(ids: np.ndarray) -> int:
    """Min-hash of the rarer ids; all ids if none is rare."""
    rare = ids[ids >= RARE_FROM]
    hashed = (rare if len(rare) else ids).astype(np.uint32) * np.uint32(2654435761)
    return int((hashed ^ hashed >> np.uint32(15)).min())


def tokenise(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sig, n, ids) of every row; ids are little-endian, 2 bytes each if the vocabulary fits, else 4."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a fixed file, 1 to 3 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = encoder.encode(part.column(1).to_pylist())
                arrays = [np.frombuffer(x, encoder.dtype) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_signature(a) for a in arrays], pa.int64()),
                     pa.array([len(a) for a in arrays], pa.int64()), pa.array(ids, pa.binary())], ["id", "sig", "n", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, sig long, n long, ids binary")


def _document_frequency(tokens: DataFrame, width: int, vocabulary: int) -> np.ndarray:
    """Number of rows with each id over all rows; a task returns one vector of the vocabulary's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                total[np.unique(np.frombuffer(x.as_buffer(), f"<u{width}"))] += 1
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["term", "n"])

    out = np.zeros(vocabulary, dtype=np.int64)
    for row in tokens.select("ids").mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row.term] = row.n
    return out


class Index:
    """Terms and BM25 weights of the items of one shard, item by item; a query is a sparse product with all of them."""

    def __init__(self, items: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        self.terms, self.weights = [], []
        for ids in items:
            terms, tf = np.unique(ids, return_counts=True)
            norm = K1 * (1 - B + B * len(ids) / mean_length)
            self.terms.append(terms)
            self.weights.append((idf[terms] * tf * (K1 + 1) / (tf + norm)).astype(np.float32))
        self.items = np.arange(len(items))  # those whose postings are still held, in order
        self.flat = np.concatenate(self.terms).astype(np.intp) if items else np.zeros(0, np.intp)
        self.value = np.concatenate(self.weights) if items else np.zeros(0, np.float32)
        self.asked = np.zeros(len(idf), dtype=np.float32)
        self.starts = self._starts()

    def _starts(self) -> np.ndarray:
        return np.cumsum([0, *(len(self.terms[i]) for i in self.items)])[:-1]

    def scores(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Score of every unused item for all terms of the seed; 0 for used ones whose postings are gone."""
        held = self.items[~used[self.items]]
        if len(held) < 0.875 * len(self.items):
            sizes = [len(self.terms[i]) for i in self.items]
            keep = np.repeat(~used[self.items], sizes)
            self.items, self.flat, self.value = held, self.flat[keep], self.value[keep]
            self.starts = self._starts()
        out = np.zeros(len(self.terms), dtype=np.float32)
        if len(self.items):
            self.asked[self.terms[seed]] = 1
            out[self.items] = np.add.reduceat(self.value * self.asked[self.flat], self.starts)
            self.asked[self.terms[seed]] = 0
        return out


class Packer:
    """Fills windows of one partition; a window left open by a shard goes on with the next."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window, self.next_sequence = window, first_sequence
        self.sequence, self.offset = -1, 0  # the open window; none while the offset is 0
        self.rows: list[tuple] = []

    def _number(self) -> int:
        self.next_sequence += 1
        return self.next_sequence - 1

    def place(self, doc: tuple, start: int) -> int:
        """Put what fits of ``doc`` from ``start`` on into the open window; returns where the rest starts."""
        if not self.offset:
            self.sequence = self._number()
        took = min(len(doc[1]) - start, self.window - self.offset)
        self.rows.append((doc, start, took, self.sequence, self.offset))
        self.offset = (self.offset + took) % self.window
        return start + took

    def shard(self, docs: list[tuple], idf: np.ndarray, mean_length: float) -> None:
        """Place every token of ``docs``, (id, ids) each: whole windows on their own, then the rests by retrieval."""
        items = []
        for doc in docs:
            size = len(doc[1]) // self.window * self.window
            self.rows.extend((doc, start, self.window, self._number(), 0) for start in range(0, size, self.window))
            if size < len(doc[1]):
                items.append((doc, size))
        index = Index([doc[1][start:] for doc, start in items], idf, mean_length)
        used = np.zeros(len(items), dtype=bool)
        scores = np.zeros(len(items), dtype=np.float32)
        following = 0  # first item that may be unused
        seeded = False  # whether ``scores`` belong to the seed of the open window
        while True:
            while following < len(items) and used[following]:
                following += 1
            if following == len(items):
                return
            best = following
            if seeded:
                scores[used] = -1
                nearest = int(np.argmax(scores))
                best = nearest if scores[nearest] > 0 else following
            doc, start = items[best]
            used[best] = True
            start = self.place(doc, start)
            cut = start < len(doc[1])
            if cut:  # the rest opens the next window as its seed
                self.place(doc, start)
            if cut or not seeded:
                scores = index.scores(best, used)
            seeded = self.offset > 0


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS, tokenizer_json: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids (binary, little-endian 32-bit), doc_tokens, sequence_id, offset.

    Every token of every row lies in exactly one piece; a text is its ids and then the end id, so null and empty texts
    are one token. Repeated rows are packed as often as they come. Sequence numbers are unique, not gapless.
    An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    tokenizer_json = tokenizer_json or default_tokenizer()
    encoder = Encoder(tokenizer_json)
    width, vocabulary = encoder.dtype.itemsize, encoder.tokenizer.get_vocab_size()
    with small_batches(spark):
        tokens = stored(tokenise(docs, tokenizer_json, id_col, text_col), "tokens")
    rows, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = _document_frequency(tokens, width, vocabulary)
    idf = np.log1p((rows - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    mean_length = total / max(rows, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoder.cache_clear()  # Spark keeps its workers: all texts have their ids now
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        shard: list[tuple] = []
        held = 0

        def emit() -> pa.RecordBatch:
            found, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0][0] for r in found], kind), pa.array([r[1] for r in found], pa.int64()),
                 pa.array([r[2] for r in found], pa.int64()),
                 pa.array([r[0][1][r[1]:r[1] + r[2]].astype("<u4").tobytes() for r in found], pa.binary()),
                 pa.array([len(r[0][1]) for r in found], pa.int64()), pa.array([r[3] for r in found], pa.int64()),
                 pa.array([r[4] for r in found], pa.int64())],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(ids.as_py(), f"<u{width}")
                if held and held + len(own) > shard_tokens:
                    packer.shard(shard, idf, mean_length)
                    shard, held = [], 0
                    yield emit()
                shard.append((key, own))
                held += len(own)
        if shard:
            packer.shard(shard, idf, mean_length)
            yield emit()

    kind_sql = tokens.schema["id"].dataType.simpleString()
    parts = max(1, min(-(-total // shard_tokens), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed = (
        tokens.repartitionByRange(parts, "sig", "id").sortWithinPartitions("sig", "id").select("id", "ids")
        .mapInArrow(tidy(run), f"id {kind_sql}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    )
    return placed.withColumnRenamed("id", id_col)
