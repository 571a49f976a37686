"""Language-model scoring by online logistic context mixing.

A text is the sequence of its lower-cased words and an end mark. A frequent word is one symbol of a code tree built from the
corpus, a rare one an escape symbol and then its bytes in a second tree, so every text has a probability. A symbol is a path
of binary decisions. Hashed contexts (the word before and the place in the sentence; in a spelled word its last bytes)
each predict a decision from counts over all training documents; a gate picks the weights that combine them in the logistic
domain, the weights learn online, and an adaptive probability map refines the result. Decisions are scored in lanes of fixed
length that start from trained weights: long texts need no more memory, and thousands of lanes advance together.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import small_batches, stored, tidy, words

#: The token that ends a text; words are never empty.
END = b""
#: Frequent tokens that are symbols of their own.
VOCABULARY = 1 << 18
#: Tokens seen less often are spelled, so that the corpus teaches how new words look.
MIN_COUNT = 2
#: Most frequent tokens whose counts every worker holds; rarer ones are looked up by a join.
TOP_TOKENS = 1 << 18
#: Byte symbols: 256 bytes and the end of a spelled word. Fewer than the characters of a string, with the vocabulary.
BYTES = 257
SPELLED, ESCAPE, FIRST_WORD = chr(BYTES - 1), chr(BYTES), BYTES + 1
#: Contexts of a symbol, with 2 ** TABLE_BITS hashed slots each. The topic is the last very frequent word before it. Words: none,
#: the topic, topic and tail of the word before, the word before. Bytes of a spelled word: topic and the last 2, topic and 3, 4, 1.
CONTEXTS = 4
TABLE_BITS = 21
#: Decisions of a lane; its weights and map start afresh.
LANE = 1024
#: Decisions of a lane that are predicted before its weights learn from them.
STEP = 8
GATES = 8
FREQUENT = 32
#: Tails up to this one end a sentence: the end mark, a full stop.
ENDS = 1
#: Logits are kept within this bound; the map has a cell for each half of it.
BOUND = 10
BUCKETS = 4 * BOUND + 1
RATE, MAP_RATE = 0.03, 0.02
#: Passes over the first texts of a task that fits starting weights; later texts are met once, at the rate of the last pass.
WARM_RATES = (0.03, 0.03, 0.01, 0.01, RATE)
#: Counts of a slot are sent to tasks as numbers below 256: exact up to this one, then by steps of a tenth, enough for 2 ** 33.
EXACT = 63
_GROUP = 1 << 17
_BLOCK = 1 << 15


def tree(frequency: Iterable[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Huffman code of symbols with these frequencies: length of each path, then inner nodes and bits of all paths from the root on.

    Unseen symbols count once.
    """
    heap = [(max(int(n), 1), i) for i, n in enumerate(frequency)]
    count = len(heap)
    heapq.heapify(heap)
    parent, bit = np.full(2 * count - 1, -1, np.int32), np.zeros(2 * count - 1, np.int8)
    for inner in range(count, 2 * count - 1):
        (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = inner
        bit[b] = 1
        heapq.heappush(heap, (n + m, inner))
    length, at = np.zeros(count, np.int32), np.arange(count, dtype=np.int32)
    while (up := parent[at] >= 0).any():
        length += up
        at = np.where(up, parent[at], at)
    end = np.cumsum(length, dtype=np.int64)
    nodes, bits = np.empty(int(end[-1]), np.uint32), np.empty(int(end[-1]), np.int8)
    at, back = np.arange(count, dtype=np.int32), 1
    while (up := parent[at] >= 0).any():
        nodes[end[up] - back], bits[end[up] - back] = parent[at[up]] - count, bit[at[up]]
        at, back = np.where(up, parent[at], at), back + 1
    return length, nodes, bits


class Code(dict):
    """Symbols of tokens as characters of a string, and the path of each symbol.

    Symbols are the bytes, the end of a spelled word, the escape and the vocabulary, in this order; a symbol's character has its number.
    """

    def __init__(self, vocabulary: list[bytes], counts: list[int], escapes: int, byte_counts: np.ndarray) -> None:
        bytes_length, bytes_nodes, bytes_bits = tree(byte_counts)
        words_length, words_nodes, words_bits = tree([escapes, *counts])
        self.length = np.concatenate([bytes_length, words_length])
        self.begin = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        # a filling behind all paths completes the last step of a text; its sign is 0
        nothing = np.zeros(STEP, np.uint32)
        self.filling = int(self.begin[-1])
        self.nodes = np.concatenate([bytes_nodes + np.uint32(len(words_length)), words_nodes, nothing]) * np.uint32(0xC2B2AE35)
        self.signs = np.concatenate([bytes_bits * 2 - 1, words_bits * 2 - 1, nothing.astype(np.int8)]).astype(np.float32)
        # words: by depth in the tree; bytes: by place in the word, added per symbol
        depth = np.arange(len(words_nodes), dtype=np.int32) - np.repeat((np.cumsum(words_length) - words_length).astype(np.int32), words_length)
        depth = np.minimum(depth >> 2, 3).astype(np.int8)
        self.gates = np.concatenate([np.full(len(bytes_nodes), 4, np.int8), depth, nothing.astype(np.int8)])
        # last byte of each token, moved behind the marks of ends; the escape has none
        last = [(0 if token == END else ENDS if token[-1:] in (b".", b"!", b"?") else token[-1] + 2) for token in vocabulary]
        self.tails = np.array([*[0] * BYTES, ENDS + 257, *last], np.uint32)
        self.ranks = np.full(FIRST_WORD + len(vocabulary), -1, np.int32)
        self.ranks[FIRST_WORD:FIRST_WORD + FREQUENT] = np.arange(min(FREQUENT, len(vocabulary)))
        self.ranks[FIRST_WORD + vocabulary.index(END)] = FREQUENT
        super().__init__((token, chr(FIRST_WORD + i)) for i, token in enumerate(vocabulary))

    def __missing__(self, token: bytes) -> str:
        return ESCAPE + str(token, "latin-1") + SPELLED

    def symbols(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, an end before and after each, and how many each has."""
        end = self[END]
        joined = ["".join([end, *map(self.__getitem__, found), end]) for found in texts]
        numbers = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<i4")
        return numbers, np.array(list(map(len, joined)), np.int64)


@dataclass
class Decisions:
    """Decisions of several texts in a row: slot per context, sign of the bit, gate per step (if filled up); ``starts`` has each text's first and the end."""

    slots: np.ndarray
    signs: np.ndarray
    gates: np.ndarray
    starts: np.ndarray


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value * np.uint32(0x9E3779B1)
    value ^= value >> np.uint32(15)
    return value


def decisions(texts: list[list[bytes]], code: Code, bits: int = TABLE_BITS, fill: bool = False) -> Decisions:
    """Decisions of texts given as words without the end; with ``fill``, each text is filled up to whole steps."""
    # the end before each text isn't scored; it gives the first word a context
    symbols, sizes = code.symbols(texts)
    scored = np.ones(len(symbols), bool)
    scored[np.cumsum(sizes) - sizes] = False
    place = np.arange(len(symbols), dtype=np.int32)
    is_word = symbols >= BYTES
    # the last word symbol at or before each place, then the ones before it
    here = np.maximum.accumulate(np.where(is_word, place, 0))
    at = np.flatnonzero(scored)
    own, head = symbols[at], here[at]
    word = is_word[at]
    tail = code.tails[symbols[here[np.maximum(head - 1, 0)]]]
    # the last very frequent word before each word, an end included
    frequent = np.maximum.accumulate(np.where(is_word & (code.ranks[symbols] >= 0), place, 0))
    topic = code.ranks[symbols[frequent[np.maximum(head - 1, 0)]]].astype(np.uint32)
    in_word = (at - head).astype(np.int32)
    last = [_mixed(symbols[np.maximum(at - back, head)].astype(np.uint32) + np.uint32(back)) for back in (1, 2, 3, 4)]
    second = _mixed(last[0] + last[1])
    third = _mixed(second + last[2])
    one = np.where(word, np.uint32(1), _mixed(topic + second))
    two = _mixed(topic + np.where(word, np.uint32(5), third))
    three = np.where(word, _mixed(_mixed(topic + np.uint32(77)) + tail), _mixed(third + last[3]))
    four = np.where(word, _mixed(symbols[here[np.maximum(head - 1, 0)]].astype(np.uint32) + np.uint32(99)), last[0])
    length, begin = code.length[own], code.begin[own]
    kept = np.concatenate([[0], np.cumsum(sizes - 1)])
    if fill:
        # the filling follows the last symbol of a text, as a symbol of its own with the same contexts
        missing = -np.add.reduceat(length, kept[:-1]) % STEP if len(texts) else length
        ends = kept[1:]
        length, begin = np.insert(length, ends, missing), np.insert(begin, ends, code.filling)
        one, two, three, four = (np.insert(x, ends, 0) for x in (one, two, three, four))
        word, in_word = np.insert(word, ends, True), np.insert(in_word, ends, 0)
        kept = kept + np.arange(len(kept))
    offsets = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
    owner = np.repeat(np.arange(len(length), dtype=np.int32), length)
    step = (begin - offsets[:-1]).astype(np.int32).take(owner, mode="clip")
    step += np.arange(offsets[-1], dtype=np.int32)
    node = code.nodes.take(step, mode="clip")
    slots = np.empty((CONTEXTS, offsets[-1]), np.uint32)
    for k, context in enumerate((one, two, three, four)):
        value = (context * np.uint32(0x9E3779B1)).take(owner, mode="clip")
        value += node
        np.right_shift(value, np.uint32(32 - bits), out=slots[k])
    # a gate holds for a step; it is that of its first decision
    gates = np.zeros(0, np.int8)
    if fill:
        gates = code.gates.take(step[::STEP], mode="clip")
        gates += np.where(word, 0, np.minimum(in_word, 4) - 1).astype(np.int8).take(owner[::STEP], mode="clip")
    return Decisions(slots, code.signs.take(step, mode="clip"), gates, offsets[kept])


def groups(texts: Iterable[tuple], limit: int = _GROUP) -> Iterator[list[tuple]]:
    """Tuples that end in a list of words, in groups of about ``limit`` words."""
    group, size = [], 0
    for item in texts:
        group.append(item)
        size += len(item[-1]) + 1
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def stretch(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


def mix(inputs: np.ndarray, found: Decisions, weights: np.ndarray, rate: float = RATE, scored: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of each text, and the mean of the final weights of its lanes.

    ``inputs`` are the stretched predictions, one array per context; decisions are filled up to steps. All lanes take their next step together.
    Without ``scored`` only the weights are learned, and probabilities are left at 1.
    """
    starts = found.starts
    sizes = np.diff(starts)
    lanes = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(sizes)), lanes)
    first = starts[owner] + LANE * (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    size = np.minimum(LANE, starts[owner + 1] - first) // STEP
    order = np.argsort(-size, kind="stable")
    first, size, owner = first[order] // STEP, size[order], owner[order]
    if not len(order):
        return np.zeros(len(sizes)), weights
    steps = [x.reshape(-1, STEP) for x in inputs]
    signs, gates = found.signs.reshape(-1, STEP), found.gates
    own = np.tile(weights, (len(order), 1, 1)).reshape(-1, CONTEXTS + 1)
    centre = BUCKETS // 2
    initial = (1 / (1 + np.exp(-(np.arange(BUCKETS) - centre) / 2))).astype(np.float32)
    table = np.tile(initial, len(order) * GATES)
    total, product = np.zeros(len(order)), np.ones(len(order))
    lane = np.arange(len(order)) * GATES
    running = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # lanes longer than t
    half, rate = np.float32(0.5), np.float32(rate)
    for t in range(int(size[0])):
        active = running[t]
        rows = first[:active] + t
        x = [k.take(rows, axis=0, mode="clip") for k in steps]
        sign = signs.take(rows, axis=0, mode="clip")
        at = lane[:active] + gates.take(rows, mode="clip")
        w = own.take(at, axis=0, mode="clip")
        dot = x[0] * w[:, 0:1]
        for k in range(1, CONTEXTS):
            dot += x[k] * w[:, k:k + 1]
        dot += w[:, CONTEXTS:]
        np.minimum(dot, np.float32(BOUND), out=dot)
        np.maximum(dot, np.float32(-BOUND), out=dot)
        p = np.exp(-sign * dot)
        p += 1
        np.reciprocal(p, out=p)  # of the bit that came
        error = (1 - p) * sign
        error *= rate
        for k in range(CONTEXTS):
            w[:, k] += np.einsum("ij,ij->i", error, x[k])
        w[:, CONTEXTS] += error.sum(axis=1)
        own[at] = w
        if not scored:
            continue
        dot *= 2
        dot += centre + half
        cell = dot.astype(np.int32)
        cell += (at * BUCKETS).astype(np.int32)[:, None]
        refined = table.take(cell, mode="clip")
        missed = sign * half
        missed += half
        missed -= refined
        refined += np.float32(MAP_RATE) * missed
        table[cell] = refined
        p -= np.abs(missed)
        p += 1
        p *= half
        np.maximum(p, np.float32(1e-6), out=p)
        ended = running[t + 1] if t + 1 < len(running) else 0
        if ended < active:  # the filling of the last step of a text counts nothing
            p[ended:][sign[ended:] == 0] = 1
        product[:active] *= p.prod(axis=1)
        if t % 4 == 3:
            total += np.log(product)
            product[:] = 1
    total += np.log(product)
    out = np.zeros(len(sizes))
    np.add.at(out, owner, total)
    return out, own.reshape(len(order), GATES, -1).mean(axis=0)


def start_weights() -> np.ndarray:
    """Weights before any fitting: predictions share alike, the constant is silent."""
    weights = np.full((GATES, CONTEXTS + 1), 0.3, np.float32)
    weights[:, CONTEXTS] = 0
    return weights


def inputs_of(parts: list[Decisions], stretched: np.ndarray) -> list[np.ndarray]:
    """Predictions of every context for the decisions of all parts."""
    size = sum(len(part.signs) for part in parts)
    out = [np.empty(size, np.float32) for _ in range(CONTEXTS)]
    at = 0
    for part in parts:
        for k in range(CONTEXTS):
            stretched[k].take(part.slots[k], mode="clip", out=out[k][at:at + len(part.signs)])
        at += len(part.signs)
    return out


def together(parts: list[Decisions]) -> Decisions:
    """Parts as one, without their slots."""
    shift = np.cumsum([0, *(part.starts[-1] for part in parts)])
    starts = np.concatenate([[0], *(part.starts[1:] + s for part, s in zip(parts, shift, strict=False))]).astype(np.int64)
    return Decisions(np.zeros((CONTEXTS, 0), np.uint32), np.concatenate([p.signs for p in parts]), np.concatenate([p.gates for p in parts]), starts)


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as numbers below 256."""
    counts = counts.astype(np.float64)
    return np.where(counts <= EXACT, counts, np.minimum(EXACT + 1 + np.floor(np.log(np.maximum(counts, 1) / (EXACT + 1)) * 10), 255)).astype(np.uint16)


def decoded() -> np.ndarray:
    """The count that each number below 256 stands for."""
    code = np.arange(256)
    return np.where(code <= EXACT, code, (EXACT + 1) * np.exp((code - EXACT - 0.5) / 10))


def stretches(cells: np.ndarray) -> np.ndarray:
    """Stretched predictions of cells: coded ones in the high byte, coded zeros in the low one."""
    counts = decoded()
    return stretch(counts[:, None], counts[None, :]).reshape(-1).take(cells, mode="clip")


def left_out(parts: list[Decisions], cells: np.ndarray) -> list[np.ndarray]:
    """Predictions of every context for the decisions of training texts, each from the counts without this decision."""
    counts = decoded()
    less = np.maximum(counts - 1, 0)
    # rows: the bit was 0, the decision is a filling, the bit was 1
    table = np.stack([stretch(counts[:, None], less[None, :]), stretch(counts[:, None], counts[None, :]), stretch(less[:, None], counts[None, :])]).reshape(-1)
    out = [np.empty(sum(len(part.signs) for part in parts), np.float32) for _ in range(CONTEXTS)]
    at = 0
    for part in parts:
        row = (part.signs.astype(np.int32) + 1) << 16
        for k in range(CONTEXTS):
            table.take(row + cells[k].take(part.slots[k], mode="clip"), mode="clip", out=out[k][at:at + len(row)])
        at += len(row)
    return out


def learn(texts: Iterable[list[bytes]], code: Code, cells: np.ndarray, bits: int = TABLE_BITS) -> tuple[np.ndarray, int]:
    """Starting weights fitted on training texts, and the number of decisions they come from."""
    weights, size = start_weights(), 0
    for group in groups((x,) for x in texts):
        parts = [decisions([x for x, in part], code, bits, fill=True) for part in groups(group, 1 << 15)]
        inputs, found = left_out(parts, cells), together(parts)
        del parts
        for rate in WARM_RATES[-1:] if size else WARM_RATES:
            weights = mix(inputs, found, weights, rate, scored=False)[1].astype(np.float32)
        size += len(found.signs)
    return weights, size


def is_training(id_col: str = "doc_id", folds: int = 5, held_out_fold: int = 1) -> Column:
    """Rows to learn from: crc32 of the id as text has another remainder. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != held_out_fold, F.lit(True))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    for batch in batches:
        for x in batch.column(0):
            yield words(x.as_py())


def token_counts(train: DataFrame, texts_at_once: int = 512, flush: int = 500_000) -> DataFrame:
    """(token, n) over all training texts, ends included; counted a few texts at a time and added up per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def added() -> pa.Table:
            total = pa.concat_tables(parts).group_by("token").aggregate([("n", "sum")])
            return pa.table({"token": total.column("token"), "n": total.column("n_sum")})

        for batch in batches:
            for start in range(0, batch.num_rows, texts_at_once):
                texts = batch.column(0).slice(start, texts_at_once)
                tokens = pc.list_flatten(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
                found = pc.value_counts(tokens.filter(pc.not_equal(tokens, "")))
                parts.append(pa.table({"token": found.field(0).cast(pa.binary()), "n": found.field(1)}))
                parts.append(pa.table({"token": pa.array([END], pa.binary()), "n": pa.array([len(texts)], pa.int64())}))
                if sum(part.num_rows for part in parts) > 4 * flush:
                    parts = [added()]
                    if parts[0].num_rows > flush:
                        yield from parts.pop().to_batches()
        if parts:
            yield from added().to_batches()
        pa.default_memory_pool().release_unused()

    return train.select("text").mapInArrow(tidy(run), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """What scoring needs besides the tables: the most frequent tokens with counts, totals, spelled bytes. All of bounded size."""

    tokens: list[bytes]
    counts: list[int]
    total: int
    distinct: int
    escapes: int
    byte_counts: np.ndarray
    known: int

    def code(self) -> Code:
        """The same code in every process; built once in each."""
        key = self.total, self.distinct, self.escapes
        if key not in _CODES:
            _CODES.clear()
            vocabulary, counts = self.tokens[:self.known], self.counts[:self.known]
            if END not in vocabulary:
                vocabulary, counts = [*vocabulary, END], [*counts, 1]
            _CODES[key] = Code(vocabulary, counts, self.escapes, self.byte_counts)
        return _CODES[key]


_CODES: dict[tuple, Code] = {}


def _model(counts: DataFrame) -> Model:
    """Totals and top tokens of stored counts. The end is always among them."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    order = [F.col("token") != F.lit(END), F.col("n").desc(), "token"]  # the end first
    top = counts.orderBy(*order).limit(TOP_TOKENS).toArrow()
    ranked = sorted(zip(top.column("token").to_pylist(), top.column("n").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    tokens, numbers = [t for t, _ in ranked], [n for _, n in ranked]
    known = min(VOCABULARY, sum(n >= MIN_COUNT for n in numbers))
    chosen = frozenset([*tokens[:known], END])  # the end has a symbol of its own, however rare

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(BYTES + 1, np.int64)  # bytes, ends of words, escapes
        for batch in batches:
            rare = [(t, n) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t not in chosen]
            if rare:
                data = np.frombuffer(b"".join(t for t, _ in rare), np.uint8)
                each = np.array([n for _, n in rare], np.int64)
                out[:256] += np.bincount(data, weights=np.repeat(each, [len(t) for t, _ in rare]), minlength=256).astype(np.int64)
                out[256:] += each.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BYTES + 1)), pa.array(out)], ["byte", "n"])

    found = np.zeros(BYTES + 1, np.int64)
    for row in counts.select("token", "n").mapInArrow(tidy(spelled), "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        found[row.byte] = row.n
    return Model(tokens, numbers, int(total), int(distinct), int(found[BYTES]), found[:BYTES], known)


def _tables(train: DataFrame, shared: Broadcast, bits: int) -> DataFrame:
    """(block, counts): ones and zeros of every slot over all training texts, in blocks of ``_BLOCK`` slots of all contexts.

    A task adds up its texts in memory of fixed size. Blocks of tasks are added up by streams in two rounds, first for
    groups of about the square root of all tasks, so that no task reads one block from all of them.
    """
    slots = CONTEXTS << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value.code()
        table = np.zeros((slots, 2), np.uint32).reshape(-1)
        used = False
        for group in groups((x,) for x in _texts(batches)):
            for part in groups(group, 1 << 15):
                used = True
                found = decisions([x for x, in part], code, bits)
                for k in range(CONTEXTS):
                    cells = found.slots[k].astype(np.intp)
                    cells *= 2
                    cells += found.signs > 0
                    np.add.at(table[k << (bits + 1):], cells, np.uint32(1))
        task = TaskContext.get().partitionId()
        for block in range(slots // _BLOCK if used else 0):
            part = table[2 * block * _BLOCK:2 * (block + 1) * _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([task], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    ["block", "task", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for block, task, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                wide = np.frombuffer(data, np.uint32 if len(data) == 8 * _BLOCK else np.uint64)
                if (block, task) in sums:
                    sums[block, task] += wide
                else:
                    sums[block, task] = wide.astype(np.uint64)
        for (block, task), found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([task], pa.int32()), pa.array([found.tobytes()], pa.binary())],
                ["block", "task", "counts"])

    schema = "block int, task int, counts binary"
    parts = train.select("text").mapInArrow(tidy(count), schema)
    near = max(1, math.isqrt(train.rdd.getNumPartitions()) // 8)
    if near > 1:
        parts = parts.withColumn("task", F.col("task") % near).repartition("block", "task").mapInArrow(tidy(add), schema)
    return parts.withColumn("task", F.lit(0)).repartition("block").mapInArrow(tidy(add), schema).select("block", "counts")


def _cells(blocks: DataFrame, bits: int) -> np.ndarray:
    """Coded counts of all slots, ones in the high byte: of fixed size, two bytes a slot."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, counts in zip(batch.column(0), batch.column(1), strict=True):
                found = coded(np.frombuffer(counts.as_buffer(), np.uint64)).reshape(-1, 2)
                data = (found[:, 1] << np.uint16(8)) | found[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()], pa.int32()), pa.array([data.tobytes()])], ["block", "data"])

    cells = np.zeros(CONTEXTS << bits, np.uint16)
    for row in blocks.mapInArrow(tidy(code), "block int, data binary").collect():
        cells[row.block * _BLOCK:(row.block + 1) * _BLOCK] = np.frombuffer(row.data, np.uint16)
    return cells.reshape(CONTEXTS, -1)


def _weights(train: DataFrame, model: Broadcast, cells: Broadcast, bits: int) -> np.ndarray:
    """Starting weights fitted on all training texts: every task goes through its own, and tasks count by their decisions."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, size = learn(_texts(batches), model.value.code(), cells.value, bits)
        if size:
            flat = weights.reshape(-1).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * size), pa.array(np.full(len(flat), size))], ["cell", "total", "size"])

    weights = start_weights().reshape(-1)
    for row in train.select("text").mapInArrow(tidy(fit), "cell long, total double, size long").groupBy("cell").agg(
            (F.sum("total") / F.sum("size")).alias("mean")).collect():
        weights[row.cell] = row["mean"]
    return weights.reshape(GATES, -1)


def score(docs: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text", bits: int = TABLE_BITS) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    The model learns from the rows where ``train`` holds (by default four fifths by id). ``base_score`` and ``score`` are
    log10 probabilities by smoothed counts of single tokens and by the mixture. A null text is empty: its end alone is scored.
    Repeated rows and null ids keep their rows. Without training rows the mixture is uniform over its code's bits.
    """
    train = is_training(id_col) if train is None else train
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), train.alias("train"))
    learned = rows.filter("train")
    with small_batches(docs.sparkSession):
        counts = stored(token_counts(learned), "counts")
        model = _model(counts)
        shared = docs.sparkSession.sparkContext.broadcast(model)
        blocks = stored(_tables(learned, shared, bits), "tables")
        cells = docs.sparkSession.sparkContext.broadcast(_cells(blocks, bits))
        weights = _weights(learned, shared, cells, bits)
    scale = math.log10(model.total + 0.5 * (model.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, dense = shared.value.code(), stretches(cells.value)
        logs = {token: math.log10(n + 0.5) for token, n in zip(shared.value.tokens, shared.value.counts, strict=True)}

        def items() -> Iterator[tuple]:
            for batch in batches:
                for key, held, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    text = x.as_py()
                    yield key, held, words(text)

        for group in groups(items()):
            parts = [decisions([x for *_, x in part], code, bits, fill=True) for part in groups(group, 1 << 15)]
            logp = (mix(inputs_of(parts, dense), together(parts), weights)[0] / math.log(10)).tolist()
            del parts
            base, n_known, rare = [], [], []
            for *_, found in group:
                value, hits, others = logs.get(END, -math.log10(2)), int(END in logs), []
                for token, times in Counter(found).items():
                    log = logs.get(token)
                    if log is None:
                        others.append({"token": token, "times": times})
                    else:
                        value += times * log
                        hits += times
                base.append(value - scale * (len(found) + 1))
                n_known.append(hits)
                rare.append(others)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in group], kind), pa.array([g[1] for g in group], pa.bool_()),
                 pa.array([len(g[2]) + 1 for g in group], pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(logp, pa.float64()), pa.array([sum(map(len, g[2])) + len(g[2]) for g in group], pa.int64()),
                 pa.array(rare, pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int64())])))],
                ["id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare"])

    kind_sql = rows.schema["id"].dataType.simpleString()
    kind = pa.int64() if kind_sql == "bigint" else pa.int32() if kind_sql == "int" else pa.string()
    with small_batches(docs.sparkSession):
        scored = stored(
            rows.select("id", (~F.col("train")).alias("held_out"), "text")
            .mapInArrow(tidy(run), f"id {kind_sql}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, "
                             "rare array<struct<token: binary, times: bigint>>")
            .withColumn("row", F.monotonically_increasing_id()), "scores")
    tail = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.times").join(counts, "token", "left")
    tail = tail.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("also"))
    return scored.join(tail, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score", "n_bytes",
        # words and the spaces between them, and one byte for the end
        (F.col("score") * (-math.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
