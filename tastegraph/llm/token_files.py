"""Token-id files compressed by a Re-Pair grammar per block.

File format: each file holds records, one per block of whole documents, each followed by
one byte ``\\n``. All numbers are little-endian.

    magic          4 bytes  ``RPG1``
    header         int64[9] record bytes, file part, block, ids before it in the part,
                            documents, ids, rules, symbols, first rule symbol
    doc ids        int64[documents]
    has id         uint8[documents]
    doc lengths    int64[documents]
    rules          uint32[rules, 2]   left and right symbol
    rule lengths   uint32[rules]      ids that the rule expands to
    sequence       uint16 or uint32[symbols] (uint16 if every symbol is below 65536)

Symbols below the first rule symbol are token ids. ``read_ids`` expands only the symbols
that cover the places asked for, which it finds from the expansion lengths.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import stage, text_key
from tastegraph.llm.words import SPACE, Block

MAGIC = b"RPG1"
BLOCK_IDS = 1 << 20
#: Occurrences from which a pair gets a rule, and the part of a sequence that a round must save.
LEAST_COUNT, LEAST_GAIN = 6, 200
SLOT_BITS = 20
#: Words whose ids a worker remembers at most, about 40 bytes each; then it starts anew.
REMEMBERED = 1_500_000
#: Bytes of texts that are split into words at once, and fresh words that are encoded in one text.
_PIECE, _TOGETHER = 1 << 22, 256
#: Bytes of texts that a task writing files encodes at once.
TEXT_BYTES = 1 << 20


class WordEncoder:
    """Ids of texts from the tokenizers library, which sees each different word once.

    The tokenizer must not carry anything over ASCII white space: its split drops white
    space and its normalizer works within words. Then a text's ids are those of its words
    one after another. Special strings have no white space, so they stay within a word.
    Words are known by 64-bit hashes, in sorted arrays.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("AZ") == "az"
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, np.uint64)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.filled = np.zeros(1 << 18, np.uint32), 0

    def _encoded(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each word, one after another; number of ids of each word).

        Many words go through the library as one text, a line each; where a token begins in
        it tells the word.
        """
        flat, counts = [], []
        groups = [fresh[i : i + _TOGETHER] for i in range(0, len(fresh), _TOGETHER)]
        found = self.tokenizer.encode_batch(["\n".join(g) for g in groups], add_special_tokens=False)
        for group, one in zip(groups, found):
            begin = np.zeros(len(group), np.int64)
            np.cumsum(np.fromiter(map(len, group[:-1]), np.int64, len(group) - 1) + 1, out=begin[1:])
            places = np.fromiter(map(itemgetter(0), one.offsets), np.int64, len(one))
            counts.append(np.bincount(np.searchsorted(begin, places, "right") - 1, minlength=len(group)))
            flat.append(np.array(one.ids, np.uint32))
        return np.concatenate(flat), np.concatenate(counts)

    def _learn(self, hashes: np.ndarray, fresh: list[str]):
        """Remember words by their hashes, which come in order."""
        flat, count = self._encoded(fresh)
        if self.filled + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, max(self.filled + len(flat), 2 * len(self.pool)))
        self.pool[self.filled : self.filled + len(flat)] = flat
        place = np.searchsorted(self.known, hashes)
        self.starts = np.insert(self.starts, place, self.filled + np.cumsum(count) - count)
        self.lengths = np.insert(self.lengths, place, count)
        self.known = np.insert(self.known, place, hashes)
        self.filled += len(flat)

    def words(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each word, one after another; number of ids of each word)."""
        if len(self.known) > REMEMBERED:
            self._forget()
        each = block.hashes()
        # Any place of a word will do, so the order of equal hashes is left open.
        order = np.argsort(each)
        hashes = each[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        hashes, first = hashes[fresh], order[fresh]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            data, begin, end = block.data, block.begin[first[new]].tolist(), block.end[first[new]].tolist()
            self._learn(hashes[new], [data[a:b].tobytes().decode() for a, b in zip(begin, end)])
            at = np.searchsorted(self.known, hashes)
        length = self.lengths[at][number].astype(np.int64)
        before = np.cumsum(length) - length
        place = np.repeat(self.starts[at][number] - before, length)
        place += np.arange(len(place))
        return self.pool[place], length

    def _pieces(self, texts):
        """(text numbers, block) of up to _PIECE bytes; longer texts are cut at white space."""
        held, rows, size = [], [], 0

        def block():
            edges = np.cumsum([0, *map(len, held)])
            return np.array(rows), Block(0, np.frombuffer(b"".join(held), np.uint8), edges)

        for row, text in enumerate(texts):
            text = _lowered(text) if self.lowers else text
            low = 0
            while len(text) - low > _PIECE:
                high = low + _PIECE
                while high < len(text) and not SPACE[text[high]]:
                    high += 1
                yield np.array([row]), Block(0, np.frombuffer(text, np.uint8)[low:high], np.array([0, high - low]))
                low = high
            held.append(text[low:] if low else text)
            rows.append(row)
            size += len(held[-1])
            if size >= _PIECE:
                yield block()
                held, rows, size = [], [], 0
        if held:
            yield block()

    def texts(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``; number of ids of each text)."""
        flat, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        for rows, block in self._pieces(texts):
            ids, length = self.words(block)
            flat.append(ids)
            total = np.concatenate([[0], np.cumsum(length)])
            counts[rows] += total[block.first + block.count] - total[block.first]
        ids = np.insert(np.concatenate(flat), np.cumsum(counts), np.uint32(end_id))
        return ids, counts + 1


def _lowered(text: bytes) -> bytes:
    """A-Z lowered as the normalizer would, so that fewer words are different.

    Not where a special string may stand, which keeps its case, and not beside combining
    marks (U+0300 to U+037F), which may join a small letter but not the large one.
    """
    return text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for this vocabulary file; tasks of one worker share its words."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def frequent_pairs(pair: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(places, pairs, counts, pair's number per place) of the pairs that are there ``least`` times.

    Counts per slot of a hash bound the pairs' own counts from above, so only places whose
    slot is full enough are sorted, and the counts found are exact.
    """
    slot = ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    at = np.flatnonzero(np.bincount(slot, minlength=1 << SLOT_BITS)[slot] >= least)
    pairs, number, counts = _distinct(pair[at])
    often = counts >= least
    kept = often[number]
    return at[kept], pairs[often], counts[often], (np.cumsum(often) - 1)[number[kept]]


def _distinct(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different pairs in order, each pair's number among them, counts).

    Pairs of 16-bit symbols are sorted as values with their places in the low bits, which
    takes a fraction of the time of sorting places by their pairs.
    """
    left, right = pair >> 32, pair & 0xFFFFFFFF
    if not len(pair) or max(left.max(), right.max()) >= 1 << 16 or left.min() < 0:
        return np.unique(pair, return_inverse=True, return_counts=True)
    packed = (((left << 16) | right).view(np.uint64) << np.uint64(32)) | np.arange(len(pair), dtype=np.uint64)
    packed.sort()
    value, place = (packed >> np.uint64(32)).astype(np.int64), (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.diff(value, prepend=-1))
    counts = np.diff(np.append(start, len(value)))
    number = np.empty(len(value), np.int64)
    number[place] = np.repeat(np.arange(len(start)), counts)
    value = value[start]
    return (value >> 16 << 32) | (value & 0xFFFF), number, counts


def re_pair(ids: np.ndarray, first: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): frequent neighbours replaced by new symbols from ``first`` on.

    Each round counts all neighbouring pairs and gives the frequent ones a rule, the most
    frequent first and half of the free symbols at most, so that later rounds can pair what
    they made; occurrences are replaced from left to right, every other one where they
    overlap. Rounds go on until no pair is frequent, no symbol is free, or a round leaves
    the sequence almost as long as it was.
    """
    symbols, rules = ids.astype(np.int64), np.zeros((0, 2), np.int64)
    while len(symbols) > 1 and len(rules) < most:
        before, free = len(symbols), most - len(rules)
        pair = (symbols[:-1] << 32) | symbols[1:]
        at, pairs, counts, number = frequent_pairs(pair, LEAST_COUNT)
        if not len(pairs):
            break
        if len(pairs) > (share := max(1, free // 2)):
            chosen = np.zeros(len(pairs), bool)
            chosen[np.argsort(-counts, kind="stable")[:share]] = True
            kept = chosen[number]
            at, number, pairs = at[kept], (np.cumsum(chosen) - 1)[number[kept]], pairs[chosen]
        run = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        within = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at, number = at[within % 2 == 0], number[within % 2 == 0]
        symbols[at] = first + len(rules) + number
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        rules = np.concatenate([rules, np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)])
        if len(symbols) > before - before // LEAST_GAIN:
            break
    return symbols, rules


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    symbols = symbols.astype(np.int64)
    while len(symbols) and symbols.max() >= first:
        rule = symbols >= first
        place = np.cumsum(1 + rule) - 1 - rule
        out = np.empty(len(symbols) + int(rule.sum()), np.int64)
        out[place] = np.where(rule, rules[np.maximum(symbols - first, 0) % max(1, len(rules)), 0], symbols)
        out[place[rule] + 1] = rules[symbols[rule] - first, 1]
        symbols = out
    return symbols.astype(np.uint32)


def _lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Ids per rule; a rule only uses symbols of earlier rounds."""
    length = np.zeros(len(rules), np.int64)
    side = rules - first
    while len(rules) and not length.all():
        each = np.where(side < 0, 1, length[np.maximum(side, 0)])
        length = np.where((each > 0).all(axis=1), each.sum(axis=1), 0)
    return length


def pack(part: int, block: int, before: int, doc_ids: list, lengths: np.ndarray, ids: np.ndarray, first: int) -> bytes:
    symbols, rules = re_pair(ids, first, max(1, (1 << 16) - first) if first < 1 << 16 else 1 << 16)
    width = np.uint16 if first + len(rules) <= 1 << 16 else np.uint32
    body = [
        np.array([0 if d is None else d for d in doc_ids], np.int64).tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        lengths.astype(np.int64).tobytes(),
        rules.astype(np.uint32).tobytes(),
        _lengths(rules, first).astype(np.uint32).tobytes(),
        symbols.astype(width).tobytes(),
    ]
    size = 4 + 72 + sum(map(len, body))
    header = np.array([size, part, block, before, len(doc_ids), len(ids), len(rules), len(symbols), first], np.int64)
    return b"".join([MAGIC, header.tobytes(), *body])


class Record:
    """A block read from a file."""

    def __init__(self, data: memoryview, at: int = 0):
        if bytes(data[at : at + 4]) != MAGIC:
            raise ValueError(f"no record at byte {at}")
        head = np.frombuffer(data, np.int64, 9, at + 4)
        self.size, self.part, self.block, self.before, docs, self.ids, rules, symbols, self.first = map(int, head)
        at += 76
        self.doc_ids = np.frombuffer(data, np.int64, docs, at)
        self.has_id = np.frombuffer(data, np.uint8, docs, at + 8 * docs).astype(bool)
        self.doc_lengths = np.frombuffer(data, np.int64, docs, at + 9 * docs)
        at += 17 * docs
        self.rules = np.frombuffer(data, np.uint32, 2 * rules, at).reshape(-1, 2).astype(np.int64)
        self.rule_lengths = np.frombuffer(data, np.uint32, rules, at + 8 * rules)
        width = np.uint16 if self.first + rules <= 1 << 16 else np.uint32
        self.symbols = np.frombuffer(data, width, symbols, at + 12 * rules)

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the block, expanding no more symbols than needed."""
        length = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.first
        length[rule] = self.rule_lengths[self.symbols[rule].astype(np.int64) - self.first]
        end = np.cumsum(length)
        low, high = int(np.searchsorted(end, start, "right")), int(np.searchsorted(end, stop, "left")) + 1
        skip = start - (int(end[low - 1]) if low else 0)
        return expand(self.symbols[low:high], self.rules, self.first)[skip : skip + stop - start]

    def all_ids(self) -> np.ndarray:
        """Ids of the whole block: each rule is expanded once, its uses are copies of that."""
        table = expand(np.arange(self.first, self.first + len(self.rules)), self.rules, self.first)
        each = self.rule_lengths.astype(np.int64)
        rule = self.symbols >= self.first
        used = self.symbols[rule].astype(np.int64) - self.first
        length = np.ones(len(self.symbols), np.int64)
        length[rule] = each[used]
        begin = np.cumsum(length) - length
        out = np.empty(int(length.sum()), np.uint32)
        out[begin[~rule]] = self.symbols[~rule]
        length = each[used]
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(begin[rule], length) + inside] = table[np.repeat((np.cumsum(each) - each)[used], length) + inside]
        return out


def records(data: bytes) -> Iterator[Record]:
    view, at = memoryview(data), 0
    while at < len(view):
        record = Record(view, at)
        yield record
        at += record.size + 1


def write_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 2,
    first_rule: int = 49408,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of every text in ascending id order (rows without an id first).

    ``first_rule`` is above every token id. Null or empty texts give the end id alone.
    Equal ids stand in order of their texts; repeated rows are all written. Ranges of ids
    with many equal ones are split by text and input place. Other columns are ignored.
    Task memory follows a block of about a million ids or the longest text.
    """

    def work(batches):
        encode = encoder(vocabulary)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held_ids, held_docs, held_lengths, held = [], [], [], 0

        def flush():
            record = pack(part, block, before, held_docs, np.concatenate(held_lengths), np.concatenate(held_ids), first_rule)
            return pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["value"])

        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            names, low = batch.column(0).to_pylist(), 0
            while low < len(names):
                high, size, texts = low, 0, []
                while high < len(names) and size < TEXT_BYTES:
                    texts.append(column[high].as_py())
                    size += len(texts[-1])
                    high += 1
                ids, lengths = encode.texts(texts, end_id)
                held_ids.append(ids), held_lengths.append(lengths), held_docs.extend(names[low:high])
                held += len(ids)
                low = high
                if held >= BLOCK_IDS:
                    yield flush()
                    block, before, held = block + 1, before + held, 0
                    held_ids, held_docs, held_lengths = [], [], []
        if held:
            yield flush()

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        text_key(text_col).alias("key"),
    ).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("id", "key", "place").sortWithinPartitions("id", "key", "place")
    blocks = ordered.select("id", "text").mapInArrow(work, "value binary")
    # The text sink writes the bytes of a string as they are, and commits whole files.
    blocks.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 32).option(
        "lineSep", "\n"
    ).option("compression", "none").text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files, from its ids."""

    def work(batches):
        for batch in batches:
            for content in batch.column(0):
                for record in records(content.as_py()):
                    ids = record.all_ids().astype("<u4")
                    end = np.cumsum(record.doc_lengths)
                    data = memoryview(ids).cast("B")
                    crc = [
                        zlib.crc32(data[4 * (stop - size) : 4 * stop])
                        for size, stop in zip(record.doc_lengths.tolist(), end.tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(end), record.part, np.int32)),
                            pa.array(record.doc_ids, mask=~record.has_id),
                            pa.array(record.before + end - record.doc_lengths),
                            pa.array(record.doc_lengths),
                            pa.array(crc, pa.int64()),
                        ],
                        ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = stage(
        files.mapInArrow(work, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"), "token-rows"
    )
    # One row per file part: how many ids stand before it.
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    return rows.join(parts, "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
