"""Token counts by a byte-pair tokenizer compiled to deterministic transducers.

Two machines stand in a row. The first walks over character classes and marks where a
piece of the tokenizer's split begins; it looks two characters ahead at most. The second
reads the bytes of a piece and emits, with each byte, by how many tokens the encoding of
the piece so far has grown. Its states are found as texts need them: a state holds, for
every suffix of the piece that still may become a token, where that suffix stands in the
vocabulary, the last token before it and the tokens spent since. The last token of the
encoding of a longer prefix is the one suffix that forms a token and stays whole beside
the last token before it, so a state and a byte determine the next state and the emitted
count. Transitions are kept in a table that all texts of a worker share.

Texts are cut into chunks of equal length, and all chunks of a segment step through the
table side by side. A chunk with a piece's beginning inside maps every entry state to one
exit state, and only its count up to that beginning depends on the entry; these constant
maps are composed at once. A chunk inside a long piece has a map over all states, of which
only the one entry that occurs is followed: such chunks are walked one after another, the
runs of all long pieces side by side. Segments hand their exit state on, so the table can
be emptied between any two of them, within a text too.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm import words
from tastegraph.llm.common import text_key

CHUNK = 256
#: Bytes that are walked between two looks at the table's size (whole chunks).
SEGMENT = 1 << 20
#: States that a worker keeps; beyond, it forgets all and finds them anew.
MOST_STATES = 300_000
_SLOT_BITS = 22

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceCounter:
    """The transducer over the bytes of a piece. State 0 is the start of a piece."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        alphabet = _byte_alphabet()
        spell = lambda s: bytes(alphabet[c] for c in s)
        self.rank = {(spell(a), spell(b)): i for i, (a, b) in enumerate(merges)}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        known = [bytes([b]) for b in range(256)]
        for token in [*known, *(a + b for a, b in self.rank)]:
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][byte]
            self.token[node] = token
        self.fits = lru_cache(1 << 20)(self._fits)
        self.forget()

    def forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.bits = _SLOT_BITS
        self._empty_table()
        self.known = 0
        self._state(((0, b"", 0),))

    def full(self) -> bool:
        return len(self.states) > MOST_STATES or self.known > 1 << (_SLOT_BITS - 2)

    def _state(self, state: tuple) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
        return self.number[state]

    def encode(self, piece: bytes) -> list[bytes]:
        """Merges by rank, the leftmost first: what defines the encoding."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.rank):
                break
            pair, out, i = None, [], 0
            for at, r in enumerate(ranks):
                if r == best:
                    pair = (parts[at], parts[at + 1])
                    break
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _fits(self, left: bytes, right: bytes) -> bool:
        """Whether the tokens stay as they are side by side."""
        return self.encode(left + right) == ([left, right] if left else [right])

    def compile(self, state: int, byte: int) -> None:
        """Find the transition of a state with a byte."""
        moved, last, spent = [], None, None
        for node, before, count in self.states[state]:
            node = self.children[node].get(byte)
            if node is None:
                continue
            moved.append((node, before, count))
            token = self.token[node]
            if token is not None and last is None and self.fits(before, token):
                last, spent = token, count
        emitted = 1 - spent
        # Tokens since the end of the piece so far are counted back from the new end.
        kept = tuple((node, before, count + emitted) for node, before, count in moved if self.children[node])
        if self.known > len(self.keys) // 2:
            self._grow()
        self._put(state << 8 | byte, self._state((*kept, (0, last, 0))), emitted)
        self.known += 1

    def _put(self, key: int, after: int, emitted: int) -> None:
        slot = int(self._slots(np.array([key]))[0])
        while self.keys[slot] >= 0:
            slot = (slot + 1) % len(self.keys)
        self.keys[slot], self.next[slot], self.emit[slot] = key, after, emitted

    def _grow(self) -> None:
        """Twice the slots; every transition keeps its state and count."""
        held = np.flatnonzero(self.keys >= 0)
        rows = zip(self.keys[held].tolist(), self.next[held].tolist(), self.emit[held].tolist())
        self.bits += 1
        self._empty_table()
        for row in rows:
            self._put(*row)

    def _empty_table(self) -> None:
        # Transitions by hash of (state, byte), with open addressing.
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.next = np.zeros(1 << self.bits, np.int32)
        self.emit = np.zeros(1 << self.bits, np.int8)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for those that are not there."""
        slot = self._slots(keys)
        open_at = np.flatnonzero(self.keys[slot] != keys)
        while len(open_at):
            held = self.keys[slot[open_at]]
            slot[open_at[held < 0]] = -1
            open_at = open_at[(held >= 0) & (held != keys[open_at])]
            slot[open_at] = (slot[open_at] + 1) % len(self.keys)
            open_at = open_at[self.keys[slot[open_at]] != keys[open_at]]
        return slot

    def step(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted counts of many states, each with its byte."""
        keys = states.astype(np.int64) << 8 | data
        slot = self._find(keys)
        if (slot < 0).any():
            for key in np.unique(keys[slot < 0]).tolist():
                self.compile(key >> 8, key & 255)
            slot = self._find(keys)
        return self.next[slot], self.emit[slot]


class Counter:
    """Counts tokens of texts as the tokenizers library does for a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer or prefix space is expected")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.pieces = PieceCounter(spec["model"]["vocab"], merges)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.classes = np.full(0x110000, 255, np.uint8)

    def _learn_classes(self, points: np.ndarray) -> None:
        """Character classes by asking the split itself: what joins a letter, a digit, a mark?"""
        for point in points.tolist():
            char = chr(point)
            joined = lambda other: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(other + char)) == 1  # noqa: B023, E731
            self.classes[point] = LETTER if joined("a") else NUMBER if joined("1") else OTHER if joined("?") else SPACE

    def _begins(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pieces begin, for texts that begin at ``first``."""
        known = self.classes[points]
        if (known == 255).any():
            self._learn_classes(np.unique(points[known == 255]))
            known = self.classes[points]
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[first], edge[n] = True, True
        blank = known == SPACE
        before = np.full(n, 255, np.uint8)  # class before, 255 at a text's begin
        before[1:] = known[:-1]
        before[edge[:-1]] = 255
        after = np.full(n, 255, np.uint8)
        after[:-1] = known[1:]
        after[edge[1:]] = 255
        space_before = np.zeros(n, bool)
        space_before[1:] = points[:-1] == 0x20
        space_before &= before != 255
        begins = edge[:-1].copy()
        begins |= ~blank & (before != known) & ~((before == SPACE) & space_before)
        begins |= blank & (before != SPACE)
        # The last of several blanks begins anew if something follows.
        begins |= blank & (before == SPACE) & (after != SPACE) & (after != 255)
        # 's 't 'm 'd 're 've 'll where a piece begins with the apostrophe.
        quote = np.flatnonzero((points == 0x27) & begins & (before != OTHER))
        if len(quote):
            pad = np.concatenate([points, [0, 0]])
            stop = np.concatenate([edge, [True]])
            one = np.where(stop[quote + 1], 0, pad[quote + 1])
            two = np.where(stop[quote + 1] | stop[np.minimum(quote + 2, n)], 0, pad[quote + 2])
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.zeros(len(quote), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            begins[quote[short | long] + 1] = False
            for hit, size in ((short, 2), (long & ~short, 3)):
                at = quote[hit] + size
                begins[at[at < n]] = begins[at[at < n]] | ~blank[at[at < n]]
        return begins

    def count(self, block: words.Block) -> np.ndarray:
        """Tokens of each row of a block."""
        data, edges = block.data, block.edges
        out = np.zeros(block.rows, np.int64)
        if not len(data):
            return out
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
        first = np.searchsorted(heads, edges[:-1][np.diff(edges) > 0])
        begins = np.zeros(len(data), bool)
        begins[heads[self._begins(points, first)]] = True
        emitted = self._walk(data, begins)
        total = np.concatenate([[0], np.cumsum(emitted, dtype=np.int64)])
        out = total[edges[1:]] - total[edges[:-1]]
        for row in range(block.rows) if self.special else ():
            text = block.text(row) if b"<|" in data[edges[row] : edges[row + 1]].tobytes() else b""
            if any(s in text for s in self.special):
                out[row] = self._with_special(text)
        return out

    def _with_special(self, text: bytes) -> int:
        """Special strings are one token each and cut the text."""
        total, low = 0, 0
        while low < len(text):
            found = [(text.find(s, low), -len(s)) for s in self.special if s in text[low:]]
            at, size = min(found, default=(len(text), 0))
            if at > low:
                part = pa.array([text[low:at].decode()])
                total += int(sum(self.count(b)[0] for b in words.blocks(part)))
            total += size < 0
            low = at - size if size else len(text)
        return total

    def _walk(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Emitted count per byte, segment after segment."""
        pieces, parts, held = self.pieces, [], ((0, b"", 0),)
        for low in range(0, len(data), SEGMENT):
            if pieces.full():
                pieces.forget()
            part = slice(low, low + SEGMENT)
            emitted, last = self._segment(data[part], begins[part], pieces._state(held))
            held = pieces.states[last]
            parts.append(emitted)
        return np.concatenate(parts)

    def _segment(self, data: np.ndarray, begins: np.ndarray, enter: int) -> tuple[np.ndarray, int]:
        """(emitted count per byte, exit state): chunks side by side, entered one after another."""
        pieces = self.pieces
        n = len(data)
        chunks = -(-n // CHUNK)
        pad = chunks * CHUNK - n
        grid = np.concatenate([data, np.zeros(pad, np.uint8)]).reshape(chunks, CHUNK)
        begin = np.concatenate([begins, np.ones(pad, bool)]).reshape(chunks, CHUNK)
        out = np.zeros((CHUNK, chunks), np.int8)
        synced = begin.any(axis=1)
        head = np.where(synced, begin.argmax(axis=1), CHUNK)
        columns, cuts = np.ascontiguousarray(grid.T), np.ascontiguousarray(begin.T)
        # From the first beginning on, a chunk's run does not depend on its entry state.
        state = np.zeros(chunks, np.int32)
        for at in range(CHUNK):
            lanes = np.flatnonzero(head <= at)
            if not len(lanes):
                continue
            now = np.where(cuts[at, lanes], 0, state[lanes])
            state[lanes], out[at, lanes] = pieces.step(now, columns[at, lanes])
        # A chunk with a beginning exits in the state just found, whatever it is entered
        # with; entry states run on through chunks without one.
        entered = np.zeros(chunks, bool)
        ready = np.concatenate([[True], synced[:-1]])
        entry = np.concatenate([[enter], state[:-1]]).astype(np.int32)
        while True:
            lanes = np.flatnonzero(ready & ~entered & (head > 0))
            if not len(lanes):
                break
            now = entry[lanes]
            for at in range(int(head[lanes].max())):
                move = head[lanes] > at
                after, out[at, lanes[move]] = pieces.step(now[move], columns[at, lanes[move]])
                now[move] = after
            entered[lanes] = True
            open_lanes = ~synced[lanes]
            state[lanes[open_lanes]] = now[open_lanes]
            through = lanes[open_lanes] + 1
            inside = through < chunks
            entry[through[inside]] = now[open_lanes][inside]
            ready[through[inside]] = True
        return out.T.reshape(-1)[:n], int(state[-1])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", most: int = 512) -> DataFrame:
    """(id, text_key, n_bytes, n_tokens, over_limit) per document.

    Null and empty texts have no tokens. Every row is counted on its own, repeated or not;
    other columns are ignored. ``vocabulary`` is a byte-level BPE file of the tokenizers
    library, readable on every executor.
    """

    def work(batches):
        counts = counter(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for block in words.blocks(batch.column(2)):
                n_bytes.append(np.diff(block.edges))
                n_tokens.append(counts.count(block))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.concatenate(n_bytes) if n_bytes else [], pa.int64()),
                    pa.array(np.concatenate(n_tokens) if n_tokens else [], pa.int64()),
                ],
                ["id", "text_key", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    out = rows.mapInArrow(work, f"id {kind}, text_key long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > most).withColumnRenamed("id", id_col)
