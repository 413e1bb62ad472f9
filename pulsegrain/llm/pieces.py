"""SentencePiece-style BPE with seeded merge-dropout, and its decoding.

A text is the pieces' alphabet after one leading space, spaces written as U+2581. Symbols
start as characters; the agenda takes the adjacent pair whose joined piece has the highest
score, leftmost first, and merges it, unless a keyed hash of (seed, document, the time it is
taken, the word's place in the text, borders of the pair) says to skip it. Characters without a piece become byte pieces, and so does a
U+2581 that stands in the text itself, so decoding always gives the text back.

No piece has a space behind another character, so a text falls into words (spaces and what
follows them) that are encoded apart. The agenda runs over many words in lockstep, one decision of each
per numpy step, symbols being linked lists in rows of equal width. Distinct words of a batch run
without skips first; the borders of the pairs they merge tell for every occurrence, by its own key,
whether one of these merges is skipped. Only such occurrences run through an agenda of their own.
Nothing is kept from batch to batch. Words over MAX_LOCKSTEP characters use a heap. Both
give the same pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.textarrays import Texts, mix, texts_of

SPACE = "▁"
WIDTHS = (8, 16, 32)  # words of up to so many characters share an array
MAX_LOCKSTEP = WIDTHS[-1]
DROPOUT = 0.1
SEED = 11
BATCH_BYTES = 2 << 20  # of texts whose words are numbered together
LOCKSTEP_ROWS = 16_384  # words merged at once, so that arrays stay small
_M = 2**64 - 1
_C = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_C64 = tuple(np.uint64(c) for c in _C)


def read_pieces(model_file: str) -> tuple[list[str], list[float], int]:
    """Pieces and scores of a BPE model with byte fallback, and the id of its byte 0."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return pieces, [model.get_score(i) for i in range(len(pieces))], pieces.index("<0x00>")


def _mix_one(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


@dataclass
class Lists:
    """Rows of numbers one after the other; row i is flat[begins[i]:begins[i + 1]]."""

    flat: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, values: np.ndarray, n: int) -> Lists:
        """Values by the row they belong to, in the order given."""
        order = np.argsort(rows, kind="stable")
        return cls(values[order], np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]))

    def lengths(self) -> np.ndarray:
        return np.diff(self.begins)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the values of the given rows, one after the other, lie in flat."""
        n = self.lengths()[rows]
        ends = np.cumsum(n)
        return np.repeat(self.begins[rows] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """Tables over the pieces of a model; built once in each worker."""

    def __init__(self, pieces: list[str], scores: list[float], byte0: int) -> None:
        self.byte0 = byte0
        special = set(range(byte0 + 256))
        ids = {p: i for i, p in enumerate(pieces) if i not in special}
        extra = sorted({c for p in ids for c in p} - set(ids))
        symbols = ids | {c: len(pieces) + i for i, c in enumerate(extra)}
        self.n_pieces, self.n = len(pieces), len(pieces) + len(extra)
        # Characters: the symbol, or -2 - code where there is none.
        self.chars = -2 - np.arange(0x110000, dtype=np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.chars[ord(c)] = i
        self.chars[ord(SPACE)], self.chars[ord(" ")] = -2 - ord(SPACE), symbols[SPACE]
        self.extra = {len(pieces) + i: ord(c) for i, c in enumerate(extra)}
        # Scores as ranks: the higher, the earlier.
        _, self.rank = np.unique(np.array(scores), return_inverse=True)
        self.rank = self.rank.astype(np.int32) + 1
        self.pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if a is not None and b is not None:
                    self.pairs[a * self.n + b] = i
        self._hash_pairs()
        self.bytes = [p.replace(SPACE, " ").encode() for p in pieces]
        for b in range(256):
            self.bytes[byte0 + b] = bytes([b])

    def _hash_pairs(self) -> None:
        """Hash tables with one pair a slot; what does not fit into one goes to the next."""
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        values = np.fromiter(self.pairs.values(), np.int32, len(keys))
        self.tables = []
        while len(keys) or not self.tables:
            bits = max(4, int(4 * len(keys)).bit_length())
            shift = np.uint64(64 - bits)
            slots = ((keys.astype(np.uint64) * _C64[len(self.tables) % 3]) >> shift).astype(np.int64)
            at, first = np.unique(slots, return_index=True)
            key, value, more = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32), np.zeros(1 << bits, bool)
            key[at], value[at] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            more[slots[left]] = True
            self.tables.append((shift, key, value, more))
            keys, values = keys[left], values[left]

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of each two symbols joined, or -1."""
        wanted = np.where((a >= 0) & (b >= 0), a.astype(np.int64) * self.n + b, -2)
        out = np.full(len(wanted), -1, np.int32)
        rows = None
        for i, (shift, keys, values, more) in enumerate(self.tables):
            slots = ((wanted.astype(np.uint64) * _C64[i % 3]) >> shift).astype(np.int64)
            found = np.where(keys[slots] == wanted, values[slots], -1)
            if rows is None:
                out[:] = found
            else:
                out[rows] = found
            on = np.flatnonzero(more[slots] & (found < 0))
            if not len(on):
                break
            wanted = wanted[on]
            rows = on if rows is None else rows[on]
        return out

    def merge_word(self, symbols: list[int], key: int, limit: int) -> list[int]:
        """One word by an agenda on a heap. limit: of 2**53, the rate of skipped merges."""
        n = len(symbols)
        symbols, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
        end, agenda = list(range(1, n + 1)), []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and symbols[i] >= 0 and symbols[j] >= 0:
                piece = self.pairs.get(symbols[i] * self.n + symbols[j])
                if piece is not None:
                    heapq.heappush(agenda, (-int(self.rank[piece]), i, j, end[j], piece))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while agenda:
            _, i, j, stop, piece = heapq.heappop(agenda)
            if gone[i] or right[i] != j or j >= n or gone[j] or end[j] != stop:
                continue
            if limit and _mix_one((key + i * _C[0] + j * _C[1] + stop * _C[2]) & _M) >> 11 < limit:
                continue
            symbols[i], end[i], gone[j], right[i] = piece, stop, True, right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [s for s, out in zip(symbols, gone, strict=True) if not out]

    def _lockstep(self, words: Lists, width: int, keys: np.ndarray | None,
                  limit: int) -> tuple[Lists, Lists]:
        """The symbols that are left of each word, and the borders of the pairs it merged.

        words have at most width characters each. Without keys no merge is skipped; borders are
        told only then.
        """
        n, row = len(words.begins) - 1, width + 1
        lengths = words.lengths()
        base = np.arange(n) * row
        inside = (np.arange(row) < lengths[:, None]).ravel()
        symbols = np.full(n * row, -1, np.int32)
        symbols[inside] = words.flat
        # The column behind a word has no symbol and ends its list; column width stands before it.
        right = np.tile(np.arange(1, row + 1, dtype=np.int64), n)
        left = np.tile(np.concatenate([[width], np.arange(width)]), n)
        piece = np.full(n * row, -1, np.int32)
        pairs = np.flatnonzero((np.arange(row) + 1 < lengths[:, None]).ravel())
        piece[pairs] = self.joined(symbols[pairs], symbols[pairs + 1])
        score = np.where(piece >= 0, self.rank[piece], 0)
        rows, steps = np.arange(n), []
        while len(rows):
            table = score.reshape(n, row)
            at = (table if len(rows) == n else table[rows]).argmax(axis=1)
            i = base[rows] + at
            go = score[i] > 0
            rows, at, i = rows[go], at[go], i[go]
            if not len(rows):
                break
            j = right[i]
            stop = right[base[rows] + j]
            borders = at.astype(np.uint64) * _C64[0] + j.astype(np.uint64) * _C64[1] + stop.astype(np.uint64) * _C64[2]
            merged = rows
            if keys is None:
                steps.append((rows, borders))
            else:
                skip = (mix(keys[rows] + borders) >> np.uint64(11)) < np.uint64(limit)
                score[i[skip]] = 0
                merged, at, i, j, stop = rows[~skip], at[~skip], i[~skip], j[~skip], stop[~skip]
            here = base[merged]
            symbols[i], right[i], left[here + stop] = piece[i], stop, at
            inside[here + j], score[here + j] = False, 0
            # The pairs beside the new piece have new borders.
            before = here + left[i]
            both = np.concatenate([i, before])
            piece[both] = self.joined(symbols[both], np.concatenate([symbols[here + stop], symbols[i]]))
            score[both] = np.where(piece[both] >= 0, self.rank[piece[both]], 0)
        alive = inside.reshape(n, row)
        left_over = Lists(symbols[inside], np.concatenate([[0], np.cumsum(alive.sum(axis=1))]))
        if keys is not None or not steps:
            return left_over, Lists(np.zeros(0, np.uint64), np.zeros(n + 1, np.int64))
        return left_over, Lists.of(*(np.concatenate(c) for c in zip(*steps, strict=True)), n)

    def _merged(self, words: Lists, keys: np.ndarray | None, limit: int) -> tuple[Lists, Lists]:
        """_lockstep for words of any length, in the order given. Long ones are left as they are."""
        n, lengths = len(words.begins) - 1, words.lengths()
        parts, low = [], 0
        for width in WIDTHS:
            group = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for k in range(0, len(group), LOCKSTEP_ROWS):
                rows = group[k:k + LOCKSTEP_ROWS]
                some = Lists(words.flat[words.places(rows)], np.concatenate([[0], np.cumsum(lengths[rows])]))
                parts.append((rows, *self._lockstep(some, width, None if keys is None else keys[rows], limit)))

        def together(which: int, kind: type) -> Lists:
            own = [np.repeat(p[0], p[which].lengths()) for p in parts]
            values = [p[which].flat for p in parts]
            return Lists.of(np.concatenate([np.zeros(0, np.int64), *own]),
                            np.concatenate([np.zeros(0, kind), *values]), n)

        return together(1, np.int32), together(2, np.uint64)

    def _characters(self, words: pa.Array) -> Lists:
        """The symbols that words begin as."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return Lists(self.chars[codes], first[offsets - offsets[0]])

    def encode_words(self, words: pa.Array, sequence: np.ndarray, keys: np.ndarray,
                     dropout: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all occurrences in one array, and where each one's ids begin.

        words are distinct, as UTF-8 bytes; sequence has the word of each occurrence and keys its key.
        """
        limit = int(dropout * 2**53)
        symbols = self._characters(words)
        plain, borders = self._merged(symbols, None, 0)
        own = np.zeros(len(sequence), bool)  # whether the occurrence skips a merge
        for k in range(0, len(sequence) if limit else 0, 8 * LOCKSTEP_ROWS):
            some = sequence[k:k + 8 * LOCKSTEP_ROWS]
            rows = np.repeat(np.arange(k, k + len(some)), borders.lengths()[some])
            value = mix(keys[rows] + borders.flat[borders.places(some)])
            own[rows[(value >> np.uint64(11)) < np.uint64(limit)]] = True
        long = symbols.lengths() > MAX_LOCKSTEP
        apart, heaped = np.flatnonzero(own), np.flatnonzero(long[sequence])
        some = sequence[apart]
        cut, _ = self._merged(Lists(symbols.flat[symbols.places(some)],
                                    np.concatenate([[0], np.cumsum(symbols.lengths()[some])])), keys[apart], limit)
        heap = [np.array(self.merge_word(symbols.flat[symbols.begins[w]:symbols.begins[w + 1]].tolist(), int(keys[row]),
                                         limit), np.int32) for row, w in zip(heaped.tolist(), sequence[heaped].tolist(), strict=True)]
        left = plain.lengths()[sequence]
        left[apart] = cut.lengths()
        left[heaped] = [len(h) for h in heap]
        begins = np.concatenate([[0], np.cumsum(left)])
        flat = np.zeros(begins[-1], np.int32)
        out = Lists(flat, begins)
        usual = np.flatnonzero(~own & ~long[sequence])
        flat[out.places(usual)] = plain.flat[plain.places(sequence[usual])]
        flat[out.places(apart)] = cut.flat
        if heap:
            flat[out.places(heaped)] = np.concatenate(heap)
        return self._with_bytes(flat, begins)

    def _with_bytes(self, flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put byte pieces where a symbol has no piece."""
        odd = np.flatnonzero((flat < 0) | (flat >= self.n_pieces))
        if not len(odd):
            return flat, begins
        codes, place = np.unique(flat[odd], return_inverse=True)
        spelled = [chr(self.extra[c] if c >= 0 else -2 - c).encode("utf-8", "surrogatepass")
                   for c in codes.tolist()]
        sizes = np.ones(len(flat), np.int64)
        sizes[odd] = np.array([len(s) for s in spelled])[place]
        new = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(new[-1], np.int32)
        plain = np.ones(len(flat), bool)
        plain[odd] = False
        out[new[:-1][plain]] = flat[plain]
        table = np.zeros((len(spelled), 4), np.int64)
        for i, s in enumerate(spelled):
            table[i, :len(s)] = list(s)
        for k in range(4):
            has = sizes[odd] > k
            out[new[odd[has]] + k] = self.byte0 + table[place[has], k]
        return out, new[begins]

    def decoded(self, ids: np.ndarray) -> bytes:
        """What the ids spell, with the space before the text."""
        return b"".join([self.bytes[i] for i in ids.tolist()])

    def decode(self, ids: np.ndarray) -> str:
        text = self.decoded(ids).decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


def words_in(texts: Texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of texts that each have one space put first, the word of each occurrence, bounds of texts.

    A word is a run of spaces and what follows it up to the next space. An empty text has none.
    """
    n = np.diff(texts.offsets)
    filled = n > 0
    starts = (texts.offsets[:-1] + np.cumsum(filled) - filled)[filled]
    data = np.full(len(texts.data) + int(filled.sum()), 32, np.uint8)
    taken = np.ones(len(data), bool)
    taken[starts] = False
    data[taken] = texts.data
    space = data == 32
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[starts] = True
    at = np.flatnonzero(begin)
    offsets = np.append(at, len(data)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    numbered = words.dictionary_encode()
    ends = texts.offsets + np.concatenate([[0], np.cumsum(filled)])
    return numbered.dictionary, numbered.indices.to_numpy().astype(np.int64), np.searchsorted(at, ends)


def encode_texts(vocabulary: Vocabulary, texts: pa.Array, keys: np.ndarray, seed: int,
                 dropout: float) -> Iterator[tuple[Texts, np.ndarray, np.ndarray]]:
    """(texts, ids, bounds) of runs of texts in order; keys has a number for each text."""
    own = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(_mix_one(seed & _M)))
    for some in texts_of(texts, BATCH_BYTES):
        words, sequence, bounds = words_in(some)
        n = np.diff(bounds)
        place = np.arange(len(sequence)) - np.repeat(bounds[:-1], n)
        each = mix(np.repeat(own[some.first:some.first + len(some)], n) + (place.astype(np.uint64) + np.uint64(1)) * _C64[0])
        ids, begins = vocabulary.encode_words(words, sequence, each, dropout)
        yield some, ids, begins[bounds]


_BUILT: dict[int, Vocabulary] = {}


def _vocabulary(model: tuple[list[str], list[float], int]) -> Vocabulary:
    key = hash((tuple(model[0]), tuple(model[1]), model[2]))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Vocabulary(*model)
    return _BUILT[key]


def encoded(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text",
            dropout: float = DROPOUT, seed: int = SEED, take: str | None = None) -> DataFrame:
    """doc_id, n_tokens, token_ids, round_trip of each row of docs.

    A document's id, its text and the number of the time it is taken, which the column take has
    (without one: 0), are part of the key of every merge, as is the word's place. So the same
    word is cut differently in different documents, places and times, and a rerun gives the same
    ids. round_trip: decoding gives the text back (a null text: the empty one, without ids).
    Repeated rows of the same take get the same ids; an empty table gives no rows; other columns
    are ignored whatever their names.
    """
    model = read_pieces(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in batches:
            which = batch.column(1).to_numpy()
            for some, ids, bounds in encode_texts(vocabulary, batch.column(2), which, seed, dropout):
                data = some.data.tobytes()
                same = [vocabulary.decoded(ids[a:b])[1:] == data[begin:end] for a, b, begin, end in zip(
                    bounds[:-1].tolist(), bounds[1:].tolist(), some.offsets[:-1].tolist(), some.offsets[1:].tolist(),
                    strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(some.first, len(some)), pa.array(np.diff(bounds)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                     pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "token_ids", "round_trip"])

    key = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"),
                     F.col(f"`{take}`").cast("long") if take else F.lit(0).cast("long"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), key.alias("key"),
                       F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")
