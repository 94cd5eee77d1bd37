"""SentencePiece encoding and decoding with seeded merge-dropout (operator 7).

Encoding is the agenda of byte-pair merging over a public vocabulary: the best
scored neighbouring pair is merged first, the leftmost of equals. With dropout
p, a candidate taken from the agenda is skipped when a keyed hash of (seed,
document, occurrence, pair, place) falls below p. So every occurrence of every word is
segmented anew, yet any task that repeats the work gives the same ids. With p = 0 the
ids are those of the public library.

Decoding concatenates the pieces' bytes and is exact for every text: characters
without a piece, line feeds and the space mark itself go out as byte pieces.

The text is cut at places that no piece of the vocabulary crosses: before runs
of spaces, and at line feeds. What a worker remembers of a part, in a bounded
table, is its agenda without dropout, the candidates taken and the ids, and the same
for the agenda that goes on after one candidate was skipped. So an occurrence is
settled by the keyed hashes of its own candidates alone if at most one of them
is skipped; the others are merged again, each with its own key, many at a time
as array operations. What is remembered never changes what comes out. The
vocabulary (a fixed file) is read on the driver and broadcast.

Defined cases: null and empty texts have no pieces; a null doc_id has a key of its
own; rows that share doc_id and text are segmented alike, and all are returned; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import ship, trimmed

_MARK = "▁"
_PART = re.compile(f" *[^ \n{_MARK}]+|\n|{_MARK}| +")
_GLUED = "\0"  # a key that starts with it is the rest of the key, any other one but a line feed is a space and the key
_M64 = (1 << 64) - 1
_ODD, _ODD2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places starts[0], ..., starts[0] + sizes[0] - 1, starts[1], ... one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _mixed(keys: np.ndarray, code: np.ndarray) -> np.ndarray:
    """32 bits of a keyed hash."""
    x = (keys ^ code) * np.uint64(_ODD)
    x ^= x >> np.uint64(32)
    return (x * np.uint64(_ODD2)) >> np.uint64(32)


def document_key(doc_id, seed: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(repr(doc_id), seed & _M64)


def occurrence_keys(key: int, first: int, n: int) -> np.ndarray:
    """Keys of a document's occurrences first to first + n - 1."""
    x = np.uint64(key) + np.arange(first + 1, first + n + 1, dtype=np.uint64) * np.uint64(_ODD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(_ODD2)
    return x ^ x >> np.uint64(32)


class Numbers(dict):
    """Numbers texts as they are first asked for; `new` holds those that came since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        self.new.append(text)
        self[text] = n = len(self)
        return n


class Known:
    """Remembered agendas in flat arrays: of each its ids, and codes of the candidates that are still to be tried.

    child: by candidate, the agenda that goes on after it is skipped, or -1.
    """

    def __init__(self) -> None:
        self.numbers, self.agenda = Numbers(), np.zeros(0, np.int64)  # of a part: its number, and by it its agenda
        self.ids, self.codes, self.child = np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.id_ends, self.code_ends = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, id_sizes: np.ndarray, codes: np.ndarray, code_sizes: np.ndarray) -> np.ndarray:
        n = len(self.id_ends) - 1
        self.ids, self.codes = np.concatenate([self.ids, ids]), np.concatenate([self.codes, codes])
        self.child = np.concatenate([self.child, np.full(len(codes), -1, np.int32)])
        self.id_ends = np.concatenate([self.id_ends, self.id_ends[-1] + np.cumsum(id_sizes)])
        self.code_ends = np.concatenate([self.code_ends, self.code_ends[-1] + np.cumsum(code_sizes)])
        return np.arange(n, n + len(id_sizes))

    def first_skipped(self, agendas: np.ndarray, keys: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Which of the agendas lose a candidate under their keys, and the place of the first one that is lost."""
        starts = self.code_ends[agendas]
        sizes = self.code_ends[agendas + 1] - starts
        places = _spread(starts, sizes)
        hit = np.flatnonzero(_mixed(np.repeat(keys, sizes), self.codes[places]) < limit)
        owner = np.repeat(np.arange(len(agendas)), sizes)[hit]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return owner[first], places[hit[first]]


def part_of(key: str) -> str:
    return key if key == "\n" else key[1:] if key.startswith(_GLUED) else " " + key


@dataclass
class Vocabulary:
    """scores: piece (spaces as spaces) to its score; ids: piece to id; table: id to its bytes."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    table: list[bytes]
    known: Known | None = None
    tables: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"known": None, "tables": None}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, ids, byte_ids, table = {}, {}, [0] * 256, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                byte_ids[b] = i
                table.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                table.append(b"")
            else:
                own = piece.replace(_MARK, " ")
                scores[own], ids[own] = sp.get_score(i), i
                table.append(own.encode())
        return cls(scores, ids, byte_ids, table)

    def merge(self, part: str, p: float, key: int) -> bytes:
        """Ids of one part as packed int32. key: of this occurrence."""
        scores, none = self.scores, float("inf")
        symbols = list(part)
        places = list(range(len(symbols)))
        # The agenda: for each neighbouring pair its negated score, or none. Parts are words, so a scan beats a heap.
        agenda = [-scores[s] if (s := a + b) in scores else none for a, b in zip(symbols, symbols[1:], strict=False)]
        if len(symbols) > 64:
            return self._merge_long(part, p, key)
        limit = int(p * (1 << 32))
        while agenda and (best := min(agenda)) != none:
            i = agenda.index(best)
            if limit and self.skipped(key, best, places[i]) < limit:
                agenda[i] = none
                continue
            merged = symbols[i] + symbols[i + 1]
            symbols[i : i + 2] = [merged]
            del places[i + 1], agenda[i]
            if i:
                agenda[i - 1] = -scores[s] if (s := symbols[i - 1] + merged) in scores else none
            if i < len(agenda):
                agenda[i] = -scores[s] if (s := merged + symbols[i + 1]) in scores else none
        return self._packed(symbols)

    @staticmethod
    def skipped(key: int, score: float, place: int) -> int:
        """32 bits by which a candidate is skipped: a keyed hash of its pair (by its rank) and place."""
        x = (key ^ int(score) << 24 ^ place) * _ODD & _M64
        return ((x ^ x >> 32) * _ODD2 & _M64) >> 32

    def _merge_long(self, part: str, p: float, key: int) -> bytes:
        """The same with a heap, for runs in which a scan per merge would cost the square of their length."""
        scores, limit, n = self.scores, int(p * (1 << 32)), len(part)
        symbols: list[str | None] = list(part)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (s := scores.get(symbols[i] + symbols[j])) is not None:
                heapq.heappush(agenda, (-s, i, len(symbols[i]) + len(symbols[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            best, i, size = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] is None or j < 0 or len(symbols[i]) + len(symbols[j]) != size:
                continue
            if limit and self.skipped(key, best, i) < limit:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return self._packed([s for s in symbols if s is not None])

    def _packed(self, symbols: list[str]) -> bytes:
        out = array("i")
        for s in symbols:
            if (k := self.ids.get(s)) is not None:
                out.append(k)
            else:
                out.extend([self.byte_ids[b] for b in s.encode()])
        return out.tobytes()

    def merge_all(
        self, parts: list[str], p: float = 0.0, keys: np.ndarray | None = None, lost: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """merge() of many parts at once: each step takes the best candidate of every part, as array operations.

        Without dropout, lost says which candidate, counted from 0, is skipped all the same (-1: none). Ids of all
        parts and how many each has; codes of the candidates taken after that and how many each has.
        """
        keys = np.zeros(len(parts), np.uint64) if keys is None else keys
        lost = np.full(len(parts), -1) if lost is None else lost
        limit, n = int(p * (1 << 32)), len(parts)
        chars = self._tables()[0]
        lengths = np.fromiter(map(len, parts), np.int64, n)
        id_sizes, code_sizes = np.zeros(n, np.int64), np.zeros(n, np.int64)
        pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # which parts, their ids, their codes
        order = np.argsort(lengths, kind="stable")
        ends = np.searchsorted(lengths[order], [0, 6, 10, 16, 32, 64], "right")
        alone = order[ends[-1] :].tolist()
        for lo, hi in zip(ends, ends[1:], strict=False):  # parts of like length together
            for at in range(lo, hi, 8192):
                ix = order[at : min(hi, at + 8192)]
                sizes = lengths[ix]
                codes = np.frombuffer("".join([parts[i] for i in ix.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
                inside = np.arange(int(sizes.max()))[None, :] < sizes[:, None]
                symbols = np.full(inside.shape, -1, np.int32)
                symbols[inside] = chars[codes]
                known = ((symbols >= 0) | ~inside).all(axis=1)
                good = np.flatnonzero(known)
                alone += ix[~known].tolist()  # with a character without a piece
                flat, counts, taken, takes = self._merge_rows(symbols[good], inside[good], keys[ix[good]], limit, lost[ix[good]])
                id_sizes[ix[good]], code_sizes[ix[good]] = counts, takes
                pieces.append((ix[good], flat, taken))
        for i in alone:
            flat = np.frombuffer(self.merge(parts[i], p, int(keys[i])), np.int32)
            id_sizes[i] = len(flat)
            pieces.append((np.array([i]), flat, np.zeros(0, np.uint64)))
        ids, codes = np.empty(id_sizes.sum(), np.int32), np.empty(code_sizes.sum(), np.uint64)
        id_starts, code_starts = np.cumsum(id_sizes) - id_sizes, np.cumsum(code_sizes) - code_sizes
        for which, flat, taken in pieces:
            ids[_spread(id_starts[which], id_sizes[which])] = flat
            codes[_spread(code_starts[which], code_sizes[which])] = taken
        return ids, id_sizes, codes, code_sizes

    def _merge_rows(self, sym: np.ndarray, inside: np.ndarray, keys: np.ndarray, limit: int, lost: np.ndarray):
        """Rows of character pieces merged: ids in all, ids per row, codes of the candidates taken (without dropout), codes per row.

        Rows lie one after the other in flat arrays with a border cell before and
        after each, whose piece merges with nothing.
        """
        n, width = sym.shape
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        wide, none = width + 2, np.float32(np.inf)
        sym = np.pad(np.where(inside, sym, -1), ((0, 0), (1, 1)), constant_values=-1).ravel()
        alive = sym >= 0
        nxt, prv = np.arange(1, n * wide + 1), np.arange(-1, n * wide - 1)
        cost, made = np.full((n, wide), none), np.zeros(n * wide, np.int32)
        flat = cost.ravel()  # the same memory
        at = np.flatnonzero(alive[:-1] & alive[1:])
        flat[at], made[at] = self._pairs(sym[at], sym[at + 1])
        rows, table, left, step = np.arange(n), cost, keys, -1
        while len(rows):
            step += 1
            i = table.argmin(axis=1)  # the first of equals
            best = flat[rows * wide + i]
            on = best < none
            if not on.all():
                rows, i, best, left = rows[on], i[on], best[on], left[on]
            if not len(rows):
                break
            at, code = rows * wide + i, (best.astype(np.int64) << 24).view(np.uint64) ^ (i - 1).astype(np.uint64)
            if limit:
                skip = _mixed(left, code) < np.uint64(limit)
            else:
                skip = lost[rows] == step
                new = lost[rows] < step
                steps.append((rows[new], code[new]))
            flat[at[skip]] = none
            at = at[~skip]
            gone = nxt[at]
            after, before = nxt[gone], prv[at]
            piece = made[at]
            sym[at] = piece
            alive[gone] = False
            flat[gone] = none
            nxt[at], prv[after] = after, at
            costs, pieces = self._pairs(np.concatenate([piece, sym[before]]), np.concatenate([sym[after], piece]))
            m = len(at)
            flat[at], made[at], flat[before], made[before] = costs[:m], pieces[:m], costs[m:], pieces[m:]
            table = cost[rows] if len(rows) < n else cost
        who = np.concatenate([s[0] for s in steps]) if steps else np.zeros(0, np.int64)
        codes = np.concatenate([s[1] for s in steps]) if steps else np.zeros(0, np.uint64)
        return sym[alive], alive.reshape(n, wide).sum(axis=1), codes[np.argsort(who, kind="stable")], np.bincount(who, minlength=n)

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Negated scores and merged ids of pairs of pieces; infinite where there is no such piece."""
        _, slots, costs, pieces = self._tables()
        want = a.astype(np.int64) << 32 | b
        at = self._slot(want, len(slots))
        held = slots[at]
        cost, made = costs[at], pieces[at]
        left = np.flatnonzero((held != want) & (held != -1))
        while len(left):  # the slot is another pair's: look at the next
            at[left] = (at[left] + 1) & (len(slots) - 1)
            held[left] = slots[at[left]]
            cost[left], made[left] = costs[at[left]], pieces[at[left]]
            left = left[(held[left] != want[left]) & (held[left] != -1)]
        return cost, made

    @staticmethod
    def _slot(want: np.ndarray, size: int) -> np.ndarray:
        return ((want.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (size - 1)

    def _tables(self):
        """Per process: code point to piece, and an open-addressed table of the pairs that merge."""
        if self.tables is None:
            chars = np.full(0x110000, -1, np.int32)
            pairs = {}
            for piece, k in self.ids.items():
                if len(piece) == 1:
                    chars[ord(piece)] = k
                for c in range(1, len(piece)):
                    if (a := self.ids.get(piece[:c])) is not None and (b := self.ids.get(piece[c:])) is not None:
                        pairs[a << 32 | b] = (-self.scores[piece], k)
            size = 1 << max(4, (6 * len(pairs)).bit_length())
            slots, costs, pieces = np.full(size, -1, np.int64), np.full(size, np.inf, np.float32), np.zeros(size, np.int32)
            starts = self._slot(np.array(list(pairs), np.int64), size).tolist() if pairs else []
            for at, (want, (cost, k)) in zip(starts, pairs.items(), strict=True):
                while slots[at] != -1:
                    at = (at + 1) & (size - 1)
                slots[at], costs[at], pieces[at] = want, cost, k
            self.tables = (chars, slots, costs, pieces)
        return self.tables

    def encode_parts(self, keys_of_parts: list[str], keys: np.ndarray, p: float, remember: int = 600_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, each occurrence under its own key, and how many each has."""
        if self.known is None or len(self.known.id_ends) > remember:
            self.known = Known()
        known = self.known
        number = np.array(list(map(known.numbers.__getitem__, keys_of_parts)), np.int64)
        if new := known.numbers.new:
            known.agenda = np.concatenate([known.agenda, known.add(*self.merge_all([part_of(x) for x in new]))])
            known.numbers.new = []
        agenda, again = known.agenda[number], np.zeros(0, np.int64)
        if limit := np.uint64(int(p * (1 << 32))):
            who, place = known.first_skipped(agenda, keys, limit)
            unknown, at = np.unique(np.where(known.child[place] < 0, place, -1), return_index=True)
            unknown, at = unknown[unknown >= 0], at[unknown >= 0]
            lost = unknown - known.code_ends[agenda[who[at]]]
            known.child[unknown] = known.add(*self.merge_all([part_of(keys_of_parts[i]) for i in who[at].tolist()], lost=lost))
            agenda[who] = known.child[place]
            # Parts that are merged one by one have no codes, and neither have those without candidates.
            alone = (known.code_ends[known.agenda + 1] == known.code_ends[known.agenda])[number]
            alone &= known.id_ends[agenda + 1] - known.id_ends[agenda] > 1
            alone[who[known.first_skipped(agenda[who], keys[who], limit)[0]]] = True
            again = np.flatnonzero(alone)
        starts, sizes = known.id_ends[agenda], known.id_ends[agenda + 1] - known.id_ends[agenda]
        if not len(again):
            return known.ids[_spread(starts, sizes)], sizes
        flat, counts, _, _ = self.merge_all([part_of(keys_of_parts[i]) for i in again.tolist()], p, keys[again])
        out = np.empty(sizes.sum() - sizes[again].sum() + counts.sum(), np.int32)
        plain = np.ones(len(sizes), bool)
        plain[again] = False
        sizes[again] = counts
        at = np.cumsum(sizes) - sizes
        out[_spread(at[plain], sizes[plain])] = known.ids[_spread(starts[plain], sizes[plain])]
        out[_spread(at[again], counts)] = flat
        return out, sizes

    def encode_texts(self, texts: list[str], doc_keys: list[int], p: float, step: int = 1 << 17, **options) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and how many each has; at most `step` parts are worked on at a time."""
        sizes, out = np.zeros(len(texts), np.int64), []
        held: list[tuple[int, int, list[str]]] = []  # text, number of its first part, parts

        def run() -> None:
            if held:
                parts = [x for _, _, ps in held for x in ps]
                keys = np.concatenate([occurrence_keys(doc_keys[i], first, len(ps)) for i, first, ps in held])
                ids, counts = self.encode_parts(parts, keys, p, **options)
                out.append(ids)
                np.add.at(sizes, np.repeat([i for i, _, _ in held], [len(ps) for _, _, ps in held]), counts)
                held.clear()

        room = step
        for i, text in enumerate(texts):
            parts = self._parts(text)
            for first in range(0, len(parts), step):  # a very long text goes in pieces
                held.append((i, first, parts[first : first + step]))
                room -= len(held[-1][2])
                if room <= 0:
                    run()
                    room = step
        run()
        return np.concatenate(out) if out else np.zeros(0, np.int32), sizes

    @staticmethod
    def _parts(text: str) -> list[str]:
        """Keys of the parts of a text."""
        if not text:
            return []
        if "  " in text or text[0] == " " or _MARK in text or _GLUED in text:
            return [x if x == "\n" else _GLUED + x for x in _PART.findall(" " + text)]
        return text.replace("\n", " \n " + _GLUED).split(" ")

    def encode(self, text: str, p: float = 0.0, seed: int = 0, doc_id=None) -> list[int]:
        """Ids of one text, part by part."""
        parts, out = self._parts(text), []
        for part, key in zip(parts, occurrence_keys(document_key(doc_id, seed), 0, len(parts)).tolist(), strict=True):
            out.extend(np.frombuffer(self.merge(part_of(part), p, key), np.int32).tolist())
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.table.__getitem__, ids))[1:].decode()


def _shared(df: DataFrame, model_path: str):
    ship(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model_path: str, p: float = 0.1, seed: int = 17) -> DataFrame:
    """(doc_id, ids, lossless) per row of docs. lossless: decoding the ids gave the text again."""
    shared = _shared(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # keeps what is held per step small
                b = whole.slice(at, 500)
                texts = [t or "" for t in b.column("text").to_pylist()]
                flat, sizes = v.encode_texts(texts, [document_key(x, seed) for x in b.column("doc_id").to_pylist()], p)
                ends = np.cumsum([0, *sizes])
                back = [v.decode(flat[i:j].tolist()) == t for i, j, t in zip(ends[:-1], ends[1:], texts, strict=True)]
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.array(back)], names=["doc_id", "ids", "lossless"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(trimmed(run), "doc_id long, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """encoded with decoded: the text of its ids."""
    shared = _shared(encoded, model_path)

    def run(ids: pd.Series) -> pd.Series:
        v = shared.value
        return pd.Series([v.decode(x.tolist()) if x is not None else None for x in ids], dtype=object)

    return encoded.withColumn("decoded", F.pandas_udf(run, "string")("ids"))


def round_trip(docs: DataFrame, model_path: str, **parameters) -> DataFrame:
    """Ids of every document, and whether decoding them gives its text again."""
    return encode(docs, model_path, **parameters).select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "lossless", "ids")


def op7_pieces(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model())
