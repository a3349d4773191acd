"""SentencePiece encoding and decoding by suffix-array matching, for merge (BPE) models with byte fallback.

The new word units of a batch are put into one text whose suffix array is searched
for every piece at once. The occurrence ranges are edges over the text; sorted by
position they answer which piece, if any, spans two neighbouring symbols. Relaxing
then joins, in every unit at a time, the neighbours whose edge has the best score,
the leftmost of equals, until no edge is left.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import RecentResults, slices_by_bytes

SPACE = "▁"
LONG_UNIT = 48  # characters from which a unit is relaxed by itself
SLICE_BYTES = 4 << 20
MATCH_CHARACTERS = 1 << 20  # of the text that one suffix array indexes, in all but single longer units
_CACHED_UNITS = 300_000


class PieceModel:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.score = np.array([model.get_score(i) for i in range(size)])
        normal = [i for i in range(size) if not special[i]]
        self.first_byte = next(i for i in range(size) if model.is_byte(i))  # of 256 in order
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        self.is_control = np.array([model.is_control(i) for i in range(size)])
        self.normal = np.array(normal, dtype=np.int32)
        self.length = np.array([len(self.text[i]) for i in normal], dtype=np.int64)
        self.longest = int(self.length.max())
        self.points = np.zeros((len(normal), self.longest), dtype=np.int32)
        for row, i in enumerate(normal):
            self.points[row, : self.length[row]] = [ord(c) for c in self.text[i]]
        # No piece goes on behind its spaces' first letter with a space, nor over a line break.
        inner = [self.text[i] for i in normal if SPACE in self.text[i].lstrip(SPACE) or ("\n" in self.text[i] and self.text[i] != "\n")]
        if inner:
            raise ValueError("pieces that cross words are not supported")
        self.cache = RecentResults(_CACHED_UNITS)
        self.spelled = [
            bytes([i - self.first_byte]) if self.is_byte[i] else b"" if self.is_control[i] else text.replace(SPACE, " ").encode()
            for i, text in enumerate(self.text)
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        units = [_unit.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        ids = self.cache.find(list(chain.from_iterable(units)), self._learn)
        ends = list(accumulate(map(len, units)))
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, without the space that encoding puts in front."""
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def _learn(self, units: set[str]) -> None:
        """Match new units, a bounded number of characters at a time."""
        group: list[str] = []
        size = 0
        for unit in units:
            group.append(unit)
            size += len(unit) + 1
            if size > MATCH_CHARACTERS:
                self.cache.young.update(zip(group, self._match(group)))
                group, size = [], 0
        if group:
            self.cache.young.update(zip(group, self._match(group)))

    def _match(self, units: list[str]) -> list[bytes]:
        """The ids of each unit."""
        joined = "\0".join(units) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), "<i4")
        edge = self._edges(points)
        starts = np.cumsum([0, *(len(u) + 1 for u in units)])[:-1]
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        short = np.flatnonzero(lengths <= LONG_UNIT)
        begins = [self._relaxed(starts[short], lengths[short], edge)]
        for k in np.flatnonzero(lengths > LONG_UNIT).tolist():
            begins.append(self._relaxed_alone(int(starts[k]), int(starts[k] + lengths[k]), edge))
        begin = np.sort(np.concatenate(begins))
        first = np.searchsorted(begin, starts)
        # A symbol ends where the next one starts, or one character before the next unit.
        end = np.append(begin[1:], len(points))
        last = np.append(first[1:], len(begin)) - 1
        end[last] = starts + lengths
        ids = edge[end - begin - 1, begin]
        if (ids < 0).any():
            ids, first = self._with_bytes(ids, begin, points, first)
        data = ids.astype("<u4").tobytes()
        edges = (4 * np.append(first, len(ids))).tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def _with_bytes(self, ids: np.ndarray, begin: np.ndarray, points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece as their UTF-8 bytes; and where each unit's ids start then."""
        unknown = np.flatnonzero(ids < 0)
        spelled = [chr(c).encode() for c in points[begin[unknown]].tolist()]
        sizes = np.ones(len(ids), np.int64)
        sizes[unknown] = [len(b) for b in spelled]
        at = np.append(0, np.cumsum(sizes))
        out = np.repeat(ids, sizes)
        where = np.repeat(at[unknown], sizes[unknown]) + np.concatenate([np.arange(len(b)) for b in spelled])
        out[where] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int32) + self.first_byte
        return out, at[first]

    def _suffixes(self, points: np.ndarray) -> np.ndarray:
        """Places in the order of what follows them, as far as the longest piece goes."""
        rank = np.unique(points, return_inverse=True)[1].astype(np.int64)
        k = 1
        while k < self.longest:
            later = np.zeros_like(rank)
            later[:-k] = rank[k:] + 1
            rank = np.unique(rank * (len(points) + 2) + later, return_inverse=True)[1].astype(np.int64)
            k *= 2
        return np.argsort(rank, kind="stable")

    def _edges(self, points: np.ndarray) -> np.ndarray:
        """`[length - 1, place]`: the piece of that length that stands at the place, or -1."""
        order = self._suffixes(points)
        padded = np.concatenate([points, np.zeros(self.longest, np.int32)])
        columns = np.arange(self.longest)
        used = columns < self.length[:, None]

        def bound(after: bool) -> np.ndarray:
            """How many suffixes are before (or not after) each piece, cut to its length."""
            low = np.zeros(len(self.length), np.int64)
            high = np.full(len(self.length), len(order), np.int64)
            while (low < high).any():
                middle = (low + high) // 2
                window = padded[order[np.minimum(middle, len(order) - 1)][:, None] + columns]
                differs = (window != self.points) & used
                at = differs.argmax(axis=1)
                rows = np.arange(len(at))
                less = window[rows, at] < self.points[rows, at]
                before = np.where(differs.any(axis=1), less, after)
                busy = low < high
                low = np.where(busy & before, middle + 1, low)
                high = np.where(busy & ~before, middle, high)
            return low

        first, end = bound(False), bound(True)
        times = end - first
        row = np.repeat(np.arange(len(times)), times)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        place = order[first[row] + nth]
        by_place = np.argsort(place, kind="stable")
        row, place = row[by_place], place[by_place]
        edge = np.full((self.longest, len(points)), -1, np.int32)
        edge[self.length[row] - 1, place] = self.normal[row]
        return edge

    def _relaxed(self, starts: np.ndarray, lengths: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Where the symbols of the units start once nothing can be joined."""
        done = [np.empty(0, np.int64)]
        unit = np.repeat(np.arange(len(starts)), lengths)
        begin = np.arange(len(unit)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + starts[unit]
        stop = starts + lengths
        while len(unit):
            # The symbol after next, or the end of the unit, is where a join would end.
            n = len(unit)
            after = np.append(begin[1:], 0)
            same = np.append(unit[1:] == unit[:-1], False)
            end = np.append(after[1:], 0)
            same2 = np.append(same[1:], False)
            end = np.where(same2, end, stop[unit])
            size = end - begin
            fits = same & (size <= self.longest)
            piece = np.where(fits, edge[np.minimum(size, self.longest) - 1, begin], -1)
            score = np.where(piece >= 0, self.score[piece], -np.inf)
            heads = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.maximum.reduceat(score, heads)
            count = np.diff(np.append(heads, n))
            is_best = score == np.repeat(best, count)
            place = np.minimum.reduceat(np.where(is_best, np.arange(n), n), heads)
            active = best > -np.inf
            keep = np.repeat(active, count)
            done.append(begin[~keep])
            keep[place[active] + 1] = False
            unit, begin = unit[keep], begin[keep]
        return np.concatenate(done)

    def _relaxed_alone(self, a: int, b: int, edge: np.ndarray) -> np.ndarray:
        """The same for one unit, with a heap: its time does not grow with the square of its length."""
        after = {i: i + 1 for i in range(a, b)}
        before = {i + 1: i for i in range(a, b)}
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            middle = after.get(i, b)
            if middle >= b:
                return
            end = after[middle]
            if end - i <= self.longest and (piece := edge[end - i - 1, i]) >= 0:
                heapq.heappush(heap, (-self.score[piece], i, middle, end))

        for i in range(a, b):
            offer(i)
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            if after.get(i) != middle or after.get(middle) != end:
                continue
            after[i] = end
            before[end] = i
            del after[middle]
            offer(i)
            if i > a:
                offer(before[i])
        return np.array(sorted(after), dtype=np.int64)


_unit = re.compile(f"{SPACE}*[^{SPACE}\n\0]+|{SPACE}+|\n|\0")
_models: dict[str, PieceModel] = {}


def model_of(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, ids` of each row: the model's ids of the whole text, of null and empty text none.

    model: path of the model file, the same on every executor. Repeated rows stay
    repeated; other columns are not read.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_of(model)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            found = pieces.encode(batch.column(1).to_pylist())
            ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], names=["doc_id", "ids"]
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`doc_id, text` of each row; of null or empty ids the empty text."""
    frame = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_of(model)
        for batch in batches:
            texts = [pieces.decode(np.asarray(i if i is not None else [], dtype=np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(decoded, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per input row: `doc_id, n_tokens, ids_crc32, n_chars, same`, encoded and decoded again.

    `ids_crc32` is taken over little-endian 32-bit ids. `same` says that decoding gave
    the text back; only a text that holds the model's own space mark may differ.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_of(model)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            texts = batch.column(1).to_pylist()
            found = pieces.encode(texts)
            decoded = [pieces.decode(np.frombuffer(x, "<u4")) for x in found]
            columns = [
                pa.array([len(x) // 4 for x in found], pa.int64()),
                pa.array(map(zlib.crc32, found), pa.int64()),
                pa.array(map(len, decoded), pa.int64()),
                pa.array([a == b for a, b in zip(texts, decoded)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_crc32", "n_chars", "same"]
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(checked, f"doc_id {kind}, n_tokens long, ids_crc32 long, n_chars long, same boolean")
