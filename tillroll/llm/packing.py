"""Best-fit packing with certified bin counts.

Texts become pieces of at most CAPACITY tokens. Partitions of pieces are packed by
best-fit decreasing, each next to a lower bound from dual-feasible functions. What
stands in the emptiest bins of a partition, more of them where the bound says that
bins are wasted, moves on: groups of partitions pool these pieces and pack them
again, until one pool is left. Everything else is final after its round.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import RecentResults, slices_by_bytes, staged
from tillroll.llm.shingles import span_hashes, spans_of

CAPACITY = 4096
END_ID = 1
PART_PIECES = 50_000  # pieces of a partition in the first round, in expectation
POOLED = 16  # partitions whose open bins meet in one pool
OPEN_BINS = 4  # that each wasted bin opens, besides the emptiest one
_CACHED_WORDS = 500_000
_WORDS_AT_ONCE = 8_192
_MARK = np.zeros(256, dtype=bool)
_MARK[list(rb"""!"#$%&()*+,-./:;=>?@[\]^_`{|}~""")] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_plain_word = re.compile(r"([a-zß-öø-ÿа-яёα-ω]+)([!-&(-/:;=-@\[-`{-~]*)")  # letters, then marks but \x27 and <


def _without_marks(source: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans with the marks behind an ASCII letter or digit as spans of their own.

    There the tokenizer starts a new group anyway, and words recur more often without them.
    """
    if not len(start):
        return start, end
    other = np.maximum.accumulate(np.where(_MARK[source], -1, np.arange(len(source))))
    cut = other[end - 1] + 1
    apart = (cut < end) & (cut > start)
    apart[apart] = _ALNUM[source[cut[apart] - 1]]
    starts = np.concatenate([start, cut[apart]])
    ends = np.concatenate([np.where(apart, cut, end), end[apart]])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


class WordIds:
    """Token ids of texts, each distinct word encoded once.

    The tokenizer drops white space and never joins what stands on its two sides,
    so a text's ids are those of its words in order. It also lowers case; A-Z are
    lowered beforehand to have fewer words, except where a special token may stand.
    Words of lower-case letters are what normalisation would leave them and one
    token group each, so their step is left out; marks behind them are a group too.
    """

    def __init__(self, path: str, cached_words: int = _CACHED_WORDS) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache = RecentResults(cached_words)

    def forget(self) -> None:
        """Drop the words learned so far."""
        self.cache = RecentResults(self.cache.most)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text, given in UTF-8.

        The distinct words of the batch, told apart by 64-bit hashes, are looked up
        once; their ids are then gathered for all words in one step.
        """
        source, start, end, at = spans_of(texts)
        data = source.tobytes()
        if b"<|" in data:
            return self._word_by_word(texts.to_pylist())
        start, end = _without_marks(source, start, end)
        hashes = span_hashes(source, start, end)
        at = np.searchsorted(start, at)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        lowered = data.lower()
        words = [lowered[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
        found = self.cache.find(words, self._learn)
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        taken = sizes[which]
        ends = np.concatenate([[0], np.cumsum(taken)])
        place = np.repeat(begins[which] - ends[:-1], taken) + np.arange(ends[-1])
        every = ids[place].tobytes()
        cuts = (4 * ends[at]).tolist()
        return [every[a:b] for a, b in zip(cuts, cuts[1:])]

    def _word_by_word(self, texts: list[bytes]) -> list[bytes]:
        """The same where a special token may stand, whose letters must not be lowered."""
        words = [(text if b"<|" in text else text.lower()).split() for text in texts]
        ids = self.cache.find(list(chain.from_iterable(words)), self._learn)
        ends = list(accumulate(map(len, words)))
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def _learn(self, words: set[bytes]) -> None:
        marked = []
        fresh = {word for word in words if word.isalpha() and word.islower()}  # for bytes, ASCII alone
        for word in words - fresh:
            text = word.decode()
            form = _plain_word.fullmatch(text if "Σ" in text else text.lower())
            if form is None:
                self.cache[word] = self._whole(text)
                continue
            letters, marks = form[1].encode(), form[2].encode()
            marked.append((word, letters, marks))
            fresh.add(letters)
        order = [word for word in fresh if word not in self.cache]
        for at in range(0, len(order), _WORDS_AT_ONCE):  # the library's own structures are large
            some = order[at : at + _WORDS_AT_ONCE]
            joined = self.plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
            ids = np.array(joined[0].ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            if len(ends) != len(some):
                raise ValueError("the tokenizer did not keep words apart")
            data = ids.tobytes()
            for word, a, b in zip(some, [0, *ends], ends):
                self.cache[word] = data[a:b]
        for word, letters, marks in marked:
            if marks not in self.cache:
                self.cache[marks] = self._whole(marks.decode())
            self.cache[word] = self.cache[letters] + self.cache[marks]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


_encoders: dict[tuple[str, int], WordIds] = {}


def pieces_of(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    cached_words: int = _CACHED_WORDS,
    keep_words: bool = True,
) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32`: each text's ids, END_ID last, cut every CAPACITY ids.

    tokenizer: path of the vocabulary file, the same on every executor. Null and
    empty texts are one piece with END_ID alone; repeated rows are texts of their own.
    A worker remembers the ids of up to two times `cached_words` words, from one task to
    the next unless `keep_words` is false; both decide time and memory, not results.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer, cached_words) not in _encoders:
            _encoders[tokenizer, cached_words] = WordIds(tokenizer, cached_words)
        encoder = _encoders[tokenizer, cached_words]
        for batch in slices_by_bytes(batches, "text", 1 << 20):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.encode(batch.column(1))):
                ids += end
                for j, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    part = ids[at : at + 4 * CAPACITY]
                    row.append(i)
                    piece.append(j)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        if not keep_words:
            encoder.forget()

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each length by best-fit decreasing: the fullest bin it fits in, else a new one."""
    bins = np.empty(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    room = 0  # bit r is set while a bin with room r is open
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = room >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            chosen = open_bins[left].pop()
            if not open_bins[left]:
                room ^= 1 << left
        else:
            left, chosen = capacity, made
            made += 1
        bins[i] = chosen
        left -= size
        if not open_bins[left]:
            room |= 1 << left
        open_bins[left].append(chosen)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins: the largest of the bounds by three families of dual-feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[1:].astype(np.int64)
    size = np.arange(1, capacity + 1, dtype=np.int64)
    best = -(-int(count @ size) // capacity)
    for k in range(1, 21):  # multiples of 1/(k+1) stay, the rest is rounded to multiples of 1/k
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int(count @ value) // (capacity * k)))
    # Small pieces are left out, and pieces that leave room for small ones only count in full.
    below = np.concatenate([[0], np.cumsum(count * size)])
    items = np.concatenate([[0], np.cumsum(count)])
    small = np.arange(1, capacity // 2 + 1)
    middle = below[capacity - small] - below[small - 1]
    large = items[capacity] - items[capacity - small]
    best = max(best, int((large + -(-middle // capacity)).max()))
    return best


def _packed(group: pd.DataFrame, last: bool) -> pd.DataFrame:
    group = group.sort_values(["length", "row_id"], ascending=[False, True], kind="stable", ignore_index=True)
    lengths = group["length"].to_numpy(dtype=np.int64)
    bins = best_fit(lengths)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    gap = len(fill) - lower_bound(lengths)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.concatenate([[True], np.diff(bins[order]) > 0])
    offset = np.empty(len(bins), dtype=np.int64)
    offset[order] = ends - lengths[order] - np.repeat((ends - lengths[order])[first], np.bincount(bins))
    opened = np.zeros(len(fill), dtype=bool)
    if not last:
        opened[np.argsort(fill, kind="stable")[: 1 + OPEN_BINS * gap]] = True
        opened &= fill < CAPACITY
    return group.assign(bin=bins, offset=offset, gap=gap, open=opened[bins])


def _pack_some(group: pd.DataFrame) -> pd.DataFrame:
    return _packed(group, False)


def _pack_last(group: pd.DataFrame) -> pd.DataFrame:
    return _packed(group, True)


def pack(pieces: DataFrame, part_pieces: int = PART_PIECES) -> DataFrame:
    """The columns of `pieces` (`length` from 1 to CAPACITY among them) with `sequence_id, offset, gap`.

    `gap` is what the partition that packed the row has above its lower bound: 0
    certifies that no packing of those pieces has fewer bins. Offsets are gapless
    from 0 in every sequence. The rounds' tables are written to the shared folder.
    """
    columns = pieces.columns
    todo = staged(pieces.withColumn("row_id", F.monotonically_increasing_id()), "packing-pieces")
    parts = max(1, -(-todo.count() // part_pieces))
    todo = todo.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(parts)))
    result: DataFrame | None = None
    level = 0
    while True:
        last = parts == 1
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in todo.schema)
        schema += ", bin long, offset long, gap long, open boolean"
        packed = todo.groupBy("part").applyInPandas(_pack_last if last else _pack_some, schema)
        packed = staged(packed, f"packing-round-{level}")
        sequence = F.lit(level << 56) + F.shiftleft(F.col("part"), 24) + F.col("bin")
        done = packed.filter(~F.col("open")).select(*columns, sequence.alias("sequence_id"), "offset", "gap")
        result = done if result is None else result.unionByName(done)
        if last:
            return result
        parts = -(-parts // POOLED)
        todo = packed.filter("open").drop("bin", "offset", "gap", "open")
        todo = todo.withColumn("part", F.floor(F.col("part") / POOLED))
        level += 1


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", **words) -> DataFrame:
    """A row per piece: `doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap`; `words` as in `pieces_of`."""
    return pack(pieces_of(docs, tokenizer, doc_id, text, **words))
