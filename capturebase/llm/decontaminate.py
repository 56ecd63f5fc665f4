"""Benchmark decontamination by suffix arrays of the training texts.

Each slice of training texts is a shard. Its suffix array holds the word suffixes, in order of their first WINDOW words, of those places
where a match can begin: a run of words of the benchmark as long as its shortest window. Every suffix of every test item is
binary-searched in each shard. Hits of neighbouring suffixes of an item at neighbouring words join to the longest verbatim matches, with
their places and lengths; counts and verdicts come from these. Nothing is shuffled. A benchmark beyond what a task should hold is searched
for block by block, and the hits of a text are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import small_batches
from ._text import ALNUM_WORD, LOWER_CODE, slices, span_hashes, utf8, word_bounds

WINDOW = 13
MAX_TEST_WORDS = 4_000_000
SHARE = 20
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")  # ALNUM_WORD over characters
_D = 3  # bytes of a word's id in a key; none of them is zero


def _keys(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first words of each suffix as fixed-length byte strings in word order."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < lengths[:, None]
    w = np.where(inside, ids[np.minimum(at, len(ids) - 1)], 0)
    digits = np.stack([w // (255 * 255), w // 255 % 255, w % 255], axis=2) + 1
    return np.ascontiguousarray(np.where(inside[:, :, None], digits, 0).astype(np.uint8)).reshape(len(starts), WINDOW * _D).view(f"S{WINDOW * _D}").ravel()


Part = tuple[object, str | None, int, int]
"""Name of an item, some of its text, a number of its own, and how many words of it come before."""


class Tests:
    """The benchmark's words and windows, as the shards are searched for."""

    def __init__(self, parts: list[Part]):
        self.names = [str(x[0]) for x in parts]
        data, off = utf8(pa.array([x[1] or "" for x in parts], pa.large_string()))
        starts, ends, rows = word_bounds(data, off, ALNUM_WORD)
        self.vocabulary, ids = np.unique(span_hashes(data, starts, ends, LOWER_CODE), return_inverse=True)
        size = np.bincount(rows, minlength=len(parts))
        first = np.cumsum(size) - size
        #: An item of fewer words than a window is one window.
        count = np.where(size >= WINDOW, size - WINDOW + 1, np.minimum(size, 1))
        self.part = np.repeat(np.arange(len(parts)), count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begins = first[self.part] + inner
        self.item = np.array([x[2] for x in parts], np.int64)[self.part]
        self.at = inner + np.array([x[3] for x in parts], np.int64)[self.part]
        self.lengths = np.minimum(size[self.part], WINDOW)
        self.shortest = int(self.lengths.min()) if len(begins) else 0
        keys = _keys(ids, begins, self.lengths) if len(begins) else np.zeros(0, f"S{WINDOW * _D}")
        self.low = keys
        self.high = np.array([k + b"\xff" * (WINDOW * _D - len(k)) for k in keys.tolist()], f"S{WINDOW * _D}")


def find(data: np.ndarray, off: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row; for each window of a test found in the texts the word that it begins at, counted through all rows; and the window."""
    starts, ends, rows = word_bounds(data, off, ALNUM_WORD)
    n_words = np.bincount(rows, minlength=len(off) - 1)
    none = np.zeros(0, np.int64)
    if not len(starts) or not tests.shortest:
        return n_words, none, none
    h = span_hashes(data, starts, ends, LOWER_CODE)
    ids = np.searchsorted(tests.vocabulary, h)
    known = tests.vocabulary[np.minimum(ids, len(tests.vocabulary) - 1)] == h
    stop = np.ones(len(h) + 1, bool)  # a run ends before these
    stop[:-1] = ~known
    brk = np.flatnonzero(stop)
    end = brk[np.searchsorted(brk, np.arange(len(h)))]
    end = np.minimum(end, np.cumsum(n_words)[rows])
    run = end - np.arange(len(h))
    places = np.flatnonzero(run >= tests.shortest)
    if not len(places):
        return n_words, none, none
    keys = _keys(ids, places, np.minimum(run[places], WINDOW))
    order = np.argsort(keys, kind="stable")  # the shard's suffix array
    keys, places = keys[order], places[order]
    a, b = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    found = np.flatnonzero(b > a)
    count = (b - a)[found]
    which = np.repeat(found, count)
    return n_words, places[np.repeat(a[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)], which


def longest(place: np.ndarray, item: np.ndarray, at: np.ndarray, length: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, item, place, place in the item and length of the longest matches: windows of one item that begin one word after the other both in
    the text and in the item are one match."""
    order = np.lexsort((place, place - at, item, row))
    place, item, at, length, row = (x[order] for x in (place, item, at, length, row))
    new = np.ones(len(place), bool)
    same = (row[1:] == row[:-1]) & (item[1:] == item[:-1]) & (place[1:] - at[1:] == place[:-1] - at[:-1])
    again = same & (place[1:] == place[:-1])
    new[1:] = ~(again | same & (place[1:] == place[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    return row[first], item[first], place[first], at[first], place[last] + length[last] - place[first]


def blocks(items: Iterable[tuple[object, str | None]], limit: int) -> Iterator[list[Part]]:
    """Items by blocks of ``limit`` characters about; a longer one in parts that overlap by WINDOW - 1 words, so that no window is lost."""
    block, size = [], 0
    for number, (name, text) in enumerate(items):
        parts, n = [(text, 0)], len(text or "")
        if n > limit:
            at = [m.span() for m in _WORD.finditer(text)]
            step = max(1, limit * len(at) // n - WINDOW + 1)
            last = max(1, len(at) - WINDOW + 1)  # windows begin before this word
            parts = [(text[at[i][0] : at[min(i + step + WINDOW - 1, len(at)) - 1][1]], i) for i in range(0, last, step)] if at else [("", 0)]
        for part, before in parts:
            if block and size + len(part or "") > limit:
                yield block
                block, size = [], 0
            block.append((name, part, number, before))
            size += len(part or "")
    if block:
        yield block


class Benchmark:
    """The benchmark's blocks: one goes with the task, several lie in broadcast files of which a task holds one at a time."""

    def __init__(self, benchmark: DataFrame, max_words: int):
        rows, limit = benchmark.select("item_id", "text").where("item_id is not null"), 2 * max_words
        n = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
        if n <= limit:
            self.one, self.files = Tests([(r[0], r[1], k, 0) for k, r in enumerate(rows.collect())]), []
        else:
            context = benchmark.sparkSession.sparkContext
            self.one, self.files = None, [context.broadcast(Tests(x)) for x in blocks(((r[0], r[1]) for r in rows.toLocalIterator()), limit)]

    def __iter__(self) -> Iterator[Tests]:
        if self.one is not None:
            yield self.one
        for file in self.files:
            yield file.value
            if getattr(file, "_path", None):
                vars(file).pop("_value", None)  # else every block stays in memory

    def find(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...], dict[int, str]]:
        """Words of each row, the longest matches as ``longest`` gives them, with places counted within the row, and the names of items."""
        n_words = np.zeros(len(off) - 1, np.int64)
        parts, names = [], {}
        for tests in self:
            n_words, place, which = find(data, off, tests)
            if len(place):
                parts.append((place, tests.item[which], tests.at[which], tests.lengths[which]))
                names |= {int(tests.item[w]): tests.names[tests.part[w]] for w in np.unique(which)}
        place, item, at, length = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in parts)]) for k in range(4))
        ends = np.cumsum(n_words)
        row = np.searchsorted(ends, place, "right")
        return n_words, longest(place - (ends - n_words)[row] if len(row) else place, item, at, length, row), names


def hit_words(n_rows: int, row: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many words of each row lie in a match."""
    order = np.lexsort((place, row))
    row, place, end = row[order], place[order], (place + length)[order]
    wide = int(end.max()) + 1 if len(end) else 1
    reach = np.maximum.accumulate(end + row * wide) if len(end) else end
    before = np.append(0, reach[:-1])[: len(end)]
    begin = np.maximum(place + row * wide, before)
    return np.bincount(row, np.maximum(0, end + row * wide - begin), n_rows).astype(np.int64)


def prepare(benchmark: DataFrame, max_words: int = MAX_TEST_WORDS) -> Benchmark:
    """The benchmark for all tasks, in blocks of 2 * ``max_words`` characters. Items without item_id or words match nothing."""
    return Benchmark(benchmark, max_words)


def is_contaminated(n_words: np.ndarray, n_hit: np.ndarray) -> np.ndarray:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def matches(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_TEST_WORDS) -> DataFrame:
    """doc_id, item_id (as a string), start, item_start and n_words of every longest verbatim match, places and lengths in words.

    A match has WINDOW words or more, or is the whole of a shorter item; longer ones than WINDOW end where text and item differ. Texts without
    words and items without words have none; repeated rows and items with one item_id have theirs each. Empty tables give no rows.
    """
    tests = prepare(benchmark, max_words)
    names = ["item_id", "start", "item_start", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                _, (row, item, place, at, length), known = tests.find(*utf8(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array([known[i] for i in item.tolist()], pa.string()), *(pa.array(x.astype(np.int64)) for x in (place, at, length))], names=["doc_id", *names])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, f"{docs.select('doc_id')._jdf.schema().toDDL()}, item_id string, start long, item_start long, n_words long")


def contamination(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_TEST_WORDS) -> DataFrame:
    """The columns of ``docs`` but the text, plus n_words, n_hit, n_items, items_sha256, contaminated, n_matches and longest (the words of the
    longest match).

    A null or wordless text has no words and is clean; an item without words matches nothing; items with one item_id count as one.
    Repeated rows stay; an empty benchmark leaves all clean. A task holds 2 * ``max_words`` characters of the benchmark at a time; a larger
    one is read in blocks for every batch of texts, which takes time but loses nothing.
    """
    kinds = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean", "n_matches": "long", "longest": "long"}
    tests = prepare(benchmark, max_words)
    kept = [c for c in docs.columns if c not in kinds]
    out = docs.select(*kept)
    schema = f"{out.drop('text')._jdf.schema().toDDL()}, {', '.join(f'{c} {k}' for c, k in kinds.items())}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                n_words, (row, item, place, _, length), known = tests.find(*utf8(batch.column("text")))
                n_hit, n_matches, most = hit_words(batch.num_rows, row, place, length), np.bincount(row, minlength=batch.num_rows), np.zeros(batch.num_rows, np.int64)
                np.maximum.at(most, row, length)
                found: list[set[str]] = [set() for _ in range(batch.num_rows)]
                for r, i in set(zip(row.tolist(), item.tolist(), strict=True)):
                    found[r].add(known[i])
                digest = [sha256(",".join(sorted(x)).encode()).hexdigest() for x in found]
                rest = batch.drop_columns(["text"])
                columns = [n_words, n_hit, np.array([len(x) for x in found], np.int64), digest, is_contaminated(n_words, n_hit), n_matches, most]
                yield pa.RecordBatch.from_arrays([*rest.columns, *map(pa.array, columns)], names=[*rest.schema.names, *kinds])

    small_batches(docs.sparkSession)
    return out.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_TEST_WORDS) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with all their columns as they are. Null and wordless texts stay, repeated rows are judged
    each, an empty benchmark keeps all, and an empty table gives no rows."""
    tests = prepare(benchmark, max_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                n_words, (row, _, place, _, length), _ = tests.find(*utf8(batch.column("text")))
                yield batch.filter(pa.array(~is_contaminated(n_words, hit_words(batch.num_rows, row, place, length))))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
