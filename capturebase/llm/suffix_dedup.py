"""Removal of repeated passages by suffix arrays.

Every string of LENGTH bytes holds one anchor: the leftmost of its GRAM-byte pieces with the smallest hash, which equal strings choose
alike. Neighbouring strings with one anchor form a segment. Equal segments are settled by comparison of hashes, or by the sort if that is
asked for; segments that share an anchor but differ go, with their bytes, to the anchor's shard. There a two-stage suffix sort orders all suffixes: those smaller than
their successor are sorted directly, the others are induced by a scan of the buckets; common prefixes of neighbours of LENGTH bytes or
more then show the repeats. A string whose anchor occurs once can't repeat, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import Store, small_side
from ._text import BASE, BYTE_CODE, mix, slices, span_hashes, trim, utf8

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1  # pieces in a string
SIDE = (LENGTH - GRAM) // 2
SHARD_BYTES = 1 << 20
BUSY = 20_000  # segments of one anchor, beyond which its strings are dealt out by their own hashes
_PLACE = np.uint64((1 << 31) - 1)  # Arrow holds no longer text
_ROW = np.dtype([("a", "<u8"), ("g", "<u8"), ("doc", "<i8"), ("t", "<i8"), ("s", "<i4"), ("n", "<i2"), ("l", "<u4"), ("r", "<u4")])
NULL_ID = -(1 << 63)


def segments(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, row, start within the row, number of strings, and hashes of either side of each segment."""
    n = len(data)
    size = np.diff(off)
    long = np.flatnonzero(size >= LENGTH)
    if not len(long):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), z, z, z, z, z
    h, m = BYTE_CODE[data], 1
    while m < GRAM:
        h = h[:-m] * np.uint64(pow(BASE, m, 1 << 64)) + h[m:]
        m *= 2
    h = mix(h)
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    m = 1
    while 2 * m <= SPAN:
        low = np.minimum(low[:-m], low[m:])
        m *= 2
    if m < SPAN:
        low = np.minimum(low[: len(low) - (SPAN - m)], low[SPAN - m :])
    valid = np.zeros(n + 1, np.int64)
    valid[off[long]] += 1
    valid[off[long + 1] - LENGTH + 1] -= 1
    ok = np.cumsum(valid[: len(low)]) > 0
    new = ok.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~ok[:-1]
    new[off[long]] = True
    s = np.flatnonzero(new)
    after = np.flatnonzero(~ok)
    stop = np.append(s[1:], len(low))
    if len(after):
        gap = np.searchsorted(after, s)
        stop = np.minimum(stop, np.where(gap < len(after), after[np.minimum(gap, len(after) - 1)], len(low)))
    at = (low[s] & _PLACE).astype(np.int64)
    g = mix(span_hashes(data, s, stop - 1 + LENGTH) + (at - s).astype(np.uint64))
    row = np.searchsorted(off, s, "right") - 1
    #: A string reaches SIDE bytes or more beyond its anchor's left or right end, so segments with a common string agree on one side.
    begin, end = np.maximum(at - SIDE, off[row]), np.minimum(at + GRAM + SIDE, off[row + 1])
    sides = [(span_hashes(data, x, y) >> np.uint64(32)).astype(np.uint32) for x, y in ((begin, at + GRAM), (at, end))]
    return h[at], g, row, s - off[row], stop - s, *sides


def merge(doc: np.ndarray, t: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of starts, those that touch or overlap made one; t tells texts of one document apart."""
    if not len(doc):
        return doc, t, a, b
    order = np.lexsort((a, t, doc))
    doc, t, a, b = doc[order], t[order], a[order], b[order]
    change = np.ones(len(doc), bool)
    change[1:] = (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])
    part = np.cumsum(change)
    reach = np.maximum.accumulate(b + part * (1 << 32)) - part * (1 << 32)
    new = change.copy()
    new[1:] |= a[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], t[at], a[at], np.maximum.reduceat(b, at)


def _anchors(docs: DataFrame, buckets: int, sort_all: bool) -> DataFrame:
    """Blocks of segment rows by bucket; blocks of starts already known to repeat have negative buckets. With ``sort_all`` none is known yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, whole in enumerate(batches):
            parts = []
            for batch in slices(whole, "text"):
                a, g, row, s, n, left, right = segments(*utf8(batch.column("text")))
                out = np.empty(len(a), _ROW)
                out["a"], out["g"], out["doc"], out["s"], out["n"] = a, g, batch.column("doc_id").to_numpy(zero_copy_only=False)[row], s, n
                out["l"], out["r"], out["t"] = left, right, batch.column("t").to_numpy()[row]
                parts.append(out)
            rows = np.concatenate([*parts, np.zeros(0, _ROW)])
            parts.clear()
            rows, again = (rows, rows[:0]) if sort_all else _first(rows)
            to = (rows["a"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows, to = rows[order], to[order]
            at = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
            ends = np.append(at[1:], len(to)).astype(np.int64)[: len(at)]
            blobs = [b"".join(np.ascontiguousarray(rows[c][x:y]).tobytes() for c in _ROW.names) for x, y in zip(at, ends, strict=True)]
            dead = np.stack(merge(again["doc"].copy(), again["t"].copy(), again["s"].astype(np.int64), again["s"].astype(np.int64) + again["n"])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(to[at], -1 - turn % buckets)), pa.array([*blobs, dead.tobytes()], pa.binary())], names=["bucket", "blob"])

    return docs.mapInArrow(run, "bucket long, blob binary")


def _first(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest row of each segment, ordered by anchor, and the others."""
    rows = rows[np.lexsort((rows["s"], rows["t"], rows["doc"], rows["g"], rows["a"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["g"][1:] != rows["g"][:-1])
    #: A row stated twice is no repeat of itself.
    rep = np.flatnonzero(new)[np.cumsum(new) - 1] if len(rows) else np.zeros(0, np.int64)
    same = (rows["doc"] == rows["doc"][rep]) & (rows["t"] == rows["t"][rep]) & (rows["s"] == rows["s"][rep])
    return rows[new], rows[~new & ~same]


def _settle(sort_all: bool):
    """Ranges of repeated starts (kind 0), and segments that may share a string with another (kind 1): with ``sort_all`` every one whose
    anchor occurs twice, else those that differ and have a side in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
                raw = blob.as_buffer()
                if bucket < 0:
                    d, t, a, b = np.frombuffer(raw, np.int64).reshape(4, -1)
                    yield _found(0, d, t, a, b, np.zeros(len(d), np.int64))
                    continue
                n, at = len(raw) // _ROW.itemsize, 0
                out = np.empty(n, _ROW)
                for c in _ROW.names:
                    out[c] = np.frombuffer(raw, _ROW[c], n, at)
                    at += n * _ROW[c].itemsize
                parts.append(out)
        if not parts:
            return
        rows = np.concatenate(parts)
        parts.clear()
        other = np.zeros(len(rows), bool)
        if not sort_all:
            rows, again = _first(rows)
            start = again["s"].astype(np.int64)
            d, t, a, b = merge(again["doc"].copy(), again["t"].copy(), start, start + again["n"])
            yield _found(0, d, t, a, b, np.zeros(len(d), np.int64))
            other = np.zeros(len(rows), bool)
        for key in [rows["a"]] if sort_all else [mix(rows["a"] + mix(rows[side].astype(np.uint64))) for side in ("l", "r")]:
            order = np.argsort(key)
            same = np.append(False, key[order][1:] == key[order][:-1])[: len(key)]
            same[:-1] |= same[1:]
            other[order[same]] = True
        rows = rows[other]
        start = rows["s"].astype(np.int64)
        yield _found(1, rows["doc"], rows["t"], start, start + rows["n"], rows["a"].view(np.int64) if len(rows) else np.zeros(0, np.int64))
        del rows
        trim()

    return run


def _found(kind: int, doc: np.ndarray, t: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(doc), kind, np.int32), doc, t, a.astype(np.int32), b.astype(np.int32), key]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["kind", "doc_id", "t", "a", "b", "key"])


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of ``text`` (0 separates its parts) in order of their first ``depth`` symbols, in two stages."""
    n = len(text)
    t = text.astype(np.int64)
    #: A suffix smaller than its successor: the next different symbol is larger.
    turn = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    to = turn[np.searchsorted(turn, np.arange(n))]
    rises = np.where(to < n - 1, t[np.minimum(to + 1, n - 1)] > t, False)
    apart = t == 0
    padded = np.concatenate([t, np.zeros(8 + depth, np.int64)]).astype(np.uint64)
    word = np.zeros(n + depth, np.uint64)
    for k in range(7):  # seven symbols of nine bits
        word = (word << np.uint64(9)) | padded[k : k + n + depth]
    direct = np.flatnonzero(rises & ~apart)
    order = direct[np.argsort(word[direct], kind="stable")]
    key = word[order]
    tied = np.zeros(len(order), bool)
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) if len(order) else np.zeros(0, np.int64)
    for d in range(7, depth, 7):
        tied = np.zeros(len(order), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        w = word[order[at] + d]
        by = np.lexsort((w, group[at]))
        order[at], w = order[at][by], w[by]
        g = group[at]
        split = np.append(True, (g[1:] != g[:-1]) | (w[1:] != w[:-1]))
        step = np.ones(len(order), bool)
        step[1:] = group[1:] != group[:-1]
        step[at] |= split
        group = np.cumsum(step)
    rising = np.split(order, np.searchsorted(t[order], np.arange(1, 258)))
    rising[0] = np.flatnonzero(apart)
    falling: list[list[np.ndarray]] = [[] for _ in range(258)]
    if n and not rises[n - 1] and not apart[n - 1]:
        falling[t[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(258):
        wave = np.concatenate(falling[c]) if falling[c] else np.zeros(0, np.int64)
        scan = [wave]
        while len(wave):
            wave = wave[wave > 0] - 1
            wave = wave[(t[wave] == c) & ~apart[wave]]
            scan.append(wave)
        scan.append(rising[c])
        bucket = np.concatenate(scan)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        if len(before):
            symbol = t[before]
            by = np.argsort(symbol, kind="stable")
            before, symbol = before[by], symbol[by]
            cut = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
            for x, y in zip(cut, np.append(cut[1:], len(symbol)), strict=True):
                falling[symbol[x]].append(before[x:y])
    return np.concatenate(out)


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, up to ``depth``."""
    out = np.zeros(len(a), np.int64)
    at = np.arange(len(a))
    padded = np.concatenate([text, np.zeros(depth, text.dtype)])
    for k in range(depth):
        at = at[padded[a[at] + k] == padded[b[at] + k]]
        if not len(at):
            break
        out[at] = k + 1
    return out


def repeats(doc: np.ndarray, t: np.ndarray, start: np.ndarray, n: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, their texts and starts of strings in ``parts`` that also start earlier; each part holds n strings from ``start``."""
    raw = np.frombuffer(b"\0".join(parts), np.uint8)
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size + 1) - size - 1
    text = raw.astype(np.int16) + 1
    text[begin[1:] - 1] = 0
    own = np.repeat(np.arange(len(n)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner = np.full(len(text), -1)
    owner[begin[own] + inner] = np.arange(len(own))
    sa = suffix_array(text)
    sa = sa[owner[sa] >= 0]
    same = np.zeros(len(sa), bool)
    same[1:] = common(text, sa[:-1], sa[1:]) >= LENGTH
    group, who = np.cumsum(~same), owner[sa]
    d, v, s = doc[own][who], t[own][who], (start[own] + inner)[who]
    order = np.lexsort((s, v, d, group))
    d, v, s, group = d[order], v[order], s[order], group[order]
    new = np.append(True, group[1:] != group[:-1])
    rep = np.flatnonzero(new)[np.cumsum(new) - 1]
    late = (d != d[rep]) | (v != v[rep]) | (s != s[rep])
    return d[late], v[late], s[late]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts whole anchors together, about SHARD_BYTES at a time."""
    held: list[tuple] = []
    size, last = 0, None

    def done(rows: list[tuple]) -> pa.RecordBatch:
        doc, t, s, n, parts = (list(x) for x in zip(*rows, strict=True))
        d, t, a = repeats(*(np.array(x, np.int64) for x in (doc, t, s, n)), parts)
        d, t, a, b = merge(d, t, a, a + 1)
        return _found(0, d, t, a, b, np.zeros(len(d), np.int64))

    for batch in batches:
        for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "t", "s", "n", "part")), strict=True):
            if size >= SHARD_BYTES and key != last:
                yield done(held)
                held, size = [], 0
            held.append(tuple(row))
            size, last = size + len(row[-1]), key
    if held:
        yield done(held)
    held.clear()
    trim()


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, and t, a hash of the text: together they are a document. Texts under one doc_id, or under none, come in order of t."""
    return docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")


def repeated_ranges(docs: DataFrame, store: Store, sort_all: bool = False) -> DataFrame:
    """doc_id, t and ranges [a, b) of starts of strings that also start earlier."""
    spark = docs.sparkSession
    docs = _keyed(docs.where("text is not null"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "kind int, doc_id long, t long, a int, b int, key long"
    found = store.put(_anchors(docs, parts, sort_all).repartition(parts, "bucket").mapInArrow(_settle(sort_all), schema), "found")
    open_ = found.where("kind = 1").select("doc_id", "t", "a", "b", "key")
    busy = store.put(open_.groupBy("key").count().where(F.col("count") > BUSY).select("key", F.lit(True).alias("spread")), "busy")
    marked = open_.join(small_side(busy, 64 * busy.count()), "key", "left").withColumn("spread", F.coalesce("spread", F.lit(False)))
    lists = marked.groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b", "key", "spread")).alias("to"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, off = utf8(batch.column("text"))
                to = batch.column("to")
                flat, count = to.flatten(), pc.list_value_length(to).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(count)), count)
                key, a, b = (flat.field(c).to_numpy() for c in ("key", "a", "b"))
                begin = off[row] + a
                end = np.minimum(off[row] + b - 1 + LENGTH, off[row + 1])
                n = end - begin - LENGTH + 1
                spread = flat.field("spread").to_numpy(zero_copy_only=False) & (n > 0)
                if spread.any():  # one string a row
                    k = n[spread]
                    at = np.repeat(begin[spread], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                    key = np.concatenate([key[~spread], span_hashes(data, at, at + LENGTH).view(np.int64)])
                    row = np.concatenate([row[~spread], np.repeat(row[spread], k)])
                    begin, end, n = np.concatenate([begin[~spread], at]), np.concatenate([end[~spread], at + LENGTH]), np.concatenate([n[~spread], np.ones(len(at), np.int64)])
                doc, t = batch.column("doc_id").to_numpy()[row], batch.column("t").to_numpy()[row]
                for k in range(0, len(n), 10_000):
                    m = slice(k, k + 10_000)
                    raw = pa.array([data[x:y].tobytes() for x, y in zip(begin[m].tolist(), end[m].tolist(), strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(key[m]), pa.array(doc[m]), pa.array(t[m]), pa.array((begin - off[row])[m].astype(np.int32)), pa.array(n[m].astype(np.int32)), raw], names=["key", "doc_id", "t", "s", "n", "part"])

    joined = docs.join(lists, ["doc_id", "t"]).select("doc_id", "t", "text", "to")
    sent = joined.mapInArrow(cut, "key long, doc_id long, t long, s int, n int, part binary")
    late = store.put(sent.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_shards, schema), "late")
    return found.where("kind = 0").unionAll(late).select("doc_id", "t", "a", "b")


def remove_repeats(docs: DataFrame, keep_text: bool = False, sort_all: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row, and with ``keep_text`` the bytes left as kept.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a smaller doc_id, or before in the same one. A null
    text is empty; a null doc_id is the smallest. Rows that agree in doc_id and text are one document stated again: they don't repeat each
    other. Different texts under one doc_id, or without one, are different documents, in order of a hash of the text. An empty table gives no
    rows. ``sort_all`` sends equal segments through the suffix sort too, where else their hashes settle them; the results are the same.
    """
    store = Store(docs.sparkSession)
    ranges = repeated_ranges(docs, store, sort_all)
    lists = ranges.groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b")).alias("to")).withColumnRenamed("doc_id", "k")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(NULL_ID)).cast("long").alias("k"), F.xxhash64("text").alias("t"))
    rows = rows.join(lists, ["k", "t"], "left").select("doc_id", "text", "to")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, off = utf8(batch.column("text"))
                gone = np.zeros(len(data) + 1, np.int64)
                to = batch.column("to")
                size = np.diff(off)
                flat = to.flatten()
                if len(flat):
                    count = pc.list_value_length(to).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    row = np.repeat(np.arange(len(count)), count)
                    a = flat.field("a").to_numpy().astype(np.int64)
                    b = np.minimum(flat.field("b").to_numpy().astype(np.int64) - 1 + LENGTH, size[row])
                    a, row, b = a[a < b], row[a < b], b[a < b]
                    np.add.at(gone, off[row] + a, 1)
                    np.add.at(gone, off[row] + b, -1)
                dead = np.cumsum(gone[:-1]) > 0
                first = dead.copy()
                first[1:] &= ~dead[:-1]
                first[off[:-1][size > 0]] = dead[off[:-1][size > 0]]
                total, spans = np.concatenate([[0], np.cumsum(dead)]), np.concatenate([[0], np.cumsum(first)])
                left = [data[x:y].tobytes() if r == 0 else data[x:y][~dead[x:y]].tobytes() for x, y, r in zip(off[:-1], off[1:], total[off[1:]] - total[off[:-1]], strict=True)]
                columns = [batch.column("doc_id"), pa.array(size), pa.array(total[off[1:]] - total[off[:-1]]), pa.array(spans[off[1:]] - spans[off[:-1]]), pa.array([sha256(x).hexdigest() for x in left])]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(left, pa.binary())] if keep_text else [])], names=names)

    return rows.mapInArrow(run, f"{docs.select('doc_id')._jdf.schema().toDDL()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)
