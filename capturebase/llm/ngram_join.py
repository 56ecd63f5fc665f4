"""Near duplicates by an exact Jaccard join of word shingles with PartEnum signatures.

Sets fall into bands of similar size. A band deals the shingle domain out to groups, and each group to SECOND parts; a signature is what a set
has in all parts of a group but one, and a set has one for every choice of that part. Two sets of a band with similarity 3/4 or more differ in
k shingles at most, k a seventh of their sizes' sum. Groups are taken in one order until k // 2 + 1 of them have shingles in two parts or
more: in one of these the sets differ by one shingle at most, so that all parts but one agree, and what agrees isn't empty. Shingles that a
notable share of all documents has are left out, which makes no two sets differ more. Sets without so many groups (short ones, and those of
frequent shingles) have the first shingles in one order as signatures too, frequent ones last.

Equal sets are one from the start. Members of a signature first meet the smallest of them. Where they are in several components, those outside
the largest then meet the others block by block, so that no task holds a whole signature: in large ones first the nearest of a block, which
joins most of them, then all of those in other components that are left. Pairs whose parities of shingle counts differ in too many bins can't be linked and go; the
others are compared by their whole sets, so the links are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import Store, small_batches, small_side
from ._text import LOWER_CODE, SPACE_WORD, mix, slices, span_hashes, trim, utf8, word_bounds
from .components import components

WORDS = 5
SECOND = 3  # parts of a group
LEAST = 16  # sizes below which a set's shingles are too few for groups
FREQUENT = 4000  # a shingle in more than one of so many documents is frequent
SALT_ROWS = 256
SMALL, NEAREST = 64, 2  # members of a signature up to which all meet at once, and beyond which the nearest of a block do first
BLOCK = 2048  # members of a signature that a task holds
FLUSH = 1 << 19  # shingles or signatures that a task holds before it passes them on
PARITY_BYTES, SHORT_BYTES = 8192, 128  # of a set's parities; of those that members of a signature meet with
TASK_ROWS, TOLD = 1 << 16, 200_000  # members about that meet in a task, and pairs that it remembers not to tell twice
_C = [np.uint64(c | 1) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their rows, ordered by row and hash."""
    s, e, row = word_bounds(data, off, SPACE_WORD)
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    w = span_hashes(data, s, e, LOWER_CODE)
    size = np.bincount(row, minlength=len(off) - 1)
    left = np.cumsum(size)[row] - np.arange(len(w))  # words from here to the row's end
    total = np.zeros(len(w), np.uint64)
    for j, c in enumerate(_C):
        there = np.flatnonzero(left > j)
        total[there] += w[there + j] * c
    first = np.ones(len(w), bool)
    first[1:] = row[1:] != row[:-1]
    at = np.flatnonzero((left >= WORDS) | first)
    h = mix(total[at] + np.minimum(left[at], WORDS).astype(np.uint64))
    row = row[at]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _starts(key: np.ndarray) -> np.ndarray:
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.flatnonzero(new)


def _is_frequent(h: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(h), bool)
    return frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h


def _enumerated(h: np.ndarray, row: np.ndarray, n_groups: np.ndarray, need: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of groups and their rows, and whether each row has fewer than ``need`` groups with shingles in two parts."""
    base = np.cumsum(n_groups) - n_groups
    total = int(n_groups.sum())
    code = mix(h ^ np.uint64(0x5851F42D4C957F2D))
    group = base[row] + (((code >> np.uint64(32)) * n_groups[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    part = (((code & np.uint64(0xFFFFFFFF)) * np.uint64(SECOND)) >> np.uint64(32)).astype(np.int64)
    place = group * SECOND + part
    order = np.argsort(place, kind="stable")
    sums, counts = np.zeros(total * SECOND, np.uint64), np.bincount(place, minlength=total * SECOND)
    at = _starts(place[order])
    if len(at):
        sums[place[order][at]] = np.add.reduceat(mix(h ^ _C[4])[order], at)
    sums, counts = sums.reshape(-1, SECOND), counts.reshape(-1, SECOND)
    rich = (counts > 0).sum(1) >= 2
    owner = np.repeat(np.arange(len(n_groups)), n_groups)
    before = np.cumsum(rich) - rich
    before -= before[np.minimum(base, max(total - 1, 0))][owner] if total else 0
    taken = before < need[owner]
    short = np.bincount(owner, rich, len(n_groups)) < need
    whole, many = sums.sum(1, dtype=np.uint64), counts.sum(1)
    sigs, rows = [], []
    for left_out in range(SECOND):
        on = np.flatnonzero(taken & (many > counts[:, left_out]))
        inner = (on - base[owner[on]]).astype(np.uint64) * np.uint64(SECOND) + np.uint64(left_out)
        sigs.append(mix(whole[on] - sums[on, left_out] + inner * _C[1] + salt[owner[on]] * _C[2]))
        rows.append(owner[on])
    return np.concatenate(sigs), np.concatenate(rows), short


def signatures(h: np.ndarray, row: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and their rows, for sets as ``shingle_sets`` gives them."""
    sigs, rows = [], []
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = np.bincount(row)
    hot = _is_frequent(h, frequent)
    band = np.frexp(np.maximum(n, 1).astype(float))[1].astype(np.int64) - 1
    for lower in (0, 1):
        #: A set just above its band's lower end also meets the sets below.
        j = band - lower
        ok = (n > 0) & (j >= 0) & ((lower == 0) | (3 * n < 4 << band))
        if not ok.any():
            continue
        top = np.left_shift(2, np.maximum(j, 0))
        k = (n + (np.minimum(4 * n // 3, 4 * top // 3) if lower == 0 else top)) // 7
        grouped = ok & (top > LEAST)
        short = ok.copy()
        if grouped.any():
            mine = grouped[row] & ~hot
            s, r, few = _enumerated(h[mine], row[mine], np.where(grouped, top // 4, 0), np.where(grouped, k // 2 + 1, 0), (j + 1).astype(np.uint64))
            sigs.append(s)
            rows.append(r)
            short &= ~grouped | few
        #: The first shingles in one order; sets that differ in k shingles share one of their first k + 1.
        mine = short[row]
        if mine.any():
            r, x, late = row[mine], mix(h[mine] + _C[3]), hot[mine]
            order = np.lexsort((x, late, r))
            r, x = r[order], x[order]
            begin = _starts(r)
            rank = np.arange(len(r)) - np.repeat(begin, np.diff(np.append(begin, len(r))))
            take = rank <= k[r]
            sigs.append(mix(x[take] + (j[r[take]] + 1).astype(np.uint64) * _C[0]))
            rows.append(r[take])
    return np.concatenate([*sigs, np.zeros(0, np.uint64)]), np.concatenate([*rows, np.zeros(0, np.int64)])


def parities(h: np.ndarray, row: np.ndarray, n_rows: int) -> list[bytes]:
    """For each row a bit a bin: whether an odd number of its shingles falls there. Bins that differ between two sets are at most as many
    as the shingles that do, so this bounds the difference from below."""
    n = np.bincount(row, minlength=n_rows)
    band = np.zeros(n_rows, np.int64)
    for j in range(1, 8):
        band += n >= 4**j
    size = np.clip(4**band, 1, PARITY_BYTES)
    begin = np.cumsum(size) - size
    bit = begin[row] * 8 + (h & (size[row] * 8 - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(bit, minlength=int(size.sum()) * 8) & 1).astype(np.uint8), bitorder="little")
    return [bits[a : a + k].tobytes() for a, k in zip(begin, size, strict=True)]


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """The same parities with fewer bins, for each row of x."""
    return np.bitwise_xor.reduce(x.reshape(len(x), -1, size), axis=1)


def _described(docs: DataFrame) -> DataFrame:
    """A row for every document: doc, n and two hashes of its set, and its parities, those of a set that a task sees again left null. And
    (doc null, a shingle, its count): how often a task met shingles that may be frequent, equal sets counted once."""
    schema = "kind int, doc long, a long, b long, n long, p binary, f binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple] = set()
        size = n_docs = 0

        def counts() -> pa.RecordBatch:
            h = np.concatenate([*held, np.zeros(0, np.uint64)])
            h.sort()
            at = _starts(h) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.append(at, len(h)))
            some = count >= max(3, n_docs // (2 * FREQUENT))
            k = int(some.sum())
            none = pa.nulls(k, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), none, pa.array(h[at][some].view(np.int64)), none, pa.array(count[some]), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], names=["kind", "doc", "a", "b", "n", "p", "f"])

        for whole in batches:
            for batch in slices(whole, "text"):
                h, row = shingle_sets(*utf8(batch.column("text")))
                n = np.bincount(row, minlength=batch.num_rows)
                a, b = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
                new = np.zeros(batch.num_rows, bool)
                if len(h):
                    at = _starts(row)
                    a[row[at]], b[row[at]] = np.add.reduceat(mix(h), at), np.add.reduceat(mix(h ^ _C[0]), at)
                    for i in row[at].tolist():
                        key = (int(a[i]), int(b[i]))
                        new[i] = key not in seen
                        seen.add(key)
                    mine = new[row]
                    held.append(h[mine])
                    size, n_docs = size + len(held[-1]), n_docs + int(new.sum())
                    own = np.cumsum(new) - 1
                    p = iter(parities(h[mine], own[row[mine]], int(new.sum())))
                bits = [next(p) if x else None for x in new]
                short = [x if x is None or len(x) <= SHORT_BYTES else _folded(np.frombuffer(x, np.uint8)[None], SHORT_BYTES).tobytes() for x in bits]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(batch.num_rows, np.int32)), batch.column("doc_id"), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(bits, pa.binary()), pa.array(short, pa.binary())], names=["kind", "doc", "a", "b", "n", "p", "f"])
                if size > 2 * FLUSH:
                    yield counts()
                    held.clear()
                    seen.clear()
                    size = n_docs = 0
        yield counts()
        held.clear()
        trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _frequent(described: DataFrame) -> np.ndarray:
    """Hashes of frequent shingles. Their number is at most FREQUENT times the mean set size, whatever the input."""
    n = described.where("kind = 0").count()
    counts = described.where("kind = 1").groupBy("a").agg(F.sum("n").alias("c"))
    kept = counts.where((F.col("c") >= 12) & (F.col("c") > n / FREQUENT)).select("a")
    return np.sort(np.array([r.a for r in kept.collect()], np.int64).view(np.uint64))


def _emit(docs: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """Blocks of (signature, set) by bucket, one set a signature and block, and in negative buckets blocks of (signature, set, smallest set)
    for the signatures that several sets of a block have: these members never travel, whatever their number."""

    def packed(sig: np.ndarray, own: np.ndarray, turn: int) -> pa.RecordBatch:
        order = np.lexsort((own, sig))
        sig, own = sig[order], own[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (own[1:] != own[:-1])
        sig, own = sig[new], own[new]
        at = _starts(sig) if len(sig) else np.zeros(0, np.int64)
        count = np.diff(np.append(at, len(sig)))
        many = np.repeat(count > 1, count)
        local = np.stack([sig[many].view(np.int64), own[many], np.repeat(own[at], count)[many]])
        sig, own = sig[at], own[at]
        to = (((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        cut = _starts(to) if len(to) else np.zeros(0, np.int64)
        ends = np.append(cut[1:], len(to)).astype(np.int64)[: len(cut)]
        blobs = [sig[x:y].tobytes() + own[x:y].tobytes() for x, y in zip(cut, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.append(to[cut], -1 - turn % buckets)), pa.array([*blobs, local.tobytes()], pa.binary())], names=["bucket", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, sets, size, turn = [], [], 0, None
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                h, row = shingle_sets(*utf8(batch.column("text")))
                if not len(h):
                    continue
                turn = int(batch.column("doc_id")[0].as_py()) if turn is None else turn + 1
                at = _starts(row)
                a = np.add.reduceat(mix(h), at)
                new = np.zeros(batch.num_rows, bool)
                name = np.zeros(batch.num_rows, np.uint64)
                name[row[at]] = a
                for i, key in zip(row[at].tolist(), a.tolist(), strict=True):
                    new[i] = key not in seen
                    seen.add(key)
                mine = new[row]
                sig, r = signatures(h[mine], row[mine], frequent)
                sigs.append(sig)
                sets.append(name[r].view(np.int64))
                size += len(sig)
                if size > FLUSH:
                    yield packed(np.concatenate(sigs), np.concatenate(sets), turn)
                    sigs, sets, size, seen = [], [], 0, set()
        if sigs:
            yield packed(np.concatenate(sigs), np.concatenate(sets), turn)
        del sigs, sets
        trim()

    return docs.mapInArrow(run, "bucket long, blob binary")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sig, own and center for each set that shares a signature: its smallest set is the center. Rows come by bucket; a task holds one."""
    names = ["sig", "own", "center"]
    parts: list[np.ndarray] = []
    last = None

    def grouped() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(parts, axis=1)
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
        rows = rows[:, new]
        at = _starts(rows[0])
        count = np.diff(np.append(at, rows.shape[1]))
        many = np.repeat(count > 1, count)
        if many.any():
            yield from told(np.stack([rows[0][many], rows[1][many], np.repeat(rows[1][at], count)[many]]))

    def told(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, rows.shape[1], 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[k : k + 50_000])) for x in rows], names=names)

    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
            raw = np.frombuffer(blob.as_buffer(), np.int64)
            if bucket < 0:
                yield from told(raw.reshape(3, -1))
                continue
            if bucket != last and parts:
                yield from grouped()
                parts.clear()
            last = bucket
            parts.append(raw.reshape(2, -1).copy())
    if parts:
        yield from grouped()
        parts.clear()
    trim()


def _verify(store: Store, docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have similarity 3/4 or more. Each b's set goes to its a; busy a's are salted."""
    n = pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    busy = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))
    go = pairs.join(busy, "a").select(F.col("b").alias("doc_id"), F.struct("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.lit(1).alias("part")).alias("to"))
    own = busy.select(F.col("a").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).select("doc_id", F.struct(F.col("doc_id").alias("a"), "salt", F.lit(0).alias("part")).alias("to"))
    routes = store.put(go.unionAll(own).groupBy("doc_id").agg(F.collect_list("to").alias("to")), f"{name}routes")
    wide = routes.agg(F.sum(64 + 48 * F.size("to"))).first()[0] or 0

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, row = shingle_sets(*utf8(batch.column("text")))
                begin = np.searchsorted(row, np.arange(batch.num_rows + 1))
                ids, to = batch.column("doc_id").to_pylist(), batch.column("to").to_pylist()
                out = [(t["a"], t["salt"], t["part"], ids[i], h[begin[i] : begin[i + 1]].tobytes()) for i in range(batch.num_rows) for t in to[i]]
                for k in range(0, len(out), 100):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 100], strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["a", "salt", "part", "b", "h"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine = None, []
        for batch in batches:
            a, b = [], []
            for x, salt, part, y, blob in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "part", "b", "h")), strict=True):
                if (x, salt) != key:
                    key, mine = (x, salt), []
                h = np.frombuffer(blob, np.uint64)
                if part == 0:
                    mine.append(h)
                    continue
                for own in mine:
                    if 4 * min(len(own), len(h)) < 3 * max(len(own), len(h)):
                        continue
                    both = len(own) + len(h)
                    joined = np.concatenate([own, h])
                    joined.sort(kind="stable")
                    common = int((joined[1:] == joined[:-1]).sum())
                    if 100 * common >= 75 * (both - common):
                        a.append(x)
                        b.append(y)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        trim()

    sent = docs.select("doc_id", "text").join(small_side(routes, wide), "doc_id").select("doc_id", "text", "to").mapInArrow(sets, "a long, salt int, part int, b long, h binary")
    return store.put(sent.repartition(int(n), "a", "salt").sortWithinPartitions("a", "salt", "part").mapInArrow(compare, "a long, b long"), f"{name}links")


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parities differ in no more bins than linked sets may."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (n, m, p, q) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n", "m", "p", "q")), strict=True)):
            x, y = np.frombuffer(p, np.uint8)[None], np.frombuffer(q, np.uint8)[None]
            size = min(x.shape[1], y.shape[1])
            keep[i] = 7 * int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()) <= n + m
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _cross(nearest: int | None):
    """Pairs of a signature's members in different components that may be linked; in signatures of more than SMALL members only the
    ``nearest`` of a block to the one that asks, if that is given. Rows come by signature and block: first the block's members, which are
    held, then those that ask for it, which pass by. Signatures of one cluster follow each other, so that most pairs are told once."""
    names = ("most", "salt", "block", "sig", "asks", "k", "doc", "n", "c", "f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cluster: tuple | None = None
        key: tuple | None = None
        held: list[tuple] = []
        told: set[tuple[int, int]] = set()
        doc = n = c = f = None

        for batch in batches:
            a, b = [], []
            for most, salt, block, sig, asks, k, d, size, comp, bits in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if (most, salt, block) != cluster or len(told) > TOLD:
                    cluster = (most, salt, block)
                    told.clear()
                if (sig, block) != key:
                    key, held, doc = (sig, block), [], None
                if not asks:
                    held.append((d, size, comp, bits))
                    continue
                if not held:
                    continue
                if doc is None:
                    doc, n, c = (np.array([x[i] for x in held]) for i in range(3))
                    least = min(len(x[3]) for x in held)
                    f = np.concatenate([_folded(np.frombuffer(x[3], np.uint8)[None], least) for x in held])
                #: Two that both ask are one pair.
                fit = np.flatnonzero((c != comp) & (4 * np.minimum(n, size) >= 3 * np.maximum(n, size)) & ((c == most) | (doc > d)))
                if len(fit):
                    q = np.frombuffer(bits, np.uint8)[None]
                    width = min(q.shape[1], f.shape[1])
                    apart = 7 * np.bitwise_count(_folded(f[fit], width) ^ _folded(q, width)).sum(1, dtype=np.int64) - n[fit] - size
                    if nearest is not None and k > SMALL and len(fit) > nearest:
                        some = np.lexsort((doc[fit], apart))[:nearest]
                        fit, apart = fit[some], apart[some]
                    for other in doc[fit[apart <= 0]].tolist():
                        pair = (other, d) if other < d else (d, other)
                        if pair not in told:
                            told.add(pair)
                            a.append(pair[0])
                            b.append(pair[1])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _possible_pairs(store: Store, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Those of ``pairs`` (a, b: documents that stand for sets, of several if they have several texts) which may be linked, each once."""
    pairs = store.put(pairs, f"{name}pairs")
    named = store.put(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), f"{name}named")
    of = store.put(sets.select("doc", "n", "p").join(small_side(named, 64 * named.count()), "doc"), f"{name}of")
    low, high = (of.select(F.col("doc").alias(x), F.col("n").alias(y), F.col("p").alias(z)) for x, y, z in (("a", "n", "p"), ("b", "m", "q")))
    fit = pairs.join(low, "a").join(high, "b").where("4 * least(n, m) >= 3 * greatest(n, m)")
    return store.put(fit.select("a", "b", "n", "m", "p", "q").mapInArrow(_possible, "a long, b long").distinct(), name)


def _members(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """sig and doc of the members of signatures with more than two members."""
    wide = groups.groupBy("sig").count().where("count > 2").select("sig")
    return groups.select("sig", F.col("own").alias("a")).join(wide, "sig").join(sets.select("a", "doc"), "a").select("sig", "doc").distinct()


def _open(store: Store, member: DataFrame, root: DataFrame, name: str) -> DataFrame:
    """sig, doc, c, k of the members of signatures with members in several components; c is the component. Signatures with the same members
    count once."""
    now = member.join(root, "doc", "left").select("sig", "doc", F.coalesce("root", "doc").alias("c"))
    many = now.groupBy("sig").agg(F.count("*").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("name")).where("lo < hi")
    once = many.groupBy("name", "k").agg(F.min("sig").alias("sig")).select("sig", "k")
    return store.put(now.join(once, "sig"), name)


def _crossed(open_: DataFrame, sets: DataFrame, parts: int, nearest: int | None = None) -> DataFrame:
    """a, b: members of a signature in different components which may be linked. Those outside the component that most belong to ask every
    block of the signature's members."""
    each = open_.groupBy("sig", "k", "c").count().groupBy("sig", "k").agg(F.max_by("c", F.struct("count", "c")).alias("most"))
    #: Signatures that mostly are of one component are dealt to as many tasks as they need.
    salts = each.groupBy("most").agg(F.ceil(F.sum("k") / TASK_ROWS).alias("salts"))
    each = each.join(salts, "most").select("sig", "most", F.pmod(F.xxhash64("sig"), "salts").alias("salt"))
    rows = open_.join(each, "sig").join(sets.select("doc", "n", "f"), "doc").withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
    kept = ["sig", "asks", "k", "doc", "n", "c", "f"]
    held = rows.withColumn("asks", F.lit(False)).select("most", "salt", F.pmod(F.xxhash64("doc"), "blocks").cast("int").alias("block"), *kept)
    asking = rows.where("c <> most").withColumn("asks", F.lit(True)).select("most", "salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *kept)
    dealt = held.unionAll(asking).repartition(parts, "most", "salt", "block").sortWithinPartitions("most", "salt", "block", "sig", "asks")
    return dealt.mapInArrow(_cross(nearest), "a long, b long").distinct()


def _links(docs: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """The description of all rows, and links a, b between documents that stand for their sets, and between the sets of one document: they
    connect exactly what the links of similarity 3/4 or more connect."""
    spark: SparkSession = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small_batches(spark)
    described = store.put(_described(docs), "described")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    #: A set is its smallest document.
    known = described.where("kind = 0 and n > 0 and doc is not null")
    sets = store.put(known.groupBy("a", "b", "n").agg(F.min("doc").alias("doc"), F.max("p").alias("p"), F.max("f").alias("f")), "sets")
    #: Blocks are large rows, so that a task gets fewer of them than it would of others.
    tasks = 4 * parts
    buckets = max(tasks, min(8 * parts, 4096))
    emitted = _emit(docs, _frequent(described), buckets).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    groups = store.put(emitted.mapInArrow(_groups, "sig long, own long, center long"), "groups")
    low, high = (sets.select(F.col("a").alias(k), F.col("doc").alias(x)) for k, x in (("center", "a"), ("own", "b")))
    star = groups.where("own <> center").select("own", "center").distinct().join(low, "center").join(high, "own").where("a <> b")
    tested = _possible_pairs(store, star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets, "star")
    near = _verify(store, docs, tested, "star")
    #: A doc_id with several texts is all of their sets.
    several = known.select("doc", "a", "b", "n").join(sets.select("a", "b", "n", F.col("doc").alias("own")), ["a", "b", "n"]).select("doc", "own").distinct()
    several = several.groupBy("doc").agg(F.collect_set("own").alias("own")).where(F.size("own") > 1).select("doc", F.explode("own").alias("own"))
    near = near.unionAll(store.put(several.select(F.col("doc").alias("a"), F.col("own").alias("b")), "several"))
    member = store.put(_members(groups, sets), "member")
    open_ = _open(store, member, components(store, near, "first"), "open0")
    store.drop("groups")
    if open_.isEmpty():
        return described, near
    pairs = _possible_pairs(store, _crossed(open_, sets, parts, NEAREST).join(tested, ["a", "b"], "left_anti"), sets, "nearest")
    if not pairs.isEmpty():
        near, tested = near.unionAll(_verify(store, docs, pairs, "nearest")), tested.unionAll(pairs)
    open_ = open_.where(F.col("k") > SMALL)
    if open_.isEmpty():
        return described, near
    open_ = _open(store, open_.select("sig", "doc"), components(store, near, "second"), "open1")
    more = _possible_pairs(store, _crossed(open_, sets, parts).join(tested, ["a", "b"], "left_anti"), sets, "cross")
    if not more.isEmpty():
        near = near.unionAll(_verify(store, docs, more, "cross"))
    return described, near


def _labelled(docs: DataFrame, store: Store) -> DataFrame:
    """doc, n and the smallest document of its component, for every row."""
    described, near = _links(docs, store)
    root = components(store, near, "all")
    rows = described.where("kind = 0")
    sets = rows.where("n > 0 and doc is not null").groupBy("a", "b", "n").agg(F.min("doc").alias("own"))
    sets = sets.join(root.withColumnRenamed("doc", "own"), "own", "left").select("a", "b", "n", F.coalesce("root", "own").alias("root"))
    joined = rows.select("doc", "a", "b", "n").join(sets, ["a", "b", "n"], "left")
    return joined.select("doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("root", "doc")).alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row.

    A null, empty or blank text has no shingles and is linked with nothing. Rows with one doc_id are one document, linked as any of them
    is; a null doc_id is linked with nothing and has a null component_id. An empty table gives no rows.
    """
    return _labelled(docs, Store(docs.sparkSession)).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays, that with the smallest doc_id; columns as they are. Rows without doc_id stay, and so do rows with
    a null or blank text, and all rows that state the doc_id which stays. An empty table gives no rows."""
    store = Store(docs.sparkSession)
    gone = store.put(_labelled(docs, store).where("doc <> root").select("doc").distinct(), "gone")
    gone = gone.select(F.col("doc").alias("doc_id"))
    return docs.join(small_side(gone, 64 * gone.count()), "doc_id", "left_anti").select(*docs.columns)
