"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network labels every byte of a text. It is read in chunks, cut between characters; the states that enter a chunk from either side are
those after the CONTEXT bytes beyond its end, across white space and words. Equal chunks in equal surroundings are evaluated once a task, a
saving and no approximation. A document's probabilities are the geometric mean over its positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import first_by_hash, small_batches
from ._text import mix, slices, span_hashes, trim, utf8
from .recurrent import Adam, gru, gru_back, gru_states

HIDDEN = 12
CHUNK, CONTEXT = 128, 32  # bytes that a window labels, and that it reads before and after them
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 2000  # of a text: a window that a hash of its id places
STEPS = 350
BATCH = 96
CACHE = 200_000
PAD = 256


def windows(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the chunks: of CHUNK bytes at most, cut before the first byte of a character."""
    size = np.diff(off)
    n = -(-size // CHUNK)
    row = np.repeat(np.arange(len(size)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    s = off[row] + k * CHUNK
    for _ in range(3):
        inside = (k > 0) & (data[s] & 0xC0 == 0x80)
        s = s - inside
    #: A chunk that began within a character is longer by what it was moved.
    last = np.append(row[1:] != row[:-1], True)[: len(row)]
    e = np.where(last, off[row + 1], np.append(s[1:], 0)[: len(s)])
    return s, e, row


def symbols(data: np.ndarray, off: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols read forward and backward (T, B) and which of them are there; a chunk of n bytes begins at CONTEXT in the one and ends, so read,
    at CONTEXT in the other."""
    n = int((e - s).max())
    t = np.arange(n + CONTEXT)[:, None]
    out = []
    for at, low, high in ((s - CONTEXT + t, off[row], e), (s + n + CONTEXT - 1 - t, s, np.minimum(off[row + 1], e + CONTEXT))):
        there = (at >= low) & (at < high)
        out += [np.where(there, data[np.clip(at, 0, len(data) - 1)].astype(np.int64), PAD), there.astype(np.float32)]
    return out[0], out[2], out[1], out[3]


class Model:
    def __init__(self, classes: list[str], seed: int = 5):
        g = np.random.default_rng(seed)
        n, k = HIDDEN, max(1, len(classes))
        make = lambda *shape: (g.standard_normal(shape) * 0.2).astype(np.float32)
        self.classes, self.params = classes, [make(PAD + 1, 3 * n), make(n, 3 * n), make(PAD + 1, 3 * n), make(n, 3 * n), make(2 * n, k), np.zeros(k, np.float32)]

    def logs(self, ahead: np.ndarray, back: np.ndarray, there: np.ndarray, there_back: np.ndarray, keep: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities (bytes of a chunk, B, classes) and the states they come from."""
        w, u, w2, u2, v, b = self.params
        f, r = gru(w, u, ahead, there, keep and keep[0]), gru(w2, u2, back, there_back, keep and keep[1])
        h = np.concatenate([f[CONTEXT:], r[: CONTEXT - 1 : -1]], 2)
        y = h @ v + b
        y -= y.max(2, keepdims=True)
        return y - np.log(np.exp(y).sum(2, keepdims=True)), h

    def gradients(self, given: tuple[np.ndarray, ...], label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over the labelled bytes, and its gradients."""
        ahead, back, there, there_back = given
        keep: tuple = ([], [])
        y, h = self.logs(*given, keep)
        mask = there[CONTEXT:]
        each = np.arange(len(label))
        loss = -float((y[:, each, label] * mask).sum() / mask.sum())
        d = np.exp(y)
        d[:, each, label] -= 1
        d = (d * (mask[:, :, None] / mask.sum())).astype(y.dtype)
        w, u, w2, u2, v, b = self.params
        dh, n = d @ v.T, u.shape[0]
        ahead_h, back_h = np.zeros((len(ahead), *dh.shape[1:2], n), dh.dtype), np.zeros((len(back), *dh.shape[1:2], n), dh.dtype)
        ahead_h[CONTEXT:], back_h[CONTEXT:] = dh[:, :, :n], dh[::-1, :, n:]
        gw, gu = gru_back(w, u, ahead, keep[0], ahead_h)
        gw2, gu2 = gru_back(w2, u2, back, keep[1], back_h)
        return loss, [gw, gu, gw2, gu2, np.einsum("tbh,tbc->hc", h, d), d.sum((0, 1))]

    def train(self, data: np.ndarray, off: np.ndarray, label: np.ndarray, steps: int, seed: int = 7) -> Model:
        """From texts and the place of each one's class."""
        g, opt = np.random.default_rng(seed), Adam(self.params, 0.01)
        s, e, row = windows(data, off)
        by = [np.flatnonzero(label[row] == c) for c in range(len(self.classes))]
        by = [x for x in by if len(x)]
        for k in range(steps if by else 0):
            opt.rate = 0.01 * (1 - 0.9 * k / steps)
            i = np.concatenate([g.choice(x, BATCH // len(by) + 1) for x in by])
            #: A piece of each chunk is labelled, so that short texts are learnt too.
            begin = s[i] + (g.random(len(i)) * np.maximum(1, e[i] - s[i] - CONTEXT)).astype(np.int64)
            end = np.minimum(e[i], begin + g.integers(8, 2 * CONTEXT))
            opt.step(self.gradients(symbols(data, off, begin, end, row[i]), label[row[i]])[1])
        return self

    def pieces(self, data: np.ndarray, off: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Sum over its bytes of each chunk's log-probabilities."""
        out = np.zeros((len(s), len(self.classes)), np.float32)
        order = np.argsort(e - s, kind="stable")
        for k in range(0, len(order), 1024):
            i = order[k : k + 1024]
            ahead, back, there, there_back = symbols(data, off, s[i], e[i], row[i])
            w, u, w2, u2, v, b = self.params
            n = u.shape[0]
            y = np.matmul(v[:n].T, gru_states(w, u, ahead, there, CONTEXT))
            y += np.matmul(v[n:].T, gru_states(w2, u2, back, there_back, CONTEXT)[::-1])
            y += b[:, None]
            y -= y.max(1, keepdims=True)
            y -= np.log(np.exp(y).sum(1, keepdims=True))
            out[i] = (y * there[CONTEXT:, None, :]).sum(0).T
        return out


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS, steps: int = STEPS, chars: int = SAMPLE_CHARS) -> Model:
    """Trained on text and lang of ``sample`` rows at most, the first by a hash of doc_id, with a lang and not held out; of each text on a
    window of ``chars`` characters, anywhere."""
    own = docs.where("lang is not null and text is not null and not coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)")
    at = F.greatest(F.lit(1), F.pmod(F.xxhash64("doc_id", F.lit(31)), F.greatest(F.length("text") - chars + 2, F.lit(1))).cast("int"))
    rows = first_by_hash(own.select("doc_id", F.substring("text", at, F.lit(chars)).alias("text"), "lang"), "doc_id", 3, sample)
    classes = sorted({r.lang for r in rows})
    model = Model(classes)
    if not classes:
        return model
    data, off = utf8(pa.array([r.text for r in rows], pa.large_string()))
    return model.train(data, off, np.array([classes.index(r.lang) for r in rows]), steps) if len(data) else model


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row.

    A null text, or one without a letter, is ``und`` with score 0, as is all if there was nothing to learn from. A null doc_id is not held
    out. Repeated rows stay; an empty table gives no rows. The whole text counts; only fitting reads windows.
    """
    model = model or fit(docs)
    names, classes = ("lang_pred", "score"), np.array(model.classes or ["und"], object)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)).alias("letters"), "text")
    schema = f"{rows.select('doc_id', 'held_out')._jdf.schema().toDDL()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, logs = np.zeros(0, np.uint64), np.zeros((0, len(classes)), np.float32)
        for whole in batches:
            for batch in slices(whole, "text"):
                data, off = utf8(batch.column("text"))
                s, e, r = windows(data, off)
                low, high = np.maximum(s - CONTEXT, off[r]), np.minimum(e + CONTEXT, off[r + 1])
                total = np.zeros((batch.num_rows, len(classes)))
                if len(s) and model.classes:
                    kinds, first, which = np.unique(span_hashes(data, low, high) + mix((s - low).astype(np.uint64) * np.uint64(CHUNK * 4) + (e - s).astype(np.uint64)), return_index=True, return_inverse=True)
                    at = np.minimum(np.searchsorted(seen, kinds), max(len(seen) - 1, 0))
                    new = seen[at] != kinds if len(seen) else np.ones(len(kinds), bool)
                    got = np.empty((len(kinds), len(classes)), np.float32)
                    got[~new] = logs[at[~new]] if len(seen) else 0
                    some = first[new]
                    got[new] = model.pieces(data, off, s[some], e[some], r[some])
                    if len(seen) + new.sum() > CACHE:
                        seen, logs = kinds, got
                    else:
                        seen, logs = np.concatenate([seen, kinds[new]]), np.concatenate([logs, got[new]])
                        order = np.argsort(seen, kind="stable")
                        seen, logs = seen[order], logs[order]
                    for c in range(len(classes)):
                        total[:, c] = np.bincount(r, got[which, c], batch.num_rows)
                    total /= np.maximum(np.bincount(r, e - s, batch.num_rows), 1)[:, None]
                ok = batch.column("letters").to_numpy(zero_copy_only=False) & bool(model.classes)
                p = np.exp(total - total.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                lang = np.where(ok, classes[p.argmax(1)], "und")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(np.where(ok, p.max(1), 0.0))], names=["doc_id", "held_out", *names])
        trim()

    small_batches(docs.sparkSession)
    return rows.mapInArrow(run, schema)
