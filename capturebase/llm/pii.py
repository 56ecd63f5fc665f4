"""Personal data by fixed patterns and by a character-level bidirectional LSTM with a conditional random field.

The network is trained from labelled spans: those that the patterns find in a bounded sample of texts, the same and invented ones in written
variants that the patterns miss, put into windows of the same texts, and numbers that are none of them. It reads windows that overlap and
together cover every place with a digit, an @ or a word for it in the whole text. What overlapping windows say of a character is averaged,
those in which it lies farther from an end counting more; then the random field decodes each stretch of windows as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import first_by_hash, small_batches
from ._text import slices
from .pii_variants import others, variant
from .recurrent import Adam, lstm, lstm_back

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
SAMPLE_DOCS = 1200
SAMPLE_CHARS = 4000  # of a text: a window that a hash of its id places
WINDOW, STRIDE, AROUND = 64, 32, 24
HELD = 4096  # windows that a task reads at a time
HIDDEN, BATCH, STEPS = 24, 96, 600
PLACES, MOST_PLACES = 24, 9600  # of a text, and in all, for invented examples
INVENTED = (0, 3, None, 2, 3, None, 1, 0, 3, None)  # kinds of invented examples, in turn; None is a number of no kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Digits before a match would have begun it, so nothing is lost by the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Where personal data can be: a digit, an @, or what is written for it.
TRIGGER = r"[0-9@]+|[(\[{<]\s?at\s?[)\]}>]|\sat\s[A-Za-z0-9-]+\s(dot\s|\.|[(\[{<]\s?dot)"
_TRIGGER = re.compile(TRIGGER, re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns, ordered by kind and start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return out


SYMBOLS = np.full(256, 1, np.uint8)  # 0 is padding, 1 other characters
SYMBOLS[ord("a") : ord("z") + 1] = SYMBOLS[0xC0:] = 2
SYMBOLS[ord("A") : ord("Z") + 1] = 3
SYMBOLS[0x30:0x3A] = 4
for _i, _c in enumerate(" \n@.+-()%_=\"':,;/#*$&|<>[]{}!?~"):
    SYMBOLS[ord(_c)] = 5 + _i
#: The letters that write @ and . as words are told apart.
for _i, _c in enumerate("atdo"):
    SYMBOLS[ord(_c)] = SYMBOLS[ord(_c.upper())] = 40 + _i
N_SYMBOLS = int(SYMBOLS.max()) + 1


def symbols(text: str) -> np.ndarray:
    return SYMBOLS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 255)]


def stretches(text: str) -> list[tuple[int, int]]:
    """Start and number of windows of each stretch; every character within AROUND of a trigger is in a window of one at least."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b, least = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND), 1
        if out and a < out[-1][0] + STRIDE * (out[-1][1] - 1) + WINDOW:
            a, least = out.pop()
        out.append((a, max(1 + max(0, -(-(b - a - WINDOW) // STRIDE)), least)))
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Model:
    def __init__(self, seed: int = 3):
        g = np.random.default_rng(seed)
        make = lambda *shape: (g.standard_normal(shape) * 0.25).astype(np.float32)
        n = HIDDEN
        self.params = [make(N_SYMBOLS, 4 * n), make(n, 4 * n), make(N_SYMBOLS, 4 * n), make(n, 4 * n), make(2 * n, TAGS), np.zeros(TAGS, np.float32), np.zeros((TAGS, TAGS), np.float32)]

    def emissions(self, x: np.ndarray, keep: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        w, u, w2, u2, v, b, _ = self.params
        h = np.concatenate([lstm(w, u, x, keep and keep[0]), lstm(w2, u2, x[::-1], keep and keep[1])[::-1]], 2)
        return h @ v + b, h

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over windows x with tags y, both (T, B), and its gradients: forward-backward over the tags, then back through time."""
        keep: tuple = ([], [])
        e, h = self.emissions(x, keep)
        w, u, w2, u2, v, b, tr = self.params
        n_t, n_b = x.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, n_t):
            alpha[t] = e[t] + _lse(alpha[t - 1][:, :, None] + tr, 1)
        for t in range(n_t - 2, -1, -1):
            beta[t] = _lse(tr + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        d = np.exp(alpha + beta - z[:, None])
        pair = np.exp(alpha[:-1][:, :, :, None] + tr + (e + beta)[1:][:, :, None, :] - z[:, None, None])
        dt = pair.sum((0, 1))
        np.add.at(dt, (y[:-1].ravel(), y[1:].ravel()), -1)
        at = np.arange(n_t)[:, None], np.arange(n_b), y
        loss = float((z.sum() - e[at].sum() - tr[y[:-1], y[1:]].sum()) / n_b)
        d[at] -= 1
        d, dt = (d / n_b).astype(e.dtype), (dt / n_b).astype(e.dtype)
        dh = d @ v.T
        gw, gu = lstm_back(w, u, x, keep[0], dh[:, :, : u.shape[0]])
        gw2, gu2 = lstm_back(w2, u2, x[::-1], keep[1], dh[::-1, :, u.shape[0] :])
        return loss, [gw, gu, gw2, gu2, np.einsum("tbh,tbc->hc", h, d), d.sum((0, 1)), dt]

    def step(self, x: np.ndarray, y: np.ndarray, opt: Adam) -> None:
        opt.step(self.gradients(x, y)[1])

    def best(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best tags for emissions e (T, B, tags), of which the first ``lengths`` of each column are there."""
        tr = self.params[-1]
        back, score = np.zeros(e.shape, np.int8), e[0].copy()
        for t in range(1, len(e)):
            s = score[:, :, None] + tr
            on = t < lengths
            back[t] = np.where(on[:, None], s.argmax(1), np.arange(e.shape[2]))
            score = np.where(on[:, None], s.max(1) + e[t], score)
        out = np.empty(e.shape[:2], np.int8)
        out[-1] = score.argmax(1)
        for t in range(len(e) - 1, 0, -1):
            out[t - 1] = back[t][np.arange(e.shape[1]), out[t]]
        return out


def tags(text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
    y = np.zeros(len(text), np.int64)
    for kind, a, b in spans:
        y[a] = 1 + 2 * kind
        y[a + 1 : b] = 2 + 2 * kind
    return y


def window(x: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, x.dtype)
    part = x[start : start + WINDOW]
    out[: len(part)] = part
    return out


def examples(texts: list[str], g: np.random.Generator) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Pieces of text with their spans: the texts themselves; places of the patterns' finds with the find written otherwise; and places of any
    kind with an invented find, or a number that is none, between two words."""
    out = [(t, base_spans(t)) for t in texts]
    spots = [(t, m.start()) for t in texts for m in list(re.finditer(r"(?<=\S) (?=\S)", t))[:: max(1, len(t) // 400)][:PLACES]]
    spots = spots[:: max(1, len(spots) // MOST_PLACES)]
    for text, spans in out[: len(texts)]:
        for kind, a, b in spans:
            for _ in range(2):
                out.append(_placed(text[max(0, a - 80) : a], variant(kind, g, text[a:b]), kind, text[b : b + 80]))
    for k, (text, at) in enumerate(spots or [("", 0)] * 1000):
        kind = INVENTED[k % len(INVENTED)]
        #: Some stand at an end of their text, or at a sign.
        left, right = (0 if g.random() < 0.1 else int(g.integers(1, 81)) for _ in range(2))
        sign = str(g.choice(["", "", "", ".", ",", ";", ":", ")"]))
        before, after = text[max(0, at + 1 - left) : at + 1] * (left > 0) + "(" * (sign == ")"), sign + text[at : at + right]
        out.append(_placed(before, others(g) if kind is None else variant(kind, g), kind, after))
    return out


def _placed(before: str, middle: str, kind: int | None, after: str) -> tuple[str, list[tuple[int, int, int]]]:
    """A piece of text around ``middle``, which is a span if it has a kind; what the patterns find elsewhere in it is one too."""
    text, a = before + middle + after, len(before)
    own = [] if kind is None else [(kind, a, a + len(middle))]
    return text, own + [(k, x, y) for k, x, y in base_spans(text) if y <= a or x >= a + len(middle) or kind is None]


def train(texts: list[str], steps: int = STEPS, seed: int = 9) -> Model:
    g, xs, ys = np.random.default_rng(seed), [], []
    for t, spans in examples(texts, g):
        x, y = symbols(t), tags(t, spans).astype(np.int8)
        for a, n in stretches(t):
            for p in range(a, a + n * STRIDE, STRIDE):
                p = max(0, p - int(g.integers(0, 8)))
                xs.append(window(x, p))
                ys.append(window(y, p))
    model = Model()
    if not xs:
        return model
    x, y = np.array(xs), np.array(ys)
    xs.clear()
    ys.clear()
    kind = np.where((y > 0).any(1), (y.max(1) + 1) // 2, 0)
    groups = [np.flatnonzero(kind == k) for k in range(len(KINDS) + 1)]
    #: Windows without a find are most of what will be read.
    weights = [BATCH // 3, BATCH // 6, BATCH // 12, BATCH // 6, BATCH // 4]
    opt = Adam(model.params, 0.012)
    for k in range(steps):
        opt.rate = 0.012 * (1 - 0.95 * k / steps)
        i = np.concatenate([g.choice(rows, w) for rows, w in zip(groups, weights, strict=True) if len(rows)])
        model.step(x[i].T.astype(np.int64), y[i].T.astype(np.int64), opt)
    return model


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS, steps: int = STEPS, chars: int = SAMPLE_CHARS) -> Model:
    """From ``sample`` texts at most with two digits or @, the first by a hash of doc_id; of each a window of ``chars`` characters, anywhere."""
    at = F.greatest(F.lit(1), F.pmod(F.xxhash64("doc_id", F.lit(29)), F.greatest(F.length("text") - chars + 2, F.lit(1))).cast("int"))
    rows = docs.where("text is not null").select("doc_id", F.substring("text", at, F.lit(chars)).alias("t")).where(F.rlike("t", F.lit("[0-9]{2}|@")))
    return train([r.t for r in first_by_hash(rows, "doc_id", 13, sample)], steps)


_AT, _DOT = r"(\s?@\s?|\s?[(\[{<]\s?at\s?[)\]}>]\s?|\sat\s)", r"(\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s|\.)"
_MAIL = re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+({_DOT}[A-Za-z0-9-]+)+", re.IGNORECASE)
_FOUR = re.compile(r"([0-9]{1,3})(\s?[(\[{]?[.][)\]}]?\s?)([0-9]{1,3})\2([0-9]{1,3})\2([0-9]{1,3})")
_CALL = re.compile(r"[+(]?[0-9][0-9().\x20/-]*[0-9]")
_OTHER = re.compile(r"[1-9][0-9]*|[0-9]+\.[0-9]+|(19|20)[0-9]{2}[-./\x20][0-9]{1,2}[-./\x20][0-9]{1,2}|[0-9]{1,2}[-./\x20][0-9]{1,2}[-./\x20]([0-9]{2}|[0-9]{4})|(19|20)[0-9]{2}\x20?[-/]\x20?(19|20)[0-9]{2}")


def plausible(kind: int, found: str) -> bool:
    """Whether what the network found can be what it says, however written."""
    digits = re.sub(r"[^0-9]", "", found)
    if kind == 0:
        m = _MAIL.fullmatch(found)
        return bool(m) and (not re.search(r"\sat\s", found, re.IGNORECASE) or bool(re.search(r"dot", found, re.IGNORECASE)))
    if kind == 1:
        m = _FOUR.fullmatch(found)
        return bool(m) and all(int(m[k]) <= 255 for k in (1, 3, 4, 5))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15 and bool(_CALL.fullmatch(found)) and not _OTHER.fullmatch(found)


def _tagged(texts: list[str], model: Model) -> Iterator[tuple[int, int, np.ndarray, int, int]]:
    """Number of the text, start and best tags of each stretch; HELD windows at a time. A longer stretch is read in parts that overlap, each
    of which answers for what begins between two places."""
    jobs: list[tuple[int, int, int, int, int]] = []

    def done() -> Iterator[tuple[int, int, np.ndarray, int, int]]:
        coded = {k: symbols(texts[k]) for k in {j[0] for j in jobs}}
        x = np.array([window(coded[k], a + i * STRIDE) for k, a, n, _, _ in jobs for i in range(n)]).astype(np.int64)
        e = np.concatenate([model.emissions(x[i : i + 1024].T)[0].transpose(1, 0, 2) for i in range(0, len(x), 1024)])
        count = np.array([j[2] for j in jobs])
        size = (count - 1) * STRIDE + WINDOW
        first = np.cumsum(size) - size
        own = np.repeat(np.arange(len(jobs)), count)
        inner = np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
        place = (first[own] + inner * STRIDE)[:, None] + np.arange(WINDOW)
        #: A stretch's own ends are ends of no window that goes on.
        ramp = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)
        total, weight = np.zeros((int(size.sum()), TAGS), np.float32), np.zeros(int(size.sum()), np.float32)
        np.add.at(total, place.ravel(), (e * ramp[None, :, None]).reshape(-1, TAGS))
        np.add.at(weight, place.ravel(), np.broadcast_to(ramp, place.shape).ravel())
        total /= weight[:, None]
        order = np.argsort(size, kind="stable")
        for k in range(0, len(order), 256):
            some = order[k : k + 256]
            there = np.array([min(int(size[s]), len(texts[jobs[s][0]]) - jobs[s][1]) for s in some])
            grid = np.zeros((int(there.max()), len(some), TAGS), np.float32)
            for c, s in enumerate(some):
                grid[: there[c], c] = total[first[s] : first[s] + there[c]]
            y = model.best(grid, there)
            for c, s in enumerate(some):
                yield jobs[s][0], jobs[s][1], y[: there[c], c], *jobs[s][3:]

    held = 0
    for k, text in enumerate(texts):
        for a, n in stretches(text):
            for b in range(0, max(1, n - 3), HELD):
                m = min(n - b, HELD + 3)
                if held + m > HELD and jobs:
                    yield from done()
                    jobs, held = [], 0
                #: Parts share three windows; each answers up to their middle.
                place = lambda w: a + w * STRIDE + WINDOW  # noqa: B023, E731
                jobs.append((k, a + b * STRIDE, m, place(b) if b else 0, place(b + HELD) if b + m < n else len(text)))
                held += m
    if jobs:
        yield from done()


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], model: Model) -> list[list[tuple[int, int, int]]]:
    """What the network finds besides the base spans."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, start, y, low, high in _tagged(texts, model):
        text, at = texts[k], np.flatnonzero(y)
        i = 0
        while i < len(at):
            j, kind = i, (int(y[at[i]]) - 1) // 2
            while j + 1 < len(at) and at[j + 1] == at[j] + 1 and y[at[j + 1]] == 2 + 2 * kind:
                j += 1
            a, b = start + int(at[i]), start + int(at[j]) + 1
            i = j + 1
            while b > a and text[b - 1] in " .,;:(\n":
                b -= 1
            while a < b and text[a] in " .,;:)\n":
                a += 1
            if a and text[a - 1] == "(" and ")" in text[a:b] and "(" not in text[a:b]:
                a -= 1
            #: A number is whole, or it is another number.
            if low <= a < high and a < b and plausible(kind, text[a:b]) and not (kind and (text[a - 1 : a].isdigit() or text[b : b + 1].isdigit())) and not any(s < b and a < e for _, s, e in base[k] + out[k]):
                out[k].append((kind, a, b))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _triggered(column: pa.Array) -> np.ndarray:
    """Rows with a place to read."""
    hit = pc.match_substring_regex(column, TRIGGER, ignore_case=True)
    return np.flatnonzero(hit.fill_null(False).to_numpy(zero_copy_only=False))


def find_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added for every row; the counts are of the base spans, n_added is of
    what the network adds.

    A null or empty text has none. Repeated rows stay; an empty table gives no rows. Positions are code points, ends exclusive.
    """
    model = model or fit(docs)
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    schema = f"{docs.select('doc_id')._jdf.schema().toDDL()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = _triggered(batch.column("text"))
                texts = [batch.column("text")[int(i)].as_py() for i in rows]
                base = [base_spans(t) for t in texts]
                counts, digest, written = np.zeros((len(KINDS) + 1, batch.num_rows), np.int64), [sha256(b"").hexdigest()] * batch.num_rows, [""] * batch.num_rows
                for i, own, more in zip(rows, base, added_spans(texts, base, model), strict=True):
                    for k, _, _ in own:
                        counts[k, i] += 1
                    counts[-1, i] = len(more)
                    digest[i], written[i] = sha256(_written(own).encode()).hexdigest(), _written(own + more)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, counts[:-1]), pa.array(digest), pa.array(written), pa.array(counts[-1])], names=["doc_id", *names])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def mask(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The columns of ``docs`` with each span of the text replaced by its kind in brackets; overlapping spans by the first's.

    Null and empty texts stay as they are, repeated rows are masked alike, an empty table gives no rows, and no column is added or renamed.
    """
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                column = batch.column("text").to_pylist()
                rows = _triggered(batch.column("text"))
                texts = [column[i] for i in rows]
                base = [base_spans(t) for t in texts]
                for i, text, own, more in zip(rows, texts, base, added_spans(texts, base, model), strict=True):
                    parts, at = [], 0
                    for a, b, k in sorted((a, b, k) for k, a, b in own + more):
                        if a >= at:
                            parts += [text[at:a], f"[{KINDS[k].upper()}]"]
                        at = max(at, b)
                    column[i] = "".join([*parts, text[at:]])
                k = batch.schema.get_field_index("text")
                yield batch.set_column(k, "text", pa.array(column, batch.schema.field(k).type))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
