"""The networks: gradients against differences, the random field against enumeration, windows that cover everything."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from capturebase.llm import langid, pii, pii_variants
from capturebase.llm._text import utf8


def doubled(model):
    model.params = [p.astype(np.float64) for p in model.params]
    return model


def differences(model, loss, grads, seed, per=6):
    g, step = np.random.default_rng(seed), 1e-5
    for p, own in zip(model.params, grads, strict=True):
        used = np.flatnonzero(np.abs(own.ravel()) > 1e-9)
        for k in g.choice(used, min(per, len(used)), replace=False):
            flat = p.ravel()
            old = flat[k]
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert abs((up - down) / (2 * step) - own.ravel()[k]) < 1e-6 * max(1, abs(own.ravel()[k])) + 2e-6


def test_tagger_gradients():
    g = np.random.default_rng(0)
    m = doubled(pii.Model())
    m.params[-1][:] = g.standard_normal((pii.TAGS, pii.TAGS)) * 0.3
    x, y = g.integers(0, pii.N_SYMBOLS, (7, 3)), g.integers(0, pii.TAGS, (7, 3))
    differences(m, lambda: m.gradients(x, y)[0], m.gradients(x, y)[1], 1)


def test_language_gradients():
    m = doubled(langid.Model(["a", "b", "c"]))
    data, off = utf8(pa.array(["some words é here and there, many of them " * 6, "short", "日本語のテキスト" * 9], pa.large_string()))
    s, e, row = langid.windows(data, off)
    given = langid.symbols(data, off, s, e, row)
    given = (given[0], given[1], given[2].astype(np.float64), given[3].astype(np.float64))
    label = row % 3
    differences(m, lambda: m.gradients(given, label)[0], m.gradients(given, label)[1], 2)


def test_random_field_against_enumeration():
    g = np.random.default_rng(5)
    m = doubled(pii.Model())
    tr = m.params[-1]
    tr[:] = g.standard_normal(tr.shape)
    x = g.integers(0, pii.N_SYMBOLS, (4, 2))
    e, _ = m.emissions(x)
    e *= 5
    paths = np.array(list(itertools.product(range(pii.TAGS), repeat=4)))
    for b, n in ((0, 4), (1, 3)):
        score = sum(e[t, b, paths[:, t]] for t in range(n)) + sum(tr[paths[:, t - 1], paths[:, t]] for t in range(1, n))
        assert m.best(e, np.array([4, 3]))[:n, b].tolist() == paths[score.argmax()][:n].tolist()
    y = g.integers(0, pii.TAGS, (4, 2))
    e, _ = m.emissions(x)
    want = 0.0
    for b in range(2):
        score = sum(e[t, b, paths[:, t]] for t in range(4)) + sum(tr[paths[:, t - 1], paths[:, t]] for t in range(1, 4))
        want += np.log(np.exp(score - score.max()).sum()) + score.max() - (sum(e[t, b, y[t, b]] for t in range(4)) + sum(tr[y[t - 1, b], y[t, b]] for t in range(1, 4)))
    assert abs(m.gradients(x, y)[0] - want / 2) < 1e-9


def test_stretches_cover_every_trigger():
    g = random.Random(2)
    for _ in range(200):
        t = "".join(g.choice(["word ", "7", "x", " ", "(at)", "@", "é" * 30, "a" * 90, "12 34 "]) for _ in range(g.randint(0, 40)))
        seen, before = set(), -1
        for a, n in pii.stretches(t):
            assert a >= before and n >= 1
            before = a + (n - 1) * pii.STRIDE + pii.WINDOW
            seen |= set(range(a, before))
        for m in re.finditer(r"[0-9@]|\(at\)", t):
            assert set(range(max(0, m.start() - pii.AROUND), min(len(t), m.end() + pii.AROUND))) <= seen


def test_chunks_cover_all_bytes_and_cut_between_characters():
    g = random.Random(3)
    texts = ["".join(g.choice(["a", " ", "é", "日", "\U0001f600"]) for _ in range(g.choice((0, 1, 50, 127, 128, 129, 400, 1000)))) for _ in range(60)]
    data, off = utf8(pa.array(texts, pa.large_string()))
    s, e, row = langid.windows(data, off)
    for i, t in enumerate(texts):
        mine = [(int(a), int(b)) for a, b, r in zip(s, e, row, strict=True) if r == i]
        assert b"".join(data[a:b].tobytes() for a, b in mine) == t.encode() and all(a < b <= a + langid.CHUNK + 3 for a, b in mine)
        for a, b in mine:
            data[a:b].tobytes().decode()


def test_a_chunk_sees_beyond_its_ends_whatever_else_is_read():
    m = langid.Model(["a", "b"])
    m.params = [p * 4 for p in m.params]
    text = "one two three four five six seven eight nine ten " * 8
    data, off = utf8(pa.array([text, text[:200] + "X" + text[201:], "short"], pa.large_string()))
    s, e, row = langid.windows(data, off)
    p = m.pieces(data, off, s, e, row)
    first, second = np.flatnonzero(row == 0), np.flatnonzero(row == 1)
    changed = [k for k, (a, b) in enumerate(zip(first, second, strict=True)) if np.abs(p[a] - p[b]).max() > 1e-6]
    assert changed == [1]
    near, _ = utf8(pa.array([text[:140] + "X" + text[141:]], pa.large_string()))
    assert np.abs(m.pieces(near, off[:2], s[first], e[first], row[first])[0] - p[first[0]]).max() > 1e-6
    given = langid.symbols(data, off, s, e, row)
    assert np.abs((m.logs(*given)[0] * given[2][langid.CONTEXT :, :, None]).sum(0) - p).max() < 1e-3
    for k in range(len(s)):
        alone = m.pieces(data, off, s[k : k + 1], e[k : k + 1], row[k : k + 1])[0]
        assert np.abs(alone - p[k]).max() < 1e-3


CONTEXTS = ["please call {} before noon", "you can reach me under {}", "write to {} for details, or come by", "my data: {}.", "paid with {} last week", "the host {} was down", "Kontakt: {} (privat)", "llame al {} por favor", "{}", "see {}, thanks"]


@pytest.fixture(scope="module")
def model():
    g = random.Random(8)
    vocabulary = "the a of and house river light day people small very great walk run see under over book table green blue work time water field".split()
    texts = []
    for _ in range(300):
        w = [g.choice(vocabulary) for _ in range(60)]
        w[g.randrange(60)] = g.choice(["bob.smith@mail.example.com", "10.1.22.33", "4539 1488 0343 6467", "+1 (988) 555-2485", "1999", "3.5", "120"])
        texts.append(" ".join(w))
    return pii.train(texts)


def test_variants_held_out_are_found(model):
    g, rng = np.random.default_rng(77), random.Random(77)
    for kind, name in enumerate(pii.KINDS):
        found = n = 0
        texts, spans = [], []
        while n < 150:
            v, c = pii_variants.variant(kind, g), rng.choice(CONTEXTS)
            text = c.format(v)
            a = text.index(v)
            if any(x < a + len(v) and a < y for _, x, y in pii.base_spans(text)):
                continue  # the patterns know it
            texts.append(text)
            spans.append((kind, a, a + len(v)))
            n += 1
        for want, got in zip(spans, pii.added_spans(texts, [pii.base_spans(t) for t in texts], model), strict=True):
            found += any(k == kind and a < want[2] and want[1] < b and abs(a - want[1]) + abs(b - want[2]) <= 2 for k, a, b in got)
        assert found >= 0.9 * n, (name, found / n)


def test_clean_text_and_other_numbers_are_left_alone(model):
    g, rng = np.random.default_rng(5), random.Random(5)
    texts = [rng.choice(CONTEXTS).format(pii_variants.others(g)) for _ in range(400)]
    texts = [t for t in texts if not pii.base_spans(t)]
    added = pii.added_spans(texts, [[] for _ in texts], model)
    assert sum(map(bool, added)) <= 0.02 * len(texts), [(t, x) for t, x in zip(texts, added, strict=True) if x][:10]
    plain = ["the house at the river and the dot on the table", "look at the field , the water", "one two three", "in 1999 and 2004 , 3.5 km away", ""]
    assert pii.added_spans(plain, [[] for _ in plain], model) == [[] for _ in plain]


def test_base_spans_of_random_strings():
    """The quick search against the patterns as they are written."""
    g = random.Random(1)
    email, ip, card, phone = (re.compile(x) for x in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))
    digits = lambda s: re.sub("[^0-9]", "", s)
    pieces = ["a", "B.", "@", "x.y", ".", "..", "-", " ", "1", "25", "255", "256", "0001", "4539148803436467", "4539 1488 0343 6467", "+1", "+", "(988) ", "555-2485", "10.0.0.1", "é", "\n", "%", "@@"]
    for _ in range(20_000):
        t = "".join(g.choice(pieces) for _ in range(g.randint(1, 14)))
        want = [(0, *m.span()) for m in email.finditer(t)]
        want += [(1, *m.span()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        want += [(2, *m.span()) for m in card.finditer(t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
        want += [(3, *m.span()) for m in phone.finditer(t) if 9 <= len(digits(m[0])) <= 15]
        assert sorted(pii.base_spans(t)) == sorted(want), t


def test_long_stretches_are_read_in_parts(model, monkeypatch):
    text = "numbers " + " ".join(str(1000 + i) for i in range(400)) + " call (988) 555-2485 or 0171-2345678 " + " ".join(str(i) for i in range(300))
    want = pii.added_spans([text, "x (988) 555-2485 y"], [[], []], model)
    assert (3, 0, 0) < want[1][0]
    monkeypatch.setattr(pii, "HELD", 16)
    got = pii.added_spans([text, "x (988) 555-2485 y"], [[], []], model)
    assert got[1] == want[1] and {x for x in want[0]} == {x for x in got[0]}
