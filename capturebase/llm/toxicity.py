"""Toxicity by weak supervision.

Voters speak for toxicity where they occur and are silent elsewhere: lists of common insults by language, patterns (phrases of dismissal,
threat and address), and words and beginnings of words that a lexicon induction draws from labelled rows. A generative model with a hidden
label, which sees votes and how far each voter is trusted but no document's given label, estimates by expectation maximisation how often each
voter speaks in either class and how far voters go together within a class; voters that do share one voice. Its posterior labels train a sparse linear classifier over words and
beginnings of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import small_batches
from ._text import ALNUM_WORD, LOWER_CODE, slices, span_hashes, utf8, word_bounds

SAMPLE_DOCS = 12_000
SAMPLE_CHARS = 4000  # longer texts aren't learnt from
SAMPLE_BYTES = 12 << 20
VOTERS = 256  # induced ones
SURE = 0.75  # share of an induced voter's labelled documents that are toxic
FEATURES = 4096
STEM = 5  # bytes of a word's beginning
ROUNDS = 40
ALIKE, NOISE = 0.8, 0.5  # correlations from which voters are one at the start, and up to which they are apart within a class
BELIEF, SILENCE = 5.0, 3.0
TRUST = 0.8  # in a list or pattern
MOST_PRIOR = 0.45  # a text without known features is never called toxic

# Common insults by language; each list is one voter.
INSULTS = {
    "de": "abschaum arschloch blöd blödmann depp dreckig dreckskerl dumm dummkopf ekelhaft erbärmlich feigling hohlkopf hurensohn idiot idioten mistkerl missgeburt nichtsnutz pfeife schwachkopf spinner trottel unfähig versager vollidiot wertlos widerlich wichser".split(),
    "en": "airhead asshole bastard blockhead bonehead buffoon clown coward creep cretin degenerate dimwit dipshit disgusting dolt dope douchebag dullard dumb dumbass dunce fathead filth filthy fool freak garbage halfwit idiot idiotic idiots imbecile jackass jerk lowlife loser losers lunatic maggot moron moronic morons nitwit numbskull parasite pathetic pig prick repulsive retard scum scumbag shithead sickening simpleton slob snob stupid swine tool trash twit ugly vermin weirdo wimp worthless wretch".split(),
    "es": "asqueroso asquerosa basura bobo cabrón cobarde cretino escoria estúpida estúpido gilipollas idiota idiotas imbécil inútil mierda patético payaso pendejo perdedor repugnante ridículo tarado tonto".split(),
    "fr": "abruti abrutie bouffon connard connasse crétin débile dégoûtant déchet idiot idiote imbécile incapable lâche minable nul ordure parasite pitoyable racaille raté salaud stupide vermine".split(),
    "it": "cretino deficiente disgustoso fannullone idiota imbecille patetico scemo schifoso stronzo stupido verme".split(),
    "nl": "achterlijk dom eikel idioot klootzak loser nutteloos sukkel walgelijk waardeloos".split(),
    "pt": "burro covarde cretino estúpido idiota imbecil inútil lixo nojento otário patético ridículo".split(),
}
# Phrases, as words in a row; each list is one voter.
PHRASES = {
    "dismissal": ["shut up", "get lost", "go to hell", "piss off", "fuck off", "drop dead", "nobody likes you", "no one likes you", "halt die klappe", "halt den mund", "verpiss dich", "ferme la", "ta gueule", "va te faire", "cállate", "vete a la mierda", "vete al infierno"],
    "threat": ["kill yourself", "i will kill you", "i will hurt you", "hope you die", "you should die", "you will regret", "ich bring dich um", "je vais te tuer", "te voy a matar", "stirb"],
    "contempt": ["you are nothing", "you are worthless", "you are useless", "you are so stupid", "piece of shit", "piece of garbage", "waste of space", "du bist nichts", "du bist wertlos", "tu es nul", "tu es rien", "eres un inútil", "no vales nada", "no sirves para nada"],
}
_LIST, _PHRASE = np.uint64(0x1D107), np.uint64(0x9A5E)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, and their rows."""
    data, off = utf8(pa.array(texts, pa.large_string()))
    s, e, r = word_bounds(data, off, ALNUM_WORD)
    return span_hashes(data, s, e, LOWER_CODE), r


def _lexicon() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of listed words, sorted, and the feature of each one's list; a word of several lists counts for the first."""
    pairs: dict[int, int] = {}
    for k, lang in enumerate(INSULTS):
        for h in _words(INSULTS[lang])[0].tolist():
            pairs.setdefault(h, int(_LIST) + k)
    keys = np.array(sorted(pairs), np.uint64)
    return keys, np.array([pairs[int(k)] for k in keys], np.uint64)


def _phrases() -> list[tuple[np.ndarray, np.uint64]]:
    out = []
    for k, name in enumerate(PHRASES):
        for phrase in PHRASES[name]:
            out.append((_words([phrase])[0], _PHRASE + np.uint64(k)))
    return out


_LISTED, _OF_LIST = _lexicon()
_SAID = _phrases()
VOICES = np.array([*(int(_LIST) + k for k in range(len(INSULTS))), *(int(_PHRASE) + k for k in range(len(PHRASES)))], np.uint64)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of the words, of the beginnings of the longer ones, and of the lists and phrases that occur."""
    s, e, r = word_bounds(data, off, ALNUM_WORD)
    word = span_hashes(data, s, e, LOWER_CODE)
    at = np.minimum(np.searchsorted(_LISTED, word), len(_LISTED) - 1)
    listed = np.flatnonzero(_LISTED[at] == word)
    fs, rs = [word, _OF_LIST[at[listed]]], [r, r[listed]]
    long = np.flatnonzero(e - s > STEM)
    fs.append(span_hashes(data, s[long], s[long] + STEM, LOWER_CODE) ^ np.uint64(0xA5A5A5A5))
    rs.append(r[long])
    for phrase, name in _SAID:
        begin = np.flatnonzero(word[: len(word) - len(phrase) + 1] == phrase[0])
        for j in range(1, len(phrase)):
            begin = begin[(word[begin + j] == phrase[j]) & (r[begin + j] == r[begin])]
        fs.append(np.full(len(begin), name))
        rs.append(r[begin])
    return np.concatenate(fs), np.concatenate(rs)


class LabelModel:
    """For each voter the shares of documents, given either class, in which it speaks, and its voice; and the share of toxic documents.

    ``trust`` is what is believed beforehand of each voter: which part of the documents that it speaks in is toxic. It counts as much as
    BELIEF documents. Silence of voters counts against toxicity up to SILENCE log-odds, as each voter knows some kinds of toxicity only.
    """

    def __init__(self, trust: np.ndarray):
        n = len(trust)
        self.trust, self.on, self.off, self.voice, self.prior = trust, np.full(n, 0.5), np.full(n, 0.01), np.ones(n), 0.1

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Of the hidden label, for each row of votes (0/1)."""
        speaks, silent = self.voice * np.log(self.on / self.off), self.voice * np.log((1 - self.on) / (1 - self.off))
        z = np.log(self.prior / (1 - self.prior)) + votes @ speaks + np.maximum((1 - votes) @ silent, -SILENCE)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def together(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Correlations of the voters within the classes."""
        cover, spread = np.zeros((votes.shape[1],) * 2), np.zeros(votes.shape[1])
        for weight in (q, 1 - q):
            c = votes - weight @ votes / max(weight.sum(), 1e-9)
            cover += (c * weight[:, None]).T @ c
            spread += weight @ (c * c)
        return cover / np.sqrt(np.outer(spread, spread) + 1e-12)

    def fit(self, votes: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
        """Begins with the belief in the voters, of which those that nearly always speak together have one voice."""
        n = votes.shape[1]
        alike = np.nan_to_num(np.corrcoef(votes.T).reshape(n, -1)) if n > 1 and len(votes) > 1 else np.eye(n)
        odds = lambda p: np.log(p / (1 - p))
        z = odds(self.prior) + votes @ ((odds(self.trust) - odds(self.prior)) / np.maximum(1, (alike * (alike > ALIKE)).sum(1)))
        q = np.where(votes.any(1), 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.02)
        for k in range(rounds):
            one, none = q.sum(), (1 - q).sum()
            self.prior = float(np.clip(q.mean(), 1e-3, MOST_PRIOR))
            self.on = np.clip((q @ votes + BELIEF * self.trust) / (one + BELIEF), 1e-4, 1 - 1e-3)
            self.off = np.clip(((1 - q) @ votes + BELIEF * (1 - self.trust) * self.prior) / (none + BELIEF), 1e-5, self.on)
            if k:
                c = self.together(votes, q)
                self.voice = 1 / np.maximum(1, (c * (c > NOISE)).sum(1))
            q = self.posterior(votes)
        return self


class Model:
    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float):
        self.known, self.weights, self.bias = known, weights, bias

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        z = np.full(len(off) - 1, self.bias)
        if len(self.known) and len(data):
            f, r = features(data, off)
            at = np.minimum(np.searchsorted(self.known, f), len(self.known) - 1)
            hit = np.flatnonzero(self.known[at] == f)
            one = np.unique(r[hit] * len(self.known) + at[hit])
            z += np.bincount(one // len(self.known), self.weights[one % len(self.known)], len(z))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[str], toxic: np.ndarray) -> Model:
    """From labelled texts; without both labels, a model that scores all alike."""
    prior = float(np.clip(toxic.mean() if len(toxic) else 0.0, 1e-3, MOST_PRIOR))
    if not len(toxic) or toxic.min() == toxic.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    fs, rs = [], []
    for k in range(0, len(texts), 500):
        f, r = features(*utf8(pa.array(texts[k : k + 500], pa.large_string())))
        order = np.lexsort((f, r))
        f, r = f[order], r[order]
        new = np.append(True, (f[1:] != f[:-1]) | (r[1:] != r[:-1]))[: len(f)]
        fs.append(f[new])
        rs.append((r[new] + k).astype(np.int32))
    kinds, which = np.unique(np.concatenate(fs), return_inverse=True)
    which, r = which.astype(np.int32), np.concatenate(rs)
    del fs, rs
    n, n1 = np.bincount(which, minlength=len(kinds)), np.bincount(which, toxic[r], len(kinds))
    lift = (n1 + 0.5 * prior) / (n + 0.5) / prior
    gain = np.where((n1 >= 3) & (n1 >= SURE * n), n1 * np.log(lift), 0)
    fixed = np.flatnonzero(np.isin(kinds, VOICES))
    gain[fixed] = 0
    voters = np.argsort(-gain, kind="stable")[:VOTERS]
    voters = np.concatenate([fixed, voters[gain[voters] > 0]])
    votes = np.zeros((len(texts), len(voters)))
    place = np.full(len(kinds), -1)
    place[voters] = np.arange(len(voters))
    mine = place[which] >= 0
    votes[r[mine], place[which[mine]]] = 1
    if not len(voters):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    #: The labelled rows have found the induced voters and say how far to trust them; from here on a row's own label has no say.
    trust = np.clip((n1[voters] + TRUST) / (n[voters] + 1), 0.5, 0.98)
    q = LabelModel(trust).fit(votes).posterior(votes)
    #: The classifier: what speaks for either class, fitted to the posterior with an L1 penalty.
    q1 = np.bincount(which, q[r], len(kinds))
    rate = float(q.mean())
    z = np.abs(q1 - n * rate) / np.sqrt(n * rate * (1 - rate) + 1e-9)
    chosen = np.sort(np.argsort(-np.where((n >= 3) & (z > 5), z, 0), kind="stable")[:FEATURES])
    chosen = chosen[(n[chosen] >= 3) & (z[chosen] > 5)]
    place[:] = -1
    place[chosen] = np.arange(len(chosen))
    mine = place[which] >= 0
    col, row = place[which[mine]], r[mine]
    w, b, m = np.zeros(len(chosen)), float(np.log(rate / (1 - rate))), len(texts)
    speed = np.full(len(chosen), 1e-8)
    for _ in range(300):
        y = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], m), -30, 30)))
        d = y - q
        g = np.bincount(col, d[row], len(chosen))
        speed += g * g
        step = 0.5 / np.sqrt(speed)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * 0.05, 0)
        b -= d.sum() / m * 2
    on = w != 0
    order = np.argsort(kinds[chosen][on], kind="stable")
    return Model(kinds[chosen][on][order], w[on][order], min(b, float(np.log(MOST_PRIOR / (1 - MOST_PRIOR)))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, limit: int = SAMPLE_BYTES, longest: int = SAMPLE_CHARS) -> Model:
    """From labelled rows that aren't held out: ``sample`` of them at most, the first by a hash of doc_id, without texts of more than
    ``longest`` characters, up to ``limit`` characters in all."""
    own = labels.where("toxic is not null and doc_id is not null and crc32(cast(doc_id as string)) % 5 != 0")
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample)
    short = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= longest)
    rows = short.join(F.broadcast(own), "doc_id").select("text", "toxic", F.xxhash64("doc_id", F.lit(11)).alias("h")).collect()
    rows.sort(key=lambda x: (x.h, x.text))
    size, kept = 0, []
    for x in rows:
        if (size := size + len(x.text)) > limit:
            break
        kept.append(x)
    return train([x.text for x in kept], np.array([x.toxic for x in kept]))


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` of ``docs`` plus score and predicted."""
    rows = docs.select(*keep, F.col("text").alias("__scored"))
    schema = f"{docs.select(*keep)._jdf.schema().toDDL()}, score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__scored"):
                p = model.score(*utf8(batch.column("__scored")))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    small_batches(docs.sparkSession)
    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    A null or empty text has the score of a text without known features, which is below 0.5. A null doc_id is not held out; null labels
    teach nothing, and of several labels of one doc_id the highest holds. Repeated rows stay; an empty table gives no rows.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return score(rows, fit(docs, labels), ["doc_id", "held_out"])


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that aren't predicted toxic, with all columns of ``docs`` as they are. Null and empty texts stay, repeated rows are judged
    alike, labels that are null or of no document teach nothing, and an empty table gives no rows."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                yield batch.filter(pa.array(model.score(*utf8(batch.column("text"))) < threshold))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
