"""The label model against a posterior computed voter by voter, and against votes whose makers are known."""

import math

import numpy as np

from capturebase.llm import toxicity


def made(seed, n=4000, prior=0.15):
    """Votes of independent voters, the last of which is copied three times, and the label that made them."""
    g = np.random.default_rng(seed)
    y = g.random(n) < prior
    on, off = np.array([0.7, 0.5, 0.6, 0.3, 0.55]), np.array([0.02, 0.01, 0.05, 0.01, 0.08])
    v = g.random((n, 5)) < np.where(y[:, None], on, off)
    return np.concatenate([v, v[:, 4:], v[:, 4:], v[:, 4:]], 1).astype(float), y, on, off


def test_posterior_is_that_of_the_votes():
    votes, _, _, _ = made(1, 200)
    m = toxicity.LabelModel(np.full(votes.shape[1], 0.8)).fit(votes)
    q = m.posterior(votes)
    for i in range(len(votes)):
        a, b, quiet = math.log(m.prior), math.log(1 - m.prior), 0.0
        for j, v in enumerate(votes[i]):
            if v:
                a, b = a + m.voice[j] * math.log(m.on[j]), b + m.voice[j] * math.log(m.off[j])
            else:
                quiet += m.voice[j] * (math.log(1 - m.on[j]) - math.log(1 - m.off[j]))
        a += max(quiet, -toxicity.SILENCE)
        assert abs(q[i] - math.exp(a) / (math.exp(a) + math.exp(b))) < 1e-9


def test_shares_and_correlations_are_found_without_labels():
    votes, y, on, off = made(2)
    m = toxicity.LabelModel(np.full(votes.shape[1], 0.8)).fit(votes)
    assert np.abs(m.on[:4] - on[:4]).max() < 0.08 and np.abs(m.off[:4] - off[:4]).max() < 0.02 and abs(m.prior - y.mean()) < 0.03
    c = m.together(votes, m.posterior(votes))
    assert c[4:, 4:].min() > 0.99 and np.abs(c[:4, :4] - np.eye(4)).max() < 0.15
    assert m.voice[4:].max() < 0.3 and m.voice[:4].min() > 0.7
    assert ((m.posterior(votes) > 0.5) == y).mean() > 0.95


def test_lists_and_phrases_vote():
    from capturebase.llm._text import utf8
    import pyarrow as pa

    texts = ["You IDIOT, shut up!", "shut the door up", "du Trottel", None, "", "say: no vales nada."]
    f, r = toxicity.features(*utf8(pa.array(texts, pa.large_string())))
    names = [*toxicity.INSULTS, *toxicity.PHRASES]
    got = {i: {names[k] for k, v in enumerate(toxicity.VOICES) if v in set(f[r == i].tolist())} for i in range(len(texts))}
    assert got[0] >= {"dismissal"} and len(got[0]) == 2 and got[2] == {"de"} and got[5] == {"contempt"} and got[1] == got[3] == got[4] == set()


def test_classifier_learns_from_votes_alone():
    g = np.random.default_rng(3)
    texts, y = [], []
    for _ in range(800):
        bad = g.random() < 0.2
        words = [f"w{g.integers(60)}" for _ in range(30)] + (["you", str(g.choice(["idiot", "moron", "zorgle"]))] if bad else [])
        texts.append(" ".join(words))
        y.append(int(bad))
    from capturebase.llm._text import utf8
    import pyarrow as pa

    model = toxicity.train(texts, np.array(y))
    p = model.score(*utf8(pa.array(["hello zorgle there", "hello idiot there", "w1 w2 w3", ""], pa.large_string())))
    assert p[0] > 0.5 and p[1] > 0.5 and p[2] < 0.5 and p[3] < 0.5
