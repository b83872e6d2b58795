"""The chain of op9 goes through a whole text, however it is laid out."""

import numpy as np

from cardwatch.llm import toxicity

MOVE = (1.2, -0.9, -0.7, 1.6)


def whole(scores):
    """Marginals of one chain over all tokens, by its two messages."""
    cc, ct, tc, tt = MOVE
    n = len(scores)
    fwd, bwd = np.zeros(n), np.zeros(n)
    for k in range(n):
        fwd[k] = scores[k] + (np.logaddexp(ct, fwd[k - 1] + tt) - np.logaddexp(cc, fwd[k - 1] + tc) if k else 0.0)
    for k in range(n - 2, -1, -1):
        b = bwd[k + 1] + scores[k + 1]
        bwd[k] = np.logaddexp(tc, b + tt) - np.logaddexp(cc, b + ct)
    return 1 / (1 + np.exp(-(fwd + bwd)))


def test_marginals_are_those_of_the_whole_text():
    rng = np.random.default_rng(3)
    words = [f"t{k}" for k in range(50)]
    model = toxicity.Model({f"w={w}": float(v) for w, v in zip(words, rng.normal(0, 1.5, 50))}, -0.2, MOVE)
    tagger = toxicity.Tagger(model)
    texts = [" ".join(rng.choice(words, n)) for n in (1, 63, 64, 65, 128, 0, 129, 1000, 3)]
    _, p = tagger.block(texts)
    at = 0
    for text in texts:
        tokens = text.split()
        if tokens:
            want = whole(np.array([tagger.score(t) for t in tokens]))
            assert np.allclose(p[at:at + len(tokens)], want, atol=1e-8), len(tokens)
        at += len(tokens)
    assert at == len(p)


def test_a_word_in_front_does_not_change_marginals_far_from_it():
    rng = np.random.default_rng(4)
    words = [f"t{k}" for k in range(50)]
    tagger = toxicity.Tagger(toxicity.Model({f"w={w}": float(v) for w, v in zip(words, rng.normal(0, 1.5, 50))}, -0.2, MOVE))
    text = " ".join(rng.choice(words, 400))
    _, p = tagger.block([text])
    _, q = tagger.block(["t1 " + text])
    assert np.allclose(p[60:], q[61:], atol=1e-6)


def test_messages_that_hardly_fade_reach_all_columns():
    tagger = toxicity.Tagger(toxicity.Model({"w=bad": 9.0}, 0.0, (9.0, -9.0, -9.0, 9.0)))
    _, p = tagger.block(["bad" + " x" * 700])
    assert p[-1] > 0.9 and p[300] > 0.9


def test_fitting_holds_features_as_arrays():
    import tracemalloc

    words = [toxicity.features(f"word{k}end") for k in range(50)]
    sequences = [([words[(7 * j + k) % 50] for k in range(toxicity.CHAIN)], [int((j + k) % 9 == 0) for k in range(toxicity.CHAIN)]) for j in range(400)]
    numbers = sum(len(t) for s, _ in sequences for t in s)
    tracemalloc.start()
    try:
        toxicity.fit_chain(sequences, rounds=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 52 * numbers  # bytes; lists of numbers beside the arrays took more
