"""The fitted models against enumeration."""

from itertools import combinations, product

import numpy as np
import zstandard

from punctuality.llm import language_id, pii, quality

# Language sets


def best_mixture(p, n, steps=3000):
    share = np.full(len(p), 1 / len(p))
    for _ in range(steps):
        part = share[:, None] * p
        share = (part / part.sum(0)) @ n / n.sum()
    return float(np.log(share @ p) @ n)


def test_language_set_is_that_of_all_subsets():
    """The chosen set has the best penalised likelihood of all sets of languages, or one as good."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.full(60, 0.3), 4) + 1e-6
    p /= p.sum(1, keepdims=True)
    model = language_id.Model(("a", "b", "c", "d"), p, 3.0)
    sizes = set()
    for case in range(40):
        truth = rng.choice(4, rng.integers(1, 4), replace=False)
        mix = rng.dirichlet(np.full(len(truth), 2.0)) @ p[truth]
        n = rng.multinomial(int(rng.integers(60, 900)), mix)
        at = np.flatnonzero(n)
        chosen, share, likelihood = model.explain(at, n[at])
        price = 3.0 * 0.5 * np.log(n.sum() + 1)
        objective = {
            s: best_mixture(p[list(s)][:, at], n[at]) - price * (len(s) - 1) for k in range(1, 5) for s in combinations(range(4), k)
        }
        assert likelihood - price * (len(chosen) - 1) > max(objective.values()) - 0.5, case
        assert abs(share.sum() - 1) < 1e-6
        sizes.add(len(chosen))
    assert len(sizes) > 1


def test_noise_is_foreign_by_its_likelihood():
    p = np.full((1, language_id.BUCKETS), 1e-9)
    at, n = language_id.trigrams("the cat sat on the mat and the cat ate")
    p[0, at] = n
    model = language_id.Model(("en",), p / p.sum(), 3.0)
    assert not model.foreign("the cat sat on the mat", 10.0)
    at, n = language_id.trigrams("zqxv")
    ahead = -np.log(language_id.BUCKETS) * n.sum() - np.log(model.probability[0, at]) @ n
    assert ahead > 0 and model.foreign("zqxv", ahead - 0.01) and not model.foreign("zqxv", ahead + 0.01)


# Compression


def test_score_is_the_difference_of_sizes():
    rng = np.random.default_rng(2)
    samples = [[" ".join(rng.choice([f"{s}{i}" for i in range(80)], 60)).encode() for _ in range(120)] for s in "gb"]
    parts = [quality.dictionary(s, 1 << 13) for s in samples]
    measure = quality.Measure(*parts, 3)
    for text in ("g1 g2 g3", " ".join(rng.choice([f"g{i}" for i in range(80)], 3000)), "é" * 5000, "x"):
        raw, sizes = text.encode(), []
        n = -(-len(raw) // quality.PIECE)
        for part in parts:
            compressor = zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(part), write_content_size=False, write_dict_id=False
            )
            sizes.append(sum(len(compressor.compress(raw[len(raw) * i // n : len(raw) * (i + 1) // n])) for i in range(n)))
        assert abs(measure(text) - (sizes[1] - sizes[0]) / len(raw)) < 0.02
    model = quality.Model(measure, 7.0, -0.5, 0.3)
    assert abs(model.score("g1 g2 g3") - 1 / (1 + np.exp(0.5 - 7.0 * measure("g1 g2 g3")))) < 1e-12


def test_training_pieces_cover_whole_texts():
    text = "".join(f"{i:06d}" for i in range(3000))
    assert "".join(quality.chunks("k", text, 1.0)) == text
    drawn = [quality.chunks(str(k), text, 0.25) for k in range(400)]
    places = [text.index(c) // quality.CHUNK for cs in drawn for c in cs]
    n = -(-len(text) // quality.CHUNK)
    counts = np.bincount(places, minlength=n)
    assert len(counts) == n and counts.min() > 60 and counts.max() < 140  # 100 of each place, its end included
    assert quality.chunks("k", None, 1.0) == []


# Random field


def test_marginals_of_trees_are_exact():
    """Without a loop, message passing gives the marginals that enumeration gives."""
    rng = np.random.default_rng(3)
    field = pii.Field(rng.normal(size=(pii.N_SHAPE, pii.N_LABELS)), rng.normal(size=(pii.N_LABELS, pii.N_LABELS)), 1.5)
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[0, 3], [2, 4]])
    for _ in range(5):
        shapes = rng.integers(1, 1 << pii.N_SHAPE, 5)
        labels = np.array([0, 0, rng.integers(0, 3), 0, rng.integers(0, 2)])
        g = pii.Graph([0] * 5, [0] * 5, shapes, labels, chain, skip)
        unary = pii.features(shapes) @ field.node
        weight = {}
        for state in product(range(pii.N_LABELS), repeat=5):
            if any(y and s != y for s, y in zip(state, labels, strict=True)):
                continue
            energy = sum(unary[i, s] for i, s in enumerate(state) if not labels[i])
            energy += sum(field.chain[state[i], state[j]] for i, j in chain)
            energy += sum(field.skip for i, j in skip if state[i] == state[j])
            weight[state] = np.exp(energy)
        total = sum(weight.values())
        want = np.zeros((5, pii.N_LABELS))
        for state, w in weight.items():
            for i, s in enumerate(state):
                want[i, s] += w / total
        assert np.abs(field.beliefs(g, 400) - want).max() < 0.01
