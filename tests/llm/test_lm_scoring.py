"""Language-model scores: counts and base by hand, the model as a distribution, its training."""

import math
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from fixtures import ODD_ROWS, clashing, frame, random_texts, words

from stockflow.llm import attention, lm_scoring
from stockflow.llm.queries import table

PATH = public_tokenizers.path("piece_bpe_32k.model")


def by_hand(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in rows]
    counts, texts = Counter(), 0
    for h, (_, text, *_) in zip(held, rows):
        if not h:
            counts.update(words(text))
            texts += 1
    total, distinct = sum(counts.values()) + texts, len(counts) + (texts > 0)
    log = lambda c: math.log10((c + 1) / (total + distinct + 1))
    out = []
    for h, (i, text, *_) in zip(held, rows):
        own = words(text)
        base = sum(log(counts[w]) for w in own) + log(texts)
        out.append((i, h, len(own) + 1, sum(counts[w] > 0 for w in own) + (texts > 0), total, base))
    return out


@pytest.mark.parametrize("most", [0, 20, 1 << 19])
def test_counts_and_base(spark, most):
    rows = [(k, t, "en", "s") for k, t in enumerate(random_texts(2))] + ODD_ROWS
    found = lm_scoring.score(clashing(frame(spark, rows)), PATH, sample=20, steps=5, most=most).collect()
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    want = sorted((repr(i), h, n, k, t, round(b, 4)) for i, h, n, k, t, b in by_hand(rows))
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_no_rows_and_nothing_to_learn_from(spark):
    assert lm_scoring.score(frame(spark, []), PATH).collect() == []
    alone = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = lm_scoring.score(frame(spark, [(alone, "some words", "en", "s")]), PATH).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0)


def test_learning_takes_all_texts_and_draws_from_distinct_ones(spark, monkeypatch):
    own = random_texts(3)
    rows = [(k, t, "en", "s") for k, t in enumerate(own + [own[0]] * 60)]
    trained = [t for k, t, *_ in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    drawn, expected = [], []
    sampled, with_parts = lm_scoring.sampled, attention.with_parts
    monkeypatch.setattr(lm_scoring, "sampled", lambda *a: drawn.append(sampled(*a).collect()) or sampled(*a))
    monkeypatch.setattr(attention, "with_parts", lambda *a: expected.append(a[1]) or with_parts(*a))
    all_distinct = len(set(trained))
    for share, least, most in ((1 << 40, 30, 30), (1, all_distinct, all_distinct)):
        monkeypatch.setattr(lm_scoring, "SAMPLE_SHARE", share)
        lm_scoring.score(frame(spark, rows), PATH, sample=30, steps=5).collect()
        assert least <= len(drawn[-1]) == len({r.place for r in drawn[-1]}) <= most
        # every subword of every training text, and each text's end, is given by some part
        model = lm_scoring.Subwords(PATH).model
        want = np.zeros(model.vocab_size())
        for text in trained:
            for word in words(text):
                np.add.at(want, model.encode(word), 1)
            want[lm_scoring.END] += 1
        assert np.allclose(expected[-1].sum(axis=1), want, rtol=1e-4, atol=1e-4)


def test_weights_learn_from_every_training_text(spark, monkeypatch):
    """One text in the sample: yet the weights move with the windows and subwords of all texts."""
    rows = [(k, t, "en", "s") for k, t in enumerate(random_texts(6)[:40])]
    trained = [t for k, t, *_ in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    monkeypatch.setattr(lm_scoring, "SAMPLE_SHARE", 1 << 40)
    rounds, averaged = [], attention.averaged
    monkeypatch.setattr(attention, "averaged", lambda *a: rounds.append(a) or averaged(*a))
    lm_scoring.score(frame(spark, rows), PATH, sample=1, steps=5).collect()
    model = lm_scoring.Subwords(PATH).model
    texts = [[p for word in words(t) for p in model.encode(word)] for t in trained]
    _, kind, row, sums, *_ = rounds[-1]
    # the numbers of windows are added up in the last row of the weights
    other = sums[kind == 2][np.argsort(row[kind == 2])].ravel()
    assert other[-1] == sum(-(-(len(t) + 1) // attention.STRIDE) for t in texts)
    assert set(row[kind == 0].tolist()) >= {lm_scoring.BEGIN, *(p for t in texts for p in t)}


def small_model():
    draw = np.random.default_rng(3)
    return attention.new_model(draw.dirichlet(np.ones(50))), draw


def test_probabilities_add_up_and_ignore_what_follows():
    model, draw = small_model()
    ids = draw.integers(0, 50, 60).astype(np.int32)
    for at in (0, 5, 23, 24, 59):
        total = 0.0
        for target in range(50):
            goal = ids.copy()
            goal[at] = target
            total += math.exp(attention.log_probabilities(model, ids, goal, np.array([60]))[at])
        assert abs(total - 1) < 1e-4
    other = ids.copy()
    other[40:] = 7
    same = [attention.log_probabilities(model, x, ids, np.array([60]))[:40] for x in (ids, other)]
    assert np.allclose(*same, atol=1e-6)


def by_plain_loop(model, ids, targets):
    """Natural log of the probability of each target of one text, place by place."""
    out = []
    for i, target in enumerate(targets):
        oldest = max(0, i - i % attention.STRIDE - attention.CONTEXT)
        x = model.embed.astype(float)
        q, own = (x[ids[i]] @ model.project)[: attention.DIM], x[ids[i]]
        looks, values = [], []
        for j in range(oldest, i + 1):
            row = x[ids[j]] @ model.project
            looks.append(math.exp(q @ row[attention.DIM : 2 * attention.DIM] / attention.DIM**0.5 + model.distance[i - j]))
            values.append(row[2 * attention.DIM :])
        context = sum(a * v for a, v in zip(looks, values)) / sum(looks)
        h = np.maximum(np.concatenate([own, context]) @ model.hidden + model.hidden_bias, 0)
        shares = np.exp(h @ model.out + model.out_bias)
        out.append(math.log(shares @ model.parts[target] / shares.sum()))
    return out


def test_probabilities_and_expected_counts_are_those_of_a_plain_loop():
    model, draw = small_model()
    model = replace(model, distance=draw.standard_normal(attention.WINDOW).astype(np.float32))
    lengths = np.array([1, 24, 70, 25])
    ids, goal = (draw.integers(0, 50, lengths.sum()).astype(np.int32) for _ in range(2))
    found = attention.log_probabilities(model, ids, goal, lengths)
    want = [v for a, b in zip(np.cumsum(lengths) - lengths, np.cumsum(lengths)) for v in by_plain_loop(model, ids[a:b], goal[a:b])]
    assert np.allclose(found, want, atol=0.02)
    expected = attention.Expectation(model)
    expected.add(ids, goal, lengths)
    assert np.allclose(expected.counts().sum(axis=1), np.bincount(goal, minlength=50), rtol=1e-4)


@pytest.mark.parametrize("bound", [1.0, 30.0, 200.0])
def test_the_quick_exponential_is_near_the_exact_one(bound):
    values = np.linspace(-bound, bound, 20_001, dtype=np.float32)
    quick, exact = values.copy(), values.copy()
    attention._raised(quick)
    attention._exponential(exact)
    assert np.isfinite(quick).all() and (quick > 0).all() and (np.diff(quick) >= 0).all()
    assert np.abs(quick / exact - 1).max() < 0.011


def test_scores_of_rows_are_those_of_a_plain_loop(spark, monkeypatch):
    rows = [(k, t, "en", "s") for k, t in enumerate(random_texts(4)[:25])] + ODD_ROWS
    learned, with_parts = [], attention.with_parts
    monkeypatch.setattr(attention, "with_parts", lambda *a: learned.append(with_parts(*a)) or learned[-1])
    found = lm_scoring.score(frame(spark, rows), PATH, sample=20, steps=50).collect()
    subwords = lm_scoring.Subwords(PATH).model
    want = []
    for i, text, *_ in rows:
        if len(text or "") > 5000:
            continue
        ids = [p for word in words(text) for p in subwords.encode(word)]
        logs = by_plain_loop(learned[-1], [lm_scoring.BEGIN, *ids], [*ids, lm_scoring.END])
        want.append((repr(i), len(words(text)) + 1, sum(logs) / math.log(10)))
    short = {(i, n) for i, n, _ in want}
    got = [(repr(r.doc_id), r.n_tokens, r.score) for r in found if (repr(r.doc_id), r.n_tokens) in short]
    assert len(got) == len(want) > 25
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 0.02 + 0.002 * abs(b[2])


def test_texts_of_a_slice_do_not_see_each_other():
    model, draw = small_model()
    ids = draw.integers(0, 50, 100).astype(np.int32)
    both = attention.log_probabilities(model, ids, ids, np.array([30, 70]))
    alone = [attention.log_probabilities(model, x, x, np.array([len(x)])) for x in (ids[:30], ids[30:])]
    assert np.allclose(both, np.concatenate(alone), atol=1e-5)


def test_windows_score_each_place_once():
    first, end = attention.windows(np.array([1, 24, 25, 100]))
    places = [p for a, b in zip(first, end) for p in range(a, min(a + attention.STRIDE, b))]
    assert places == list(range(150))


@pytest.mark.parametrize("name", ["project", "distance", "hidden", "hidden_bias", "out", "out_bias", "embed"])
def test_gradients_are_slopes(name):
    model, draw = small_model()
    ids, goal = draw.integers(0, 50, 80).astype(np.int32), draw.integers(0, 50, 80)
    first, end = attention.windows(np.array([30, 50]))
    start = np.repeat([0, 30], [2, 3])
    grads = attention.gradients(model, ids, goal, first, end, start)[1]
    weights = getattr(model, name)
    if name == "embed":
        rows, values = grads[name]
        row, column = int(rows[0]), 3
        place, slope = (row, column), values[0, column]
    else:
        place = tuple(int(draw.integers(0, n)) for n in (weights.shape if name != "distance" else (12,)))
        slope = grads[name][place]
    losses = []
    for step in (1e-2, -1e-2):
        changed = weights.astype(np.float64).copy()
        changed[place] += step
        moved = attention.Model(**{**model.weights(), "parts": model.parts, name: changed})
        losses.append(attention.gradients(moved, ids, goal, first, end, start)[0])
    assert abs((losses[0] - losses[1]) / 2e-2 - slope) < 2e-3 + 0.05 * abs(slope)


def test_the_slopes_come_with_the_expected_counts():
    """Added up by target while the slopes are found: those of a pass of their own."""
    model, draw = small_model()
    lengths = np.array([30, 1, 100, 24, 5])
    ids, goal = (draw.integers(0, 50, lengths.sum()).astype(np.int32) for _ in range(2))
    first, end = attention.windows(lengths)
    start = np.repeat(np.cumsum(lengths) - lengths, -(-lengths // attention.STRIDE))
    sums = np.zeros(model.parts.shape, np.float32)
    loss, _ = attention.gradients(model, ids, goal, first, end, start, sums)
    expected = attention.Expectation(model)
    expected.add(ids, goal, lengths)
    assert np.allclose(sums * model.parts, expected.counts(), rtol=1e-3, atol=1e-5)
    assert abs(loss + attention.log_probabilities(model, ids, goal, lengths).mean()) < 1e-4


@pytest.mark.parametrize("size", [7, 1 << 17])
def test_sums_of_rows_are_those_of_a_plain_loop(size):
    draw = np.random.default_rng(2)
    rows, values = draw.integers(0, size, 500), draw.standard_normal((500, 16))
    want = np.zeros((size, 16))
    np.add.at(want, rows, values)
    for kind in (np.float32, np.float64):
        found, sums = attention._row_sums(rows, values.astype(kind), size)
        assert (found == np.unique(rows)).all() and sums.dtype == kind
        assert np.allclose(sums, want[found], atol=1e-4)


def test_words_have_their_own_subwords_however_many_are_kept(monkeypatch):
    texts = pa.array(random_texts(5)[:60] + ["", "a b a"])
    subwords = lm_scoring.Subwords(PATH)
    want = [[p for word in words(t) for p in subwords.model.encode(word)] for t in texts.to_pylist()]
    for kept in (1 << 20, 0):
        monkeypatch.setattr(lm_scoring, "CACHED", kept)
        for a in range(0, len(texts), 20):
            *_, ids, count = lm_scoring.read_slice(texts.slice(a, 20), subwords)
            ends = np.cumsum(count)
            assert [ids[x:y].tolist() for x, y in zip(ends - count, ends)] == want[a : a + 20]


def test_training_learns_what_follows_what():
    draw = np.random.default_rng(1)
    follow = draw.permutation(30)
    ids = [int(draw.integers(0, 30))]
    for _ in range(3999):
        ids.append(int(follow[ids[-1]]) if draw.random() < 0.9 else int(draw.integers(0, 30)))
    ids = np.array(ids, np.int32)
    unigram = np.full(30, 1 / 30)
    model, losses = attention.new_model(unigram), []
    for number in range(attention.ROUNDS):
        # two tasks of twenty texts each, averaged after each round
        found = []
        for half in (slice(0, 2000), slice(2000, 4000)):
            learner = attention.Learner(model, attention.rate_of(number), seed=number)
            losses.append(learner.read(ids[half], np.roll(ids, -1)[half], np.full(20, 100), passes=6, batch=8))
            found.append(learner.rows_out())
        kind, row, values = (np.concatenate(x) for x in zip(*found))
        keys, place = np.unique(kind * 10_000 + row, return_inverse=True)
        sums = np.zeros((len(keys), attention.PARTS))
        np.add.at(sums, place, values)
        model = attention.averaged(model, keys // 10_000, keys % 10_000, sums, unigram, 1.0)
    assert losses[0] > losses[-1] + 0.5 and losses[-1] < 1.6  # without learning: log 30 = 3.4


def test_the_average_of_one_learner_is_its_own_model():
    model, draw = small_model()
    ids, goal = draw.integers(0, 40, 300).astype(np.int32), draw.integers(0, 50, 300)
    learner = attention.Learner(model)
    learner.read(ids, goal, np.array([100, 200]), passes=2)
    after = attention.averaged(model, *learner.rows_out(), np.full(50, 0.02), 1.0)
    for name, weights in learner.weights.items():
        assert np.allclose(getattr(after, name), weights, atol=1e-6), name
    assert (after.embed[40:] == model.embed[40:]).all()  # subwords that were not read stay
    assert np.allclose(learner.counts.sum(axis=1), np.bincount(goal, minlength=50), rtol=1e-4)


@pytest.mark.parametrize("size", [100, 1 << 17])
def test_ids_of_texts_come_back_from_their_bytes(size):
    ids = np.array([0, 5, size - 1, 7, 99], np.int32)
    count = np.array([0, 3, 0, 2])
    back = lm_scoring.from_binary(lm_scoring.as_binary(ids, count, lm_scoring.id_type(size)).slice(1), lm_scoring.id_type(size))
    assert back[0].tolist() == ids.tolist() and back[1].tolist() == [3, 0, 2]


def test_the_model_beats_the_base_on_held_out_texts(spark):
    found = lm_scoring.score(table(spark, "/root/testdata/sf0.01", "documents"), PATH).filter("held_out").collect()
    assert len(found) > 100
    assert sum(r.score for r in found) > 1.05 * sum(r.base_score for r in found)
