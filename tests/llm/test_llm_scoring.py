import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import attention, lmscore
from tidemark.llm.lmscore import end_id, lm_scores, trained_on
from tidemark.llm.store import table
from tidemark.llm.tokens import tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")


def base(pairs):
    def words(text):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split() + [None]

    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs]
    counts = Counter(w for (_, t), h in zip(pairs, held) if not h for w in words(t))
    n, v = sum(counts.values()), len(counts)
    for (i, t), h in zip(pairs, held):
        ws = words(t)
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        yield i, h, len(ws), sum(counts[w] > 0 for w in ws), n, score


def test_baseline_equals_brute_force(documents, odd_texts, prose):
    texts = [*odd_texts, *[prose(i % 9, 30 + i) for i in range(60)], "Same WORDS", "same words"]
    pairs = [*enumerate(texts), (None, "a b c"), (4, texts[4]), (4, "other text")]
    got = lm_scores(documents(pairs, extra=("score", "chunk")), WORDS, rounds=1).collect()
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    wanted = sorted(base(pairs), key=repr)
    assert [f[:5] for f in found] == [w[:5] for w in wanted]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in wanted], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_nothing_to_learn_from_and_empty_table(documents):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = lm_scores(documents([(only, "a b")]), WORDS, rounds=1).collect()
    assert (row.held_out, row.n_known, row.train_tokens, row.base_score) == (True, 0, 0, 0.0)
    assert lm_scores(documents([]), WORDS, rounds=1).count() == 0


def model_of(rng, size, learned=400, unseen=20):
    """A model of random sequences over ``size`` ids, the last of which are never counted."""
    text = rng.integers(0, size - unseen, learned)
    counts = np.bincount(text, minlength=size)
    final = rng.random(size) < 0.5
    groups = attention.finest(counts, final).of
    keys, times = np.unique(groups[np.append(size - 1, text[:-1])] * size + text, return_counts=True)
    return attention.Model(counts, final, keys, times), counts, (text, groups)


def test_gradient_and_windows():
    rng = np.random.default_rng(0)
    model, *_ = model_of(rng, 200)
    flat = attention.initial().astype(np.float64)
    flat += rng.normal(0, 0.1, len(flat))
    parts = [attention.windowed(rng.integers(0, 200, n), 199) for n in (1, 25, 70)]
    ids, target, scored = (np.concatenate(x) for x in zip(*parts))
    assert scored.sum() == 96
    args = model.group_of[ids], model.class_of[target], scored, model
    _, grad = attention.gradient(flat, *args)
    some = rng.choice(len(flat), 30, replace=False)
    for i in [*some, *np.argsort(-np.abs(grad))[:30]]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = (attention.gradient(up, *args)[0] - attention.gradient(down, *args)[0]) / 2e-5
        assert slope == pytest.approx(grad[i], abs=1e-6)


def slow_score(flat, model, sequence, begin, counts, learned):
    """The score of one sequence: every id by itself, from the definition."""
    p = {name: value.astype(np.float64) for name, value in attention.unpacked(flat).items()}
    text, groups = learned
    size = len(counts)
    classes, final_classes = model.class_of, np.unique(model.class_of)
    smooth = counts + 0.5
    follows = Counter(zip(groups[np.append(begin, text[:-1])].tolist(), text.tolist()))
    inputs = np.append(begin, sequence[:-1])
    total = 0.0
    for t, wanted in enumerate(sequence.tolist()):
        window = t // attention.TARGETS
        first = window * attention.TARGETS - attention.AHEAD
        seen = [int(inputs[j]) if 0 <= j else begin for j in range(first, t + 1)]
        x = [p["group_in"][model.group_of[i]] + p["place"][k] for k, i in enumerate(seen)]
        q = x[-1] @ p["wq"]
        e = [math.exp(float(q @ (one @ p["wk"])) / math.sqrt(attention.WIDTH)) for one in x]
        mixed_in = sum(w / sum(e) * (one @ p["wv"]) for w, one in zip(e, x))
        y = x[-1] + mixed_in @ p["wo"]
        z = y + np.maximum(y @ p["w1"] + p["b1"], 0) @ p["w2"]
        group = int(model.group_of[seen[-1]])
        after = {i: n for (g, i), n in follows.items() if g == group}
        of_class = Counter()
        for i, n in after.items():
            of_class[int(classes[i])] += n
        share = np.bincount(classes, smooth, attention.CLASSES) / smooth.sum()
        kinds = len(of_class) + 1
        prior = [math.log(max((of_class[c] + kinds * share[c]) / (sum(of_class.values()) + kinds), 1e-30)) for c in range(attention.CLASSES)]
        logits = z @ p["out"] + p["bias"] + prior
        c = int(classes[wanted])
        total += (logits[c] - math.log(np.exp(logits).sum())) / math.log(10)
        within = smooth[wanted] / smooth[classes == c].sum()
        total += math.log10((after.get(wanted, 0) + attention.PRIOR * within) / (of_class[c] + attention.PRIOR))
    assert len(final_classes) <= attention.CLASSES and size == len(classes)
    return total


def test_scores_equal_a_slow_model():
    rng = np.random.default_rng(5)
    model, counts, learned = model_of(rng, 150, 300)
    flat = attention.initial()
    flat += rng.normal(0, 0.2, len(flat)).astype(np.float32)
    for n in (1, 24, 60):
        sequence = rng.integers(0, 150, n)
        fast = sum(x.sum() for x in attention.scored_windows(flat, model, attention.windowed(sequence, 149), batch=2))
        assert fast == pytest.approx(slow_score(flat, model, sequence, 149, counts, learned), rel=1e-4)


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_scorer_gives_what_the_forward_pass_gives(spread):
    rng = np.random.default_rng(8)
    model, *_ = model_of(rng, 400, 3000)
    flat = attention.initial().astype(np.float64)
    flat += rng.normal(0, spread, len(flat))
    ids, target, _ = attention.windowed(rng.integers(0, 400, 500), 399)
    groups, classes = model.group_of[ids], model.class_of[target].ravel()
    log = attention.forward(attention.unpacked(flat), groups, model)["log"]
    scorer = attention.Scorer(flat, model)
    assert scorer.cut_scores == scorer.cut_logits == (spread > 0.1)
    found = scorer.class_log(groups, classes)
    assert found == pytest.approx(log[np.arange(len(classes)), classes], rel=1e-5, abs=1e-5)


def test_scores_are_causal_and_windows_score_each_id_once():
    rng = np.random.default_rng(1)
    model, *_ = model_of(rng, 300)
    flat = attention.initial()
    flat += rng.normal(0, 0.2, len(flat)).astype(np.float32)
    text = rng.integers(0, 300, 100)
    other = text.copy()
    other[48:] = rng.integers(0, 300, 52)
    a, b = (list(attention.scored_windows(flat, model, attention.windowed(t, 299)))[0] for t in (text, other))
    assert a[:2] == pytest.approx(b[:2]) and a[2] != pytest.approx(b[2])
    # probabilities of all ids after one context add up to one, ids never counted included
    for before in (299, int(text[0])):
        ids, target, scored = attention.windowed(np.array([before, 0]), 299)
        total = 0.0
        scored[0, 0] = False
        for i in range(300):
            target[0, 1] = i
            total += 10 ** float(next(attention.scored_windows(flat, model, (ids, target, scored)))[0])
        assert total == pytest.approx(1.0, rel=1e-4)


def test_training_improves_held_out_texts(documents, prose):
    words = [prose(s, 40) for s in range(6)]
    texts = [" ".join(words[(i + k) % 6] for k in range(3)) for i in range(80)]
    scores = [
        sum(r.score for r in lm_scores(documents(texts), WORDS, rounds=n).where("held_out").collect()) for n in (0, 3)
    ]
    assert scores[1] > scores[0]


def test_held_out_documents_are_likelier_than_under_the_baseline(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    sums = lm_scores(docs, WORDS).where("held_out").selectExpr("sum(score) AS model", "sum(base_score) AS base").first()
    assert sums.model > sums.base


def test_classes_do_not_mix_ends_of_words():
    counts = np.random.default_rng(2).integers(0, 99, tokenizer(WORDS).get_vocab_size())
    for known in (attention.Vocabulary(counts, lmscore._ends_words(WORDS)), attention.finest(counts, lmscore._ends_words(WORDS))):
        ends = {i for t, i in tokenizer(WORDS).get_vocab().items() if t.endswith("</w>")}
        kinds = {}
        for i, c in enumerate(known.of.tolist()):
            assert kinds.setdefault(c, i in ends) == (i in ends)
    assert known.count <= attention.GROUPS and end_id(WORDS) == 49407


def test_every_document_is_trained_on_and_no_window_twice():
    rng = np.random.default_rng(3)
    for count in (1, 2, 3, 4, 7, 8, 9, 100):
        for version in rng.integers(-(2**63), 2**63 - 1, 20).tolist():
            parts = [trained_on(version, count, turn, 2, 4) for turn in range(2)]
            both = np.concatenate(parts)
            assert len(both) and len(set(both.tolist())) == len(both) and both.min() >= 0 and both.max() < count
            assert len(both) in (max(count // 4, 1), count // 4 + 1)


def test_rounds_train_on_every_window_once(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 49407, n).astype(lmscore.id_type(WORDS)) for n in (0, 1, 23, 24, 300, 24 * 90)]
    versions = [int(v) for v in rng.integers(-(2**63), 2**63 - 1, len(texts))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(versions), pa.array([t.tobytes() for t in texts], pa.binary())], ["version", "ids"]
    )
    wanted = [attention.windowed(np.append(t, np.uint16(end_id(WORDS))), end_id(WORDS)) for t in texts]
    whole = Counter(row.tobytes() for _, target, _ in wanted for row in target)
    for rounds in (1, 2, 3):
        seen = Counter()

        class Recorder:
            def __init__(self, flat, model):
                self.flat, self.windows = flat, 0

            def train(self, windows):
                self.windows += len(windows[0])
                seen.update(row.tobytes() for row in windows[1])

        monkeypatch.setattr(attention, "Trainer", Recorder)
        flat = attention.initial()
        for turn in range(rounds):
            list(lmscore._trained(iter([batch]), WORDS, turn, rounds, flat, lambda: None))
        assert seen == whole


def test_windows_come_in_chunks_of_any_size(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 49407, n).astype(lmscore.id_type(WORDS)) for n in (0, 1, 23, 24, 25, 700, 24 * 900)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["ids"])
    wanted = [attention.windowed(np.append(t, np.uint16(end_id(WORDS))), end_id(WORDS)) for t in texts]
    for size in (3, 100, 1 << 20):
        monkeypatch.setattr(lmscore, "CHUNK", size)
        found = list(lmscore._in_chunks(batch, WORDS))
        for part, whole in zip(zip(*[w for w, _ in found]), zip(*wanted)):
            assert (np.concatenate(part) == np.concatenate(whole)).all()
        rows = np.concatenate([r for _, r in found])
        assert (np.bincount(rows) == [len(w[0]) for w in wanted]).all()


def test_some_windows_of_many_texts():
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 500, n).astype(np.uint16) for n in (0, 1, 23, 24, 25, 47, 48, 700, 24 * 40)]
    for chance in (0.1, 0.5, 1.0):
        parts, wanted = [], []
        for text in texts:
            windows = attention.windowed(np.append(text, np.uint16(999)), 999)
            part = np.flatnonzero(rng.random(len(windows[0])) < chance)
            part = part if len(part) else np.array([len(windows[0]) - 1])
            parts.append(part)
            wanted.append([w[part] for w in windows])
        found = attention.gathered(texts, parts, 999)
        for some, whole in zip(found, zip(*wanted)):
            assert (some == np.concatenate(whole)).all()


def test_batches_share_their_arrays():
    rng = np.random.default_rng(7)
    model, *_ = model_of(rng, 200)
    trainer = attention.Trainer(attention.initial(), model)
    long, short = (attention.windowed(rng.integers(0, 200, 24 * n), 199) for n in (128, 5))
    trainer.train(long)
    kept = {name: id(array) for name, array in trainer.room.kept.items()}
    flat = trainer.flat.copy()
    flat += rng.normal(0, 0.1, len(flat)).astype(np.float32)
    for ids, target, scored in (short, long):
        args = flat, model.group_of[ids], model.class_of[target], scored, model
        (loss, grad), (alone, other) = attention.gradient(*args, trainer.room), attention.gradient(*args)
        assert loss == alone and (grad == other).all()
    assert kept and kept == {name: id(array) for name, array in trainer.room.kept.items()}


def test_a_task_makes_its_scorer_once(monkeypatch):
    model, *_ = model_of(np.random.default_rng(3), 200)
    made = []

    class Counted(attention.Scorer):
        def __init__(self, *args):
            made.append(args)
            super().__init__(*args)

    monkeypatch.setattr(attention, "Scorer", Counted)
    monkeypatch.setattr(lmscore, "CHUNK", 2)
    monkeypatch.setattr(lmscore, "id_type", lambda path: np.uint16)
    monkeypatch.setattr(lmscore, "end_id", lambda path: 199)
    ids = [np.arange(n, dtype=np.uint16) % 200 for n in (100, 0, 300)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": [1, 2, 3], "version": [1, 2, 3], "ids": pa.array([x.tobytes() for x in ids], pa.binary())}
    )
    found = list(lmscore._model_scores(iter([batch, batch]), "", attention.initial(), lambda: model))
    assert [b.num_rows for b in found] == [3, 3] and found[0].equals(found[1]) and len(made) == 1
