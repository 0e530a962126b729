import hashlib
import random
from collections import Counter
from math import log2

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import rarefeatures as rare
from tidemark.llm.rarefeatures import WINDOW, decoded, edited_fingerprints, entropy_histogram, fingerprints, likeness


def slow_class(window):
    total = 0
    for n in Counter(window).values():
        total += sum(int(g) for g in rare.GAINS[:n])
    bits = int(log2(WINDOW)) * WINDOW * rare.ONE
    return (bits - total) * rare.CLASSES // bits


def slow_features(text, ranks):
    """Distinct features in order of place, by the definition."""
    rank = [int(ranks[slow_class(text[i : i + WINDOW])]) for i in range(len(text) - WINDOW + 1)]
    points = Counter()
    for start in range(len(rank)):
        run = rank[start : start + rare.RUN]
        points[start + run.index(min(run))] += 1
    least = 0 if len(rank) <= rare.CAPACITY else rare.POINTS
    places = [i for i in range(len(rank)) if points[i] >= least and rank[i] <= rare.CLASSES]
    if not places:
        return [hashlib.sha256(text).digest()[:8]] if text else []
    return list(dict.fromkeys(text[i : i + WINDOW] for i in places))


def slow_chain(text, ranks):
    found = slow_features(text, ranks)
    chain = np.zeros((-(-len(found) // rare.CAPACITY), rare.FILTER_BITS), bool)
    for i, feature in enumerate(found):
        if len(feature) == 8:
            h = int.from_bytes(feature, "little")
        else:
            h = int(rare.window_hashes(np.frombuffer(feature, np.uint8), np.array([0]))[0])
        for k in range(rare.HASHES):
            chain[i // rare.CAPACITY, h >> 11 * k & rare.FILTER_BITS - 1] = True
    return np.packbits(chain, axis=1)


def slow_likeness(a, b):
    """From the bits of each pair of filters, one by one."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if (len(b), b.tobytes()) < (len(a), a.tobytes()):
        a, b = b, a
    scores, weights = [], []
    for f in map(np.unpackbits, a):
        found = []
        for g in map(np.unpackbits, b):
            chance, most = int(f.sum()) * int(g.sum()) / rare.FILTER_BITS, min(int(f.sum()), int(g.sum()))
            cut = chance + rare.CUT * (most - chance)
            found.append(min(max(int((f & g).sum()) - cut, 0) / max(most - cut, 1e-6), 1))
        scores.append(max(found))
        weights.append(int(f.sum()))
    return sum(s * w for s, w in zip(scores, weights)) / sum(weights)


@pytest.fixture
def texts(prose, odd_texts):
    rng = random.Random(4)
    odd = [t if t is None else t[:3000] for t in odd_texts]
    made = [prose(i, rng.randint(1, 250))[: rng.randint(1, 1500)] for i in range(40)]
    junk = ["".join(rng.choices("ab é中\n<>#", k=rng.randint(0, 600))) for _ in range(20)]
    return [*odd, *made, *junk, "z" * 31, "z" * 33, "0123456789abcdef" * 2]


def ranks_of(texts):
    counts = Counter(slow_class(t[i : i + WINDOW]) for t in texts for i in range(len(t) - WINDOW + 1))
    order = sorted(range(rare.CLASSES + 1), key=lambda c: (counts[c], c))
    ranks = np.empty(rare.CLASSES + 1, np.int64)
    ranks[order] = np.arange(rare.CLASSES + 1)
    ranks[: rare.LEAST_CLASS] = rare.CLASSES + 1
    return ranks, counts


def test_histogram_counts_every_window(documents, texts):
    _, counts = ranks_of([(t or "").encode() for t in texts])
    got = {r["class"]: r["n"] for r in entropy_histogram(documents(texts)).collect()}
    assert got == dict(counts)


def test_fingerprints_equal_the_definition(documents, texts, monkeypatch):
    encoded = [(t or "").encode() for t in texts]
    ranks, _ = ranks_of(encoded)
    for step in (1 << 17, 100):  # the step must not show
        monkeypatch.setattr(rare, "STEP", step)
        chains = rare._chains(encoded, ranks)
        assert all(c.tobytes() == slow_chain(t, ranks).tobytes() for c, t in zip(chains, encoded))
    got = {r.doc_id: r.fingerprint for r in fingerprints(documents(texts, extra=("fingerprint",))).collect()}
    assert [got[i] for i in range(len(texts))] == [rare.encoded(c) for c in chains]
    assert all((decoded(got[i]) == c).all() for i, c in enumerate(chains))


def test_edited_texts_and_likeness_equal_brute_force(documents, texts):
    pairs = [*((3 * i, t) for i, t in enumerate(texts)), (None, "no id at all"), (-5, texts[30]), (9999, texts[30])]
    random.Random(1).shuffle(pairs)
    docs = documents(pairs, extra=("range", "place", "n_chars_"))
    got = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    assert len(got) == len(pairs)
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    ranks, _ = ranks_of([(t or "").encode() for _, t in pairs])
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        own, new, other = (slow_chain(t.encode(), ranks) for t in (text, changed, following))
        row = got[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (rare.encoded(own), rare.encoded(new))
        assert row.near_edited == pytest.approx(slow_likeness(own, new), abs=1e-5)
        assert row.near_next == pytest.approx(slow_likeness(own, other), abs=1e-5)


def test_copies_near_copies_and_strangers_are_told_apart(documents, prose):
    base = [prose(i, 300) for i in range(30)]
    got = {r.doc_id: r for r in edited_fingerprints(documents(base)).collect()}
    assert all(r.near_edited > 0.35 and r.near_next < 0.1 for r in got.values())
    copies = edited_fingerprints(documents([(i, base[0]) for i in range(6)])).collect()
    assert {r.near_next for r in copies} == {1.0} and len({r.fingerprint for r in copies}) == 1


def test_repeated_rows_are_one_document_with_copies(documents, prose):
    texts = [(1, prose(1, 80)), (2, prose(2, 80)), (3, prose(3, 80))]
    ranks, _ = ranks_of([t.encode() for _, t in texts])
    alone = {r.doc_id: r for r in edited_fingerprints(documents(texts), ranks).collect()}
    many = edited_fingerprints(documents([texts[0]] * 300 + texts[1:] + [texts[2]] * 2), ranks).collect()
    assert Counter(r.doc_id for r in many) == {1: 300, 2: 1, 3: 3}
    assert all(tuple(r) == tuple(alone[r.doc_id]) for r in many)


def test_single_document_follows_itself_and_empty_table(documents):
    (row,) = edited_fingerprints(documents([(5, "a b " * 30)])).collect()
    assert row.near_next == 1.0
    (row,) = edited_fingerprints(documents([(5, None)])).collect()
    assert (row.fingerprint, row.near_edited, row.near_next) == ("0:", 1.0, 1.0)
    assert edited_fingerprints(documents([])).count() == 0
    assert fingerprints(documents([])).count() == 0


def test_neighbours_wherever_batches_are_cut():
    rng = random.Random(7)
    docs = sorted((rng.randrange(40), 0, i, f"t{i}") for i in range(120))
    starts = [docs[0][:2], *sorted({docs[k][:2] for k in (30, 60, 90)} - {docs[0][:2]})]
    rows = pa.RecordBatch.from_arrays(
        [pa.array([d[k] for d in docs]) for k in range(4)], ["place", "tie", "doc_id", "text"]
    )
    dealt = pa.Table.from_batches(rare._dealt(iter([rows.slice(i, 7) for i in range(0, 120, 7)]), starts))
    dealt = dealt.sort_by([(c, "ascending") for c in ("range", "guest", "place", "tie", "doc_id")])

    def pairs(ids, copies, texts, following):
        return pa.RecordBatch.from_arrays([pa.array([*zip(map(bytes.decode, texts), map(bytes.decode, following))], pa.list_(pa.string()))], ["p"])

    for size in (1, 5, 1000):
        found = [tuple(p) for b in rare._neighbours(iter(dealt.to_batches(size)), pairs) for p in b.column("p").to_pylist()]
        texts = [d[3] for d in docs]
        assert sorted(found) == sorted(zip(texts, texts[1:] + texts[:1]))


def test_likeness_is_symmetric_and_bounded():
    rng = np.random.default_rng(2)
    chains = [rare.filters(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 5, 128, 129, 700)]
    for a in chains:
        for b in chains:
            assert 0 <= likeness(a, b) <= 1 and likeness(a, b) == likeness(b, a)
        assert likeness(a, a) == 1
