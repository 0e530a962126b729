import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import packing
from tidemark.llm.mixing import TARGETS, bounded, mixed_sample, probabilities, raked
from tidemark.llm.packing import SIZES, best_fit_packing, cost, pack


def test_raking_meets_all_marginals(spark):
    rng = random.Random(1)
    cells = [(s, k, t, rng.randint(1, 9000)) for s in "abcd" for k in ("en", "de", None) for t in "xy" if rng.random() < 0.9]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": 0.5, "lang": {"en": 2.0, "de": 1.0, None: 1.0}, "topic": {"x": 1.0, "y": 3.0}}
    found = raked(df, targets, rounds=25).collect()
    total = sum(r.weight for r in found)
    by_lang, by_topic = defaultdict(float), defaultdict(float)
    for r in found:
        by_lang[r.lang] += r.weight / total
        by_topic[r.topic] += r.weight / total
    assert by_lang["en"] == pytest.approx(0.5, abs=1e-6) and by_topic["y"] == pytest.approx(0.75, abs=1e-6)
    shares = {s: sum(n for a, _, _, n in cells if a == s) ** 0.5 for s in "abcd"}
    for s, share in shares.items():
        weight = sum(r.weight for r in found if r.source == s) / total
        assert weight == pytest.approx(share / sum(shares.values()), abs=1e-6)


def test_probabilities_spend_the_wanted_share_and_stay_below_one(spark):
    cells = [("a", 100, 0.5), ("b", 1000, 0.3), ("c", 5000, 0.2), ("d", 10, 0.0)]
    df = spark.createDataFrame(cells, "source string, tokens long, weight double")
    for share in (0.05, 0.3, 0.9):
        found = probabilities(df, share).collect()
        assert all(0 <= r.probability <= 1 for r in found)
        assert sum(r.probability * r.tokens for r in found) == pytest.approx(share * 6110, rel=1e-9)
    assert all(r.probability == (r.source != "d") for r in probabilities(df, 1.0).collect())


def test_sample_follows_the_probabilities(documents, odd_texts, prose):
    docs = documents([prose(i, 60) for i in range(400)], source="big").union(
        documents([(1000 + i, prose(i, 60)) for i in range(100)], source="small")
    ).union(documents([(2000 + i, t) for i, t in enumerate(odd_texts)], lang=None, source=None))
    rows = mixed_sample(docs, share=0.5, keep=tuple(docs.columns)).collect()
    assert len(rows) == 500 + len(odd_texts)
    expected = sum(r.probability * r.n_tokens for r in rows)
    assert expected == pytest.approx(0.5 * sum(r.n_tokens for r in rows), rel=0.02)
    chance = {r.source: r.probability for r in rows}
    assert chance["small"] > chance["big"]
    drawn = Counter(r.source for r in rows if r.sampled)
    assert abs(drawn["big"] - 400 * chance["big"]) < 60
    assert mixed_sample(documents([])).count() == 0


def test_bounded_sample_meets_its_targets_and_lowers_the_share_only_where_it_must(spark):
    rng = random.Random(4)
    cells = [
        (s, k, t, rng.randint(100, 3000) * (30 if k == "en" else 1))
        for s in "abcdefghij" for k in ("en", "de", None) for t in "xy" if rng.random() < 0.9
    ]
    rest = sum(n for s, _, _, n in cells if s != "a")
    own = sum(n for s, _, _, n in cells if s == "a")
    cells = [(s, k, t, n * rest // (2 * own) if s == "a" else n) for s, k, t, n in cells]  # a third of all
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    total = sum(n for *_, n in cells)

    def off(found):
        size = sum(r.probability * r.tokens for r in found)
        worst = 0.0
        for d, exponent in TARGETS.items():
            have, got = Counter(), Counter()
            for r in found:
                have[r[d]] += r.tokens
                got[r[d]] += r.probability * r.tokens
            weights = {v: n**exponent for v, n in have.items()}
            worst = max([worst, *(abs(got[v] / size - w / sum(weights.values())) for v, w in weights.items())])
        return worst, size / total

    assert off(probabilities(raked(df, TARGETS), 0.8).collect())[0] > 0.02
    found = bounded(df, TARGETS, 0.8).collect()
    worst, share = off(found)
    assert len(found) == len(cells) and all(0 <= r.probability <= 1 for r in found)
    assert worst < 1e-3 and 0.1 < share < 0.8
    # a little more cannot be had: some cell is full, and at less the share is kept
    assert any(r.probability > 0.999 for r in found)
    worst, less = off(bounded(df, TARGETS, share * 0.9).collect())
    assert worst < 1e-3 and less == pytest.approx(share * 0.9, rel=1e-3)


def test_bounded_sample_without_any_that_meets_its_targets(spark):
    df = spark.createDataFrame([("a", "en", 10), ("b", "de", 10)], "source string, lang string, tokens long")
    targets = {"source": {"a": 1.0, "b": 1.0}, "lang": {"en": 1.0}}
    found = {r.source: r.probability for r in bounded(df, targets, 0.4).collect()}
    assert found["a"] > 0 and found["b"] == 0
    assert bounded(df.limit(0), targets, 0.4).count() == 0


def test_packing_keeps_every_token_and_fits(documents, odd_texts, prose, monkeypatch):
    texts = [*odd_texts, *[prose(i, n) for i, n in enumerate([3, 500, 511, 512, 513, 900, 4095, 4096, 4097, 9000] * 4)]]
    pairs = [*enumerate(texts), (None, "a b"), (3, texts[3])]
    packed = best_fit_packing(documents(pairs, extra=("bin", "n")), run=16).collect()
    lengths = Counter((i, len((t or "").encode().split()) + 1) for i, t in pairs)
    got = defaultdict(int)
    for row in packed:
        got[row.doc_id] += row.n_tokens
    want = defaultdict(int)
    for (i, n), times in lengths.items():
        want[i] += n * times
    assert got == want
    bins = defaultdict(list)
    for row in packed:
        bins[row.shard, row.run, row.bin].append(row)
    for rows in bins.values():
        rows.sort(key=lambda r: r.place)
        used = 0
        for row in rows:
            assert row.place == used
            used += row.n_tokens
        assert rows[0].bin_size == min(s for s in SIZES if s >= used)
    assert best_fit_packing(documents([])).count() == 0


def test_hot_ids_and_rows_without_one_are_dealt_over_shards(documents):
    pairs = [(None, f"a b c {i}") for i in range(600)] + [(7, "the same")] * 600
    packed = best_fit_packing(documents(pairs), run=100).collect()
    for doc in (None, 7):
        assert len({r.shard for r in packed if r.doc_id == doc}) == 12
        assert sum(r.n_tokens for r in packed if r.doc_id == doc) == (600 * 5 if doc is None else 600 * 3)


def test_sequences_hold_their_subword_ids(spark, documents, odd_texts, prose, tmp_path):
    import public_tokenizers

    from tidemark.llm.tokens import tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*odd_texts, *[prose(i, 40 * i) for i in range(1, 60)]]
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    packed = packing.op8_best_fit_packing(spark, str(tmp_path)).collect()
    got, bins = Counter(), defaultdict(int)
    for row in packed:
        got[row.doc_id] += row.n_tokens
        bins[row.shard, row.run, row.bin, row.bin_size] += row.n_tokens
    assert got == {i: len(tokenizer(path).encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    assert all(used <= size for (*_, size), used in bins.items())


def test_rows_without_an_id_are_drawn_each(documents):
    rows = mixed_sample(documents([(None, f"w {i % 3}") for i in range(600)], extra=("ticket", "probability")), share=0.5).collect()
    drawn = sum(r.sampled for r in rows)
    assert 200 < drawn < 400
    again = mixed_sample(documents([(5, "w w")] * 50 + [(6, "w w")] * 50), share=0.5).collect()
    assert all(len({r.sampled for r in again if r.doc.doc_id == i}) == 1 for i in (5, 6))


def slow_best_fit(lengths, opened):
    """Contents of the bins; of equally full ones the last to be filled goes first."""
    rooms, filled, touched = [], [], []
    for turn, (length, size) in enumerate(zip(lengths, opened)):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            least = min(rooms[i] for i in fitting)
            i = max((i for i in fitting if rooms[i] == least), key=touched.__getitem__)
        else:
            i = len(rooms)
            rooms.append(size)
            filled.append(0)
            touched.append(0)
        rooms[i] -= length
        filled[i] += length
        touched[i] = turn
    return filled


def test_best_fit_equals_a_slow_one_and_no_single_size_is_cheaper():
    rng = random.Random(8)
    for _ in range(40):
        lengths = sorted((rng.choice([rng.randint(1, 4096), rng.randint(1, 600)]) for _ in range(120)), reverse=True)
        opened = [min(s for s in SIZES if s >= n) for n in lengths]
        _, _, filled = packing.best_fit(lengths, SIZES, opened)
        assert filled == slow_best_fit(lengths, opened)
        bins, places, sizes = pack(np.array(lengths))
        total = sum(cost(int(s)) for s in dict(zip(bins.tolist(), sizes.tolist())).values())
        for single in SIZES:
            _, _, filled = packing.best_fit(lengths, SIZES, [max(single, o) for o in opened])
            assert total <= sum(cost(min(s for s in SIZES if s >= f)) for f in filled) + 1e-6
