import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import suffixdedup
from tidemark.llm.suffixdedup import contexts, repeated_strings, suffix_dedup
from tidemark.llm.suffixes import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_equals_sorting(symbols):
    assert suffix_array(np.array(symbols, np.int64)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("text", [b"a" * 300, b"ab" * 200, b"mississippi" * 9, bytes(range(256)), b"abcabcab" * 31 + b"a"])
def test_suffix_array_of_periodic_texts(text):
    found = suffix_array(np.frombuffer(text, np.uint8).astype(np.int64)).tolist()
    assert found == sorted(range(len(text)), key=lambda i: text[i:])


def test_equal_strings_have_equal_contexts():
    rng = random.Random(2)
    shared = bytes(rng.randrange(97, 102) for _ in range(80))
    data = b"".join(bytes(rng.randrange(97, 123) for _ in range(40)) + shared for _ in range(4))
    array = np.frombuffer(data, np.uint8)
    owner, start, strings, h, ahead = contexts(array, np.array([0, len(data)]))
    assert start[0] == 0 and (start[1:] == start[:-1] + strings[:-1]).all()
    at = {}
    for s, n, name, a in zip(start, strings, h, ahead):
        for i in range(s, s + n):
            at.setdefault(data[i : i + 50], set()).add((int(name), int(s + a - i)))
    assert all(len(names) == 1 for names in at.values())


def brute(pairs, length=50):
    seen, found = {}, []
    for i, t in pairs:
        data = (t or "").encode()
        for s in range(len(data) - length + 1) if i is not None else ():
            w = data[s : s + length]
            seen[w] = min(seen.get(w, i), i)
    for i, t in pairs:
        data = (t or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1) if i is not None else ():
            if seen[data[s : s + length]] < i:
                covered[s : s + length] = b"\x01" * length
        rest = bytes(x for x, c in zip(data, covered) if not c)
        spans = sum(1 for k in range(len(data)) if covered[k] and (k == 0 or not covered[k - 1]))
        found.append((i, len(data), sum(covered), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("large", [1 << 20, 200])
def test_removed_bytes_equal_brute_force(documents, odd_texts, prose, monkeypatch, large):
    monkeypatch.setattr(suffixdedup, "LARGE", large)  # both ways of comparing contexts
    rng = random.Random(4)
    passages = [prose(i, 14) for i in range(4)]
    texts = [t for t in odd_texts if t is None or len(t) < 60_000]
    for i in range(60):
        parts = [prose(100 + i, rng.randint(1, 20)), rng.choice(passages), prose(300 + i, rng.randint(0, 9))]
        texts.append(rng.choice([" ", "", "\n"]).join(parts))
    base = prose(50, 120).split()
    for _ in range(12):
        copy = list(base)
        copy[rng.randrange(len(copy))] = "edited"
        texts.append(" ".join(copy))
    texts += [texts[-1], texts[20], "é" * 40, "é" * 60, "ab" * 40, "ba" * 50, "x" * 49, "x" * 50, "x" * 51]
    pairs = [*enumerate(texts), (None, texts[30]), (12, texts[40]), (12, texts[41])]
    rng.shuffle(pairs)
    got = suffix_dedup(documents(pairs, extra=("start", "mask", "copy"))).drop("spans").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(pairs)


def test_long_texts_are_cut_into_the_same_contexts(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 1300, 1300, 1310, 5000])
    whole = [x.tolist() for x in contexts(data, offsets)]
    monkeypatch.setattr(suffixdedup, "STRETCH", 1 << 9)
    # Bits of the hash that a position takes from it differ, so only runs are compared.
    _, start, strings, *_ = contexts(data, offsets)
    assert sum(strings) == sum(whole[2]) and (np.diff(start) > 0).all()


def test_what_a_context_shares_at_most():
    parts = [b"abcd", b"abxx", b"abc", b"", b"zz", b"abcd"]
    assert suffixdedup.most_shared(parts) == [4, 2, 3, 0, 0, 4]


def test_one_suffix_array_for_many_contexts():
    texts = [b"p" * 10 + b"q" * 45, b"p" * 8 + b"q" * 45 + b"r", b"z" * 60]
    masks = repeated_strings(texts, np.array([5, 9, 1]))
    assert masks[0] == 0 and masks[2] == 0 and bin(masks[1]).count("1") == 4


def test_empty_table(documents):
    assert suffix_dedup(documents([])).count() == 0
