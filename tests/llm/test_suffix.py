"""Suffix arrays and common prefixes against sorting all suffixes."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sublens.llm import suffix


def check(symbols, many):
    t = np.array([*symbols, 0], dtype=np.uint16)
    sa = suffix.suffix_array(t, many)
    text = t.tolist()
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    got = suffix.permuted_common_prefixes(t, sa)
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert got[b] == n
    assert got[sa[0]] == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=70, max_size=260))
def test_small_alphabet(symbols):
    check(symbols, 2000)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=0, max_size=200))
def test_recursion_without_and_with_doubling(symbols):
    check(symbols, 10**9)
    check(symbols, 8)


@pytest.mark.parametrize("text", ["a" * 300, "ab" * 200, "abcabcab" * 40 + "z", "mississippi" * 30, "ba" + "a" * 200 + "b" + "a" * 200])
def test_periodic(text):
    check([ord(c) for c in text], 2000)


def test_doubling_leaves_final_groups_alone(monkeypatch):
    sorted_sizes, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **k: sorted_sizes.append(len(a)) or argsort(a, **k))
    t = np.append(np.concatenate([np.arange(2, 5000), np.full(40, 1)]), 0)       # 4,998 are final at once
    sa = suffix._doubled(t)
    assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
    assert sorted_sizes[0] == len(t) and max(sorted_sizes[1:]) <= 40


def test_common_prefixes_of_wide_symbols():
    t = np.array([70_000, 5, 70_000, 5, 70_000, 9, 0])
    assert suffix.permuted_common_prefixes(t, suffix.suffix_array(t)).tolist() == [0, 0, 3, 2, 1, 0, 0]
