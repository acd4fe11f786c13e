from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té漢\x0b")), max_size=6), st.integers(1, 30))
def test_words_and_hashes_match_a_plain_scan(values, limit):
    found, hashes = [], {}
    for block in text.blocks(pa.array(values, pa.string()), limit):
        words = text.words(block)
        raw, of = block.data.tobytes(), text.Hasher(block.data)(words.starts, words.ends)
        for r in range(block.n):
            span = range(words.bounds[r], words.bounds[r + 1])
            found.append([raw[words.starts[i]:words.ends[i]] for i in span])
            for i in span:
                hashes.setdefault(raw[words.starts[i]:words.ends[i]], set()).add(int(of[i]))
    assert found == [WORD.findall((x or "").encode()) for x in values]
    assert all(len(x) == 1 for x in hashes.values())
    assert len({next(iter(x)) for x in hashes.values()}) == len(hashes)


def test_shingles_stay_within_rows():
    hashes = np.arange(1, 8, dtype=np.uint64)
    keys, at = text.shingles(hashes, np.array([0, 3, 3, 4, 7]), 2)
    assert at.tolist() == [0, 1, 4, 5]
    again, _ = text.shingles(np.array([1, 2], np.uint64), np.array([0, 2]), 2)
    assert again[0] == keys[0]


def test_distinct_and_row_sums():
    keys, bounds = text.distinct(np.array([5, 3, 5, 9], np.uint64), np.array([0, 0, 0, 2]), 3)
    assert keys.tolist() == [3, 5, 9] and bounds.tolist() == [0, 2, 2, 3]
    assert text.row_sums(np.array([1, 2, 3]), np.array([0, 2, 2, 3])).tolist() == [3, 0, 3]
