"""Words and shingles of Arrow columns against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adspend.llm.near_dedup import shingle_sets
from adspend.llm.words import ALNUM, NOT_SPACE, slices, window_hashes

PATTERNS = ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\x0b.9😀 ", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_of_rows(texts, slice_bytes):
    for table, pattern in PATTERNS:
        got, seen = [], {}
        for words in slices(pa.array(texts, pa.string()), table, slice_bytes):
            h = words.hashes()
            for r in range(words.rows):
                a, b = words.ptr[r], words.ptr[r + 1]
                own = words.joined(a, b).decode().split(" ") if b > a else []
                got.append(own)
                for w, value in zip(own, h[a:b], strict=True):
                    assert seen.setdefault(w, value) == value
        assert got == [re.findall(pattern, (t or "").translate(LOWERED)) for t in texts]
        assert len(set(seen.values())) == len(seen)


def test_sliced_columns_and_long_texts():
    column = pa.array(["x", None, "a b", "c" * 5000 + " d", ""], pa.string()).slice(1)
    sizes = [int(n) for w in slices(column, NOT_SPACE, 100) for n in np.diff(w.ptr)]
    assert sizes == [0, 2, 2, 0]


def test_windows_tell_order_and_length():
    h = np.arange(1, 9, dtype=np.uint64)
    assert len(set(window_hashes(h, 3)) | set(window_hashes(h[::-1].copy(), 3)) | set(window_hashes(h, 2))) == 6 + 6 + 7


def test_shingle_sets_are_sets_of_word_windows():
    texts = ["a b c d e f", "A b  c\td e f", "a b c", "", None, "x x x x x x x x"]
    got = [s.tolist() for s in shingle_sets(pa.array(texts, pa.string()))]
    assert got[0] == got[1] and [len(g) for g in got] == [2, 2, 1, 0, 0, 1]
