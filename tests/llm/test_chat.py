import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adspend.llm import chat

TEXT = st.lists(st.sampled_from([*chat.CONTROL, *(c[0] + "\\" + c[1:] for c in chat.CONTROL), "\\", "<", "[", "a\n", "%0A"]),
                max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_escape_is_reversible_and_hides_control_strings(role, text):
    whole, a, b = chat.segment(role, text)
    assert chat.parse(whole) == (role, text) and chat.unescape(whole[a:b]) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROL)
    assert whole.count(chat.BEGIN) == 1 and whole.count("<|im_end|>") == 1


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok"), (1, 2, "user", None), (1, 3, "assistant", ""),
        (1, 4, None, "tail"), (2, 0, "user", "alone"), (None, 1, "assistant", "x"), (None, 0, "user", "y"),
        (3, None, "assistant", "last"), (3, 0, "user", "first"), (4, 0, "user", "b"), (4, 0, "user", "a"),
        *((5, k, "assistant" if k % 2 else "user", f"<|im_end|> é😀 {k}" * 20) for k in range(200))]


def conversations(spark, rows=ROWS):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn(
        "offset", F.lit("clash")).withColumn("segment", F.lit(0)).repartition(3)


def test_read_back(spark):
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(conversations(spark))).collect()}
    assert set(got) == {r[0] for r in ROWS}
    for conv in got:
        turns = sorted(((t is None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        own = got[conv]
        assert own.n_turns == len(turns)
        assert own.turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns))
        replies = [x for _, _, r, x in turns if r == "assistant"]
        assert (own.n_examples, own.loss_chars, own.loss_sha256) == (
            len(replies), sum(map(len, replies)), sha("".join(replies)))


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    segments = chat.format_turns(conversations(spark))
    whole = {}
    for r in sorted(segments.collect(), key=lambda r: (r.conv_id or 0, r.seq)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
    spans = {(r.conv_id, r.target_seq): r for r in chat.expand_replies(segments).collect()}
    texts = {(r.conv_id, r.target_seq): r for r in chat.render(segments).collect()}
    assert set(spans) == set(texts) and len(spans) == sum(r[2] == "assistant" for r in ROWS)
    for key, r in texts.items():
        s = spans[key]
        assert r.text == whole[key[0]][: s.example_chars] and (r.loss_start, r.loss_end) == (s.loss_start, s.loss_end)
        assert r.text[: s.context_chars].count("<|im_end|>") == key[1]
        assert r.text[s.loss_end:] == chat.END  # nothing but the reply is under the mask, and it is the last turn


def test_the_examples_are_made_and_read_back(spark):
    segments = chat.format_turns(conversations(spark))
    both = chat.with_examples(segments).collect()
    made = sorted((repr(r.conv_id), r.target_seq, r.context_chars, r.loss_start, r.loss_end, r.example_chars)
                  for r in both if r.seq is None)
    assert made == sorted((repr(r[0]), *r[1:]) for r in chat.expand_replies(segments).collect())
    assert sum(r.seq is not None for r in both) == len(ROWS)
    for before, r in zip(both, both[1:], strict=False):
        assert r.seq is not None or (before.conv_id, before.seq) == (r.conv_id, r.target_seq)
    # examples whose context isn't the turns before the reply are told
    moved = segments
    for name in ("offset", "text_start", "text_end"):
        moved = moved.withColumn(name, F.col(name) + 5)
    with pytest.raises(Exception, match="doesn't end with its reply"):
        chat.read_back(moved).collect()


def test_empty_table(spark):
    none = conversations(spark, [])
    assert chat.read_back(chat.format_turns(none)).collect() == []
    assert chat.expand_replies(chat.format_turns(none)).collect() == []
