"""Unit-wise encoding equals the library's, whatever the white space."""

import struct

from hypothesis import given, settings
from hypothesis import strategies as st

from txlens.llm.automaton import compile_rules
from txlens.llm.tokens import WordEncoder, default_tokenizer_path

ENCODER = WordEncoder(default_tokenizer_path(), entries=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "don't", "It's", " ", "  ", "\n", "\t", " ", " ", "\x1c", "é", "日本", "ﬁ", "12", "3.5", "$$$", "<|endoftext|>", "", "²", "ª"]), max_size=12),
       st.text(max_size=8))
def test_ids_equal_the_library(parts, tail):
    text = "".join(parts) + tail
    text = text.encode("utf-8", "ignore").decode()
    got = ENCODER.ids(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_equal_a_fresh_tokenizer():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(default_tokenizer_path())
    for text in ("<|endoftext|>", "one <|endoftext|> two", "a<|endoftext|>b", "a <|endoftext| > b", "no such token here"):
        got = ENCODER.ids(text)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == plain.encode(text, add_special_tokens=False).ids
    assert 50256 in plain.encode("a<|endoftext|>b", add_special_tokens=False).ids


def test_null_and_empty():
    assert ENCODER.ids(None) == ENCODER.ids("") == b""


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=12).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_automaton_agrees_with_re(data):
    import re
    patterns = ["ab*c?", "(a|bc){2,3}", "[^a]+b", "(?i:AB)c{2}"]
    for p in patterns:
        rows = compile_rules([p], True).rows()
        row = rows[0]
        for b in data:
            row = row[b]
        assert bool(row[256]) == bool(re.fullmatch(p.encode(), data)), p
    rows = compile_rules(patterns, False).rows()
    row = rows[0]
    for b in data:
        row = row[b]
    assert row[256] == sum(1 << i for i, p in enumerate(patterns) if re.search(b"(?:" + p.encode() + b")\\Z", data))
