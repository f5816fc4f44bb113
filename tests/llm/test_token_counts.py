import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ashgrid.llm import token_counts as T
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, ROWS, no_docs, odd_docs, read

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("text", [
    "", " ", "\n\n \n", "it's 'll WE'LL", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "x" * 3000,
    "abc" * 500, "0123456789" * 40, "½ ² ١٢٣ Ⅷ", "é 漢字 😀​", "  x\x1cy\x85z",
    "  def f(x):\n\treturn x  ", "thndorhe ingthat ciónmentebo", LONG])
def test_counts_equal_the_library(text):
    assert T.counter(PATH).count(text) == library(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text_counts_as_in_the_library(text):
    assert T.counter(PATH).count(text) == library(text)


def test_whole_tokens_are_proved():
    counter = T.counter(PATH)
    assert len(counter.proved) > 45_000
    for piece in list(counter.proved)[::997]:
        assert counter.merged(piece.encode()) == 1


def test_long_merge_equals_short(monkeypatch):
    counter = T.counter(PATH)
    for piece in (b"internationalisation", b"aaaaaaaaaaaaab", b"thndorheingthat" * 9):
        assert counter._merged_long(piece) == counter.merged(piece)


def test_bounded_table_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(T, "KEPT", 2)
    counter = T.Counter(PATH)
    texts = [f"zqxv{i}wk" for i in range(9)] * 2
    assert [counter.count(t) for t in texts] == [library(t) for t in texts]


def test_rows(spark):
    got = T.count_tokens(odd_docs(spark), PATH, limit=5).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i or 0, len((t or "").encode()), library(t), library(t) > 5) for i, t in ROWS)
    assert T.count_tokens(no_docs(spark), PATH).count() == 0


def test_query_equals_library(spark):
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit)
           for r in T.op10_token_counts(spark, SF_SMALL).collect()}
    assert got == {i: (len(t.encode()), library(t), library(t) > 512)
                   for i, t in zip(ids, texts, strict=True)}


def test_proved_strings_make_the_same_counter(monkeypatch):
    proved = list(T.counter(PATH).proved)
    monkeypatch.setattr(T.Counter, "merged", lambda self, piece: pytest.fail("proved again"))
    again = T.Counter(PATH, proved)
    assert dict(again) == T.counter(PATH).proved


def test_kept_counts_are_bounded_by_their_characters(monkeypatch):
    monkeypatch.setattr(T, "KEPT_CHARS", 3000)
    counter = T.Counter(PATH, list(T.counter(PATH).proved))
    for i in range(20):
        text = "q" * 1000 + str(i)
        assert counter.count(text) == library(text)
        assert counter.held <= 3000 + 2100
