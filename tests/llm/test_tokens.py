import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm.registry import BYTE_VOCABULARY, PIECE_VOCABULARY, WORD_VOCABULARY
from basketry.llm.tokens import PieceWords, TextEncoder

KINDS = [(BYTE_VOCABULARY, "lead"), (WORD_VOCABULARY, "drop")]
ENCODERS = {path: TextEncoder(path, spaces, kept=64) for path, spaces in KINDS}
CASES = ["", None, " a  b", "x \n y\n", "日本 test", "<|endoftext|> a", "a<|endoftext|>b c", "\n \n", "end \n ", "tab\tx y", " ", "İstanbul ẞ", " it's we'll 12,345  ", "x" * 100, "l'eau «a.» 3.14 a,b;c\nD.\n\nE \nF", "é" * 40 + "!?" * 20, "a\xadb", "İ", "ﬁn é"]


def same(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == encoder.whole.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("path", ENCODERS)
def test_cases(path):
    same(ENCODERS[path], CASES)
    same(ENCODERS[path], [])


@pytest.mark.parametrize("path", ENCODERS)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab AB'.,\n\tls1 é«ßÉ\"-_\x0b\xa0日"), max_size=30), max_size=5))
def test_equals_the_library(path, texts):
    same(ENCODERS[path], texts)


@pytest.mark.parametrize("path", ENCODERS)
def test_documents(path, documents):
    same(ENCODERS[path], [r["text"] for r in documents.select("text").collect()])


def test_word_numbers_are_exact():
    words = PieceWords(PIECE_VOCABULARY, kept=32)
    text = "a b a \x0b " + "q" * 30 + " c " + "q" * 31 + " " + "q" * 30 + " \x1c \xa0"
    data = pa.array([text, "b a"], pa.large_string())
    from basketry.llm.tokens import raw

    number, starts = words.numbers(*raw(data))
    found = [w for t in (text, "b a") for w in t.encode().split()]
    assert len(number) == len(found)
    assert [[x == y for y in number] for x in number] == [[x == y for y in found] for x in found]


class _Counted:
    """A tokenizer that notes how often it is given a word."""

    def __init__(self, whole, word):
        self.__dict__ |= {"whole": whole, "word": word, "times": 0}

    def __setattr__(self, name, value):
        setattr(self.whole, name, value)

    def __getattr__(self, name):
        return getattr(self.whole, name)

    def encode_batch_fast(self, texts, **how):
        self.__dict__["times"] += sum(t.count(self.word) for t in texts)
        return self.whole.encode_batch_fast(texts, **how)


def test_recurring_chunks_outlive_a_full_table():
    enc = TextEncoder(BYTE_VOCABULARY, "lead", kept=2000)
    plain, enc.whole = enc.whole, _Counted(enc.whole, "recurring")
    for i in range(20):
        text = "a recurring word " + " ".join(f"w{i}x{j}" for j in range(600))
        ids, bounds = enc.encode(pa.array([text, None, "recurring"]))
        want = [plain.encode(t, add_special_tokens=False).ids for t in (text, "", "recurring")]
        assert [ids[a:z].tolist() for a, z in zip(bounds, bounds[1:])] == want
        assert enc.table.count <= 2700
    assert enc.whole.times == 2  # with a space before and without, once each


class _Noted:
    """A tokenizer that keeps the texts it is given."""

    def __init__(self, whole):
        self.__dict__ |= {"whole": whole, "texts": []}

    def __setattr__(self, name, value):
        setattr(self.whole, name, value)

    def __getattr__(self, name):
        return getattr(self.whole, name)

    def encode_batch_fast(self, texts, **how):
        self.texts.extend(texts)
        return self.whole.encode_batch_fast(texts, **how)


def test_new_chunks_follow_one_another_without_marks():
    enc = TextEncoder(BYTE_VOCABULARY, "lead")
    plain, enc.whole = enc.whole, _Noted(enc.whole)
    texts = [" it's 12ab we'll" + "".join(f" naïve{i} «w{i}»" for i in range(300)), "x\n y\n", " <|endoftext|> z"]
    ids, bounds = enc.encode(pa.array(texts))
    assert [ids[a:z].tolist() for a, z in zip(bounds, bounds[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    joined = [t for t in enc.whole.texts if "naïve" in t]
    assert joined and not any("<|endoftext|> na" in t or "<|endoftext|> «" in t for t in joined)
    assert len(joined) <= 5  # 200 chunks in each


def test_no_threads_beside_the_task(monkeypatch):
    import os

    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    TextEncoder(BYTE_VOCABULARY, "lead", kept=64)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_words_that_end_in_zero_bytes_differ():
    from basketry.llm.tokens import raw

    found = ["a", "a\0", "abcdefg", "abcdefg\0", "abcdefg\0h", "a", "abcdefg\0"]
    number, _ = PieceWords(PIECE_VOCABULARY, kept=32).numbers(*raw(pa.array([" ".join(found)], pa.large_string())))
    assert [[x == y for y in number] for x in number] == [[x == y for y in found] for x in found]
