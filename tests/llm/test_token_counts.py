import random

import public_tokenizers
import pytest
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer, models

from tallyhouse.llm import token_counts
from tallyhouse.llm.token_counts import Counter, Vocabulary

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores in a unigram tokenizer of another library."""
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(FILE, "rb").read())
    tokenizer = Tokenizer(models.Unigram([(p.piece, p.score) for p in model.pieces], 0, True))
    return lambda text: len(tokenizer.encode("▁" + text.replace(" ", "▁")).ids) if text else 0


def texts(n):
    rnd = random.Random(1)
    return [
        "".join(rnd.choice(["the", "a", "b", " ", "  ", "é", "日", "\n", "▁", "😀", "ing"]) for _ in range(rnd.randint(0, 30)))
        for _ in range(n)
    ]


def test_counts_match_the_library(documents, library):
    rows = [None, "", " ", "the " * 2000, "x" * 5000, *texts(500)]
    found = token_counts.token_counts(documents(*enumerate(rows)), Vocabulary.from_file(FILE)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["n_tokens"] == library(rows[row["doc_id"]] or ""), rows[row["doc_id"]]


def test_ties_and_unknown_characters():
    # "abc" is "ab c" or "a bc" at the same score: the piece that begins first wins; both are two.
    counter = Counter(Vocabulary((("a", -1.0), ("bc", -2.0), ("ab", -2.0), ("c", -1.0)), False, False))
    assert counter.count("abc") == 2
    # Without byte pieces a run of unknown characters is one token.
    assert counter.count("xyza") == 2 and counter.count("axcyy") == 4
    assert Counter(Vocabulary((("a", -1.0),), True, False)).count("aé") == 3


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    vocabulary = Vocabulary.from_file(FILE)
    plain, bounded = Counter(vocabulary), Counter(vocabulary)
    for text in texts(200):
        assert bounded.count(text) == sum(plain.best_path(u) for u in plain.units(text)) * bool(text)
        assert len(bounded) <= 10 and len(bounded.old) <= 10


def test_models_that_normalize_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "m.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="normalize"):
        Vocabulary.from_file(path)


def test_empty(documents):
    docs = documents((1, "a")).limit(0)
    assert token_counts.token_counts(docs, Vocabulary.from_file(FILE)).isEmpty()
