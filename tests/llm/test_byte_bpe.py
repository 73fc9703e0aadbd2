import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe
from tallyhouse.llm.words import slices


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def ranks(request):
    return byte_bpe.read_ranks(P.path(request.param))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(1)
    parts = [*"ab É日1²½ \n\t\r.,!'\x1c\x85\xa0　_‿İ😀", "  ", "'s", "'ll", " the", " un", "happi", "ness", "<|endoftext|>"]
    found = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    return [None, "", " ", "a" * 3000, "ab" * 700, "日本語" * 200, "the " * 900, *found]


@pytest.mark.parametrize("dictionary", [800_000, 5])
def test_encoding_matches_the_library_and_decodes(clashing, ranks, library, dictionary, monkeypatch):
    monkeypatch.setattr(byte_bpe, "DICTIONARY_WORDS", dictionary)
    rows = [*enumerate(texts()), (7, texts()[7]), (None, "no id")]
    plain = dict(rows)
    found = byte_bpe.digests(clashing(*rows), ranks, P.PATTERN).collect()
    assert len(found) == len(rows)
    for row in found:
        text = plain[row["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_ids_and_their_bytes(documents, ranks, library):
    rows = list(enumerate(texts()))
    ids = byte_bpe.encode(documents(*rows), ranks, P.PATTERN)
    for row in ids.collect():
        assert bytes(row["ids"]).decode().split() == [str(i) for i in library.encode_ordinary(rows[row["doc_id"]][1] or "")]
    for row in byte_bpe.decode(ids, ranks).collect():
        assert bytes(row["data"]).decode() == (rows[row["doc_id"]][1] or "")


def test_both_folds(spark, ranks, library, monkeypatch):
    """Merging one pair at a time and all pairs of a rank at once."""
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcthe é日") for _ in range(rnd.randint(1, 40))) for _ in range(300)] + ["aaaaaaa", "a" * 64]
    table, frame = byte_bpe.RankTable(ranks), spark.createDataFrame([(w,) for w in words], "word string")
    for long_bytes in (64, 0):
        monkeypatch.setattr(byte_bpe, "LONG_BYTES", long_bytes)
        found = frame.select("word", byte_bpe.encode_word(table, F.col("word")).alias("ids")).collect()
        for row in found:
            assert row["ids"] == library._core_bpe.encode_single_piece(row["word"].encode())


def test_splitting_before_spaces(library):
    splitter, rnd = byte_bpe.Splitter(P.PATTERN), random.Random(4)
    some = [*"ab É日|#s1²½ \n\t\r.,!'\x1c\x85\xa0　_‿²İ", "  ", "'s", " a"]
    rows = ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 14))) for _ in range(5000)]
    whole = 0
    for text, (data, parts) in zip(rows, splitter.texts(pa.array(rows))):
        assert data.decode() == text
        whole += parts is None
        found = splitter.matches(data) if parts is None else [
            *splitter.matches(parts[0]), *(w for p in parts[1:] for w in splitter.unit_matches(p))
        ]
        for unit in parts or ():
            assert splitter.unit_matches(unit) == splitter.matches(b" " + unit)
        assert b"".join(found).decode() == text
        assert [i for w in found for i in library._core_bpe.encode_single_piece(w)] == library.encode_ordinary(text)
    assert 0 < whole < len(rows)


def test_empty(documents, ranks):
    assert byte_bpe.digests(documents((1, "a")).limit(0), ranks, P.PATTERN).isEmpty()


@pytest.mark.parametrize("pattern", [P.PATTERN, r"[a-z]+| \d"])
def test_words_of_texts(pattern):
    """Texts split as arrays give the matches of the pattern, which may leave bytes out."""
    splitter, rnd = byte_bpe.Splitter(pattern), random.Random(5)
    for some in ([*"ab É日|#s1²½ \n\t\r.,!'\x1c\x85\xa0　_‿²İ", "  ", "'s", " a"], [*"abé É.,s\n", "b ", " a", "d.\nS"]):
        rows = [None, "", *("".join(rnd.choice(some) for _ in range(rnd.randint(0, 20))) for _ in range(3000))]
        for part in slices(pa.array(rows)):
            words, ends = splitter.words(part)
            found = words.to_pylist()
            for i, text in enumerate(rows[part.first : part.last]):
                assert found[ends[i] : ends[i + 1]] == splitter.matches((text or "").encode())


def test_words_are_counted_in_one_shuffle(documents, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_COUNTED_WORDS", 5)
    rows = [t.replace("_", " ") for t in texts() if t]
    counts = byte_bpe.count_words(documents(*enumerate(rows)).select("doc_id", "text"), P.PATTERN)
    splitter = byte_bpe.Splitter(P.PATTERN)
    expected = Counter(w for t in rows for w in splitter.matches(t.encode()) if len(w) <= byte_bpe.DICTIONARY_BYTES)
    assert {bytes(r["word"]): r["n"] for r in counts.collect()} == expected
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_dictionary_compares_words_in_full(monkeypatch):
    monkeypatch.setattr(byte_bpe, "_hashes", lambda words: np.full(len(words), 7, np.uint64))
    table = pa.table({"word": pa.array([b"ab", b"cd"], pa.binary()), "ids": pa.array([[1, 2], [3]], pa.list_(pa.int32()))})
    found, _ = byte_bpe.Dictionary(table).find(pa.array([b"ab", b"xy", b"abc", b""], pa.large_binary()))
    assert found.tolist() == [True, False, False, False]
    none = byte_bpe.Dictionary(table.slice(0, 0))
    assert not none.find(pa.array([b"ab"], pa.large_binary()))[0].any()
