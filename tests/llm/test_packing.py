import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")
JSON = open(FILE).read()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_str(JSON)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_words_encode_like_whole_texts(library):
    rnd = random.Random(3)
    parts = [*"abZ'ÉéΣσß日 \n\t.,!?#$|()0ſİ́ \x1c\x85…“”", "'s", "'ll", " the", "<|endoftext|>", ", "]
    encoder = packing.Encoder(JSON)
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == library(text), text


def check(rows, pieces, library, window):
    """Every id of every row lies in exactly one piece; sequences are whole and unpadded."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(np.array([*library(t or ""), packing.END], "<u4"))
    assert by_doc.keys() == texts.keys()
    for i, (ids, *more) in texts.items():
        found = sorted(by_doc[i], key=lambda p: p["start"])
        assert sum(p["length"] for p in found) == len(ids) * (1 + len(more))
        for p in found:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(part.tobytes())
        if not more:
            assert [p["start"] for p in found] == list(np.cumsum([0, *[p["length"] for p in found]])[:-1])
    for found in by_sequence.values():
        found.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in found])
        assert [p["offset"] for p in found] == [0, *ends[:-1]]
        assert ends[-1] <= window and not ends[-1] & (ends[-1] - 1)


@pytest.mark.parametrize("shard_tokens", [1 << 20, 300])
def test_pieces(clashing, library, shard_tokens):
    rnd = random.Random(5)
    words = "the cat dog sat on mat blue unhappiness zürich".split()
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 90)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "twice"), (502, "twice"), (503, "long " * 900)]
    found = packing.pack(clashing(*rows), JSON, window=128, shard_tokens=shard_tokens).collect()
    check(rows, found, library, 128)


def test_neighbours_share_words(documents):
    """A window is filled with texts of the seed's words."""
    rnd = random.Random(7)
    topics = [[f"{c}{w}" for w in ("alpha", "beta", "gamma", "delta", "omega")] for c in "abcd"]
    rows = [(i, " ".join(rnd.choices(topics[i % 4], k=12))) for i in range(160)]
    found = packing.pack(documents(*rows, partitions=1), JSON, window=512).collect()
    together = defaultdict(set)
    for p in found:
        together[p["sequence_id"]].add(p["doc_id"] % 4)
    assert sum(map(len, together.values())) / len(together) < 2


def test_bm25_scores_match_the_formula():
    rnd = np.random.default_rng(2)
    texts = [rnd.integers(0, 30, rnd.integers(1, 40)).astype(np.uint32) for _ in range(25)]
    index, mean = packing.Index(texts), np.mean([len(t) for t in texts])
    for q in range(25):
        expected = np.zeros(25)
        for term in set(texts[q].tolist()):
            df = sum(term in t for t in texts)
            idf = np.log((25 - df + 0.5) / (df + 0.5))
            for d, t in enumerate(texts):
                tf = (t == term).sum()
                if tf and idf > 0:
                    size = packing.K1 * (1 - packing.B + packing.B * len(t) / mean)
                    expected[d] += idf * tf * (packing.K1 + 1) / (tf + size)
        assert np.allclose(index.scores(q), expected)


def test_empty(documents):
    assert packing.pack(documents((1, "a")).limit(0), JSON).isEmpty()


def test_words_of_latin_letters_need_only_the_merges(library):
    """Against the whole tokenizer: every Latin letter, alone and in words, and what is not one."""
    encoder = packing.Encoder(JSON)
    letters = [chr(c) for c in range(0x21, 0x250)] + ["́", "é", "ſ", "ﬁ", "ª", "ʼn", "İ", "i̇", "日", "ж", "١", "²"]
    words = [*letters, *(f"x{c}y" for c in letters), *(f"{c}{d}" for c in "eßžq" for d in letters)]
    for word in words:
        if word.split() == [word]:
            lowered = word.encode().lower()
            assert encoder.word_ids(lowered) == encoder.tokenizer.encode(lowered.decode(), add_special_tokens=False).ids
            assert encoder.ids(word.encode()) == np.array(library(word), "<u4").tobytes()
