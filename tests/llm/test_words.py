import re

import numpy as np
import pyarrow as pa

from tallyhouse.llm.shingles import common, shingle_sets, signatures
from tallyhouse.llm.words import NOT_ALNUM, find_words, slices

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return text.encode().lower().decode()


def test_words_match_a_regular_expression(letters):
    texts = [None, "", *letters(1, 300), "x" * 5000, " "]
    for most in (1, 50, 1 << 20):
        found, hashes = [], {}
        for part in slices(pa.array(texts, pa.string()), most):
            data = part.lowered()
            words = find_words(data, part.offsets)
            per_text = [[] for _ in range(part.last - part.first)]
            for a, b, t, h in zip(words.starts, words.ends, words.text, words.hashes):
                word = data[a:b].tobytes()
                per_text[t].append(word.decode())
                assert hashes.setdefault(word, h) == h
            found += per_text
        assert found == [WORD.findall(lower(t or "")) for t in texts]
        assert len(set(hashes.values())) == len(hashes)


def test_an_offset_column_and_other_separators():
    column = pa.array(["zz", "a-b 1", None, "é,c"]).slice(1)
    (part,) = slices(column)
    words = find_words(part.data, part.offsets, NOT_ALNUM)
    found = [part.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    assert found == ["a", "b", "1", "é", "c"] and words.text.tolist() == [0, 0, 0, 2, 2]


def test_shingle_sets(letters):
    texts = ["", "a", "a b", "A  b", "a b a b", *letters(2, 200, alphabet="ab ")]
    for n in (1, 2, 5):
        sets = []
        for part in slices(pa.array(texts), 300):
            found = shingle_sets(part, n)
            sets += [found.of(i) for i in range(part.last - part.first)]
        plain = []
        for text in texts:
            words = tuple(WORD.findall(lower(text)))
            windows = {words[i : i + n] for i in range(len(words) - n + 1)}
            plain.append(windows or ({words} if words else set()))
        assert [len(s) for s in sets] == [len(s) for s in plain]
        for a, x in zip(sets[:40], plain):
            for b, y in zip(sets[:40], plain):
                assert common(a, b) == len(x & y)


def test_signatures_estimate_the_similarity():
    rnd = np.random.default_rng(1)
    words = [f"w{i}" for i in rnd.permutation(3000)]
    texts = [" ".join(words[:2000]), " ".join(words[500:2500]), ""]
    (part,) = slices(pa.array(texts))
    signs = signatures(shingle_sets(part, 1), 512)
    assert abs((signs[0] == signs[1]).mean() - 0.6) < 0.07
    assert not signs[2].any()
