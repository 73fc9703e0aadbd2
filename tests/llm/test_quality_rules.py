import re
from collections import Counter

import pytest

from tallyhouse.llm import quality_rules as rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {p for i, w in enumerate(windows) if times[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def failed(m):
    conditions = (
        m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"],
        10 * m["n_symbols"] > m["n_words"], 100 * m["n_dup_lines"] > 50 * m["n_lines"],
        m["word_chars"] < 2 * m["n_words"], m["word_chars"] > 15 * m["n_words"],
    )
    return sum(1 << bit for bit, condition in enumerate(conditions) if condition)


@pytest.fixture
def texts(letters):
    return [
        None, "", " \n", "one", "a b c a b c", "a a a a", "x\x0by\x1cz é日 ", "a\nb\na\n \na",
        "spam " * 3000, " ".join(f"word{i}" for i in range(60)), "###$ " * 60, "w" * 200_000,
        *letters(4, 200, (0, 120), "ab \n#"),
    ]


def test_measures_and_bits_match_plain_python(documents, texts):
    rows = rules.ledger(documents(*enumerate(texts))).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = measures(texts[row["doc_id"]])
        assert {m: row[m] for m in rules.MEASURES} == expected
        assert row["failed_rules"] == failed(expected)


def test_policies_read_only_the_bits(documents, texts):
    rows = rules.ledger(documents(*enumerate(texts)))
    bits = [failed(measures(t)) for t in texts]
    for policy in (rules.BASE, rules.STRICT):
        assert rows.filter(rules.passes(policy)).count() == sum(not b & policy.mask for b in bits)
    found = {(r["policy"], r["rule"]): r for r in rules.ablation(rows, [rules.BASE, rules.STRICT]).collect()}
    assert len(found) == len(rules.BASE.rules) + len(rules.STRICT.rules)
    for (name, rule), row in found.items():
        policy = {"base": rules.BASE, "strict": rules.STRICT}[name]
        bit = rules.mask([rule])
        assert row["failed"] == sum(bool(b & bit) for b in bits)
        assert row["failed_alone"] == sum(b & policy.mask == bit for b in bits)
        assert row["kept"] == sum(not b & policy.mask for b in bits)


def test_kept_rows_have_their_columns(clashing, texts):
    docs = clashing(*enumerate(texts), (None, texts[9]), (9, texts[9]))
    kept = rules.keep(docs)
    assert kept.schema == docs.schema
    good = [i for i, t in enumerate(texts) if not failed(measures(t))]
    assert 9 in good
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted([*good, -1, 9])
    assert {r["n_words"] for r in kept.collect()} == {"own n_words"}
    assert rules.ledger(docs).columns[-7:] == [f"{m}_" if m == "n_words" else m for m in rules.MEASURES] + ["failed_rules_"]


def test_no_python_runs_and_nothing_is_shuffled(documents):
    plan = rules.ledger(documents((1, "a")).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(documents):
    assert rules.keep(documents((1, "a")).limit(0)).isEmpty()
