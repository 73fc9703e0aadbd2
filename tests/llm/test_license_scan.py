import random
import time

from tallyhouse.llm import license_scan
from tallyhouse.llm.license_texts import TEMPLATES

MIT = TEMPLATES["mit"]


def found(docs, templates=TEMPLATES, **options):
    rows = license_scan.scan(docs, templates, **options).collect()
    return sorted([(r["doc_id"], r["template"], r["first_byte"], r["text"]) for r in rows], key=str)


def test_whole_notices_with_their_places(clashing):
    before = "Zürich, ça va. "
    texts = [
        before + MIT + " the end", "x " * 5000 + TEMPLATES["bsd"], "no notice here", None, "",
        TEMPLATES["cc-by-nc-4.0-notice"] + " and so on " + TEMPLATES["cc-by-nc-4.0-notice"],
    ]
    hits = found(clashing(*enumerate(texts)))
    assert [(i, name) for i, name, _, _ in hits] == [
        (0, "mit"), (1, "bsd"), (5, "cc-by-nc-4.0-notice"), (5, "cc-by-nc-4.0-notice")
    ]
    for i, _, first, text in hits:
        assert texts[i].encode()[first : first + len(text.encode())] == text.encode()
    assert hits[0][2] == len(before.encode()) and hits[0][3] == MIT.rstrip(".")


def test_changed_notices(documents):
    """Other marks, case and line ends change nothing; changed words lower the coverage."""
    words = MIT.split()
    dropped = " ".join(w for i, w in enumerate(words) if i % 15)
    swapped = " ".join("WORD" if i % 12 == 5 else w for i, w in enumerate(words))
    lines = "\n * ".join(MIT.upper().split(", "))
    half = " ".join(words[: len(words) // 2])
    docs = documents((1, dropped), (2, swapped), (3, lines), (4, half), (5, "Z " + MIT.replace(" ", "  ")))
    rows = {r["doc_id"]: r for r in license_scan.scan(docs, {"mit": MIT}).collect()}
    assert rows.keys() == {1, 2, 3, 5}
    n = rows[3]["template_words"]
    assert rows[3]["matched_words"] == rows[5]["matched_words"] == n == 79 or rows[3]["coverage"] == 1.0
    missing = len(range(0, len(words), 15))
    assert abs(rows[1]["matched_words"] - (n - missing)) <= 1
    assert abs(rows[2]["matched_words"] - (n - len(range(5, len(words), 12)))) <= 2


def test_notices_broken_by_inserted_text(documents):
    """Parts in the template's order are one match; in another order, or too little, none."""
    words = MIT.split()
    first, second = " ".join(words[:40]), " ".join(words[40:])
    other = " ".join(f"Holder{i} Zqx{i * 7}" for i in range(60))
    texts = [f"{first} {other} {second}", f"{second} {other} {first}", f"{first} {other} {first}"]
    texts += [f"{first} {other} {MIT} {other} {second}", f"{first} {other} {second} {other} {texts[0]}"]
    hits = license_scan.scan(documents(*enumerate(texts)), {"mit": MIT}).collect()
    assert sorted(r["doc_id"] for r in hits) == [0, 3, 4, 4]
    for r in hits:
        whole = MIT if r["doc_id"] == 3 else texts[0]
        assert r["coverage"] == 1.0 and r["text"] == whole.rstrip(".")


def test_many_broken_notices_in_one_text(documents):
    """Every one is found, in time that grows with their number."""
    words = MIT.split()
    first, second = " ".join(words[:40]), " ".join(words[40:])
    other = " ".join(f"Holder{i} Zqx{i * 7}" for i in range(30))
    text = f" {other} ".join([first, second] * 2000)
    start = time.perf_counter()
    rows = license_scan.scan(documents((1, text)), {"mit": MIT}).collect()
    assert time.perf_counter() - start < 60
    assert len(rows) == 2000 and all(r["coverage"] == 1.0 for r in rows)
    ranges = sorted((r["first_byte"], r["last_byte"]) for r in rows)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_later_notice_does_not_lend_its_words():
    """The first notice lacks its last words, which the second has: both are reported."""
    def part(numbers, at):
        return [(n, at + 10 * k, at + 10 * k + 5) for k, n in enumerate(numbers)]

    parts = [part(range(0, 9), 0), part(range(9, 17), 1000), part(range(0, 10), 2000), part(range(10, 20), 3000)]
    chains = list(license_scan._chains(parts, 15))
    assert [[p[0] for p in c] for c in chains] == [list(range(17)), list(range(20))]
    # Without the second notice what follows extends the first.
    late = [part(range(0, 9), 0), part(range(9, 16), 1000), part([3, 4], 1500), part([16, 17], 2000)]
    (chain,) = license_scan._chains(late, 15)
    assert [p[0] for p in chain] == list(range(18)) and chain[-1][1] == 2010


def test_chains_are_longest_rising_runs():
    rnd = random.Random(4)
    for _ in range(300):
        pairs = [(rnd.randrange(12), 10 * k, 10 * k + 5) for k in range(rnd.randint(1, 14))]
        size = [1] * len(pairs)
        for j, pair in enumerate(pairs):
            size[j] += max((size[i] for i in range(j) if pairs[i][0] < pair[0]), default=0)
        chain = license_scan._Chain()
        for pair in pairs:
            chain.add(pair)
        found = chain.longest()
        assert len(found) == max(size) and found == sorted(found, key=lambda p: (p[1], p[0]))
        assert all(a[0] < b[0] for a, b in zip(found, found[1:]))


def test_index_blocks_give_the_same(documents):
    docs = documents(*enumerate([*TEMPLATES.values(), " ".join(TEMPLATES.values())]))
    assert found(docs) == found(docs, index_entries=100)


def test_any_long_enough_shared_run_is_a_hit():
    import numpy as np
    import pyarrow as pa

    from tallyhouse.llm.words import slices

    index = license_scan.Index.of([("mit", MIT)])
    compact = "".join(c for c in MIT.lower() if c.isalnum())
    size = license_scan.RUN + license_scan.WINNOW - 1
    for start in range(0, len(compact) - size, 17):
        (part,) = slices(pa.array(["zz " + compact[start : start + size] + " qq"]))
        assert list(index.regions(part, index.sieve())), start
    assert np.all(np.diff(index.hashes.astype(float)) >= 0)


def test_empty(documents):
    assert not found(documents((1, MIT)).limit(0))
    assert not found(documents((1, MIT)), {}) and not found(documents((1, MIT)), {"none": "", "short": "a b"})
