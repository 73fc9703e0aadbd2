import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from tallyhouse.llm import conversation_repair, damage, edit_paths, queries
from tallyhouse.llm.conversation_repair import audits, cheapest_edits, repair

ROWS = "conv_id bigint, turn bigint, role string, text string"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
MUST_GO = ("blank", "duplicate")


def every_repair(rows):
    """Cost, initials and roles of all ways to edit a few rows, with up to two insertions a gap."""
    inserts = [c for n in range(3) for c in itertools.product(["user", "assistant"], repeat=n)]

    def choices(role, fault):
        stays = 5 * (fault == "truncated")
        yield "D", 2, None
        if fault not in MUST_GO:
            yield "K", stays, role
            yield "R", 1 + stays, "user"
            yield "R", 1 + stays, "assistant"

    gaps = [[[("I", 5, role) for role in c] for c in inserts]] * (len(rows) + 1)
    for edits in itertools.product(*(list(choices(*row)) for row in rows)):
        for filled in itertools.product(*gaps):
            done = [*filled[0], *itertools.chain(*([e, *f] for e, f in zip(edits, filled[1:])))]
            roles = [role for _, _, role in done if role is not None]
            initials = "".join(r[:1] or "?" for r in roles)
            if re.fullmatch("(s?(ua)+)?", initials):
                yield sum(c for _, c, _ in done), "".join(e for e, _, _ in done), roles


def best_repair(rows):
    """The same for many rows, from the last row to the first: what is put before does not change
    which of two endings is better."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    grown = {"": "u", "s": "u", "a": "u", "u": "a"}
    names = {"u": "user", "a": "assistant"}

    @cache
    def to_end(i, state, inserted):
        found = []
        if inserted < 2:
            found.append((*to_end(i, grown[state], inserted + 1), 5, "I", names[grown[state]]))
        if i == len(rows):
            if state in ("", "a"):
                return 0, "", ()
        else:
            role, fault = rows[i]
            found.append((*to_end(i + 1, state, 0), 2, "D", None))
            if fault not in MUST_GO:
                stays = 5 * (fault == "truncated")
                if (state, role[:1]) in after:
                    found.append((*to_end(i + 1, after[state, role[:1]], 0), stays, "K", role))
                found.append((*to_end(i + 1, grown[state], 0), 1 + stays, "R", names[grown[state]]))
        if not found:
            return 10**9, "", ()
        return min((cost + c, e + audit, (r, *roles)) for cost, audit, roles, c, e, r in found)

    cost, audit, roles = to_end(0, "", 0)
    return cost, audit, [r for r in roles if r is not None]


def mine(rows):
    edits = list(cheapest_edits((0, None, role, "t", fault, False) for role, fault in rows))
    return sum(e[1] for e in edits), "".join(e[0] for e in edits), [e[3] for e in edits if e[3] is not None]


def some_rows(rnd, n):
    return [
        (rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", " ", "u", "aide"]),
         rnd.choice([None, None, None, "truncated", "blank", "duplicate"]))
        for _ in range(n)
    ]


def test_all_ways_of_a_few_rows():
    rnd = random.Random(1)
    for _ in range(120):
        rows = some_rows(rnd, rnd.randint(0, 2))
        cost, audit, roles = min(every_repair(rows))
        assert mine(rows) == (cost, audit, roles) == best_repair(rows), rows


def test_many_rows():
    rnd = random.Random(2)
    for _ in range(1500):
        rows = some_rows(rnd, rnd.randint(0, 30))
        assert mine(rows) == best_repair(rows), rows


@pytest.mark.parametrize("modulus", [1, 2, 7, 1 << 61])
def test_colliding_hashes_change_nothing(monkeypatch, modulus):
    monkeypatch.setattr(edit_paths, "MODULUS", modulus)
    monkeypatch.setattr(conversation_repair, "_SETTLE_ROWS", 5)
    rnd = random.Random(3)
    for _ in range(400):
        rows = some_rows(rnd, rnd.randint(0, 40))
        assert mine(rows) == best_repair(rows), rows


def test_paths_compare_as_their_letters(monkeypatch):
    for modulus in (3, 11, 1 << 61):
        monkeypatch.setattr(edit_paths, "MODULUS", modulus)
        rnd = random.Random(modulus)
        paths = [(edit_paths.Path(None), "")]
        for _ in range(300):
            parent, letters = rnd.choice(paths[-40:])
            letter = rnd.choice("DIK")
            paths.append((edit_paths.Path(parent, letter), letters + letter))
        for _ in range(3000):
            (a, x), (b, y) = rnd.choice(paths), rnd.choice(paths)
            assert edit_paths.precedes(a, b) == (x < y)
            same = next((k for k, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
            assert edit_paths.common_prefix(a, b) == same


def test_a_long_conversation_is_settled_on_the_way(monkeypatch):
    rows = [(("user", "assistant")[k % 2], None) for k in range(20_000)]
    handed = cheapest_edits((0, k, role, "t", fault, False) for k, (role, fault) in enumerate(rows))
    assert next(handed)[2][1] == 0 and len(list(handed)) == 19_999
    # Nothing but blanks: nothing is kept, and the longest path is still settled.
    assert mine([("user", "blank")] * 5_000) == (10_000, "D" * 5_000, [])


def plain_audit(rows):
    """A conversation's result from its damaged rows, in plain Python."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        fault = None
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, roles = best_repair(tuple((r[1], f) for r, f in zip(rows, faults)))
    kept, lines, places = iter(roles), [], iter(rows)
    for letter in audit:
        text = "" if letter == "I" else next(places)[2]
        if letter != "D":
            lines.append(f"{next(kept)}:{text}")
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha), lines


def damaged(conv, turn, role, text):
    role, text = (" " if v is None else v for v in (role, text))
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    row = (turn, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))
    return [row] * (2 if kind == 3 else 1)


def conversations(rnd, n):
    texts = ["Good.", "No", "Why? \n", "", " \t", "é日!", "x\x1c", "Yes. And", None]
    return [
        (rnd.choice([None, *range(12)]), rnd.choice([None, *range(9)]), rnd.choice(["user", "assistant", "system", "", "tool", None]), rnd.choice(texts))
        for _ in range(n)
    ]


def test_tables(spark):
    rows = conversations(random.Random(4), 400)
    table = spark.createDataFrame([(*r, 1) for r in rows], ROWS + ", cost int").withColumnRenamed("cost", "step").repartition(5)
    edits = repair(table)
    by_id = {}
    for conv, turn, role, text in rows:
        by_id.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    found = {r.conv_id: tuple(r)[1:] for r in audits(edits).collect()}
    assert found == {conv: plain_audit(some)[0] for conv, some in by_id.items()}
    repaired = {conv: [] for conv in by_id}
    for r in sorted(edits.collect(), key=lambda r: r.step):
        if r.role is not None:
            repaired[r.conv_id].append(f"{r.role}:{r.text}")
    assert repaired == {conv: plain_audit(some)[1] for conv, some in by_id.items()}
    assert repair(table.limit(0)).isEmpty() and audits(repair(table.limit(0))).isEmpty()


def test_long_texts_and_one_large_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(3_000)] + [(2, 0, "user", "long " * 200_000)]
    table = spark.createDataFrame(rows, ROWS).repartition(4)
    found = {r.conv_id: r for r in audits(repair(table)).collect()}
    assert found[1].audit == "K" * 3_000 and found[1].cost == 0
    assert (found[2].truncated, found[2].audit, found[2].cost) == (1, "D", 2)


def test_damage(spark):
    rows = conversations(random.Random(5), 2_000)
    found = damage.damage_turns(spark.createDataFrame(rows, ROWS)).collect()
    expected = [(r[0], *d) for r in rows for d in damaged(*r)]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_query_over_the_given_conversations(spark, sf_folder):
    by_id = {}
    for r in spark.read.parquet(f"{sf_folder}/conversations.parquet").collect():
        by_id.setdefault(r.conv_id, []).extend(damaged(*r))
    found = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, sf_folder).collect()}
    assert found == {conv: plain_audit(rows)[0] for conv, rows in by_id.items()}
