from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from fundsift.llm import conversation_repair as repair
from fundsift.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, pos long, node string, n long, path string, fault string"


def odd_conversations() -> list[tuple]:
    """Shared beginnings, whole copies, nulls everywhere, ties, gaps, a long one and one turn only."""
    dice = random.Random(4)
    say = ["Hello.", "What now?", "No end", "", " \t", "Good!\n", "Ünïcode 東京.", "x" * 3000 + "."]
    rows = []
    for c in range(60):
        for t in range(dice.choice([1, 2, 3, 3, 5, 9])):
            rows.append((c, t + (t > 3), dice.choice(["user", "assistant"]) if t or c % 4 else "system", dice.choice(say[:3])))
    rows += [(c, t, "user", f"same {t}.") for c in range(100, 140) for t in range(3)]
    rows += [(200, t, ["user", "assistant"][t % 2], f"Turn {t}{'.' * (t % 7 > 0)}") for t in range(600)]
    rows += [(300, None, None, None), (300, None, "tool", "Null first."), (300, 5, "user", None), (300, 5, "user", "Tie."), (300, 5, "assistant", "Tie.")]
    rows += [(None, 1, "user", "Whose?"), (None, 1, "user", "Whose?"), (None, None, None, None), (-7, 3, "", "Odd."), (-5, 0, "user", "Below zero.")]
    rows += [(400 + k, 0, dice.choice(["user", "system", "odd"]), dice.choice(say)) for k in range(40)]
    return [r + (1, "n", 2, "p", "f") for r in rows + rows[:1]]


@pytest.fixture(scope="module")
def rows():
    return odd_conversations()


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = tmp_path_factory.mktemp("talk")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(path / "conversations.parquet"))
    return str(path)


def crc(text):
    return zlib.crc32(text.encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows, heads=True):
    told = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            told[c].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    told = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in told.items()}
    if not heads:
        return told
    found = {}
    for c, own in told.items():
        h = crc(str(c)) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        found[c] = told.get(base, [])[:h] + own[h:]
    return found


def plain_trie(told):
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in told.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(map(str, sorted(ends[p])))))
        for p, m in members.items()
    )


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_trie_equals_brute_force(spark, folder, rows, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        found = Counter(tuple(r) for r in queries.op12_prefix_trie(spark, folder).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == plain_trie(rebuilt(rows))


def test_trie_without_shared_heads(spark, folder, rows):
    talks = spark.read.parquet(folder + "/conversations.parquet")
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(talks).collect()) == plain_trie(rebuilt(rows, heads=False))


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(none, F.lit(3)).count() == 0
    assert repair.repair_conversations(none).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    talks = spark.createDataFrame([(7, 0, "user", "a", *[None] * 5), (8, 0, "user", "b", *[None] * 5)], SCHEMA)
    found = [tuple(r)[:6] for r in prefix_trie.prefix_trie(talks, F.lit(8)).collect()]
    assert found == [(7, 0, None, 2, 0, 1)]


def test_skeleton_has_the_proper_prefixes_of_shortened_splitters():
    a, b, c = (bytes([x]) * prefix_trie.TOKEN for x in b"abc")
    skeleton = prefix_trie.Skeleton([a + b, a + b + c, a + c + c, a + c + c, c])
    assert skeleton.cuts == [a, a + b + c, a + c, c]
    assert sorted(skeleton.depth) == [0, 1, 2]
    assert [skeleton.part(p) for p in (b"", a, a + b, a + b + c, a + b + c + a, a + c, b, c)] == [0, 1, 1, 2, 2, 3, 3, 4]


def plain_repair(initials, faults):
    """Cost and audit by relaxing (cost, audit) of every node until nothing changes."""
    lattice = repair.Lattice(bytes(initials), bytes(faults))
    best = {0: (0, "")}
    todo = [0]
    while todo:
        node = todo.pop()
        cost, audit = best[node]
        for letter, price, target in lattice.edges(node):
            found = (cost + price, audit + letter)
            if target not in best or found < best[target]:
                best[target] = found
                todo.append(target)
    ends = [repair.STATES * len(initials) + s for s in (repair.START, repair.ASSISTANT)]
    return min(best[e] for e in ends if e in best)


def test_both_directions_find_the_least_audit():
    dice = random.Random(9)
    for k in range(1500):
        n = dice.randint(0, 9)
        initials = [dice.choice([0, 1, 2, 2, 3, 3]) for _ in range(n)]
        faults = [dice.choice([0, 0, 0, 1, 2, 3] if k % 2 else [0, 0, 3]) for _ in range(n)]
        assert repair.Lattice(bytes(initials), bytes(faults)).cheapest() == plain_repair(initials, faults)


def test_edges_run_both_ways():
    dice = random.Random(2)
    for _ in range(50):
        n = dice.randint(0, 5)
        lattice = repair.Lattice(bytes(dice.choices(range(4), k=n)), bytes(dice.choices(range(4), k=n)))
        nodes = range(repair.STATES * (n + 1))
        there, cheapest = {}, {}
        for a in nodes:
            for _, c, b in lattice.edges(a):
                there[a, b] = min(c, there.get((a, b), 99))
            for c, b in lattice.back(a):
                cheapest[b, a] = min(c, cheapest.get((b, a), 99))
        assert there == cheapest


def test_a_very_long_conversation():
    cost, audit = repair.Lattice(bytes([2, 3] * 20_000 + [2]), bytes(40_001)).cheapest()
    assert (cost, len(audit), audit.count("D")) == (2, 40_001, 1)


def damaged(rows):
    told, known = defaultdict(list), dict.fromkeys(r[0] for r in rows)
    for c, turn, role, text, *_ in rows:
        role, text = (" " if v is None else v for v in (role, text))
        f = crc(f"{' ' if c is None else c}:{' ' if turn is None else turn}") % 20
        order = (turn is not None, turn or 0, role, sha(text))
        text = "" if f == 1 else "".join(x for x in text if x not in ".!?") if f == 2 else text
        for _ in range((f != 0) + (f == 3)):
            told[c].append((order, turn, "user" if f == 4 else role, text))
    return {c: [r[1:] for r in sorted(told[c], key=lambda r: r[0])] for c in known}


def plain_result(c, told):
    codes = {"s": 1, "u": 2, "a": 3}
    white = repair.WHITE
    faults, seen, turns = [], set(), [t for t, *_ in told if t is not None]
    for _, role, text in told:
        end = text.strip(white)[-1:]
        faults.append(1 if not end else 2 if (role, text) in seen else 3 if end not in ".!?" else 0)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in told]
    cost, audit = plain_repair([codes.get(i, 0) for i in initials], faults)
    lines, rest, last = [], iter(told), ""
    for letter in audit:
        _, role, text = next(rest) if letter != "I" else (None, None, "")
        if letter in "IR":
            role = "assistant" if last == "u" else "user"
        if letter != "D":
            last = role[0]
            lines.append(f"{role}:{text}")
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (c, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha("\n".join(lines)))


def test_repair_equals_brute_force(spark, folder, rows):
    short = [r for r in rows if r[0] != 200]
    expected = Counter(plain_result(c, told) for c, told in damaged(short).items())
    found = Counter(tuple(r) for r in queries.op13_conversation_repair(spark, folder).collect() if r.conv_id != 200)
    assert found == expected
    assert any(k[7] == "" for k in found)


@pytest.mark.parametrize("name", ["op12_prefix_trie", "op13_conversation_repair"])
def test_queries_equal_their_sql(spark, folder, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{Path(folder) / 'conversations.parquet' / '*.parquet'}'")
    result = duck.execute(queries.SQL[name])
    found = queries.QUERIES[name](spark, folder)
    columns = [c[0] for c in result.description]
    assert Counter(map(tuple, result.fetchall())) == Counter(tuple(r[c] for c in columns) for r in found.collect())
