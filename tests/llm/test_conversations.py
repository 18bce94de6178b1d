import hashlib
import itertools
import random
import zlib

import pytest

from skyledger.llm import audits, conversations

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, part int, kind int, copy int, cost string, tie string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 7, 7, 7, "x", "x") for row in rows], SCHEMA).repartition(3)


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def cheapest(rows):
    """Cost and audit over all edits of up to a few rows: (initial, gone, cut off)."""
    best = None
    for edits in itertools.product(*[("D",) if gone else ("K", "R", "D") for _, gone, _ in rows]):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""]))
            cost = 5 * sum(inserts) + sum({"K": 0, "R": 1, "D": 2}[e] for e in edits)
            cost += sum(5 for e, row in zip(edits, rows) if row[2] and e != "D")
            if best is not None and (cost, audit) >= best:
                continue
            turns = []
            for n, edit, row in zip(inserts, [*edits, "D"], [*rows, None]):
                turns += ["?"] * n
                turns += [row[0]] if edit == "K" else ["?"] if edit == "R" else []
            free = [i for i, t in enumerate(turns) if t == "?"]
            for roles in itertools.product("ua", repeat=len(free)):
                for i, role in zip(free, roles):
                    turns[i] = role
                if all(len(t) == 1 for t in turns) and legal("".join(turns)):
                    best = cost, audit
                    break
    return best


def test_edits_are_the_cheapest_and_least():
    draw = random.Random(3)
    for _ in range(150):
        rows = [(draw.choice(["s", "u", "a", "u", "a", "t", ""]), draw.random() < 0.2, draw.random() < 0.2) for _ in range(draw.randint(0, 4))]
        edits = audits.Edits()
        for row in rows:
            edits.read(*row)
        told = edits.told()
        assert min(told[state] for state in audits.ENDS if told[state]) == cheapest(rows), rows


def test_parts_join_to_the_whole():
    draw = random.Random(5)
    for _ in range(60):
        rows = [(draw.choice("suauat"), draw.random() < 0.2, draw.random() < 0.2) for _ in range(draw.randint(1, 60))]
        whole, joined = audits.Edits(), audits.Joined()
        for row in rows:
            whole.read(*row)
        at = 0
        while at < len(rows):
            size = draw.randint(1, 12)
            part = [audits.Edits(state) for state in range(audits.STATES)]
            for row in rows[at : at + size]:
                for edits in part:
                    edits.read(*row)
            joined.add([edits.told() for edits in part])
            at += size
        assert joined.end() == min(whole.told()[state] for state in audits.ENDS if whole.told()[state])


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 3])
def test_texts_compare_as_strings_even_if_hashes_collide(monkeypatch, prime):
    monkeypatch.setattr(audits, "PRIME", prime)
    draw = random.Random(1)
    texts, nodes = audits.Texts(), [0]
    for _ in range(400):
        nodes.append(texts.add(draw.choice(nodes[-40:]), draw.choice("DIKR")))
    for _ in range(3000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert texts.less(a, b) == (texts.text(a) < texts.text(b))
        depth = draw.randint(0, texts.depth[a])
        assert texts.text(texts.cut(a, depth)) == texts.text(a)[:depth]


def test_ancestors_are_few_steps_away():
    texts, node = audits.Texts(), 0
    for i in range(100_000):
        node = texts.add(node, "K")
    steps, at = 0, node
    while texts.depth[at] > 3:
        far = texts.back[at]
        at = far if texts.depth[far] >= 3 else texts.before[at]
        steps += 1
    assert steps < 60


def expected(rows, order):
    """The contract row by row, with the audit of one plain pass over all rows."""
    table = {}
    for conv, turn, role, text in rows:
        table.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        place = (turn is not None, turn or 0, order[role, text])
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        table[conv] += [(place, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in table.items():
        own.sort(key=lambda row: row[0])
        turns = [place[1] for place, _, _ in own if place[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, seen, edits = dict(blank=0, duplicate=0, truncated=0), set(), audits.Edits()
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            edits.read(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = min(edits.told()[state] for state in audits.ENDS if edits.told()[state])
        made, left = [], iter(own)
        for edit in audit:
            row = next(left) if edit != "I" else (None, None, "")
            if edit != "D":
                made.append([row[1] if edit == "K" else None, row[2]])
        assert next(left, None) is None
        for i, turn in enumerate(made):
            before = made[i - 1][0][:1] if i else ""
            turn[0] = turn[0] or ("assistant" if before == "u" else "user")
        assert legal("".join(role[:1] for role, _ in made))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=str)


def check(spark, rows):
    ties = conversations.rows_of(frame(spark, rows)).select("role", "text", "tie").distinct().collect()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    df = conversations.report(frame(spark, rows))
    assert df.columns == names
    assert sorted(map(tuple, df.collect()), key=str) == expected(rows, {(t.role, t.text): t.tie for t in ties})


ODD = [
    (1, 0, "system", "Rules."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So."), (1, 2, "assistant", "So."), (1, 2, "user", "Tie!"),
    (2, None, "user", "No turn"), (2, None, None, "No role."), (2, 7, "assistant", None), (2, 90, "user", " \t\n\x0b\x0c\r"),
    (3, 0, "", "Empty role."), (3, 1, "tool", "Call"), (3, 2, "userland", "é漢\x00. "), (None, 0, "user", "Null conversation?"),
    (None, None, None, None), (4, 5, "assistant", "Alone!"), (5, 1, "user", ""), (-6, -3, "user", "x" * 300_000), (-6, 4, "assistant", "y."),
    *[(7, i, ("user", "assistant")[i % 2], "Same.") for i in range(40)], *[(20 + i, 0, "user", "Hi.") for i in range(60)],
]


def test_odd_rows(spark):
    check(spark, ODD)


def test_long_conversations_in_parts(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", 7)
    draw = random.Random(9)
    rows = [(draw.choice([1, 1, 1, 2, 3]), i // 2, draw.choice(["user", "assistant", "system", "x"]), f"t{draw.randint(0, 150)}" + draw.choice(".?, ")) for i in range(500)]
    check(spark, rows)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    check(spark, [tuple(row) for row in table.select("conv_id", "turn", "role", "text").collect()])


def test_empty(spark):
    check(spark, [])


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Late."), (1, 1, "user", "Ask?"), (1, 2, "assistant", "Tell."), (2, 0, "user", "")]
    table = conversations.rows_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = conversations.repaired(table).orderBy("conv_id", "position").collect()
    assert [tuple(r) for r in made] == [(1, 0, "user", "Ask?"), (1, 1, "assistant", "Tell.")]
