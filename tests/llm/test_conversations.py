import hashlib
import itertools
import random
import zlib

import pytest

from docweave.llm import conversations, edit_algebra as ea, queries

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\v\f\r"


def damaged(rows):
    """Rows after damage, by definition."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(BLANKS)
        out.append("B" if not body else "D" if (role, text) in seen else "T" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, lines): shortest paths row by row, whole audits compared at the end of each step."""
    states = {"": (0, "", ())}
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def offer(into, state, entry):
        if state not in into or entry[:2] < into[state][:2]:
            into[state] = entry

    def filled(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                for new in allowed[state].replace("s", ""):
                    offer(out, new, (cost + 2, audit + "I", (*lines, names[new] + ":")))
        return out

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in filled(states).items():
            offer(after, state, (cost + 3, audit + "D", lines))
            if fault in ("B", "D"):
                continue
            late = int(fault == "T")
            if role[:1] and role[0] in allowed[state]:
                offer(after, role[0], (cost + late, audit + "K", (*lines, f"{role}:{text}")))
            for new in allowed[state].replace("s", ""):
                offer(after, new, (cost + 2 + late, audit + "R", (*lines, f"{names[new]}:{text}")))
        states = after
    return min(e[:3] for state, e in filled(states).items() if state in ("", "a"))


def by_hand(rows):
    found, out = {}, {}
    for row in damaged(rows):
        found.setdefault(row[0], []).append(row)
    for conv in {r[0] for r in rows}:
        own = sorted(found.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = faults_of(own)
        cost, audit, lines = cheapest(own, faults)
        turns = {r[1] for r in own if r[1] is not None}
        heads = [r[2][:1] for r in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in "BDT"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def report(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query_agrees_with_definition(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert report(queries.QUERIES["op13_conversation_repair"](spark, sf)) == by_hand(rows)


def random_rows(rng, convs, most):
    texts = ["Fine.", "cut", "", " ", "why?", "no!", "a b c", None, "x.\n", "Same."]
    out = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "user", "assistant"])
            turn = None if rng.random() < 0.05 else turn + (rng.random() < 0.1)
            out.append((None if conv == 3 else conv, turn, role, rng.choice(texts) if rng.random() < 0.7 else f"{rng.random()}."))
    return out


@pytest.mark.parametrize("segment_rows", [1024, 3])
def test_random_conversations(spark, segment_rows, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", segment_rows)
    rows = random_rows(random.Random(segment_rows), 60, 40)
    rows += [(1000, i, "user" if i % 2 else "assistant", f"line {i}.") for i in range(700)]
    rows += [(1001, 5, "user", "Same.")] * 400
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = by_hand(rows)
    got = report(conversations.repair_report(conversations.damage(table)))
    assert got.keys() == expected.keys()
    for conv in expected:
        assert got[conv] == expected[conv], conv


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "cut"), (2, 0, "system", "Rules."), (2, 1, "user", ""), (2, 2, "user", "Why?")]
    got = sorted(tuple(r) for r in conversations.repaired_rows(conversations.rows_of(spark.createDataFrame(rows, SCHEMA))).collect())
    lines = {c: [(e, r, t) for conv, _, e, r, t in got if conv == c] for c in (1, 2)}
    assert [p for c, p, *_ in got if c == 2] == list(range(3))
    assert lines[2] == [("K", "system", "Rules."), ("K", "user", "Why?"), ("I", "assistant", "")]
    own = [r for r in rows if r[0] == 1]
    assert len(lines[1]) == sum(e != "D" for e in cheapest(own, faults_of(own))[1])


def test_empty_table_and_clashing_columns(spark):
    wide = spark.createDataFrame([(1, 0, "user", "Hi.", "x", "y", 9)], SCHEMA + ", audit string, gaps string, copies long")
    assert len(report(conversations.repair_report(conversations.damage(wide)))) == 1
    assert conversations.repair_report(conversations.damage(wide.limit(0))).count() == 0


def test_dropped_conversation_and_wide_turns(spark):
    gone = next(i for i in itertools.count() if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (-1, -(2**63), "user", "Hi."), (-1, 2**63 - 1, "assistant", "x" * 100_000 + ".")]
    got = report(conversations.repair_report(conversations.damage(spark.createDataFrame(rows, SCHEMA))))
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got[-1][0] is None


def all_sequences(n):
    return ("".join(s) for s in itertools.product([chr(ea.FIRST + i) for i in range(16)], repeat=n))


def rows_from(symbols):
    roles = ["system", "user", "assistant", "tool"]
    return [(1, i, roles[ea.class_of(s)], "") for i, s in enumerate(symbols)], [["", "B", "D", "T"][ea.fault_of(s)] for s in symbols]


def test_every_short_sequence():
    algebra = ea.Algebra(["BA", "EI", "IE", chr(0x101) + chr(0x101)])
    for n in range(4):
        for symbols in all_sequences(n):
            assert algebra.cheapest(symbols) == cheapest(*rows_from(symbols))[:2], symbols


def test_products_in_any_grouping():
    rng = random.Random(5)
    for _ in range(60):
        symbols = "".join(rng.choice("EIAMGKHL") for _ in range(rng.randrange(2, 60)))
        rules = list(dict.fromkeys(a + b for a, b in zip(symbols[:6], symbols[1:7])))
        algebra = ea.Algebra(rules)
        expected = ea.Algebra().cheapest(symbols)
        assert algebra.cheapest(symbols) == expected == cheapest(*rows_from(symbols))[:2]
        cuts = sorted({0, len(symbols), *rng.sample(range(len(symbols)), min(5, len(symbols)))})
        parts = [algebra.matrix(symbols[a:b]) for a, b in zip(cuts, cuts[1:])]
        assert ea.finish(ea.product(parts)) == expected


def test_rules_share_work(spark, sf):
    rows = conversations.damage(spark.read.parquet(f"{sf}/conversations.parquet"))
    parts = conversations.segments(rows)
    rules = conversations.learn_rules(parts)
    algebra = ea.Algebra(rules)
    signs = [r["symbols"] for r in parts.select("symbols").collect()]
    assert 0 < len(rules) <= conversations.ROUNDS * conversations.RULES_A_ROUND
    assert sum(len(algebra.shorten(s)) for s in signs) < 0.6 * sum(map(len, signs))
