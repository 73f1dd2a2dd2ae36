"""Conversation repair against the enumeration of all edits, and against SQL."""

import hashlib
import random
import re
from zlib import crc32

import duckdb
import pytest

from wirelens.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, node string, n int"
GOOD = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        found = re.findall("[^\x20\x09-\x0d]", text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_edit(rows, marks, most_inserts=2):
    """All (cost, audit, repaired rows) by recursion; insertions before a row and at the end."""

    def go(i, inserts, made):
        spelled = "".join(r[:1] or "?" for r, _ in made)
        if re.fullmatch(r"s?(ua)*u?", spelled) is None:
            return
        if i == len(rows) and GOOD.fullmatch(spelled):
            yield 0, "", made
        if inserts < most_inserts:
            for role in NAMES.values():
                for cost, audit, out in go(i, inserts + 1, [*made, (role, "")]):
                    yield cost + 5, "I" + audit, out
        if i < len(rows):
            _, role, text = rows[i]
            ways = [(2, "D", None)]
            if marks[i] not in ("blank", "duplicate"):
                more = 5 * (marks[i] == "truncated")
                ways += [(more, "K", role)] + [(1 + more, "R", r) for r in NAMES.values()]
            for c, letter, r in ways:
                for cost, audit, out in go(i + 1, 0, made if r is None else [*made, (r, text)]):
                    yield cost + c, letter + audit, out

    return min((c, a, "\n".join(f"{r}:{t}" for r, t in out)) for c, a, out in go(0, 0, []))


def wanted(rows):
    after = damaged(rows)
    marks = faults(after)
    cost, audit, text = every_edit(after, marks)
    turns = [t for t, _, _ in after if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(after, after[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(k) for k in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def random_rows(r, conv, n):
    return [(conv, r.choice([i, i, i, i + 1, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(["Yes.", "No!", "cut", "é?\n", " \t", "", None, "Yes. \v", f"t{i}."])) for i in range(n)]


def test_cheapest_edits_equal_enumeration(spark, tmp_path):
    r = random.Random(5)
    rows = [x for c in range(150) for x in random_rows(r, c, r.randrange(1, 6))] + random_rows(r, None, 4)
    spark.createDataFrame([(*x, "k", 1) for x in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {x[0]: tuple(x[1:]) for x in queries.op13_repair(spark, str(tmp_path)).collect()}
    want = {c: wanted([x for x in rows if x[0] == c]) for c in {x[0] for x in rows}}
    assert got == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert {x[0]: x[1:] for x in con.execute(queries.ORACLES["op13_repair"]).fetchall()} == want


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute(queries.ORACLES["op13_repair"])
    columns = [x[0] for x in want.description]
    assert sorted(map(tuple, queries.op13_repair(spark, sf).select(columns).collect())) == sorted(want.fetchall())


def parse(roles, marks):
    one = repair.Repair()
    for i, (role, mark) in enumerate(zip(roles, marks)):
        one.add(role, f"t{i}", mark)
    return one.close()


def test_audits_compare_by_rank_as_they_do_whole():
    """Against a table over states that compares audits whole, on longer conversations than can be enumerated."""
    r = random.Random(9)
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    for _ in range(60):
        n = r.randrange(1, 60)
        roles = [r.choice("uuaas") if r.random() < 0.8 else "x" for _ in range(n)]
        marks = [r.choice([None, None, None, "truncated", "blank", "duplicate"]) for _ in range(n)]
        best = {"": (0, "")}
        for i in range(n + 1):
            for _ in range(2):
                for s, (c, a) in list(best.items()):
                    for x in "ua":
                        if (s, x) in go:
                            best[go[s, x]] = min(best.get(go[s, x], (99999, "")), (c + 5, a + "I"))
            if i == n:
                break
            after = {}
            for s, (c, a) in best.items():
                ways = [(s, c + 2, a + "D")]
                if marks[i] in (None, "truncated"):
                    more = 5 * (marks[i] == "truncated")
                    ways += [(go.get((s, roles[i])), c + more, a + "K")] + [(go.get((s, x)), c + 1 + more, a + "R") for x in "ua"]
                for t, cost, audit in ways:
                    if t is not None:
                        after[t] = min(after.get(t, (99999, "")), (cost, audit))
            best = after
        top = parse(roles, marks)
        assert (top.cost, top.audit()) == min(best[s] for s in ("", "a") if s in best)


def test_long_conversation_in_bounded_state():
    n = 30_000
    one = repair.Repair()
    for i in range(n):
        one.add("assistant", f"t{i}.", None)
        assert len(one.tops) <= 8
    depth, path = 0, one.tops[0].path
    while path is not None:
        path, depth = path[0], depth + 1
    assert depth < 2 * repair.PACK + n // repair.PACK
    end = one.close()
    assert len(end.audit().replace("I", "")) == n and end.cost == n // 2


def test_duplicates_of_a_large_conversation_by_grouping(spark):
    r = random.Random(2)
    rows = [x for c in (1, 2, None) for x in random_rows(r, c, 40)] + [(1, 7, "user", "Yes.")] * 30
    turns = repair.damage(spark.createDataFrame([(*x, "k", 1) for x in rows], SCHEMA).repartition(3))
    small, large = (sorted(map(str, repair.repairs(turns, n).collect())) for n in (1 << 18, 20))
    assert small == large


def test_repaired_rows(spark):
    r = random.Random(4)
    rows = [x for c in range(30) for x in random_rows(r, c, 6)]
    turns = repair.damage(spark.createDataFrame([(*x, "k", 1) for x in rows], SCHEMA).repartition(3))
    found = repair.repairs(turns)
    out = {}
    for x in sorted(repair.repaired(turns, found).collect(), key=lambda x: (x["conv_id"], x["n"])):
        out.setdefault(x["conv_id"], []).append((x["role"], x["text"]))
    for x in found.collect():
        made = out.get(x["conv_id"], [])
        assert GOOD.fullmatch("".join(role[:1] for role, _ in made))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in made).encode()).hexdigest() == x["repaired_sha256"]


def test_nothing_left_and_nothing_there(spark, tmp_path):
    turn = next(t for t in range(100) if crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, turn, "user", "gone.", "k", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert [tuple(x) for x in queries.op13_repair(spark, str(tmp_path)).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repairs(repair.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    plain = repair.repairs(repair.whole(spark.createDataFrame([(1, 0, "user", "Hi.", "k", 1), (1, 1, "assistant", "Yo.", "k", 1)], SCHEMA))).collect()
    assert [(x["cost"], x["audit"]) for x in plain] == [(0, "KK")]


@pytest.mark.parametrize("roles,audit", [("ua", "KK"), ("sua", "KKK"), ("s", "D"), ("u", "D"), ("aua", "DKK"), ("uu", "KR"), ("uaau", "KKRR")])
def test_known_repairs(roles, audit):
    assert parse(roles, [None] * len(roles)).audit() == audit
