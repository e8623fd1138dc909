"""Conversation repair against plain Python: strings instead of nodes, one pass instead of runs."""

import hashlib
import random
import zlib

from starfold.llm import conversation_repair as cr
from starfold.llm.queries import op11_conversation_repair

SF001 = "/root/testdata/sf0.001"

KEPT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def made(state):
    return "a" if state == "u" else "u"


def cheapest(rows):
    """(cost, audit) by trying every edit, with whole strings. rows: (initial, has to go, truncated)."""
    best = {"": (0, "")}

    def relaxed(old):
        out = dict(old)
        for _ in range(4):
            for state, (cost, audit) in list(out.items()):
                out[made(state)] = min(out.get(made(state), (10**9, "")), (cost + 3, audit + "I"))
        return out

    for initial, gone, truncated in rows:
        after = {}
        for state, (cost, audit) in relaxed(best).items():
            choices = [(state, cost + 4, "D")]
            if not gone:
                choices.append((made(state), cost + 3 + 3 * truncated, "R"))
                if (state, initial) in KEPT:
                    choices.append((KEPT[state, initial], cost + 3 * truncated, "K"))
            for to, c, edit in choices:
                after[to] = min(after.get(to, (10**9, "")), (c, audit + edit))
        best = after
    return min(relaxed(best)[s] for s in ("", "a") if s in relaxed(best))


def crc(text):
    return zlib.crc32(text.encode())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(rows):
    """The result of the query, conversation by conversation."""
    found = {}
    broken = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in broken if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], crc(r[2])))
        seen, states, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            states.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = cheapest(states)
        fixed, state, rest = [], "", [r[1:] for r in own]
        for edit in audit:
            role, text = ("", "") if edit == "I" else rest.pop(0)
            if edit in "IR":
                state = made(state)
                fixed.append(({"u": "user", "a": "assistant"}[state], text))
            elif edit == "K":
                state = KEPT[state, role[:1]]
                fixed.append((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(states, states[1:]))
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        found[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_conv(frame):
    rows = frame.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS if c in frame.columns) for r in rows}
    assert len(out) == len(rows)
    return out


def written(spark, rows, tmp_path, kind="conv_id long, turn long, role string, text string"):
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert by_conv(op11_conversation_repair(spark, SF001)) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Hi.", "no stop", "", " \t", None, "Ünd?", "x!\n "])) for _ in range(600)]
    rows += [(99, 1, "user", "same."), (99, 1, "user", "same."), (99, 2, "assistant", "long " * 50_000 + "."), (99, 3, "assistant", "ok!")]
    rows = list({(r[0], r[1], r[2] or " ", r[3] if r[3] is not None else " "): r for r in rows}.values()) + rows[-4:-3]
    assert by_conv(op11_conversation_repair(spark, written(spark, rows, tmp_path))) == brute(rows)


def test_empty_and_dropped(spark, tmp_path):
    assert op11_conversation_repair(spark, written(spark, [], tmp_path / "none")).count() == 0
    turn = next(t for t in range(1000) if crc(f"5:{t}") % 20 == 0)
    rows = by_conv(op11_conversation_repair(spark, written(spark, [(5, turn, "user", "Hello.")], tmp_path / "gone")))
    assert rows == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_runs_join_to_one_pass(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(30)}{rng.choice(['.', '', '!'])}") for c, n in enumerate([1, 2, 5, 9, 700]) for t in range(n)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    whole = by_conv(cr.audits(frame))
    assert by_conv(cr.audits(frame, most=3)) == whole == by_conv(cr.audits(frame, most=1))
    for conv in whole:
        own, seen, states = [r[2:] for r in rows if r[0] == conv], set(), []
        for role, text in own:
            again = (role, text) in seen
            seen.add((role, text))
            states.append((role[0], again, not again and text[-1] not in ".!?"))
        assert whole[conv][-2:] == cheapest(states)


def test_audit_is_least_of_all():
    rng = random.Random(1)
    for _ in range(3_000):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(9))]
        assert cr.solve(rows) == cheapest(rows)


def test_compare_survives_colliding_hashes(monkeypatch):
    monkeypatch.setattr(cr, "MODULUS", 3)  # nearly all hashes collide
    rng = random.Random(2)
    for _ in range(1_000):
        rows = [(rng.choice("sua"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(12))]
        assert cr.solve(rows) == cheapest(rows)


def test_extra_columns_and_names(spark):
    rows = [(1, 0, "user", "Hi.", "x", 7), (1, 1, "assistant", "Yes.", "y", 8)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, N long")
    assert by_conv(cr.audits(frame)) == {1: (0, 0, 0, 0, 0, 0, "KK")}
    renamed = frame.toDF("Conv", "at", "who", "said", "audit", "pos")
    audited = cr.audits(renamed, "Conv", "at", "who", "said")
    assert [tuple(r) for r in cr.repaired(renamed, audited, "Conv", "at", "who", "said").collect()] == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]
