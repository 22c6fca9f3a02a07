"""Conversation repair against trying all edits, whole and in pieces."""

import hashlib
import random
import re
import zlib

import pytest

from terraloom.llm import conversation_repair as repair

GOOD = re.compile(r"(s?(ua)+)?\Z")
COLUMNS = ["conv_id", "turn", "role", "text"]


def lightest(rows):
    """Lightest (cost, audit) and the repaired rows by trying all edits of (role, text, must go, truncated) that can still be best."""
    most = 5 * len(rows) + 4
    best = [(most, "~", [])]

    def go(i, cost, audit, out):
        if (cost, audit) >= best[0][:2]:
            return
        initials = "".join(r[:1] or "?" for r, _ in out)
        if not any(GOOD.match(initials + more) for more in ("", "a", "ua", "uaua")):
            return
        if i == len(rows) and GOOD.match(initials):
            best[0] = (cost, audit, out)
        if i < len(rows):
            role, text, gone, cut = rows[i]
            go(i + 1, cost + 3, audit + "D", out)
            if not gone:
                go(i + 1, cost + cut, audit + "K", [*out, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + 2 + cut, audit + "R", [*out, (new, text)])
        if not audit.endswith("II"):
            for new in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*out, (new, "")])

    go(0, 0, "", [])
    return best[0]


def plain(conversations):
    out = {}
    for conv in {c for c, *_ in conversations}:
        rows = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in conversations if c == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, *_ in rows if t is not None}
        seen, counts, judged = set(), [0, 0, 0], []
        for _, role, text in rows:
            body = text.strip(" \t\n\x0b\f\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, fixed = lightest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, digest)
    return out


def odd_conversations():
    rng = random.Random(3)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None]
    texts = ["One.", "Two!", "Cut", "", " \t\n", None, "Ask? ", "ünï.\n", "No stop\x0b"]
    rows = [
        (conv, rng.choice([None, *range(5)]) if conv % 3 == 0 else turn, rng.choice(roles), rng.choice(texts))
        for conv in range(40) for turn in range(rng.randrange(1, 8))
    ]
    return [*rows, (None, None, None, None), (None, 1, "user", "x" * 100_000), (-5, 2, "user", "Hi."), (-5, 2, "user", "Hi.")]


def facts(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def schema(kind="bigint"):
    return f"conv_id {kind}, turn bigint, role string, text string"


def test_whole_and_in_pieces(spark):
    rows = odd_conversations()
    df, want = spark.createDataFrame(rows, schema()), plain(rows)
    assert facts(repair.repair_report(df)) == want
    assert facts(repair.repair_report(df, long_rows=3)) == want
    assert facts(repair.repair_report(df.selectExpr("*", "7 AS _conv", "role AS fault", "1 AS _k"), long_rows=3)) == want


def test_long_conversation_in_pieces(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Text {t}.", "Again.", f"cut {t}", ""])) for t in range(3000)]
    rows += [(2, 0, "user", "Hi."), (3, 0, "system", "Be short.")]
    df = spark.createDataFrame(rows, schema()).repartition(7)
    whole, pieces = facts(repair.repair_report(df)), facts(repair.repair_report(df, long_rows=100))
    assert whole == pieces and len(pieces[1][6].replace("I", "")) == 3000 and pieces[2][5:7] == (2, "KI")


def test_damage_and_lost_conversations(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Words, of {c} and {t}!") for c in range(150) for t in range(c % 4 + 1)]
    rows += [(None, None, "user", None)]
    got = facts(repair.repair_report(repair.damage(spark.createDataFrame(rows, schema()))))
    kept = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    want = plain(kept)
    lost = {c for c, *_ in rows} - set(want)
    assert lost
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want | dict.fromkeys(lost, nothing)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_empty_table_and_text_ids(spark, kind):
    assert repair.repair_report(spark.createDataFrame([], schema(kind))).count() == 0
    got = repair.repair(spark.createDataFrame([("7", 0, "assistant", "Yes.")], schema("string"))).first()
    assert (got.audit, got.cost, [tuple(r) for r in got.repaired]) == ("IK", 2, [("user", ""), ("assistant", "Yes.")])
