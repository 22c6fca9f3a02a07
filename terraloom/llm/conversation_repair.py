"""Repair of conversation structure as a lightest derivation.

Items are ``(row, state)``: the rows before ``row`` are edited and the roles produced so far
leave the automaton of ``(s?(ua)+)?`` in ``state``. Edits are weighted deductions between
items. Values are pairs (cost, audit); every deduction raises them and keeps their order, so
an agenda in the sense of Knuth pops each item at its lightest value, and the search ends
once a goal item is popped.

Whole conversations are repaired in the task that receives them. Those of more rows or
characters than a task should hold are cut into pieces: a piece's lightest derivations
between all states come from the same agenda, further deductions join consecutive pieces,
and texts only stream by.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import lookup, materialize

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: A conversation beyond these sizes is repaired in pieces.
LONG_ROWS, LONG_CHARS = 4096, 8 << 20
_PIECE_BITS = 8
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(START, "s"): SYSTEM, **{(state, "u"): USER for state in (START, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
GOALS = (START, ASSISTANT)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
#: Rows as one character each: the role's initial (``o``: none of s, u, a), upper case if truncated, or a row that must go.
MUST_GO = "x"


def _deductions(codes: str, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edit, weight and new item of every deduction from an item."""
    for role in "ua":
        to = _NEXT.get((state, role))
        if to is not None:
            yield "I", INSERT, i, to
    if i == len(codes):
        return
    yield "D", DELETE, i + 1, state
    code = codes[i]
    if code == MUST_GO:
        return
    extra = TRUNCATED if code.isupper() else 0
    for role in "sua":
        to = _NEXT.get((state, role))
        if to is None:
            continue
        if role == code.lower():
            yield "K", KEEP + extra, i + 1, to
        elif role != "s":
            yield "R", REROLE + extra, i + 1, to


def derive(codes: str, start: int = START, goals: tuple[int, ...] = GOALS, every: bool = False) -> dict[int, tuple[int, str]]:
    """The lightest ``(cost, audit)`` that leads from ``start`` over all rows: to the first of ``goals``, or to each with ``every``.

    Two audits of one item with equal costs never begin with one another, since what the
    longer one has more are insertions, which cost; so order by text is kept by every deduction.
    """
    agenda, final, out = [(0, "", 0, start)], set(), {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(codes) and state in goals:
            out[state] = (cost, audit)
            if not every or len(out) == len(goals):
                break
        for edit, weight, j, to in _deductions(codes, i, state):
            if (j, to) not in final:
                heapq.heappush(agenda, (cost + weight, audit + edit, j, to))
    return out


@lru_cache(1 << 16)
def _best(codes: str) -> tuple[int, str]:
    return next(iter(derive(codes).values()))


def apply_edits(audit: str, rows: Iterator[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str, int]]:
    """Role and text of every repaired row and the state after it."""
    for edit in audit:
        if edit == "I":
            state = USER if (state, "u") in _NEXT else ASSISTANT
            yield _ROLE[state], "", state
            continue
        role, text = next(rows)
        if edit == "K":
            state = _NEXT[state, role[:1]]
            yield role, text, state
        elif edit == "R":
            state = USER if (state, "u") in _NEXT else ASSISTANT
            yield _ROLE[state], text, state


def _prepared(conversations: DataFrame) -> DataFrame:
    """The rows with nulls as one space, ``_conv`` (the id as text), ``fault`` 0, 1 (blank) or 2 (truncated if nothing worse)."""
    present = F.coalesce("present", F.lit(True)) if "present" in conversations.columns else F.lit(True)
    rows = conversations.select(
        "conv_id", F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n")).alias("_conv"), F.col("turn").cast("long").alias("turn"),
        F.when(present, F.coalesce("role", F.lit(" "))).otherwise("").alias("role"),
        F.when(present, F.coalesce("text", F.lit(" "))).otherwise("").alias("text"), present.alias("present"),
    )
    # The last character that is no space decides.
    end = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\f\r", "     ")), -1, 1)
    fault = F.when(end == "", 1).when(~end.isin(".", "!", "?"), 2).otherwise(0)
    return rows.withColumn("fault", fault)


_FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _code(role: str, fault: int) -> str:
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == 2 else initial


def _whole(turns: list[int | None], roles: list[str], texts: list[str], faults: list[int]) -> dict:
    known = {t for t in turns if t is not None}
    seen, codes, counts = set(), [], [0, 0, 0]
    for role, text, fault in zip(roles, texts, faults):
        again = (role, text) in seen
        seen.add((role, text))
        kind = 1 if fault == 1 else 3 if again else fault
        if kind:
            counts[{1: 0, 3: 1, 2: 2}[kind]] += 1
        codes.append(MUST_GO if kind in (1, 3) else _code(role, fault))
    cost, audit = _best("".join(codes))
    return {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0, "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
        "illegal": sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:])), "cost": cost, "audit": audit,
        "repaired": [{"role": role, "text": text} for role, text, _ in apply_edits(audit, zip(roles, texts))],
    }


def _in_tasks(rows: DataFrame) -> DataFrame:
    """Conversations that a task can hold: all facts and ``repaired``, the rows as an array."""
    schema = rows.select("conv_id").schema
    for name in _FACTS:
        schema = schema.add(name, "long")
    row = T.StructType().add("role", "string").add("text", "string")
    schema = schema.add("audit", "string").add("repaired", T.ArrayType(row))

    def run(batches):
        held: list[list] = [[], [], [], []]
        out: list[dict] = []
        last, name = None, None

        def table():
            done = pa.Table.from_pylist(out, arrow).to_batches()
            out.clear()
            return done

        def finish():
            out.append({"conv_id": name, **_whole(*held)})
            for column in held:
                column.clear()

        arrow, chars = None, 0
        for batch in batches:
            arrow = arrow or pa.schema([
                ("conv_id", batch.schema.field("conv_id").type), *((x, pa.int64()) for x in _FACTS), ("audit", pa.string()),
                ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
            ])
            columns = [batch.column(c).to_pylist() for c in ("_conv", "conv_id", "present", "turn", "role", "text", "fault")]
            for conv, own, present, *row in zip(*columns):
                if conv != last:
                    if last is not None:
                        finish()
                        if chars > 1 << 20 or len(out) >= 4096:
                            yield from table()
                            chars = 0
                    last, name = conv, own
                if present:
                    chars += len(row[2])
                    for column, value in zip(held, row):
                        column.append(value)
        if last is not None:
            finish()
        if out:
            yield from table()

    dealt = rows.repartition("_conv").sortWithinPartitions("_conv", F.asc_nulls_first("turn"), "role", "text")
    return dealt.mapInArrow(run, schema)


def _coded(rows: DataFrame) -> DataFrame:
    """The rows of long conversations in order: ``_k`` ascends in a conversation, ``_piece`` has at most 256 consecutive rows."""
    ordered = rows.where("present").repartitionByRange("_conv", F.asc_nulls_first("turn"), "role", "text")
    ordered = ordered.sortWithinPartitions("_conv", F.asc_nulls_first("turn"), "role", "text")
    ordered = materialize(ordered.withColumn("_k", F.monotonically_increasing_id()), "turns")
    same = [F.xxhash64(F.lit(k), "role", "text").alias(f"_h{k}") for k in (1, 2)]
    marks = ordered.select("_conv", *same, "_k")
    keys = ["_conv", "_h1", "_h2"]
    firsts = marks.groupBy(*keys).agg(F.min("_k").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1")
    found = lookup(ordered.select("*", *same), materialize(firsts, "repeats"), keys, "_copies")
    again = F.coalesce(F.col("_k") > F.col("_first"), F.lit(False))
    kind = F.when(F.col("fault") == 1, 1).when(again, 3).otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(F.col("_kind").isin(1, 3), MUST_GO).when(F.col("_kind") == 2, F.upper(code)).otherwise(code)
    out = found.withColumn("_kind", kind).withColumn("_code", code).withColumn("_initial", initial)
    out = out.withColumn("_piece", F.shiftright("_k", _PIECE_BITS))
    return materialize(out.select("conv_id", "_conv", "turn", "role", "text", "_k", "_piece", "_kind", "_code", "_initial"), "coded")


def _pieces(coded: DataFrame) -> DataFrame:
    """Per piece the lightest derivations between all states, as ``froms, tos, costs, audits``, and its first and last initial."""

    def run(batches):
        for batch in batches:
            out = []
            for conv, piece, rows in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_piece", "rows"))):
                codes, initials = "".join(r["_code"] for r in rows), [r["_initial"] for r in rows]
                found = [(p, q, *value) for p in range(4) for q, value in derive(codes, p, (0, 1, 2, 3), True).items()]
                froms, tos, costs, audits = map(list, zip(*found))
                out.append({
                    "_conv": conv, "_piece": piece, "n": len(rows), "froms": froms, "tos": tos, "costs": costs, "audits": audits,
                    "head": initials[0], "tail": initials[-1], "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
                })
            fields = [("_conv", pa.string()), ("_piece", pa.int64()), ("n", pa.int64()), ("froms", pa.list_(pa.int64())), ("tos", pa.list_(pa.int64())),
                      ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("head", pa.string()), ("tail", pa.string()), ("illegal", pa.int64())]
            yield from pa.Table.from_pylist(out, pa.schema(fields)).to_batches()

    rows = coded.groupBy("_conv", "_piece").agg(F.array_sort(F.collect_list(F.struct("_k", "_code", "_initial"))).alias("rows"))
    schema = "_conv string, _piece long, n long, froms array<long>, tos array<long>, costs array<long>, audits array<string>, head string, tail string, illegal long"
    return rows.mapInArrow(run, schema)


class _Joined:
    """The lightest derivations over the pieces of a conversation so far.

    All derivations soon share their beginning: it is settled, and only what differs is held.
    """

    def __init__(self):
        self.reached = {START: (0, "")}
        self.settled: list[str] = []
        self.waiting: list[list[int]] = []
        self.illegal, self.tail = 0, None

    def add(self, piece: dict) -> Iterator[tuple[int, str]]:
        better: dict[int, tuple[int, str]] = {}
        for p, q, cost, audit in zip(piece["froms"], piece["tos"], piece["costs"], piece["audits"]):
            if p in self.reached:
                value = (self.reached[p][0] + cost, self.reached[p][1] + audit)
                better[q] = min(better.get(q, value), value)
        self.illegal += piece["illegal"] + (self.tail is not None and self.tail + piece["head"] not in _LEGAL)
        self.tail, self.reached = piece["tail"], better
        self.waiting.append([piece["_piece"], piece["n"]])
        yield from self._settle(len(commonprefix([audit for _, audit in better.values()])))

    def end(self) -> Iterator[tuple[int, str]]:
        cost, audit = min(self.reached[q] for q in GOALS if q in self.reached)
        self.cost, self.reached = cost, {START: (cost, audit)}
        yield from self._settle(len(audit), True)

    def _settle(self, n: int, last: bool = False) -> Iterator[tuple[int, str]]:
        """Edits of every waiting piece whose rows lie in the first ``n`` edits; insertions go before the row they precede."""
        text, at = next(iter(self.reached.values()))[1], 0
        while self.waiting:
            piece, rows = self.waiting[0]
            end = at
            while end < n and rows:
                rows -= text[end] != "I"
                end += 1
            if rows:
                break
            if last and len(self.waiting) == 1:
                end = n
            self.waiting.pop(0)
            yield piece, text[at:end]
            self.settled.append(text[at:end])
            at = end
        self.reached = {q: (cost, audit[at:]) for q, (cost, audit) in self.reached.items()}


def _join_pieces(pieces: DataFrame) -> DataFrame:
    """``_conv, _piece, edits`` of every piece, and a row without ``_piece`` of every conversation with ``cost, audit, illegal``."""

    def run(batches):
        last, joined = None, None

        def finish():
            rows = [{"_conv": last, "_piece": piece, "edits": edits} for piece, edits in joined.end()]
            return [*rows, {"_conv": last, "cost": joined.cost, "audit": "".join(joined.settled), "illegal": joined.illegal}]

        fields = pa.schema([("_conv", pa.string()), ("_piece", pa.int64()), ("edits", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])
        for batch in batches:
            out = []
            for piece in (row for k in range(0, batch.num_rows, 64) for row in batch.slice(k, 64).to_pylist()):
                if piece["_conv"] != last:
                    if last is not None:
                        out += finish()
                    last, joined = piece["_conv"], _Joined()
                out += [{"_conv": last, "_piece": p, "edits": edits} for p, edits in joined.add(piece)]
            yield from pa.Table.from_pylist(out, fields).to_batches()
        if last is not None:
            yield from pa.Table.from_pylist(finish(), fields).to_batches()

    dealt = pieces.repartition("_conv").sortWithinPartitions("_conv", "_piece")
    return dealt.mapInArrow(run, "_conv string, _piece long, edits string, cost long, audit string, illegal long")


def _digests(coded: DataFrame, edits: DataFrame) -> DataFrame:
    """``_conv, repaired_sha256``: texts stream through the hash, each piece's edits before its rows."""

    def run(batches):
        last, digest, plan, state, first = None, None, "", START, True

        def feed(rows):
            nonlocal state, first
            for role, text, state in apply_edits(rows[0], iter(rows[1]), state):
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False

        fields = pa.schema([("_conv", pa.string()), ("repaired_sha256", pa.string())])
        for batch in batches:
            out = []
            for conv, k, role, text, piece_edits in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_k", "role", "text", "edits"))):
                if conv != last:
                    if last is not None:
                        feed((plan, ()))
                        out.append({"_conv": last, "repaired_sha256": digest.hexdigest()})
                    last, digest, plan, state, first = conv, hashlib.sha256(), "", START, True
                if k is None:
                    feed((plan, ()))
                    plan = piece_edits
                    continue
                cut = next(c for c, edit in enumerate(plan) if edit != "I") + 1
                feed((plan[:cut], ((role, text),)))
                plan = plan[cut:]
            if out:
                yield from pa.Table.from_pylist(out, fields).to_batches()
        if last is not None:
            feed((plan, ()))
            yield from pa.Table.from_pylist([{"_conv": last, "repaired_sha256": digest.hexdigest()}], fields).to_batches()

    none = F.lit(None)
    heads = edits.select("_conv", "_piece", none.cast("long").alias("_k"), none.cast("string").alias("role"), none.cast("string").alias("text"), "edits")
    rows = coded.select("_conv", "_piece", "_k", "role", "text", none.cast("string").alias("edits")).unionByName(heads)
    dealt = rows.repartition("_conv").sortWithinPartitions("_conv", "_piece", F.asc_nulls_first("_k"))
    return dealt.mapInArrow(run, "_conv string, repaired_sha256 string")


def _in_pieces(rows: DataFrame) -> DataFrame:
    coded = _coded(rows)
    joined = materialize(_join_pieces(_pieces(coded)), "joined")

    def count(kind: int) -> Column:
        return F.count(F.when(F.col("_kind") == kind, 1))

    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    facts = coded.groupBy("_conv").agg(
        F.first("conv_id").alias("conv_id"), gaps.alias("gaps"), count(1).alias("blank"), count(3).alias("duplicate"), count(2).alias("truncated")
    )
    whole = joined.where("_piece IS NULL").select("_conv", "illegal", "cost", "audit")
    digests = _digests(coded, joined.where("_piece IS NOT NULL").select("_conv", "_piece", "edits"))
    return facts.join(whole, "_conv").join(digests, "_conv").select("conv_id", *_FACTS, "audit", "repaired_sha256")


def repair(conversations: DataFrame) -> DataFrame:
    """Facts and ``repaired`` (the rows as structs of role and text) of every conversation in ``conv_id, turn, role, text``.

    Made for conversations that a task can hold; ``repair_report`` handles any length. Rows
    are taken by turn, nulls first, ties by role and text. A null role or text counts as one
    space. Repeated rows are duplicates of the first. Rows whose optional column ``present``
    is false only announce their id. A conversation without rows has zeros, an empty audit
    and no repaired rows; null ids form one conversation. An empty role is illegal beside
    every other and can only be replaced or deleted. Further columns are ignored.
    """
    return _in_tasks(_prepared(conversations))


def repair_report(conversations: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS) -> DataFrame:
    """``conv_id``, the facts, ``audit`` and ``repaired_sha256`` of every conversation, of any length; see ``repair``.

    A conversation of more than ``long_rows`` rows or ``long_chars`` characters is repaired in
    pieces of at most 256 rows all over the cluster, with equal results. Only its hash, which
    is sequential by definition, and its audit, which is one string, are made by one task, streaming.
    """
    rows = _prepared(conversations)
    sizes = rows.where("present").groupBy("_conv").agg(F.count("*").alias("_n"), F.sum(F.length("text")).alias("_chars"))
    longs = materialize(sizes.where((F.col("_n") > long_rows) | (F.col("_chars") > long_chars)).select("_conv", "_n"), "long-conversations")
    joined = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    if longs.isEmpty():
        return _in_tasks(rows).select("conv_id", *_FACTS, "audit", F.sha2(joined, 256).alias("repaired_sha256"))
    marked = materialize(lookup(rows, longs, ["_conv"], "_n"), "marked")
    held = _in_tasks(marked.where("_n IS NULL")).select("conv_id", *_FACTS, "audit", F.sha2(joined, 256).alias("repaired_sha256"))
    return held.unionByName(_in_pieces(marked.where("_n IS NOT NULL")))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with faults chosen by crc32 of ``conv_id:turn``: dropped, emptied, unpunctuated, repeated, or said by the user.

    A dropped row stays with ``present`` false, so that its conversation is known. Nulls count as one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_fate"))
    rows = rows.withColumn("_copy", F.explode(F.when(F.col("_fate") == 3, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_fate") != 0).alias("present"),
    )
