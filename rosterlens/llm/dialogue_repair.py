"""Repair of conversation structure: cheapest edits to a grammar of turns, by a
suffix-shared automaton of role and fault signatures.

A conversation is right when the initials of its roles are ``(s?(ua)+)?``. Its
rows, by turn, have one fault at most, the first of: blank (no character but
white space), duplicate (same role and text earlier), truncated (the last
character but white space is not ``. ! ?``). Edits and costs: Keep 0, Rerole to
user or assistant 1, Delete 2 (the only one for blank and duplicate rows),
Insert a turn without text 5; a truncated row that stays adds 5. The audit is
the edits' initials in order, the cheapest, of those the least by ASCII.

1. ``row_faults`` sorts each conversation's rows in one task (spilling, never
   held) and ``signatures`` reads them as a stream: a letter a row.
2. Equal signatures of all conversations become one. They are dealt by ranges
   of their reverses, so those that end alike meet in a task, in order. There
   the automaton grows from the end: a node is a suffix, kept on a stack while
   signatures share it, and holds for each grammar state the cost to go and the
   first edit of the best audit suffix. Each is worked out once a node and state,
   but for the suffixes that a bound between two ranges cuts.
3. Of a node and state no two edits have one initial, so the least audit of
   the cheapest is the one that takes the least first edit each time: no
   suffix strings are kept or compared.
4. ``repaired_turns`` streams each conversation's audit and rows together and
   gives the repaired turns.

Defined results: rows go by (turn, role, text), turn nulls first; null role and
null text are one space; repeated rows are duplicates; a null conv_id is a
conversation of its own; ``live`` false marks a row that only names its
conversation; other columns are ignored; an empty table gives an empty result.
A very long text is held once, by its row. A very long conversation goes
through one task as a stream (a digest of it is one chain), with a letter of
signature and audit a row, as the result has one value of them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.work import keep, ship_code

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
# Grammar states: nothing yet, after a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = {START, ASSISTANT}
#: The turn that may come next by rerole or insertion, and the state it leads to.
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ROLES = {"u": "user", "a": "assistant"}
GONE = "x"  # signature letter of a row that must go
NEVER = 1 << 60
BATCH_ROWS = 2_000
BATCH_CHARS = 4_000_000
WHITE = " \t\n\x0b\x0c\r"

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long"


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): rows damaged by
    crc32("conv_id:turn") % 20, nulls being one space: 0 drops the row (it stays
    as one not live), 1 empties its text, 2 takes out ``. ! ?``, 3 repeats it,
    4 makes it a user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    text = F.coalesce("text", space)
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("live"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _rows(turns: DataFrame) -> DataFrame:
    live = F.col("live") if "live" in turns.columns else F.lit(True)
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), live.alias("live"))


def row_faults(turns: DataFrame) -> DataFrame:
    """The rows with ``fault`` (blank, duplicate, truncated or null)."""
    rows = _rows(turns).repartition("conv_id")
    earlier = F.row_number().over(Window.partitionBy("conv_id", "live", "role", "text").orderBy("turn")) > 1
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return rows.withColumn("fault", F.when(last == "", "blank").when(earlier, "duplicate")
                           .when(~last.isin(".", "!", "?"), "truncated"))


def letter(initial: Column, fault: Column) -> Column:
    """A row's letter of the signature: its role's initial, as a capital where
    it is truncated; ``o`` any other role; ``x`` a row that must go."""
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (F.when(fault.isin("blank", "duplicate"), GONE)
            .when(fault == "truncated", F.upper(known)).otherwise(known))


def _signed(batches):
    """Sorted rows of whole conversations -> one row a conversation."""
    names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
    types = [pa.int64(), pa.string(), *[pa.int64()] * 5]
    done: list = []
    now = None  # [conv_id, letters, first turn, last turn, distinct turns, faults, illegal pairs, last initial]

    def close():
        conv, letters, low, high, turns, faults, illegal, _ = now
        done.append((conv, "".join(letters), high - low + 1 - turns if turns else 0, *faults, illegal))

    def flush():
        arrays = [pa.array(c, t) for c, t in zip(zip(*done), types)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for conv, turn, initial, sign, fault, live in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now[0] != conv:
                if now is not None:
                    close()
                now = [conv, [], 0, 0, 0, [0, 0, 0], 0, None]
            if not live:
                continue
            now[1].append(sign)
            if len(now[1]) % 65_536 == 0:
                now[1] = ["".join(now[1])]
            if turn is not None:
                if not now[4]:
                    now[2] = turn
                if not now[4] or turn != now[3]:
                    now[4] += 1
                now[3] = turn
            if fault:
                now[5][("blank", "duplicate", "truncated").index(fault)] += 1
            if now[7] is not None and now[7] + initial not in ("su", "ua", "au"):
                now[6] += 1
            now[7] = initial
        if len(done) >= BATCH_ROWS:
            yield flush()
    if now is not None:
        close()
    if done:
        yield flush()


def signatures(faults: DataFrame) -> DataFrame:
    """(conv_id, signature, gaps, blank, duplicate, truncated, illegal) of each conversation."""
    initial = F.substring("role", 1, 1)
    again = F.coalesce(F.col("fault") == "duplicate", F.lit(False))  # of equal rows the first is none
    rows = (faults.sortWithinPartitions("conv_id", "turn", "role", "text", again)
            .select("conv_id", "turn", initial.alias("initial"), letter(initial, F.col("fault")).alias("sign"), "fault", "live"))
    return rows.mapInArrow(_signed, f"conv_id long, signature string, {REPORT}")


class Automaton:
    """Suffix-shared automaton over signatures given by their reverses in
    order. The stack holds the nodes of the signature at hand, from the end."""

    def __init__(self):
        self.reverse = ""
        costs = [0 if s in ACCEPTING else NEVER for s in range(4)]
        self.stack = [self._inserted(costs, [""] * 4)]
        self.made = 0

    @staticmethod
    def _inserted(costs: list, edits: list) -> tuple[list, list]:
        """Insertions before the rest: they lead to another state of the same node."""
        changed = True
        while changed:
            changed = False
            for s in range(4):
                c = costs[NEXT[s][1]] + COSTS[INSERT]
                if c < costs[s] or (c == costs[s] and INSERT < edits[s]):
                    changed |= (c, INSERT) != (costs[s], edits[s])
                    costs[s], edits[s] = c, INSERT
        return costs, edits

    def _node(self, sign: str, rest: list) -> tuple[list, list]:
        self.made += 1
        costs, edits = [], []
        role, more = sign.lower(), TRUNCATED_COST if sign.isupper() else 0
        for s in range(4):
            best = (rest[s] + COSTS[DELETE], DELETE)
            if sign != GONE:
                wanted, then = NEXT[s]
                if role == wanted:
                    best = min(best, (rest[then] + more, KEEP))
                else:
                    best = min(best, (rest[then] + more + COSTS[REROLE], REROLE))
                if role == "s" and s == START:
                    best = min(best, (rest[SYSTEM] + more, KEEP))
            costs.append(best[0])
            edits.append(best[1])
        return self._inserted(costs, edits)

    def best(self, reverse: str) -> tuple[int, str]:
        """(cost, audit) of the signature whose reverse is given."""
        same = 0
        for a, b in zip(reverse, self.reverse):
            if a != b:
                break
            same += 1
        del self.stack[same + 1:]
        for sign in reverse[same:]:
            self.stack.append(self._node(sign, self.stack[-1][0]))
        self.reverse = reverse
        at, state, audit = len(reverse), START, []
        while True:
            edit = self.stack[at][1][state]
            if not edit:
                break
            audit.append(edit)
            if edit == KEEP and state == START and reverse[at - 1].lower() == "s":
                state = SYSTEM
            elif edit != DELETE:
                state = NEXT[state][1]
            at -= edit != INSERT
        return self.stack[-1][0][START], "".join(audit)


def _audited(batches):
    automaton = Automaton()
    for batch in batches:
        reverses = batch.column(0).to_pylist()
        found = [automaton.best(r) for r in reverses]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[::-1] for r in reverses], pa.string()), pa.array([c for c, _ in found], pa.int64()),
            pa.array([a for _, a in found], pa.string())], ["signature", "cost", "audit"])


def audits(signed: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each distinct signature."""
    reverses = signed.select(F.reverse("signature").alias("reverse")).distinct()
    return (reverses.repartitionByRange("reverse").sortWithinPartitions("reverse")
            .mapInArrow(_audited, "signature string, cost long, audit string"))


def repair_plans(turns: DataFrame) -> DataFrame:
    """One row a conversation: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit), kept in the shared folder."""
    ship_code(turns.sparkSession)
    signed = keep(signatures(row_faults(turns)), "signatures")
    return keep(signed.join(audits(signed), "signature").drop("signature"), "repairs")


def _edited(batches):
    """Audits (``head``) and rows of conversations, in order -> the repaired
    turns, each conversation's first row being its head (position null)."""
    names, out, size = ["conv_id", "position", "role", "text"], [], 0
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    conv, audit, at, position, last = None, "", 0, 0, None

    def give(role, text):
        nonlocal size, position, last
        out.append((conv, position, role, text))
        size += len(text)
        position, last = position + 1, role[:1]

    def inserted():
        """Turns that the audit puts in before the next row."""
        nonlocal at
        while at < len(audit) and audit[at] == INSERT:
            give("assistant" if last == "u" else "user", "")
            at += 1

    def flush():
        nonlocal size
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        out.clear()
        size = 0
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for c, is_head, plan, role, text in zip(*(x.to_pylist() for x in batch.columns)):
            if is_head:
                inserted()
                conv, audit, at, position, last = c, plan, 0, 0, None
                out.append((conv, None, None, None))
            else:
                inserted()
                edit = audit[at]
                at += 1
                if edit == KEEP:
                    give(role, text)
                elif edit == REROLE:
                    give("assistant" if last == "u" else "user", text)
            if len(out) >= BATCH_ROWS or size >= BATCH_CHARS:
                yield flush()
    inserted()
    if out:
        yield flush()


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) of the repaired conversations, in order
    within a partition; a row with null position stands before each
    conversation, also one of which nothing is left."""
    ship_code(turns.sparkSession)
    rows = _rows(turns).where("live").select("conv_id", F.lit(False).alias("is_head"), F.lit(None).cast("string").alias("audit"),
                                             "turn", "role", "text")
    heads = plans.select("conv_id", F.lit(True).alias("is_head"), "audit", F.lit(None).cast("long").alias("turn"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    stream = (heads.unionByName(rows).repartition("conv_id")
              .sortWithinPartitions("conv_id", F.desc("is_head"), "turn", "role", "text"))
    return stream.select("conv_id", "is_head", "audit", "role", "text").mapInArrow(
        _edited, "conv_id long, position long, role string, text string")


def _hashed(batches):
    conv, digest = None, None
    for batch in batches:
        done = []
        for c, position, role, text in zip(*(x.to_pylist() for x in batch.columns)):
            if position is None:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
        if done:
            yield _digests(done)
    if digest is not None:
        yield _digests([(conv, digest.hexdigest())])


def _digests(done):
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())],
                                      ["conv_id", "repaired_sha256"])


def repair_digests(turns: DataFrame) -> DataFrame:
    """The plans of all conversations with the digest of the repaired turns
    (``role:text``, joined by newlines)."""
    plans = repair_plans(turns)
    digests = repaired_turns(turns, plans).mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    return plans.join(digests, plans.conv_id.eqNullSafe(digests.conv_id)).drop(digests.conv_id)
