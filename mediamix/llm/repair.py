"""Conversation structure repair over a suffix-shared automaton of signatures.

Rows of a conversation become one sign each: the role's initial as far as the grammar knows
it, whether the row must go, whether it is truncated. The distinct signatures of all
conversations, sorted from the end, form an automaton whose nodes are their distinct
suffixes. A node's cost-to-go and best edit depend on the node and the state of the grammar
only, so they are computed once for each, whatever the number of signatures and
conversations that end so; a signature's audit is read off along its nodes.

The grammar of role initials is ``(s?(ua)+)?``.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamix.llm.common import type_of
from mediamix.session import cut_lineage, release

#: Contract values: cost of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What is no content of a text.
BLANK = " \t\n\x0b\x0c\r"
#: States of the grammar: at the start, after a system row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that can come next by state, and the state after it; a system row can only be kept.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
NEVER = 1 << 60
#: Sign of a row that must go; others are the role's initial (o: another), in capitals if truncated.
GONE = "x"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) after damage by crc32(``conv:turn``) % 20.

    0 drops a row (``gone``: its conversation stays known), 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes it the user's. Nulls are one space, in the key too;
    the conversation's id and the turn stay null.
    """
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv, turn, role, text))
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    new = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(space(text), ".!?", "")).otherwise(space(text))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        conv.alias("conv"), turn.alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(space(role)).alias("role"), new.alias("text"), (kind == 0).alias("gone"), F.explode(times).alias("copy")
    ).drop("copy")


def _fault() -> Column:
    """First fault of a row: b(lank), d(uplicate), t(runcated) or none."""
    content = F.rtrim(F.col("text"), F.lit(BLANK))
    return F.when(content == "", "b").when(F.col("again") > 1, "d").when(~F.right(content, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")


def placed(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, gone) with ``fault`` and ``place`` in their conversation.

    One shuffle by conversation serves both windows.
    """
    dealt = rows.repartition("conv")
    again = F.row_number().over(Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    faulty = dealt.withColumn("again", again).withColumn("fault", _fault())
    order = Window.partitionBy("conv").orderBy("gone", F.col("turn").asc_nulls_first(), "role", "text", "again")
    return faulty.select("conv", "turn", "role", "text", "gone", "fault", F.row_number().over(order).alias("place"))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(new, values): rows of sorted batches, ``new`` where a conversation begins."""
    current, started = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            new = not started or row[0] != current
            current, started = row[0], True
            yield new, row


def summaries(rows: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, gaps, illegal neighbours, and its signature."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal")
    ddl = f"conv {type_of(rows, 'conv')}, {', '.join(f'{n} bigint' for n in names)}, signature string"

    def run(batches):
        kind = None
        done: list[tuple] = []

        def close():
            gaps = int(last - first + 1 - turns) if turns else 0
            done.append((conv, gaps, counts["b"], counts["d"], counts["t"], illegal, signature.decode()))

        def handed():
            arrays = [pa.array([r[0] for r in done], kind), *(pa.array([r[i] for r in done], pa.int64()) for i in range(1, 6)), pa.array([r[6] for r in done], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["conv", *names, "signature"])

        def typed(batches):
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        size = 0
        signature = None
        for new, (key, turn, initial, fault, gone) in _conversations(typed(batches)):
            if new:
                if signature is not None:
                    close()
                    size += len(signature) + 64
                    if size > 1 << 22:
                        yield handed()
                        done, size = [], 0
                conv, signature, before, illegal = key, bytearray(), None, 0
                first = last = None
                turns, counts = 0, {"b": 0, "d": 0, "t": 0, "": 0}
            if gone:
                continue
            if turn is not None and (turns == 0 or turn != last):
                turns, first, last = turns + 1, turn if turns == 0 else first, turn
            counts[fault] += 1
            illegal += before is not None and before + initial not in ("su", "ua", "au")
            before = initial
            sign = GONE if fault in ("b", "d") else initial if initial in ("s", "u", "a") else "o"
            signature += (sign.upper() if fault == "t" else sign).encode()
        if signature is not None:
            close()
            yield handed()

    plain = rows.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "gone", "place")
    dealt = plain.repartition("conv").sortWithinPartitions("conv", "place").drop("place")
    return dealt.mapInArrow(run, ddl)


class Suffixes:
    """Nodes of the suffixes of one signature; equal suffixes of the next one keep theirs."""

    def __init__(self):
        self.signs = ""  # reversed: node n stands for the last n signs
        self.costs, self.edits = array("q"), bytearray()
        self._node([0, NEVER, NEVER, 0], [0, 0, 0, 0])

    def _node(self, costs: list[int], edits: list[int]) -> None:
        """Insertions at the node, then keep it. Of equal costs, the least edit in ASCII."""
        changed = True
        while changed:
            changed = False
            for state in range(4):
                there = costs[NEXT[state][1]] + INSERT
                if (there, ord("I")) < (costs[state], edits[state]) and there < NEVER:
                    costs[state], edits[state], changed = there, ord("I"), True
        self.costs.extend(costs)
        self.edits += bytes(edits)

    def read(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of the signature that ``backwards`` is the reverse of."""
        same = 0
        for a, b in zip(self.signs, backwards):
            if a != b:
                break
            same += 1
        del self.costs[4 * (same + 1) :]
        del self.edits[4 * (same + 1) :]
        for sign in backwards[same:]:
            after = self.costs[-4:]
            costs, edits = [], []
            extra, own = TRUNCATED * sign.isupper(), sign.lower()
            for state in range(4):
                options = [(min(NEVER, after[state] + DELETE), ord("D"))]
                if own != GONE:
                    role, following = NEXT[state]
                    options.append((min(NEVER, after[following] + REROLE + extra), ord("R")))
                    if own == role[0]:
                        options.append((min(NEVER, after[following] + extra), ord("K")))
                    elif own == "s" and state == START:
                        options.append((min(NEVER, after[SYSTEM] + extra), ord("K")))
                cost, edit = min(options)
                costs.append(cost)
                edits.append(edit)
            self._node(costs, edits)
        self.signs = backwards
        return self.costs[4 * len(backwards) + START], self._audit(backwards)

    def _audit(self, backwards: str) -> str:
        node, state, out = len(backwards), START, bytearray()
        while True:
            edit = self.edits[4 * node + state]
            if not edit:
                return out.decode()
            out.append(edit)
            if edit == ord("K") and backwards[node - 1].lower() == "s":
                state = SYSTEM
            elif edit != ord("D"):
                state = NEXT[state][1]
            node -= edit != ord("I")


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct signatures, dealt by ranges of their reverse."""

    def run(batches):
        automaton = Suffixes()
        for batch in batches:
            found = batch.column(0).to_pylist()
            read = [automaton.read(b) for b in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[::-1] for b in found], pa.string()), pa.array([c for c, _ in read], pa.int64()), pa.array([a for _, a in read], pa.string())], names=["signature", "cost", "audit"]
            )

    backwards = signatures.select(F.reverse("signature").alias("backwards")).distinct()
    dealt = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return dealt.mapInArrow(run, "signature string, cost bigint, audit string")


def repaired(rows: DataFrame, solved: DataFrame, with_text: bool = False) -> DataFrame:
    """(conv, repaired_sha256) of the rows after the edits of their conversation's audit.

    The audit comes first in a conversation's sorted rows; texts are hashed as they come.
    With ``with_text`` also ``turns``, the repaired (role, text) rows.
    """
    kind = type_of(rows, "conv")
    ddl = f"conv {kind}, repaired_sha256 string" + ", turns array<struct<role:string,text:string>>" * with_text
    turn_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        arrow = None
        done: list[tuple] = []
        size, hashed, at, state, written = 0, None, 0, START, False
        audit, turns = "", []

        def put(role, text):
            nonlocal written, size
            hashed.update(f"{chr(10) * written}{role}:{text}".encode())
            written = True
            if with_text:
                turns.append({"role": role, "text": text})
                size += len(text)

        def inserted():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                role, state = NEXT[state]
                put(role, "")
                at += 1

        def handed():
            arrays = [pa.array([r[0] for r in done], arrow), pa.array([r[1] for r in done], pa.string())]
            return pa.RecordBatch.from_arrays([*arrays, *([pa.array([r[2] for r in done], turn_type)] if with_text else [])], names=["conv", "repaired_sha256", "turns"][: 2 + with_text])

        def typed(batches):
            nonlocal arrow
            for batch in batches:
                arrow = batch.schema.field(0).type
                yield batch

        for new, (key, given, role, text) in _conversations(typed(batches)):
            if new:
                if hashed is not None:
                    inserted()
                    done.append((conv, hashed.hexdigest(), turns))
                    size += 64
                    if size > 1 << 22:
                        yield handed()
                        done, size = [], 0
                conv, audit, turns = key, given, []
                hashed, at, state, written = hashlib.sha256(), 0, START, False
                continue
            inserted()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                state = SYSTEM
            else:
                other, state = NEXT[state]
                role = role if edit == "K" else other
            put(role, text)
        if hashed is not None:
            inserted()
            done.append((conv, hashed.hexdigest(), turns))
            yield handed()

    nothing = F.lit(None).cast("string")
    heads = solved.select("conv", F.lit(0).alias("place"), "audit", nothing.alias("role"), nothing.alias("text"))
    own = rows.where("NOT gone").select("conv", "place", nothing.alias("audit"), "role", "text")
    dealt = heads.union(own).repartition("conv").sortWithinPartitions("conv", "place").drop("place")
    return dealt.mapInArrow(run, ddl)


def repair(rows: DataFrame, conv: str = "conv_id", with_text: bool = False) -> DataFrame:
    """Faults and cheapest repair of conversations of (conv, turn, role, text, gone) rows.

    A row's first fault counts: blank (nothing but white space), duplicate (role and text
    seen earlier in the conversation), truncated (does not end in ``.``, ``!`` or ``?``).
    Blank and duplicate rows must be deleted. Returns one row per conversation: ``conv``,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, and with
    ``with_text`` the repaired ``turns``.

    Rows are ordered by turn, nulls first, then by role and text; rows that agree in all of
    them are duplicates of the first. Roles other than those the grammar knows by their
    initial can only be changed or deleted. A null id is a conversation of its own. A
    conversation whose rows are all ``gone``, or all deleted, has an empty repair, whose
    hash is that of an empty string. An empty table gives no rows. A conversation is read by
    one task as a stream: it holds one sign and one edit a row, no texts.
    """
    table = cut_lineage(placed(rows))
    summed = cut_lineage(summaries(table))
    solved = cut_lineage(summed.join(audits(summed.select("signature")), "signature"))
    ends = repaired(table, solved, with_text)
    out = solved.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    joined = cut_lineage(out.alias("a").join(ends.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv"))).select("a.*", "b.repaired_sha256", *(["b.turns"] * with_text)))
    release(table, summed, solved)
    return joined.withColumnRenamed("conv", conv)


def damage_and_repair(conversations: DataFrame, conv: str = "conv_id", with_text: bool = False) -> DataFrame:
    """``repair`` of the ``damaged`` table: every conversation of it, whatever was dropped."""
    return repair(damaged(conversations, conv), conv, with_text)
