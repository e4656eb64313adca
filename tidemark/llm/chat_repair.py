"""Least-cost repair of conversation structure over a suffix-shared automaton.

Conversations become strings of signs, one per row: the row's role (system, user, assistant
or another) and its first fault (none, truncated, duplicate, blank). They must end up as
``(s?(ua)+)?``. What a repair costs from a row onwards depends only on the signs from there
to the end and on the state of that grammar, so equal endings are one node of an automaton
built from the end (a directed acyclic word graph), and the cost-to-go and the edit that
begins the best audit are found once per node and grammar state for all conversations.

A conversation of any length is spread out. Rows are sorted by ranges of (conversation, turn,
role, digest of the text), numbered, and cut into segments of at most 4,096 rows.
Distinct segments go through the automaton: first for their costs from each state to each
state; one pass over a conversation's segments from the last to the first turns these into
the costs that wait behind each segment; then distinct pairs of segment and costs behind it
give the edits. Copies of a row are counted before they are moved, and only the first row
of equal role and text in a conversation keeps its text. What is left in one task is what
has an order by nature: one row per segment, and the digest of a repaired conversation,
which is streamed and not held.

Defined results: nulls are one space, null ``conv_id`` is a conversation of its own. Rows are
taken by turn, null first, then role, then digest of the text (SHA-256); the order of the input
does not count. Repeated rows are duplicates of each other. A role that begins with none of
s, u, a fits nowhere and is given another or goes; an empty role is such a one. Ties between
cheapest edits go to the ASCII-least audit; each edit and state has one outcome, so the audit
settles the result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stage

# Rows of a segment, as a power of two.
SEGMENT_BITS = 12
# Nodes an automaton holds before it is begun anew.
NODES = 100_000

# Costs of the edits, and what a truncated row adds unless deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK_CHARS = r"\x20\x09-\x0D"

# A sign is SIGNS[4 * role + fault].
ROLES, FAULTS = "sua?", ("none", "truncated", "duplicate", "blank")
SIGNS = "ABCDEFGHIJKLMNOP"

# Grammar states: nothing so far, after s, after u, after a. The next state by role.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
# The role that a rerole or an insert must give in each state.
DUE = "uuau"
NEVER = 1 << 40
END = "end"


class Automaton:
    """Nodes for endings of signatures, with cost-to-go and first edit for each grammar state."""

    def __init__(self) -> None:
        self.begin()

    def begin(self) -> None:
        self.nodes: dict[int, int] = {}
        self.roots: dict[str, int] = {}
        self.signs: list[int] = []
        self.children: list[int] = []
        self.costs: list[list[int]] = []
        self.edits: list[str] = []

    def _add(self, sign: int, child: int, costs: list[int], edits: str) -> int:
        self.signs.append(sign)
        self.children.append(child)
        self.costs.append(costs)
        self.edits.append(edits)
        return len(self.costs) - 1

    def root(self, behind: str) -> int:
        """The node of the empty ending, given the costs behind it: the end itself, or one cost per state."""
        if behind not in self.roots:
            if behind == END:
                # ".": go on; an open s or u needs inserts
                root = self._add(-1, -1, [0, 2 * INSERT, INSERT, 0], ".II.")
            else:
                root = self._add(-1, -1, [int(c) for c in behind.split(",")], "....")
            self.roots[behind] = root
        return self.roots[behind]

    def node(self, signature: str, behind: str) -> int:
        if len(self.costs) > NODES:
            self.begin()
        at = self.root(behind)
        for letter in reversed(signature):
            sign = SIGNS.index(letter)
            key = at * 16 + sign
            found = self.nodes.get(key)
            if found is None:
                found = self.nodes[key] = self._node(sign, at)
            at = found
        return at

    def _node(self, sign: int, child: int) -> int:
        ahead = self.costs[child]
        role, fault = ROLES[sign // 4], FAULTS[sign % 4]
        best = [(ahead[state] + DELETE, "D") for state in range(4)]
        if fault in ("none", "truncated"):
            extra = TRUNCATED if fault == "truncated" else 0
            for state in range(4):
                options = [best[state], (REROLE + extra + ahead[STEP[state][DUE[state]]], "R")]
                if role in STEP[state]:
                    options.append((KEEP + extra + ahead[STEP[state][role]], "K"))
                best[state] = min(options)
        for _ in range(2):  # no more than two inserts in a row can pay
            for state in range(4):
                best[state] = min(best[state], (INSERT + best[STEP[state][DUE[state]]][0], "I"))
        return self._add(sign, child, [min(c, NEVER) for c, _ in best], "".join(e for _, e in best))

    def walk(self, at: int, state: int) -> tuple[str, int]:
        """The best audit from a node in a state, and the state it ends in."""
        audit = []
        while True:
            edit = self.edits[at][state]
            if edit == ".":
                return "".join(audit), state
            audit.append(edit)
            if edit in "IR":
                state = STEP[state][DUE[state]]
            elif edit == "K":
                state = STEP[state][ROLES[self.signs[at] // 4]]
            if edit != "I":
                at = self.children[at]


EXITS = [",".join("0" if s == exit_ else str(NEVER) for s in range(4)) for exit_ in range(4)]


def _by_signature(rows: DataFrame, found, shape: str) -> DataFrame:
    """Run a function of (automaton, signature, costs behind) over rows whose neighbours share endings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            signatures, behinds = batch["signature"].to_pylist(), batch["behind"].to_pylist()
            results = [found(automaton, s, b) for s, b in zip(signatures, behinds)]
            columns = [pa.array([r[i] for r in results], kind) for i, kind in enumerate((pa.list_(pa.string()), pa.list_(pa.int64())))]
            yield pa.record_batch([batch["signature"], batch["behind"], *columns], ["signature", "behind", "audits", "numbers"])

    near = rows.repartitionByRange("behind", F.reverse("signature")).sortWithinPartitions("behind", F.reverse("signature"))
    return near.mapInArrow(run, "signature string, behind string, audits array<string>, numbers array<long>").selectExpr(*shape.split("; "))


def _costs(automaton: Automaton, signature: str, _: str) -> tuple[list[str], list[int]]:
    """Costs from each state (in turn) to each exit state."""
    nodes = [automaton.costs[automaton.node(signature, exit_)] for exit_ in EXITS]
    return [], [nodes[exit_][state] for state in range(4) for exit_ in range(4)]


def _audits(automaton: Automaton, signature: str, behind: str) -> tuple[list[str], list[int]]:
    """The best audit from each state and the state it ends in."""
    node = automaton.node(signature, behind)
    walks = [automaton.walk(node, state) if automaton.costs[node][state] < NEVER else ("", state) for state in range(4)]
    return [audit for audit, _ in walks], [state for _, state in walks]


def damaged(rows: DataFrame) -> DataFrame:
    """The damage that the check plants, by crc32 of ``conv_id:turn``; ``copies`` is 2 for a repeated row."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))), F.lit(20))
    plain = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    return plain.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def signed(rows: DataFrame) -> DataFrame:
    """conv_id, pos, turn, role, text, sign: rows in order, with their place, role and first fault.

    ``rows`` has conv_id, turn, role, text and the number of copies, without nulls in role
    and text. Positions rise within a conversation and have no gaps inside a segment.
    """
    same = ["conv_id", "turn", "role", "digest"]
    distinct = stage(
        rows.groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .withColumn("digest", F.sha2("text", 256)),
        "distinct-turns",
    )
    early = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    first = distinct.groupBy("conv_id", "role", "digest").agg(F.min(early)["turn"].alias("turn")).select(*same, F.lit(True).alias("first"))
    match = [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in same]
    marked = distinct.alias("d").join(first.alias("f"), match, "left").select("d.*", F.coalesce("first", F.lit(False)).alias("first"))
    copies = marked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))

    last = F.regexp_extract("text", rf"([^{BLANK_CHARS}])[{BLANK_CHARS}]*\z", 1)
    seen_first = F.col("first") & (F.col("copy") == 1)
    fault = F.when(last == "", 3).when(~seen_first, 2).when(~last.isin(".", "!", "?"), 1).otherwise(0)
    role = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(F.startswith("role", F.lit("a")), 2).otherwise(3)
    order = ["conv_id", "turn", "role", "digest", "copy"]
    kept = F.when(fault < 2, F.col("text"))
    found = copies.select(*order, kept.alias("text"), F.substring(F.lit(SIGNS), 4 * role + fault + 1, F.lit(1)).alias("sign"))
    sorted_rows = found.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = sorted_rows.select("conv_id", F.monotonically_increasing_id().alias("pos"), "turn", "role", "text", "sign")
    return stage(numbered, "signed-turns")


def segments(rows: DataFrame) -> DataFrame:
    """conv_id, begin, signature: signed rows in segments, begin being the first row's position."""
    signs = F.transform(F.array_sort(F.collect_list(F.struct("pos", "sign"))), lambda r: r["sign"])
    grouped = rows.groupBy("conv_id", F.shiftright("pos", SEGMENT_BITS).alias("segment"))
    return stage(grouped.agg(F.min("pos").alias("begin"), F.array_join(signs, "").alias("signature")).drop("segment"), "segments")


def _runs(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bool, tuple]]:
    """Rows of a partition sorted by conversation, each with whether its conversation begins there."""
    before: list = []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in columns)):
            yield before != [row[0]], row
            before = [row[0]]


def _batches(rows: Iterable[tuple], names: list[str], kinds: list[pa.DataType], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _costs_behind(parts: DataFrame, conv_kind: str) -> DataFrame:
    """Each segment with the costs that wait behind it, least first brought to 0, or ``end`` for a last one."""
    blank = parts.select("signature", F.lit("").alias("behind")).distinct()
    matrices = _by_signature(blank, _costs, "signature; numbers as costs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            ahead: list[int] = []
            for new, (conv, begin, signature, costs) in _runs(noted(), ["conv_id", "begin", "signature", "costs"]):
                least = min(ahead) if not new else 0
                yield conv, begin, signature, END if new else ",".join(str(c - least) for c in ahead)
                if new:
                    ahead = [0, 2 * INSERT, INSERT, 0]
                ahead = [min(costs[4 * s + e] + ahead[e] for e in range(4)) for s in range(4)]

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch["conv_id"].type, pa.int64(), pa.string(), pa.string()]
                yield batch

        yield from _batches(rows(), ["conv_id", "begin", "signature", "behind"], kinds)

    joined = parts.join(matrices, "signature").select("conv_id", "begin", "signature", "costs")
    backwards = joined.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("begin"))
    return stage(backwards.mapInArrow(run, f"conv_id {conv_kind}, begin long, signature string, behind string"), "segments-behind")


def edits(parts: DataFrame) -> DataFrame:
    """conv_id, pos, nth, edit, role: the cheapest edits of every conversation in order.

    An edit of a row has the row's position and nth 2, an insert the position of the row it
    stands before and nth 0 or 1. ``role`` is the first letter of the role it gives.
    """
    conv_kind = parts.schema["conv_id"].dataType.simpleString()
    behind = _costs_behind(parts, conv_kind)
    plans = _by_signature(behind.select("signature", "behind").distinct(), _audits, "signature; behind; audits; numbers as exits")
    planned = behind.join(plans, ["signature", "behind"]).select("conv_id", "begin", "signature", "audits", "exits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch["conv_id"].type, pa.int64(), pa.int32(), pa.string(), pa.string()]
                yield batch

        def rows() -> Iterator[tuple]:
            state = START
            for new, (conv, begin, signature, audits, exits) in _runs(noted(), ["conv_id", "begin", "signature", "audits", "exits"]):
                entry = START if new else state
                state, at, nth = entry, 0, 0
                for edit in audits[entry]:
                    role = None
                    if edit != "D":
                        role = ROLES[SIGNS.index(signature[at]) // 4] if edit == "K" else DUE[state]
                        state = STEP[state][role]
                    if edit == "I":
                        yield conv, begin + at, nth, edit, role
                        nth += 1
                    else:
                        yield conv, begin + at, 2, edit, role
                        at, nth = at + 1, 0
                assert state == exits[entry]

        yield from _batches(rows(), ["conv_id", "pos", "nth", "edit", "role"], kinds)

    forwards = planned.repartition("conv_id").sortWithinPartitions("conv_id", "begin")
    return forwards.mapInArrow(run, f"conv_id {conv_kind}, pos long, nth int, edit string, role string")


def repaired(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id, pos, nth, edit, cost, turn, role, text: every edit with what it leaves; role and text are null where it deletes."""
    steps = edits(parts)
    name = F.when(F.col("step") == "u", "user").otherwise("assistant")
    inserted = steps.where("edit = 'I'").withColumnRenamed("role", "step").select(
        "conv_id", "pos", "nth", "edit", F.lit(INSERT).alias("cost"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        name.alias("role"), F.lit("").alias("text"),
    )
    of_rows = steps.where("edit <> 'I'").select("pos", "nth", "edit", F.col("role").alias("step")).join(rows, "pos")
    gone = F.col("edit") == "D"
    truncated = F.when(F.col("sign").isin(*SIGNS[1::4]), TRUNCATED).otherwise(0)
    cost = F.when(gone, DELETE).when(F.col("edit") == "R", REROLE + truncated).otherwise(KEEP + truncated)
    role = F.when(F.col("edit") == "K", F.col("role")).when(F.col("edit") == "R", name)
    edited = of_rows.select("conv_id", "pos", "nth", "edit", cost.alias("cost"), "turn", role.alias("role"), F.when(~gone, F.col("text")).alias("text"))
    return edited.unionByName(inserted)


def digests(steps: DataFrame) -> DataFrame:
    """conv_id, cost, audit, repaired_sha256: each conversation's edits and result, streamed in order."""
    conv_kind = steps.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "edit", "cost", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch["conv_id"].type, pa.int64(), pa.string(), pa.string()]
                yield batch

        def rows() -> Iterator[tuple]:
            held = None
            for new, (conv, edit, cost, role, text) in _runs(noted(), columns):
                if new:
                    if held:
                        yield held[0], held[1], "".join(held[2]), held[3].hexdigest()
                    held = [conv, 0, [], sha256(), b""]
                held[1] += cost
                held[2].append(edit)
                if edit != "D":
                    held[3].update(held[4] + f"{role}:{text}".encode())
                    held[4] = b"\n"
            if held:
                yield held[0], held[1], "".join(held[2]), held[3].hexdigest()

        yield from _batches(rows(), ["conv_id", "cost", "audit", "repaired_sha256"], kinds, 1000)

    ordered = steps.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "nth").select(*columns)
    return ordered.mapInArrow(run, f"conv_id {conv_kind}, cost long, audit string, repaired_sha256 string")


def faults(parts: DataFrame) -> DataFrame:
    """conv_id and its numbers of blank, duplicate, truncated rows and illegal neighbours."""
    before = F.coalesce(F.lag(F.right("signature", F.lit(1))).over(W.partitionBy("conv_id").orderBy("begin")), F.lit(""))
    roles = F.translate(F.concat("before", "signature"), SIGNS, "".join(r * 4 for r in ROLES))
    legal = F.regexp_count("roles", F.lit("s(?=u)|u(?=a)|a(?=u)"))
    marked = parts.withColumn("before", before).withColumn("roles", roles)
    count = lambda fault: F.sum(F.regexp_count("signature", F.lit(f"[{SIGNS[FAULTS.index(fault) :: 4]}]"))).cast("long").alias(fault)
    return marked.groupBy("conv_id").agg(
        count("blank"), count("duplicate"), count("truncated"), F.sum(F.length("roles") - 1 - legal).cast("long").alias("illegal")
    )


def report(conversations: DataFrame) -> DataFrame:
    """One row per original conversation: its gaps and faults after the damage, the cheapest repair and its digest."""
    left = damaged(conversations)
    rows = signed(left)
    parts = segments(rows)
    turns = rows.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    found = [conversations.select("conv_id").distinct(), gaps, faults(parts), digests(repaired(rows, parts))]
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    merged = whole.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )
    return merged.select("conv_id", *numbers, "audit", "repaired_sha256")
