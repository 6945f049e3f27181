"""Conversation structure repair by a generalised LR parse of the role grammar.

The grammar says which sequences of role initials a conversation may have.  Its
LR table is built from the productions (``RoleParser``).  A parse keeps a
graph-structured stack: a stack is a node (state, node below), equal nodes are
one, so stacks share what they have in common.  Every turn offers weighted
actions to every top of the stack: keep it, rerole it, delete it, and insert
turns before it.  Tops that become equal are merged by the minimum of
(cost, audit), where the audit is the string of the actions' initials.  Of equal
costs no audit begins with another (more letters would be more inserts, which
cost), so the merge stays right whatever follows.

Scale.  Turns are sorted by range of (conversation, turn, role, text), so a
conversation of any length lies over as many tasks as it needs, and parsed in
segments of at most ``SEGMENT`` turns.  A segment that begins inside a
conversation is parsed from every possible stack, which are few, as the grammar
is left-recursive.  Its table (stack before, stack after, cost, audit) is what a
fold over the conversation's segments needs; the fold, in order in one task, reads
no turns and holds some bytes for each.  The chosen edits are joined back to the
turns.  Equal turns are one row with a number from the start, so repeated rows
are combined before they move.

Faults: ``blank`` (no character but ASCII white space), ``duplicate`` (role and
text seen earlier in the conversation), ``truncated`` (the last such character is
not one of . ! ?); the first that holds counts.  Blank and duplicate turns must be
deleted, truncated ones cost ``TRUNCATED`` unless deleted.

Defined cases: a null role or text is one space; a null conversation id is a
conversation of its own; null turn numbers come first and count for no gap; equal
turn numbers are ordered by role and text.  A role is known by its first
character; one that the grammar does not know can only be reroled or deleted, an
empty one likewise.  Texts of any length pass through whole.  An empty table gives
empty results.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from cohortlake.llm.common import stored

#: An optional system turn, then pairs of user and assistant; or nothing.
GRAMMAR = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "ua"), ("T", "Tua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 2, 2, 3, 1
SEGMENT = 512
#: Stacks that a grammar may have; more means that it nests.
MAX_STACKS = 256
END = "$"


class RoleParser:
    """LR table of a grammar, and the graph of its stacks; nodes are numbers, 0 is the empty stack."""

    def __init__(self, grammar=GRAMMAR):
        self.rules = (("", grammar[0][0]), *grammar)
        heads = {head for head, _ in grammar}
        self.symbols = sorted({x for _, body in self.rules for x in body})
        self.terminals = [x for x in self.symbols if x not in heads]
        self._follow(heads)
        self.states, self.goto = [self._closure({(0, 0)})], {}
        for state in self.states:
            for x in self.symbols:
                moved = self._closure({(r, d + 1) for r, d in state if self.rules[r][1][d : d + 1] == x})
                if moved:
                    if moved not in self.states:
                        self.states.append(moved)
                    self.goto[self.states.index(state), x] = self.states.index(moved)
        self.nodes, self.numbers = [(0, None)], {(0, None): 0}
        self.shifts, self.insertions, self.moves = {}, {}, {}
        for node in range(MAX_STACKS):
            if node == len(self.nodes):
                self.stacks = range(node)
                return
            for x in self.terminals:
                self.shifted(node, x)
        raise ValueError("the grammar has stacks without bound; write it left-recursive")

    def _closure(self, items: set) -> frozenset:
        todo = list(items)
        for r, d in todo:
            ahead = self.rules[r][1][d : d + 1]
            new = [(i, 0) for i, (head, _) in enumerate(self.rules) if head and head == ahead and (i, 0) not in items]
            items |= set(new)
            todo += new
        return frozenset(items)

    def _follow(self, heads: set) -> None:
        empty, first, self.follow = set(), {h: set() for h in heads}, {h: set() for h in heads | {""}}
        self.follow[""].add(END)
        for _ in range(len(self.rules) ** 2 + 1):  # more passes than facts can take to travel
            for head, body in self.rules:
                ahead = set(self.follow[head])
                for x in reversed(body):
                    if x in heads:
                        self.follow[x] |= ahead
                        ahead = first[x] | (ahead if x in empty else set())
                    else:
                        ahead = {x}
                if head:
                    for x in body:
                        first[head] |= first[x] if x in heads else {x}
                        if x not in empty:
                            break
                    else:
                        empty.add(head)

    def _push(self, state: int, below: int) -> int:
        """The node of ``state`` over ``below``; a state with one finished rule is reduced at once."""
        (rule, dot), *more = self.states[state]
        head, body = self.rules[rule]
        if head and not more and dot == len(body) and body:
            return self._reduce(below, len(body) - 1, head)
        if (state, below) not in self.numbers:
            self.numbers[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.numbers[state, below]

    def _reduce(self, node: int, pops: int, head: str) -> int:
        for _ in range(pops):
            node = self.nodes[node][1]
        return self._push(self.goto[self.nodes[node][0], head], node)

    def reduced(self, node: int, ahead: str) -> list[int]:
        """``node`` and the stacks that reductions make of it before ``ahead``."""
        out = [node]
        for at in out:
            for r, d in self.states[self.nodes[at][0]]:
                head, body = self.rules[r]
                if head and d == len(body) and ahead in self.follow[head]:
                    out += [n for n in [self._reduce(at, len(body), head)] if n not in out]
        return out

    def shifted(self, node: int, x: str) -> list[int]:
        """The stacks after terminal ``x``."""
        if (node, x) not in self.shifts:
            tops = [n for n in self.reduced(node, x) if (self.nodes[n][0], x) in self.goto]
            self.shifts[node, x] = sorted({self._push(self.goto[self.nodes[n][0], x], n) for n in tops})
        return self.shifts[node, x]

    def accepts(self, node: int) -> bool:
        return any((0, 1) in self.states[self.nodes[n][0]] for n in self.reduced(node, END))

    def inserts(self, node: int) -> list[tuple[str, int]]:
        """(inserted initials, stack after them) that lead to each stack in the fewest inserts."""
        if node not in self.insertions:
            found = {node: ""}
            for at in (queue := [node]):
                for x in ROLES:
                    for n in self.shifted(at, x):
                        if n not in found:
                            found[n] = found[at] + x
                            queue.append(n)
            self.insertions[node] = [(letters, n) for n, letters in found.items()]
        return self.insertions[node]

    def actions(self, node: int, initial: str) -> list[tuple[int, str, str, int]]:
        """(cost, audit, roles, stack after) of keeping or reroling a turn, inserts before it included."""
        if (node, initial) not in self.moves:
            made = []
            for letters, n in self.inserts(node):
                audit, cost = "I" * len(letters), INSERT * len(letters)
                made += [(cost + KEEP, audit + "K", letters + initial, t) for t in (self.shifted(n, initial) if initial in self.terminals else ())]
                made += [(cost + REROLE, audit + "R", letters + x, t) for x in ROLES for t in self.shifted(n, x)]
            self.moves[node, initial] = made
        return self.moves[node, initial]

    def step(self, tops: dict, initial: str, n: int, doomed: bool, truncated: bool) -> dict:
        """The tops after ``n`` equal turns; a top is stack -> (cost, audit, audit by turn, roles by turn)."""
        out: dict = {}

        def offer(node, top):
            if node not in out or top[:2] < out[node][:2]:
                out[node] = top

        for node, (cost, audit, by_turn, roles) in tops.items():
            offer(node, (cost + DELETE * n, audit + "D" * n, by_turn + " " + "D" * n, roles + " " + "-" * n))
            if not doomed:
                more, dashes = "D" * (n - 1), "-" * (n - 1)
                for c, a, r, to in self.actions(node, initial):
                    offer(to, (cost + c + DELETE * (n - 1) + (TRUNCATED if truncated else 0), audit + a + more, by_turn + " " + a + more, roles + " " + r + dashes))
        return out


# ------------------------------------------------------------------ faults
NULL = " "
PRINTED = r"[^\x20\x09-\x0D]"
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _turns(turns: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, role, text) with their number ``n`` and faults."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NULL)).alias(c)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role"), said("text"))
    rows = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")), "repair-turns")
    # A text said twice in a conversation, and where first; few, so only these meet the turns again.
    again = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(
        F.count(F.lit(1)).alias("times"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unnumbered"))
    again = stored(again.where("times > 1").drop("times"), "repair-again").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "digest", "first", "unnumbered")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.sha2("text", 256) == F.col("digest"))
    blank = ~F.col("text").rlike(PRINTED)
    seen = F.coalesce(F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("first"))), F.lit(False))
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, 0).when(seen, 1).when(cut, 2).otherwise(3)
    return rows.join(again, same, "left").select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


# ------------------------------------------------------------------ segments
_L, _I, _S = LongType(), IntegerType(), StringType()
TABLE = ArrayType(StructType([StructField("start", _I), StructField("end", _I), StructField("cost", _L), StructField("audit", _S), StructField("roles", _S)]))
SUMMARY = StructType([
    *[StructField(c, _L) for c in COUNTS], StructField("first", _S), StructField("last", _S), StructField("low", _L), StructField("high", _L),
    StructField("turns", _L), StructField("first_turn", _L), StructField("last_turn", _L), StructField("table", TABLE),
])
REPORT = StructType([*[StructField(c, _L) for c in ("gaps", *COUNTS, "cost")], StructField("audit", _S)])


class Segment:
    """What a run of turns does to every stack that may lie before it."""

    def __init__(self, parser: RoleParser, conv, number: int, starts):
        self.parser, self.conv, self.number, self.rows = parser, conv, number, 0
        self.tops = {s: {s: (0, "", "", "")} for s in starts}
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.last = self.low = self.high = self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, role: str, n: int, fault: int) -> None:
        x = role[:1]
        c = self.counts
        c["illegal"] += n - 1 + (self.rows > 0 and self.last + x not in LEGAL)
        c["blank"] += n if fault == 0 else 0
        c["duplicate"] += (n - (fault > 1)) if fault else 0
        c["truncated"] += fault == 2
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.first, self.first_turn = (self.first, self.first_turn) if self.rows else (x, turn)
        self.last, self.last_turn, self.rows = x, turn, self.rows + 1
        self.tops = {s: self.parser.step(tops, x, n, fault < 2, fault == 2) for s, tops in self.tops.items()}

    def summary(self) -> dict:
        table = [{"start": s, "end": e, "cost": t[0], "audit": t[2][1:], "roles": t[3][1:]} for s, tops in self.tops.items() for e, t in tops.items()]
        names = ("first", "last", "low", "high", "turns", "first_turn", "last_turn")
        return {**self.counts, **{k: getattr(self, k) for k in names}, "table": table}


def _segments(rows: DataFrame, parser: RoleParser, limit: int) -> DataFrame:
    """The sorted turns with (part, segment, i), and a row with i = -1 and the summary for each segment; a written table."""
    conv = rows.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", conv), StructField("part", _I), StructField("segment", _I), StructField("i", _I), StructField("role", _S), StructField("text", _S), StructField("summary", SUMMARY)])

    def run(batches):
        held, closed, part = None, [], None

        def summaries():
            made = [{"conv_id": s.conv, "part": part, "segment": s.number, "i": -1, "role": None, "text": None, "summary": s.summary()} for s in closed]
            closed.clear()
            return pa.RecordBatch.from_pylist(made, schema=schema_arrow)

        for batch in batches:
            got = batch.to_pydict()
            segments, places = [], []
            for conv_id, turn, role, n, fault, part in zip(*(got[c] for c in ("conv_id", "turn", "role", "n", "fault", "part"))):
                if held is None or held.conv != conv_id or held.rows >= limit:
                    inside = held is None or held.conv == conv_id
                    if held:
                        closed.append(held)
                    number = held.number + 1 if held else 0
                    # A task's first turns and a later segment may have any stack below them.
                    held = Segment(parser, conv_id, number, parser.stacks if inside else (0,))
                segments.append(held.number)
                places.append(held.rows)
                held.add(turn, role, n, fault)
            columns = [batch.column("conv_id"), batch.column("part"), pa.array(segments, pa.int32()), pa.array(places, pa.int32()), batch.column("role"), batch.column("text")]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(batch.num_rows, schema_arrow.field("summary").type)], schema=schema_arrow)
            if closed:
                yield summaries()
        if held:
            closed.append(held)
            yield summaries()

    schema_arrow = to_arrow_schema(schema)
    order = ("conv_id", "turn", "role", "text")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return stored(dealt.mapInArrow(run, schema), "repair-segments")


# ------------------------------------------------------------------ fold
class Fold:
    """The cheapest parse of a conversation from the tables of its segments, in order."""

    def __init__(self, parser: RoleParser):
        self.parser = parser
        self.tops = {0: (0, "", None)}  # stack -> (cost, audit since the settled part, its last link)
        self.settled: list = []  # chosen (place, audit by turn, roles by turn)
        self.audit: list = []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.turns, self.low, self.high, self.last, self.last_turn = 0, None, None, None, None

    def add(self, place, s: dict) -> None:
        for k in COUNTS:
            self.counts[k] += s[k]
        self.counts["illegal"] += self.last is not None and self.last + s["first"] not in LEGAL
        self.turns += s["turns"] - (s["first_turn"] is not None and s["first_turn"] == self.last_turn)
        self.low = s["low"] if self.low is None else self.low
        self.high = s["high"] if s["high"] is not None else self.high
        self.last, self.last_turn = s["last"], s["last_turn"]
        tops: dict = {}
        for row in s["table"]:
            if row["start"] in self.tops:
                cost, audit, link = self.tops[row["start"]]
                made = (cost + row["cost"], audit + row["audit"].replace(" ", ""), (link, row["start"], place, row["audit"], row["roles"]))
                if row["end"] not in tops or made[:2] < tops[row["end"]][:2]:
                    tops[row["end"]] = made
        before = {top[2][1] for top in tops.values()}
        if len(before) == 1:  # every parse goes through one stack: what lies before it is settled
            _, audit, link = self.tops[before.pop()]
            self._settle(audit, link)
            tops = {n: (cost, a[len(audit) :], (None, *l[1:])) for n, (cost, a, l) in tops.items()}
        self.tops = tops

    def _settle(self, audit: str, link) -> None:
        chain = []
        while link:
            link, _, *pick = link
            chain.append(pick)
        self.settled += reversed(chain)
        self.audit.append(audit)

    def result(self) -> tuple[dict, list]:
        """(report, (place, audit by turn, roles by turn) of each segment); inserts at the end are a turn more of the last."""
        ends = [(cost + INSERT * len(x), audit + "I" * len(x), x, link) for node, (cost, audit, link) in self.tops.items() for x, to in self.parser.inserts(node) if self.parser.accepts(to)]
        cost, audit, inserted, link = min(ends, key=lambda e: e[:2])
        self._settle(audit, link)
        if inserted:
            self.settled[-1][1] += " " + "I" * len(inserted)
            self.settled[-1][2] += " " + inserted
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": "".join(self.audit)}, self.settled


def _folded(segments: DataFrame, parser: RoleParser) -> DataFrame:
    """(conv_id, part, segment, edits) of every segment, and (conv_id, report) of every conversation; a written table."""
    edits = ArrayType(StructType([StructField("audit", _S), StructField("roles", _S)]))
    conv = segments.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", conv), StructField("part", _I), StructField("segment", _I), StructField("edits", edits), StructField("report", REPORT)])

    def run(batches):
        fold, at = None, None

        def done():
            report, picks = fold.result()
            rows = [{"conv_id": at, "part": p, "segment": s, "edits": [{"audit": a, "roles": r} for a, r in zip(audit.split(" "), roles.split(" "))]} for (p, s), audit, roles in picks]
            return pa.RecordBatch.from_pylist([*rows, {"conv_id": at, "report": report}], schema=schema_arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if fold is None or row["conv_id"] != at:
                    if fold:
                        yield done()
                    fold, at = Fold(parser), row["conv_id"]
                fold.add((row["part"], row["segment"]), row["summary"])
        if fold:
            yield done()

    schema_arrow = to_arrow_schema(schema)
    order = ("conv_id", "part", "segment")
    dealt = segments.where("i < 0").select(*order, "summary").repartition("conv_id").sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(run, schema), "repair-edits")


# ------------------------------------------------------------------ results
@dataclass(frozen=True)
class Repair:
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; of conversations with turns.
    report: DataFrame
    #: conv_id, part, segment, i, j, role, text: the repaired turns; in a conversation they stand by (part, segment, i, j).
    turns: DataFrame


def repair_conversations(turns: DataFrame, segment: int = SEGMENT, grammar=GRAMMAR) -> Repair:
    """Faults, cheapest edits and repaired turns of (conv_id, turn, role, text)."""
    parser = RoleParser(grammar)
    segments = _segments(_turns(turns), parser, segment)
    folded = _folded(segments, parser)
    edits = folded.where("report IS NULL").select("conv_id", "part", "segment", F.posexplode("edits").alias("i", "edit")).select("conv_id", "part", "segment", "i", "edit.*")
    rows = segments.where("i >= 0").select("part", "segment", "i", F.col("role").alias("own_role"), "text")
    made = edits.join(rows, ["part", "segment", "i"], "left")
    # A turn's edits: inserts, then what becomes of the turn, then deleted copies.
    letters = F.filter(F.sequence(F.lit(1), F.length("audit")), lambda k: F.substring("audit", k, F.lit(1)) != "D")

    def turn(k: Column) -> Column:
        letter, initial = F.substring("audit", k, F.lit(1)), F.substring("roles", k, F.lit(1))
        named = F.coalesce(*[F.when(initial == x, F.lit(name)) for x, name in ROLES.items()])
        return F.struct(F.when(letter == "K", F.col("own_role")).otherwise(named).alias("role"), F.when(letter == "I", F.lit("")).otherwise(F.col("text")).alias("text"))

    out = made.select("conv_id", "part", "segment", "i", F.posexplode(F.transform(letters, turn)).alias("j", "turn"))
    return Repair(folded.where("report IS NOT NULL").select("conv_id", "report.*"), out.select("conv_id", "part", "segment", "i", "j", "turn.*"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the ``role:text`` of repaired turns, joined by newlines; in order, so a conversation is one task's work."""
    order = ("conv_id", "part", "segment", "i", "j")
    conv = turns.schema["conv_id"]
    schema = StructType([StructField("conv_id", conv.dataType), StructField("sha256", _S)])

    def run(batches):
        at, state = None, None
        for batch in batches:
            made = {"conv_id": [], "sha256": []}
            for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").cast(pa.large_binary()).to_pylist()):
                if state is not None and conv_id == at:
                    state.update(b"\n")
                else:
                    if state is not None:
                        made["conv_id"].append(at)
                        made["sha256"].append(state.hexdigest())
                    at, state = conv_id, hashlib.sha256()
                state.update(line)
            yield pa.RecordBatch.from_pydict(made, schema=schema_arrow)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"conv_id": [at], "sha256": [state.hexdigest()]}, schema=schema_arrow)

    schema_arrow = to_arrow_schema(schema)
    lines = turns.select(*order, F.concat("role", F.lit(":"), "text").alias("line")).repartition("conv_id").sortWithinPartitions(*order)
    return lines.select("conv_id", "line").mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with faults by the crc32 of ``conv_id:turn``, for trials: 1 of 20 dropped, 1 emptied, 1 cut short, 1 repeated, 1 as user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NULL))
    kind = F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    made = turns.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(said("role")).alias("role"), text.alias("text"), kind.alias("kind"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return made.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), times)).alias("_")).drop("_")
