"""Conversations made to alternate again by the cheapest edits.

Turns are to read (by the initials of their roles) as one of the strings (s?(ua)+)?. Rows that are blank or repeated have
to go; the others are aligned to these strings by Wagner and Fischer's table: keep a row (0; 5 more if it ends without a
mark), give it the role user or assistant (1 and the same), delete it (2), or insert an empty turn (5). The strings of all
lengths share their endings, so one table by rows and letters left, for strings that end in a letter, serves every length
that is feasible. Ukkonen's band bounds it: what a length must cost at least over the rows' least cost (3 for each letter
beyond the sound rows, 2 for each one less) may not be more than the incumbent, the cost of the best alignment found with
a narrower band. Of the lengths of least cost the backtraced audits are compared; the least by letter stays. A backtrace
takes delete before insert before keep or role, so it gives the least audit of its length.

A conversation is cut in blocks of at most BLOCK kinds of rows, so that no task aligns or holds one of any number of rows.
A block's table gives its cost from and to each state of the grammar (nothing yet, after s, u or a); the costs of what
follows come from these few numbers, back from the end; then each block is aligned again with them, from each state, and
the chain of states from the beginning says which alignment holds. An insertion counts to the row that follows it, and to
the last block if none does. Each block's audit has one letter for each of its rows besides insertions and ends in one, so
audits compare as those of the whole conversation do. Most conversations are one block.

Equal rows of one turn are counted before any shuffle and are one kind of row; texts are not in these shuffles. They join
at the end with the rows that stay.

Edge cases: null roles and texts are one space; null turns come first; rows of one turn go by role, then by a hash of role
and text; a null conv_id is a conversation of its own; rows that repeat within a turn are duplicates of the first; an empty
table gives empty ones; a role's initial is its first character as it is (an empty role has none); other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.llm.shared import stash

BLOCK = 512
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
NEVER = float("inf")
BEGIN, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, after an s, after a u, after an a
STATES = (BEGIN, SYSTEM, USER, ASSISTANT)
CLOSING = {BEGIN: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # what is inserted behind the last row
ROLE = {USER: "user", ASSISTANT: "assistant"}
LETTER = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
TURNED = {USER: ASSISTANT, ASSISTANT: USER}


#: Rows that may stay, as letters: s, u, a, or - for another initial; in upper case, or +, those that end without a mark.
CUT_LETTER = {"s": "S", "u": "U", "a": "A", "-": "+"}
CUT_LETTERS = frozenset(CUT_LETTER.values())


def taken(row: str, letter: int) -> int:
    """The cost of a row as this letter, u or a."""
    return (0 if row.lower() == LETTER[letter] else REROLE) + (TRUNCATED if row in CUT_LETTERS else 0)


COSTS = {row: {letter: taken(row, letter) for letter in ROLE} for pair in CUT_LETTER.items() for row in pair}


class Table:
    """Least costs of aligning the rows from i on to r letters in turn, of which `last` is the last; without insertions
    behind the last row. Cells whose excess over the rows' least cost is above `over` at least are left out."""

    def __init__(self, rows: str, last: int, over: float):
        self.rows, self.last = rows, last
        n, sound = len(rows), 0
        self.low, self.cost = [0] * (n + 1), [[] for _ in range(n)] + [[0.0]]
        for i in range(n - 1, -1, -1):
            sound += rows[i] not in CUT_LETTERS
            low, high = max(0, sound - int(over // DELETE)), sound + int(over // (TRUNCATED - DELETE))
            below, base, here, best = self.cost[i + 1], self.low[i + 1], [], NEVER
            as_last, as_other = COSTS[rows[i]][last], COSTS[rows[i]][TURNED[last]]
            for r in range(low, high + 1):
                k = r - base
                best += INSERT
                if 0 <= k < len(below):
                    best = min(best, below[k] + DELETE)
                if r and 0 < k <= len(below):
                    best = min(best, below[k - 1] + (as_last if r % 2 else as_other))
                here.append(best)
            self.low[i], self.cost[i] = low, here

    def at(self, i: int, r: int) -> float:
        k = r - self.low[i]
        return self.cost[i][k] if 0 <= k < len(self.cost[i]) else NEVER

    def lengths(self, i: int, first: int) -> range:
        """The lengths in the band whose first letter is this one."""
        low = max(1, self.low[i])
        odd = first == self.last
        return range(low + ((low % 2 == 1) != odd), self.low[i] + len(self.cost[i]), 2)

    def least(self, i: int, first: int) -> float:
        return min((self.at(i, r) for r in self.lengths(i, first)), default=NEVER)

    def audit(self, i: int, r: int) -> str:
        out = []
        while i < len(self.rows):
            now = self.at(i, r)
            if self.at(i + 1, r) + DELETE == now:
                out.append("D")
                i += 1
            elif r and self.at(i, r - 1) + INSERT == now:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.rows[i].lower() == LETTER[self.last if r % 2 else TURNED[self.last]] else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def openings(rows: str) -> list[tuple[int, int]]:
    """(place, cost) for each row that may be the s at the beginning: those before it go."""
    return [(i, i * DELETE + (TRUNCATED if row == "S" else 0)) for i, row in enumerate(rows) if row in "sS"]


def follows(state: int) -> int:
    return ASSISTANT if state == USER else USER


def least_cost(rows: str) -> int:
    return sum(DELETE for row in rows if row in CUT_LETTERS)


@lru_cache(maxsize=4)
def tables(rows: str, over: float) -> dict[int, Table]:
    return {last: Table(rows, last, over) for last in (USER, ASSISTANT)}


@lru_cache(maxsize=4096)
def crossings(rows: str) -> list[list[float]]:
    """The least cost of these rows from each state to each."""
    n, over = len(rows), 8.0
    while True:
        got, made = [[NEVER] * 4 for _ in STATES], tables(rows, over)
        for state in STATES:
            got[state][state] = float(n * DELETE)
            for last in ROLE:
                got[state][last] = min(got[state][last], made[last].least(0, follows(state)))
        for i, cost in openings(rows):
            got[BEGIN][SYSTEM] = min(got[BEGIN][SYSTEM], cost + (n - i - 1) * DELETE)
            for last in ROLE:
                got[BEGIN][last] = min(got[BEGIN][last], cost + made[last].least(i + 1, USER))
        worst = max(got[state][last] for state in STATES for last in ROLE)
        if not n or worst <= least_cost(rows) + over:
            return got
        over = max(2 * over, worst - least_cost(rows)) if worst < NEVER else 2 * over


@lru_cache(maxsize=16384)
def aligned(rows: str, state: int, after: tuple[float, ...]) -> tuple[float, str]:
    """Cost and audit of these rows from a state on, where `after` is the cost of what follows from each state."""
    n, over, floor = len(rows), 8.0, least_cost(rows) + min(after)
    while True:
        made = tables(rows, over)
        found = [(n * DELETE + after[state], lambda: "D" * n)]
        for last, table in made.items():
            for r in table.lengths(0, follows(state)) if n else ():
                found.append((table.at(0, r) + after[last], lambda table=table, r=r: table.audit(0, r)))
        for i, cost in openings(rows) if state == BEGIN else ():
            ahead = "D" * i + "K"
            found.append((cost + (n - i - 1) * DELETE + after[SYSTEM], lambda ahead=ahead, i=i: ahead + "D" * (n - i - 1)))
            for last, table in made.items():
                for r in table.lengths(i + 1, USER) if i + 1 < n else ():
                    found.append((cost + table.at(i + 1, r) + after[last], lambda ahead=ahead, table=table, i=i, r=r: ahead + table.audit(i + 1, r)))
        incumbent = min(cost for cost, _ in found)
        if incumbent <= floor + over:
            return incumbent, min(audit() for cost, audit in found if cost == incumbent)
        over = incumbent - floor if incumbent < NEVER else 2 * over


def walked(rows: str, state: int, audit: str) -> tuple[int, list[tuple[int, str, int]]]:
    """The state after an audit, and (row, edit, letter) of what stays: row is -1 for what is inserted."""
    i, out = 0, []
    for edit in audit:
        if edit != "D":
            state = SYSTEM if edit == "K" and state == BEGIN and rows[i] in "sS" else follows(state)
            out.append((-1 if edit == "I" else i, edit, state))
        i += edit != "I"
    return state, out


# tables: a row of `kinds` is a kind of row: equal rows of one turn

SHAPE = "c long, known boolean, block long, turns array<long>, roles array<string>, sames array<binary>, counts array<long>, faults array<int>"
SUMS = "n_turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
SOUND, CUT, BLANK, AGAIN = range(4)


def keyed(df: DataFrame) -> DataFrame:
    """Rows with a key of their conversation and turn that is never null, and the hash of role and text."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return rows.select(F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNotNull().alias("known"), "turn", F.coalesce(F.col("turn"), F.lit(0)).alias("t"), F.col("turn").isNotNull().alias("timed"), "role", "text", same.alias("same"))


def kinds_of(rows: DataFrame) -> DataFrame:
    plain = r"[^\x20\x09-\x0D]"
    blank = ~F.col("text").rlike(plain)
    cut = ~blank & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    kinds = rows.select("c", "known", "turn", "t", "timed", "role", "same", blank.alias("blank"), cut.alias("cut"))
    kinds = kinds.groupBy("c", "known", "t", "timed", "same").agg(F.count("*").alias("n"), F.first("turn").alias("turn"), F.first("role").alias("role"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    kinds = stash(kinds, "kinds")
    firsts = kinds.groupBy("c", "known", "same").agg(F.min(F.struct("timed", "t")).alias("first"))
    again = F.struct("timed", "t") > F.col("first")
    return kinds.join(firsts, ["c", "known", "same"]).withColumn("again", again).drop("first")


def illegal(a: str, b: str) -> bool:
    return a[:1] + b[:1] not in ("su", "ua", "au")


def blocks_of(kinds: DataFrame, block: int = BLOCK) -> DataFrame:
    """Kinds of rows in order, a row for each block of a conversation, with its counts and crossings."""
    order = ["known", "c", "timed", "t", "role", "same"]
    sorted_kinds = kinds.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["c", "known", "turn", "role", "same", "n", "blank", "again", "cut"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, out = TaskContext.get().partitionId(), 0, [], []
        schema = pa.schema([("c", pa.int64()), ("known", pa.bool_()), ("block", pa.int64()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("sames", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("faults", pa.list_(pa.int32())),
                            *((f, pa.int64()) for f in ("n_turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal")), ("head", pa.string()), ("tail", pa.string()), ("crossings", pa.list_(pa.float64()))])

        def close() -> None:
            nonlocal made
            if held:
                out.append(summed(held) | {"block": part << 32 | made})
                made += 1
                held.clear()

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in names), strict=True):
                if held and (row[:2] != held[0][:2] or len(held) == block):
                    close()
                held.append(row)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    made = sorted_kinds.select(*names).mapInArrow(pack, f"{SHAPE}, {SUMS}, crossings array<double>")
    return stash(made, "blocks")


def summed(held: list[tuple]) -> dict:
    """A block's row from its kinds of rows."""
    _, _, turns, roles, sames, counts, blank, again, cut = zip(*held, strict=True)
    faults = [BLANK if b else AGAIN if a else CUT if x else SOUND for b, a, x in zip(blank, again, cut, strict=True)]
    known = [t for t in turns if t is not None]
    bad = sum(illegal(a, b) for a, b in zip(roles, roles[1:], strict=False)) + sum(n - 1 for n in counts)
    # of the rows of a kind all but the first repeat it, unless they are blank
    duplicates = sum(0 if f == BLANK else n if f == AGAIN else n - 1 for f, n in zip(faults, counts, strict=True))
    rows = live(roles, faults)
    return {
        "c": held[0][0], "known": held[0][1], "turns": list(turns), "roles": list(roles), "sames": list(sames), "counts": list(counts), "faults": faults,
        "n_turns": len(set(known)), "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
        "blank": sum(n for f, n in zip(faults, counts, strict=True) if f == BLANK), "duplicate": duplicates, "truncated": faults.count(CUT),
        "illegal": bad, "head": roles[0], "tail": roles[-1], "crossings": [x for line in crossings(rows) for x in line],
    }


def live(roles: list[str], faults: list[int]) -> str:
    """The letters of the rows that may stay."""
    letters = ((r[:1] if r[:1] in ("s", "u", "a") else "-", f) for r, f in zip(roles, faults, strict=True) if f <= CUT)
    return "".join(CUT_LETTER[r] if f == CUT else r for r, f in letters)


def streamed(rows: DataFrame, fn, schema: str) -> DataFrame:
    """fn over the blocks of each conversation in order (a list of small rows), a conversation at a time."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["c"], row["known"]) != (held[0]["c"], held[0]["known"]):
                    yield from fn(held)
                    held = []
                held.append(row)
        if held:
            yield from fn(held)

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in run(batches):
            out.append(row)
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return rows.select(*names).repartition("c", "known").sortWithinPartitions("c", "known", "block").mapInArrow(batched, schema)


def costs_behind(held: list[dict]) -> Iterator[dict]:
    """The cost of what follows each block from each state, from the last block back."""
    after, out = [float(len(CLOSING[s]) * INSERT) if s != BEGIN else 0.0 for s in STATES], []
    for k in range(len(held) - 1, -1, -1):
        row = held[k]
        out.append({"c": row["c"], "known": row["known"], "block": row["block"], "place": k, "after": list(after), "closing": k == len(held) - 1})
        cross = row["crossings"]
        after = [min(cross[4 * s + e] + after[e] for e in STATES) for s in STATES]
    yield from reversed(out)


def chained(held: list[dict]) -> Iterator[dict]:
    """The state that each block begins in, how many rows stay before it, and what lies between it and the block before."""
    state, kept, before = BEGIN, 0, None
    turn = None
    for row in held:
        joint = {"illegal": int(before is not None and illegal(before, row["head"])), "same_turn": int(turn is not None and turn == row["first_turn"])}
        yield {"c": row["c"], "known": row["known"], "block": row["block"], "state": state, "kept": kept, **joint}
        kept, state, before = kept + row["stay"][state], row["ends"][state], row["tail"]
        turn = row["last_turn"] if row["last_turn"] is not None else turn


def repair(conversations: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Of conversations (conv_id, turn, role, text): a report (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)
    with a row for each conversation, and the repaired rows (conv_id, nth, role, text)."""
    rows = keyed(conversations)
    blocks = blocks_of(kinds_of(rows), block)
    behind = stash(streamed(blocks.select("c", "known", "block", "crossings"), costs_behind, "c long, known boolean, block long, place long, after array<double>, closing boolean"), "behind")
    keys = ["c", "known", "block"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, ends, stay = [], [], []
            for roles, faults, place, after in zip(*(batch.column(k).to_pylist() for k in ("roles", "faults", "place", "after")), strict=True):
                some = live(roles, faults)
                begins = (BEGIN,) if place == 0 else STATES
                each = {s: aligned(some, s, tuple(after))[1] for s in begins}
                walks = {s: walked(some, s, a) for s, a in each.items()}
                audits.append([each.get(s, "") for s in STATES])
                ends.append([walks[s][0] if s in walks else BEGIN for s in STATES])
                stay.append([len(walks[s][1]) if s in walks else 0 for s in STATES])
            columns = {k: batch.column(k) for k in [*keys, "closing"]} | {"audits": pa.array(audits, pa.list_(pa.string())), "ends": pa.array(ends, pa.list_(pa.int32())), "stay": pa.array(stay, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(columns)

    shapes = blocks.select(*keys, "roles", "faults").join(behind.select(*keys, "place", "after", "closing"), keys)
    audited = stash(shapes.mapInArrow(align, "c long, known boolean, block long, closing boolean, audits array<string>, ends array<int>, stay array<long>"), "audits")
    links = audited.select(*keys, "ends", "stay").join(blocks.select(*keys, "head", "tail", "first_turn", "last_turn"), keys)
    chain = streamed(links, chained, "c long, known boolean, block long, state long, kept long, illegal long, same_turn long")

    stay = pa.struct([("turn", pa.int64()), ("same", pa.binary()), ("role", pa.string()), ("nth", pa.int64())])
    written = pa.schema([("c", pa.int64()), ("known", pa.bool_()), ("block", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("stays", pa.list_(stay)), ("joint_illegal", pa.int64()), ("joint_turn", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = batch.slice(at, 256).to_pylist()
                yield pa.RecordBatch.from_pylist([{k: row.get(k) for k in written.names} | edited(row) for row in rows], written)

    chosen = chain.select(*keys, "state", "kept", F.col("illegal").alias("joint_illegal"), F.col("same_turn").alias("joint_turn"))
    stays = "stays array<struct<turn:long,same:binary,role:string,nth:long>>"
    whole = blocks.select(*keys, "turns", "roles", "sames", "counts", "faults").join(audited.select(*keys, "closing", "audits"), keys).join(chosen, keys)
    edits = stash(whole.mapInArrow(write, f"c long, known boolean, block long, cost long, audit string, {stays}, joint_illegal long, joint_turn long"), "edits")

    sums = blocks.select(*keys, "n_turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal").join(edits.drop("stays"), keys)
    total = lambda c: F.sum(c).alias(c)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda b: b["audit"]), "").alias("audit")
    gaps = F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - (F.sum("n_turns") - F.sum("joint_turn")), F.lit(0)).alias("gaps")
    report = sums.groupBy("c", "known").agg(gaps, total("blank"), total("duplicate"), total("truncated"), F.sum(F.col("illegal") + F.col("joint_illegal")).alias("illegal"), total("cost"), audit)
    report = report.select(F.when(F.col("known"), F.col("c")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    staying = edits.select("c", "known", F.inline("stays"))
    found = staying.where("same is not null").select("c", "known", F.coalesce("turn", F.lit(0)).alias("t"), F.col("turn").isNotNull().alias("timed"), "same", F.col("role").alias("new_role"), "nth")
    texts = rows.select("c", "known", "t", "timed", "same", "role", "text").join(found, ["c", "known", "t", "timed", "same"])
    texts = texts.groupBy("c", "known", "nth").agg(F.first(F.coalesce("new_role", "role")).alias("role"), F.first("text").alias("text"))  # equal rows of a turn
    made = staying.where("same is null").select("c", "known", "nth", "role", F.lit("").alias("text"))
    repaired = texts.unionByName(made).select(F.when(F.col("known"), F.col("c")).alias("conv_id"), "nth", "role", "text")
    return report, repaired


def edited(row: dict) -> dict:
    """A block's cost and audit with the rows that had to go, and what stays: its turn and hash, a new role or null, and
    its place in the conversation from 0."""
    state, faults, counts = row["state"], row["faults"], row["counts"]
    audit = row["audits"][state]
    ended, stay = walked(live(row["roles"], faults), state, audit)
    where = [i for i, f in enumerate(faults) if f <= CUT]
    stays = [{"turn": None if i < 0 else row["turns"][where[i]], "same": None if i < 0 else row["sames"][where[i]], "role": None if edit == "K" else ROLE[letter], "nth": row["kept"] + k} for k, (i, edit, letter) in enumerate(stay)]
    out, cost, at = [], 0, 0
    for fault, n in zip(faults, counts, strict=True):
        if fault > CUT:
            out.append("D" * n)
            cost += n * DELETE
            continue
        begin = at
        while audit[at] == "I":
            at += 1
        edit = audit[at]
        at += 1
        out.append(audit[begin:at] + "D" * (n - 1))
        cost += (at - 1 - begin) * INSERT + (n - 1) * DELETE + {"D": DELETE, "K": 0, "R": REROLE}[edit] + (TRUNCATED if fault == CUT and edit != "D" else 0)
    if row["closing"]:
        for edit in CLOSING[ended]:
            ended = follows(ended)
            stays.append({"turn": None, "same": None, "role": ROLE[ended], "nth": row["kept"] + len(stays)})
            out.append(edit)
            cost += INSERT
    return {"cost": cost, "audit": "".join(out), "stays": stays}


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the hash of role:text lines in order. Rows stream through the hash, so that a
    conversation is never held as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = None, None
        done: list[tuple] = []

        def pop() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names=["conv_id", "repaired_sha256"])
            done.clear()
            return made

        for batch in batches:
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if state is None or conv != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    state, at = sha256(), conv
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(done) > 4096:
                yield pop()
        if state is not None:
            done.append((at, state.hexdigest()))
        yield pop()

    return repaired.repartition("conv_id").sortWithinPartitions("conv_id", "nth").select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def with_empty(conversations: DataFrame, report: DataFrame, digest: DataFrame) -> DataFrame:
    """A row for every conv_id of the first table, zeros and the hash of nothing for those without rows."""
    every = conversations.select(F.col("conv_id").cast("long").alias("e_id")).distinct()
    both = report.join(digest.withColumnRenamed("conv_id", "d_id"), F.col("conv_id").eqNullSafe(F.col("d_id")), "left").drop("d_id").withColumn("there", F.lit(True))
    joined = every.join(both, F.col("e_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("e_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))
