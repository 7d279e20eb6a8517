"""Cheapest repairs of conversations: bidirectional Dijkstra over the edit lattice.

A node of the lattice is a number of rows dealt with and the state of the pattern
``(s?(ua)+)?`` of role initials; an edge keeps, reroles or deletes a row, or inserts one. A forward
heap from the start and a reverse heap from both accepting ends run until their least costs
together exceed the cheapest crossing, so that every crossing of that cost is known. A walk
that prefers letters in ASCII order over all these paths then spells the least audit, which
is the least of all concatenations, without storing any of them.

Spark sorts the rows of a conversation; tasks see them one after another and hold some
numbers a row, never the texts.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundsift.llm.common import stage

#: Prices of the edits, and what an undeleted truncated row costs besides.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States of the pattern: nothing yet, after a system row, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ROLES = {USER: "user", ASSISTANT: "assistant"}

#: Faults of a row, the first that holds, and rows that are not there.
SOUND, BLANK, DUPLICATE, CUT, GONE = range(5)

_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_NEVER = (1 << 31) - 1

WHITE = " \t\n\x0b\x0c\r"


def follows(state: int) -> int:
    """What must come after ``state``, unless it is a system row at the start."""
    return ASSISTANT if state == USER else USER


class Lattice:
    """The edits of one conversation, given the initial and the fault of each row."""

    def __init__(self, initials: bytes, faults: bytes):
        self.initials, self.faults, self.n = initials, faults, len(initials)

    def edges(self, node: int) -> list[tuple[str, int, int]]:
        """Letter, cost and target of each edge from a node, in ASCII order."""
        row, state = divmod(node, STATES)
        after = follows(state)
        insert = ("I", INSERT, row * STATES + after)
        if row == self.n:
            return [insert]
        down = (row + 1) * STATES
        found = [("D", DELETE, down + state), insert]
        if (fault := self.faults[row]) in (SOUND, CUT):
            more = TRUNCATED * (fault == CUT)
            initial = self.initials[row]
            if initial == after or initial == SYSTEM and state == START:
                found.append(("K", KEEP + more, down + initial))
            found.append(("R", REROLE + more, down + after))
        return found

    def back(self, node: int) -> list[tuple[int, int]]:
        """Cost and source of each edge to a node."""
        row, state = divmod(node, STATES)
        before = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}.get(state, ())
        found = [(INSERT, row * STATES + b) for b in before]
        if not row:
            return found
        up = (row - 1) * STATES
        found.append((DELETE, up + state))
        if (fault := self.faults[row - 1]) in (SOUND, CUT):
            more = TRUNCATED * (fault == CUT)
            cost = KEEP if self.initials[row - 1] == state else REROLE
            found += [(cost + more, up + b) for b in before]
            if state == SYSTEM and self.initials[row - 1] == SYSTEM:
                found.append((KEEP + more, up + START))
        return found

    def cheapest(self) -> tuple[int, str]:
        """The least cost, and the least audit of that cost in ASCII order."""
        size = STATES * (self.n + 1)
        ahead, behind = array("i", [_NEVER]) * size, array("i", [_NEVER]) * size
        forward, reverse = [(0, START)], []
        ahead[START] = 0
        best = _NEVER
        for end in (START, ASSISTANT):
            node = STATES * self.n + end
            behind[node] = 0
            heappush(reverse, (0, node))
            if ahead[node] == 0:
                best = 0
        while True:
            low, high = forward[0][0] if forward else math.inf, reverse[0][0] if reverse else math.inf
            if low + high > best or low == high == math.inf:
                break
            near, far, heap = (ahead, behind, forward) if low <= high else (behind, ahead, reverse)
            cost, node = heappop(heap)
            if cost > near[node]:
                continue
            steps = [(c, t) for _, c, t in self.edges(node)] if heap is forward else self.back(node)
            for price, target in steps:
                if (found := cost + price) < near[target]:
                    near[target] = found
                    heappush(heap, (found, target))
                    if far[target] != _NEVER and found + far[target] < best:
                        best = found + far[target]
        return best, self._least_audit(best, ahead, behind, low, high)

    def _least_audit(self, best: int, ahead: array, behind: array, low: float, high: float) -> str:
        """``ahead`` is final below ``low``, ``behind`` below ``high``; every cheapest path crosses over."""
        good = bytearray(len(ahead))  # nodes final ahead that lie on a cheapest path
        ends = [STATES * self.n + end for end in (START, ASSISTANT)]
        todo = [end for end in ends if ahead[end] == best and best < low]
        for end in todo:
            good[end] = 1
        for node, cost in enumerate(ahead):
            if cost < low and not good[node] and any(behind[t] < high and cost + c + behind[t] == best for _, c, t in self.edges(node)):
                good[node] = 1
                todo.append(node)
        while todo:
            node = todo.pop()
            for price, source in self.back(node):
                if not good[source] and ahead[source] < low and ahead[source] + price == ahead[node]:
                    good[source] = 1
                    todo.append(source)
        letters, node, paid = bytearray(), START, 0
        while paid < best or node // STATES < self.n:
            for letter, price, target in self.edges(node):
                known = behind[target] < high and paid + price + behind[target] == best
                if known or good[target] and ahead[target] == paid + price:
                    break
            letters += letter.encode()
            node, paid = target, paid + price
        return letters.decode()


_SOLVED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = [f.split()[0] for f in _SOLVED.split(", ")][:-1]


class _Conversation:
    """Counts and lattice of one conversation, whose rows are added in order."""

    def __init__(self):
        self.initials, self.faults = bytearray(), bytearray()
        self.counts = [0] * 5
        self.illegal = self.turns = 0
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if fault == GONE:
            return
        code = _INITIALS.get(initial, 0)
        if self.initials and (self.initials[-1], code) not in _LEGAL:
            self.illegal += 1
        self.initials.append(code)
        self.faults.append(fault)
        self.counts[fault] += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1

    def solved(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = Lattice(bytes(self.initials), bytes(self.faults)).cheapest()
        return (gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, cost, audit)


def _record(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, initial, fault) in order of their conversations and places."""
    names = ["conv_id", *_COUNTS, "audit"]
    kinds = [pa.int64()] * 7 + [pa.string()]
    now, open_one = None, None
    for batch in batches:
        done = []
        columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "initial", "fault")]
        for conv_id, turn, initial, fault in zip(*columns, strict=True):
            if open_one is None or conv_id != now:
                if open_one:
                    done.append((now, *open_one.solved()))
                now, open_one = conv_id, _Conversation()
            open_one.add(turn, initial, fault)
        yield _record(done, names, kinds)
    if open_one:
        yield _record([(now, *open_one.solved())], names, kinds)


class _Repaired:
    """Digest of one repaired conversation, whose rows pass by in order."""

    def __init__(self, solved: tuple):
        self.solved, self.audit, self.at = solved, solved[-1], 0
        self.state, self.digest, self.empty = START, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        line = role + ":" + text if self.empty else "\n" + role + ":" + text
        self.digest.update(line.encode("utf-8", "surrogatepass"))
        self.empty = False

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = follows(self.state)
            self._put(ROLES[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = _INITIALS[role[:1]]
            self._put(role, text)
        elif letter == "R":
            self.state = follows(self.state)
            self._put(ROLES[self.state], text)

    def end(self) -> tuple:
        self._inserts()
        return (*self.solved, self.digest.hexdigest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's solution (place 0), then its rows."""
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    now = None
    for batch in batches:
        done = []
        solutions = zip(*(batch[c].to_pylist() for c in ["conv_id", *_COUNTS, "audit"]), strict=True)
        for place, solution, role, text in zip(batch["place"].to_pylist(), solutions, batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if place == 0:
                if now:
                    done.append(now.end())
                now = _Repaired(solution)
            else:
                now.row(role, text)
        yield _record(done, names, kinds)
    if now:
        yield _record([now.end()], names, kinds)


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, place (from 1), role, text, fault of rows with columns conv_id, turn, order, role, text, gone.

    ``order`` breaks ties between equal turns; rows that are ``gone`` only tell that their conversation exists.
    """
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "order")
    digest = F.when(~F.col("gone"), F.sha2("text", 256))
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn("digest", digest)
    same = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy("place")
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    fault = (
        F.when(F.col("gone"), GONE)
        .when(end == "", BLANK)
        .when(F.col("seen") > 1, DUPLICATE)
        .when(~end.isin(".", "!", "?"), CUT)
        .otherwise(SOUND)
    )
    rows = rows.withColumn("seen", F.row_number().over(same))
    return rows.select("conv_id", "turn", "place", "role", "text", fault.alias("fault"))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``judged`` rows, with the cheapest repair and its digest.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Any
    number of rows may belong to one conversation, null ids among them: the search holds about 12 bytes a
    row besides its heaps, and the digest is taken while the sorted rows stream by.
    """
    rows = stage(rows, "judged")
    places = rows.select("conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"), "fault")
    places = places.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    solved = stage(places.mapInArrow(_solve, "conv_id long, " + _SOLVED), "solved")
    heads = solved.withColumn("place", F.lit(0))
    lines = rows.filter(F.col("fault") != GONE).select("conv_id", "place", "role", "text")
    every = heads.unionByName(lines, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return every.mapInArrow(_digests, f"conv_id long, {_SOLVED}, repaired_sha256 string")


def as_rows(conversations: DataFrame, damage: Column | None = None) -> DataFrame:
    """``judged`` rows of a table conv_id, turn, role, text.

    Null roles and texts are one space. Equal turns go by role, then by digest of the text.
    ``damage``, a number over conv_id and turn, drops a row (0), empties its text (1), removes
    its sentence ends (2), repeats it (3) or makes it a user row (4).
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    what = F.lit(-1) if damage is None else damage
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), what.alias("damage"))
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("order", F.struct("role", F.sha2("text", 256))).withColumn("copy", F.explode(copies))
    changed = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return judged(
        rows.select(
            "conv_id",
            "turn",
            F.struct("order", "copy").alias("order"),
            F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
            changed.alias("text"),
            (F.col("damage") == 0).alias("gone"),
        )
    )


def repair_conversations(conversations: DataFrame, damage: Column | None = None) -> DataFrame:
    """Faults and cheapest repair of each conversation (conv_id, turn, role, text), after ``damage`` if given.

    See ``as_rows`` for nulls and ties and ``repair`` for the columns. A row's first fault counts: blank,
    duplicate (role and text seen earlier), truncated. Conversations whose rows are all dropped, have
    zeros, an empty audit and the digest of nothing. Rows without conv_id are one conversation. An empty
    table gives no rows; other columns are ignored.
    """
    return repair(as_rows(conversations, damage))
