"""Repair of conversation structure by survivor-coalescence Viterbi (operator 12).

A conversation should read: a system message or none, then user and assistant
in turn, an assistant last. Its rows are kept, given another role or deleted,
and empty messages are put between them, at the least cost; among repairs of
equal cost the one whose edit initials come first in ASCII order counts.

The decoder has four states - nothing yet, after the system message, after a
user, after an assistant - and one survivor for each: the best edits so far that
end there. Survivors are branches of one tree of backpointers. A node counts who
refers to it (children and survivors); one that nobody refers to goes, and its
parent loses a reference. Where the tree's root has one child and no survivor,
all survivors share that edit: it is emitted and the child becomes the root. So
what is held is the part on which the survivors still differ, not the
conversation. Equal costs are told apart by the complete unresolved suffixes
(what has been emitted is common to all); the survivors' order by suffix is kept
from row to row, so a comparison takes constant time however long they are. Rows
of one role alone leave two repairs of equal cost until the end: then the
unresolved part is the whole run, a few numbers and the text for each row.

A state that another one beats whatever follows holds no survivor: from "after an
assistant" everything can follow that follows the system message, and all that
follows nothing but a system message that is kept, whose deletion costs 4.

A conversation's rows come to one task sorted by turn, since a hash of the whole
repaired conversation is one sequential computation; they stream through it.
Sorting spills, duplicates are numbered beforehand by a spilling window over
equal messages, and the decoder is bounded as said, so a conversation that holds
a third of all rows takes time and one output cell for its audit, not memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import crc32_sql, quoted

RETYPE, DELETE, INSERT, CUT = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
START, SYSTEM, USER, ASSISTANT = range(4)
#: States from which a message of each kind may follow.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
EDITS = "place long, edit string, role string, text string"


class _Node:
    """An edit: its initial, the message that it yields (None: none), the edit before it, and who refers to it."""

    __slots__ = ("letter", "message", "parent", "refs")

    def __init__(self, letter, message, parent):
        self.letter, self.message, self.parent, self.refs = letter, message, parent, 0
        if parent is not None:
            parent.refs += 1


class Decoder:
    """Cheapest edits of one conversation, row by row. ``feed`` and ``finish`` return edits that are settled.

    A survivor is (cost, rank, tail, node): ``tail`` are the inserts since the
    last row, ``rank`` the place of its suffix before them among the survivors'
    suffixes. After as many rows no suffix that ends with a row's edit begins
    another, so (rank, tail) orders complete suffixes.
    """

    def __init__(self):
        self.root = _Node("", None, None)
        self.root.refs = 1
        self.live: list = [(0, 0, "", self.root), None, None, None]
        self.since = self.unsettled = self.cost = 0
        self._insert()

    def _release(self, survivor):
        node = survivor[3]
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node.parent.refs -= 1
            node = node.parent

    def _insert(self):
        """Empty messages wherever they make a state cheaper."""
        changed = True
        while changed:
            changed = False
            for state in (USER, ASSISTANT):
                for before in BEFORE[state]:
                    x, held = self.live[before], self.live[state]
                    if x is not None and (held is None or (x[0] + INSERT, x[1], x[2] + "I") < held[:3]):
                        node = _Node("I", (ROLE[state], ""), x[3])
                        node.refs = 1
                        self.live[state] = (x[0] + INSERT, x[1], x[2] + "I", node)
                        if held is not None:
                            self._release(held)
                        changed = True

    def feed(self, initial: str, role: str, text: str, must_go: bool, cut: bool) -> list:
        best: list = [None] * 4

        def offer(state, x, price, letter, message):
            new = (x[0] + price, x[1], x[2] + letter, letter, message, x[3])
            if best[state] is None or new[:3] < best[state][:3]:
                best[state] = new

        for state, x in enumerate(self.live):
            if x is not None:
                offer(state, x, DELETE, "D", None)
        if not must_go:
            more = CUT if cut else 0
            own = STATE.get(initial)
            for to in (SYSTEM, USER, ASSISTANT):
                if to != own and to == SYSTEM:
                    continue
                for before in BEFORE[to]:
                    if self.live[before] is not None:
                        if to == own:
                            offer(to, self.live[before], more, "K", (role, text))
                        else:
                            offer(to, self.live[before], RETYPE + more, "R", (ROLE[to], text))
        order = sorted(x[1:3] for x in best if x is not None)
        new: list = [None] * 4
        for state, x in enumerate(best):
            if x is not None:
                node = _Node(x[3], x[4], x[5])
                node.refs = 1
                new[state] = (x[0], order.index(x[1:3]), "", node)
        for x in self.live:
            if x is not None:
                self._release(x)
        self.live = new
        self._insert()
        done = self.live[ASSISTANT][0]
        for state, lead in ((START, DELETE), (SYSTEM, 0)):
            if self.live[state] is not None and self.live[state][0] > done + lead:
                self._release(self.live[state])
                self.live[state] = None
        self.since += 1
        # Looked for as often as the unresolved part is long: a constant share of the work.
        return self._settled(self.live[ASSISTANT][3]) if self.since > self.unsettled + 8 else []

    def _settled(self, node) -> list:
        branch = []
        while node is not self.root:
            branch.append(node)
            node = node.parent
        out = []
        while branch and self.root.refs == 1:
            self.root = branch.pop()
            self.root.parent = None
            out.append(self.root)
        self.since, self.unsettled = 0, len(branch)
        return out

    def finish(self) -> list:
        end = min(x for x in (self.live[START], self.live[ASSISTANT]) if x is not None)
        self.cost, node = end[0], end[3]
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]


class _Conversation:
    """Counts and edits of one conversation whose rows come in order."""

    def __init__(self):
        self.decoder, self.rows = Decoder(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high, self.initial = 0, None, None, ""

    def feed(self, turn, role, text, blank, repeat, cut) -> list:
        initial = role[:1]
        if self.rows and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.rows, self.initial = self.rows + 1, initial
        if turn is not None and turn != self.high:
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        if blank:
            self.blank += 1
        elif repeat:
            self.duplicate += 1
        elif cut:
            self.truncated += 1
        return self.decoder.feed(initial, role, text, blank or repeat, cut)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, lost): rows damaged by the checksum of ``conv_id:turn``, for trials of the repair.

    Of twenty values, 0 loses the row (``lost``), 1 empties its text, 2 takes out
    its end marks, 3 repeats it, 4 makes it the user's. Nulls count as one space.
    """
    conv, turn = quoted(conv_col), quoted(turn_col)
    part = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part(conv), F.lit(":"), part(turn)).cast("binary")) % 20
    rows = turns.select(conv.alias("conv_id"), turn.alias("turn"), part(quoted(role_col)).alias("role"),
                        part(quoted(text_col)).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.col("kind") == 0, F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("lost"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their faults, each conversation in one partition and in order."""
    given = {c.lower(): c for c in rows.columns}
    lost = quoted(given["lost"]) if "lost" in given else F.lit(False)
    said = rows.select(quoted("conv_id").alias("conv_id"), quoted("turn").alias("turn"),
                       F.coalesce(quoted("role"), F.lit(" ")).alias("role"),
                       F.coalesce(quoted("text"), F.lit(" ")).alias("text"), F.coalesce(lost, F.lit(False)).alias("lost"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    same = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    marked = said.withColumns({"blank": F.length(body) == 0, "cut": ~F.right(body, F.lit(1)).isin(*ENDS), "same": same}) \
        .repartition("conv_id")
    # The window's groups lie within the partitions by conversation: no further shuffle.
    earlier = Window.partitionBy("conv_id", "lost", "same").orderBy(F.asc_nulls_first("turn"))
    return marked.withColumn("repeat", F.row_number().over(earlier) > 1).drop("same") \
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "repeat")


def _streamed(batches, done, more) -> Iterator:
    """Feed ordered rows to one conversation after the other; ``more`` gets settled edits, ``done`` each end."""
    key, talk = None, None
    for b in batches:
        for conv, turn, role, text, lost, blank, cut, repeat in zip(*[c.to_pylist() for c in b.columns]):
            if talk is None or conv != key:
                if talk is not None:
                    yield from done(key, talk)
                key, talk = conv, _Conversation()
            if not lost:
                yield from more(key, talk.feed(turn, role, text, blank, repeat, cut))
    if talk is not None:
        yield from done(key, talk)


ORDERED = ("conv_id", "turn", "role", "text", "lost", "blank", "cut", "repeat")


def _mapped(rows: DataFrame, new: str, make) -> DataFrame:
    """Rows (conv_id, new...) that ``make()`` yields as tuples, in batches of bounded size."""
    schema = StructType([rows.schema["conv_id"]] + StructType.fromDDL(new).fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        target, held, size = to_arrow_schema(schema), [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), target)], schema=target)
        for row in make(batches):
            held.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, str))
            if size > 1 << 20:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()
    return rows.select(*ORDERED).mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): each conversation's edits in order; role and text are null where deleted.

    ``rows`` has conv_id, turn, role, text and, if need be, ``lost`` (rows that
    are not there). Nulls of role and text count as one space; an empty role has
    no initial and fits nowhere; null conv_ids form one conversation; null turns
    stand first; rows of one turn stand by role, then text; of repeated rows all
    but the first are duplicates. A conversation without rows and an empty table
    give no edits. Other columns are ignored.
    """
    def make(batches):
        place = 0

        def more(key, edits):
            nonlocal place
            for e in edits:
                yield (key, place, e.letter, *(e.message or (None, None)))
                place += 1

        def done(key, talk):
            nonlocal place
            yield from more(key, talk.decoder.finish())
            place = 0
        return _streamed(batches, done, more)
    return _mapped(_ordered(rows), EDITS, make)


def reports(rows: DataFrame) -> DataFrame:
    """One row for each conversation: faults, cost and initials of its edits, hash of the repaired conversation.

    Rows as for ``repaired``; a conversation whose rows are all lost has zeros, no
    edits and the empty string's hash. gaps: turns missing between the first and
    the last. A row counts for its first fault: blank, a duplicate of an earlier
    row, cut off (no end mark last). illegal: neighbours whose roles may not follow each other.
    """
    def make(batches):
        audit, digest, empty = bytearray(), hashlib.sha256(), True

        def take(edits):
            nonlocal empty
            for e in edits:
                audit.extend(e.letter.encode())
                if e.message is not None:
                    digest.update(("" if empty else "\n").encode() + ":".join(e.message).encode("utf-8"))
                    empty = False

        def more(key, edits):
            take(edits)
            return ()

        def done(key, talk):
            nonlocal audit, digest, empty
            take(talk.decoder.finish())
            yield (key, talk.gaps(), talk.blank, talk.duplicate, talk.truncated, talk.illegal, talk.decoder.cost,
                   audit.decode(), digest.hexdigest())
            audit, digest, empty = bytearray(), hashlib.sha256(), True
        return _streamed(batches, done, more)
    return _mapped(_ordered(rows), REPORT, make)


def oracle() -> str:
    """Damage, faults and cheapest repairs in SQL: a recursion over rows that carries each state's (cost, initials, messages)."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    none = "{'c': 1000000000, 'a': '', 'm': ''}"
    after = lambda x, cost, letter, line="''": f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 'm': {x}.m || {line}}}"
    least = lambda *x: f"list_min([{', '.join(x)}])"
    own = "chr(10) || role || ':' || text"

    def taken(x, initial, role):
        kept, turned = after(x, "more", "K", own), after(x, f"more + {RETYPE}", "R", f"chr(10) || '{role}:' || text")
        return f"CASE WHEN must_go THEN {none} WHEN role[1] = '{initial}' THEN {kept} ELSE {turned} END"

    put = lambda x, role: after(x, INSERT, "I", f"chr(10) || '{role}:'")
    gone = lambda x: after(x, DELETE, "D")
    return f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(key)} % 20 AS kind FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '{ENDS}', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM base WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         rtrim(text, {blanks}) AS body FROM hurt),
marked AS (
  SELECT *, body = '' AS blank, right(body, 1) NOT IN ('.', '!', '?') AS cut, body = '' OR again AS must_go,
         CASE WHEN right(body, 1) NOT IN ('.', '!', '?') THEN {CUT} ELSE 0 END AS more,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1] AS pair FROM placed),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, {{'c': 0, 'a': '', 'm': ''}} AS s, {none} AS y,
         {{'c': {INSERT}, 'a': 'I', 'm': chr(10) || 'user:'}} AS u,
         {{'c': {2 * INSERT}, 'a': 'II', 'm': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS a
  FROM (SELECT DISTINCT conv_id FROM base)
  UNION ALL
  SELECT conv_id, k, s, y, {least('u1', put('a1', 'user'))} AS u, a1 AS a FROM (
    SELECT *, {least('a0', put('u1', 'assistant'))} AS a1 FROM (
      SELECT *, {least('u0', put('s', 'user'), put('y', 'user'), put('a0', 'user'))} AS u1 FROM (
        SELECT w.conv_id, r.k, {gone('w.s')} AS s,
               {least(gone('w.y'), f"CASE WHEN must_go OR role[1] <> 's' THEN {none} ELSE {after('w.s', 'more', 'K', own)} END")} AS y,
               {least(gone('w.u'), *[taken(f'w.{x}', 'u', 'user') for x in 'sya'])} AS u0,
               {least(gone('w.a'), taken('w.u', 'a', 'assistant'))} AS a0
        FROM walk w JOIN marked r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.k = w.k + 1)))),
ended AS (SELECT conv_id, {least('s', 'a')} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
       sha256(substr(best.m, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""
