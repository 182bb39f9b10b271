"""Repair of conversations' structure by a Viterbi decoder that emits edits as soon as they are settled.

A repaired conversation's role initials are ``(s?(ua)+)?``. Every row is kept, given another role or deleted, and empty turns may be inserted; the cheapest edits
win, among equal ones the ASCII-least string of initials (D, I, K, R). After each row the best way into each state (nothing yet, system, user, assistant) survives. Ways
share a tree of backpointers; a node counts what refers to it and goes when nothing does. Once all survivors descend from one node the edits up to it are settled and leave the task,
so memory holds the unsettled suffix only, and ties are decided on exactly that suffix. (Two ways into a state after the same rows, at the same cost, are never prefixes of each other: the
longer one would have cost an insertion more. So comparing them when they meet decides for good.)

A conversation's rows stream through one task in the order of their turns, sorted by Spark, as its digest has to see them one after the other; whatever their number, the task
holds a batch. Which rows repeat an earlier one is counted beforehand by aggregates over all rows and arrives in the stream as a mark before a text's first row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.merkle import crc_sql

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEPT, REROLED, DELETED, INSERTED, CUT_OFF = 0, 3, 4, 3, 3
BLANK = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
#: From which states a turn of a kind may follow, and the state after it.
AFTER = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
#: Settled edits are looked for when so many nodes are open, or twice what stayed open last time.
OPEN = 32


class Node:
    """An edit on the way from its parent; ``refs`` counts children and survivors."""

    __slots__ = ("cost", "depth", "edit", "parent", "refs", "role", "row")

    def __init__(self, parent: Node | None, edit: str, role: str | None, cost: int, row: tuple | None) -> None:
        self.parent, self.edit, self.role, self.cost, self.row, self.refs = parent, edit, role, cost, row, 0
        self.depth = 0 if parent is None else parent.depth + 1
        if parent is not None:
            parent.refs += 1


def earlier(a: Node, b: Node) -> bool:
    """Whether the edits up to ``a`` are ASCII-less than those up to ``b``: both suffixes from where the ways part, whole."""
    x, y = [], []
    while a is not b:
        if a.depth >= b.depth:
            x.append(a.edit)
            a = a.parent
        else:
            y.append(b.edit)
            b = b.parent
    return x[::-1] < y[::-1]


class Decoder:
    """One conversation. ``push`` takes a row (turn, role, text, fault) and ``close`` ends it; both yield settled nodes in order."""

    def __init__(self) -> None:
        self.root = Node(None, "", None, 0, None)
        self.root.refs = 1
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.limit, self.most_open = OPEN, 0
        self._insert()

    def _drop(self, node: Node) -> None:
        """A survivor lets go: nodes that nothing refers to leave the tree."""
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            parent, node.parent = node.parent, None
            parent.refs -= 1
            node = parent

    def _offer(self, best: dict[int, tuple[int, Node]], state: int, cost: int, parent: Node, edit: str, role: str | None, own: int, row: tuple | None) -> None:
        held = best.get(state)
        if held and held[0] < cost:
            return
        node = Node(parent, edit, role, own, row)
        node.refs = 1
        if held and held[0] == cost and not earlier(node, held[1]):
            self._drop(node)
            return
        best[state] = (cost, node)
        if held:
            self._drop(held[1])

    def _insert(self) -> None:
        """Empty turns after the last row: a user's turn, then an assistant's. More in a row only add their cost."""
        for kind, state in (("u", USER), ("a", ASSISTANT)):
            for source in AFTER[kind][0]:
                if source in self.best:
                    cost, node = self.best[source]
                    self._offer(self.best, state, cost + INSERTED, node, "I", ROLES[state], INSERTED, None)

    def push(self, row: tuple) -> Iterator[Node]:
        _, role, _, fault = row
        old, new = self.best, {}
        extra = CUT_OFF if fault == "truncated" else 0
        for state, (cost, node) in old.items():
            self._offer(new, state, cost + DELETED, node, "D", None, DELETED, row)
        if fault not in ("blank", "duplicate"):
            for kind, (sources, state) in AFTER.items():
                for source in sources:
                    if source not in old:
                        continue
                    cost, node = old[source]
                    if role[:1] == kind:
                        self._offer(new, state, cost + KEPT + extra, node, "K", role, KEPT + extra, row)
                    if state in ROLES:
                        self._offer(new, state, cost + REROLED + extra, node, "R", ROLES[state], REROLED + extra, row)
        self.best = new
        for _, node in old.values():
            self._drop(node)
        self._insert()
        self._prune()
        yield from self._settled()

    def _prune(self) -> None:
        """States from which no cheapest way can lead: after an assistant's turn all follows that follows a system's, and all that follows nothing for one deletion more."""
        if ASSISTANT in self.best:
            least = self.best[ASSISTANT][0]
            for state, more in ((SYSTEM, 0), (START, DELETED)):
                if state in self.best and least + more < self.best[state][0]:
                    self._drop(self.best.pop(state)[1])

    def _settled(self) -> Iterator[Node]:
        chain, (_, node) = [], next(iter(self.best.values()))
        if node.depth - self.root.depth < self.limit:
            return
        while node is not self.root:
            chain.append(node)
            node = node.parent
        self.most_open = max(self.most_open, len(chain))
        while chain and self.root.refs == 1:
            yield self._advance(chain.pop())
        self.limit = max(OPEN, 2 * len(chain))

    def _advance(self, node: Node) -> Node:
        node.parent = None
        self.root = node
        return node

    def close(self) -> Iterator[Node]:
        """The cheapest way into an accepting state."""
        (cost, node), *more = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        for c, n in more:
            if c < cost or c == cost and earlier(n, node):
                cost, node = c, n
        chain = []
        while node is not self.root:
            chain.append(node)
            node = node.parent
        while chain:
            yield self._advance(chain.pop())


HEADER, MARK, ROW = range(3)
EDITS = "conv_id long, step long, edit string, role string, text string, turn long, role_before string, fault string, cost int"
_ARROW = pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("turn", pa.int64()), ("role_before", pa.string()), ("fault", pa.string()), ("cost", pa.int32())])


def fault_of(text: str, first: bool) -> str | None:
    """A row's first fault: blank, duplicate, truncated, or None."""
    shown = text.rstrip(BLANK)
    if not shown:
        return "blank"
    return "duplicate" if not first else None if shown[-1] in ".!?" else "truncated"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decode a sorted stream of headers, marks and rows."""
    out: list[tuple] = []
    size = 0
    conv, step, first, decoder = None, 0, False, None

    def told(nodes: Iterator[Node]) -> Iterator[tuple]:
        nonlocal step
        for n in nodes:
            step += 1
            turn, before, text, fault = n.row or (None, None, "", None)
            yield conv, step, n.edit, n.role, None if n.edit == "D" else text, turn, before, fault, n.cost

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)

    def ended() -> list[tuple]:
        return list(told(decoder.close())) if decoder else []

    for b in batches:
        for c, kind, turn, role, text in zip(*[b.column(x).to_pylist() for x in ("conv_id", "kind", "turn", "role", "text")], strict=True):
            if kind == HEADER:
                more = ended()
                conv, step, first, decoder = c, 0, False, Decoder()
                more.append((c, 0, None, None, None, None, None, None, 0))
            elif kind == MARK:
                first = True
                continue
            else:
                more = list(told(decoder.push((turn, role, text, fault_of(text, first)))))
                first = False
            for row in more:
                out.append(row)
                size += 64 + len(row[4] or "")
            if size > 1 << 20:
                yield batch()
                out, size = [], 0
    out += ended()
    if out:
        yield batch()


def repaired_turns(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The edits that repair each conversation of ``rows`` (conv_id, turn, role, text), in order: step, edit (K, R, D, I), role and text afterwards (null if deleted), the row's turn, role_before and fault, cost.

    Each conversation begins with a row of step 0 without an edit, conversations of ``conversations`` (conv_id) without rows too. Rows go by turn (null first), rows of one turn
    by the digest of role and text. A null role or text counts as one space; a null conv_id is a conversation. A role whose initial is none of s, u, a cannot be kept. Repeated
    rows are duplicates. A partition holds whole conversations, each in order. An empty table gives an empty result; other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).withColumn("digest", _row_digest())
    firsts = plain.groupBy("conv_id", "digest").agg(F.min("turn").alias("least"), F.count_if(F.col("turn").isNull()).alias("without"))
    ids = plain.select("conv_id") if conversations is None else plain.select("conv_id").unionByName(conversations.select(F.col("conv_id").cast("long").alias("conv_id")))
    no_text = F.lit(None).cast("string")
    heads = ids.distinct().select("conv_id", F.lit(HEADER).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), no_text.alias("role"), no_text.alias("text"))
    marks = firsts.select("conv_id", F.lit(MARK).alias("kind"), F.when(F.col("without") == 0, F.col("least")).alias("turn"), "digest", no_text.alias("role"), no_text.alias("text"))
    stream = heads.unionByName(marks).unionByName(plain.withColumn("kind", F.lit(ROW)))
    in_order = stream.withColumn("headed", F.col("kind") != HEADER).repartition("conv_id").sortWithinPartitions("conv_id", "headed", "turn", "digest", "kind")
    return in_order.select("conv_id", "kind", "turn", "role", "text").mapInArrow(_edits, EDITS)


def _row_digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SUMMARY = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Summary:
    """What the edits of one conversation add up to, taken one by one."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.faults, self.illegal, self.cost, self.audit = conv, {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0, []
        self.low = self.high = self.role = None
        self.turns, self.sha, self.begun = 0, hashlib.sha256(), False

    def take(self, edit: str, role: str | None, text: str | None, turn: int | None, before: str | None, fault: str | None, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            self.illegal += self.role is not None and self.role[:1] + before[:1] not in LEGAL
            self.role = before
            if turn is not None and turn != self.high:  # in order, so a turn is new if it is not the last one
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if edit != "D":
            self.sha.update(f"{chr(10) * self.begun}{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SUMMARY, strict=True)], schema=_SUMMARY)

    for b in batches:
        for conv, step, *edit in zip(*[b.column(x).to_pylist() for x in _ARROW.names], strict=True):
            if step:
                now.take(*edit)
                continue
            if now:
                out.append(now.row())
            now = Summary(conv)
            if len(out) >= 4096:
                yield batch()
                out = []
    if now:
        out.append(now.row())
    if out:
        yield batch()


def repair_summaries(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repaired_turns``, as that returns them: its partitions are read in order, without an exchange."""
    return edits.mapInArrow(_summaries, SUMMARY)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows are dropped, emptied, cut off, repeated or given the role user by the CRC-32 of their conversation and turn. Nulls are one space."""
    spot = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    t = conversations.select("conv_id", "turn", spot.alias("spot"), role.alias("role"), text.alias("text")).where("spot <> 0")
    role = F.when(F.col("spot") == 4, "user").otherwise(F.col("role")).alias("role")
    text = F.when(F.col("spot") == 1, "").when(F.col("spot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")
    return t.select("conv_id", "turn", role, text, F.explode(F.sequence(F.lit(1), F.when(F.col("spot") == 3, 2).otherwise(1)))).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_summaries(repaired_turns(damaged(conversations), conversations))


OP13_SQL = rf"""
with recursive c as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as spot from conversations),
damaged as (
  select conv_id, turn, case spot when 4 then 'user' else role end as role, case spot when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from c, unnest(range(case spot when 0 then 0 when 3 then 2 else 1 end))),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, unhex(sha256(strlen(role)::varchar || ':' || role || text))) as nth from damaged),
r as (
  select *, row_number() over (partition by conv_id, role, text order by nth) > 1 as again,
    lag(role) over (partition by conv_id order by nth) as role_before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as shown from placed),
f as (select *, left(role, 1) as kind, case when shown = '' then 'blank' when again then 'duplicate' when right(shown, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from r),
facts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (role_before is not null and left(role_before, 1) || kind not in ('su', 'ua', 'au')) as illegal, count(*) as n from f group by conv_id),
follows(kind, source, state, role) as (values ('s', '0', 's', ''), ('u', '0', 'u', 'user'), ('u', 's', 'u', 'user'), ('u', 'a', 'u', 'user'), ('a', 'u', 'a', 'assistant')),
pads(source, state, added, shown) as (values ('0', '0', '', []), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []), ('0', 'u', 'I', ['user:']), ('s', 'u', 'I', ['user:']), ('a', 'u', 'I', ['user:']), ('u', 'a', 'I', ['assistant:']),
  ('0', 'a', 'II', ['user:', 'assistant:']), ('s', 'a', 'II', ['user:', 'assistant:'])),
ways as (
  select conv_id, 0::bigint as nth, state, 3 * len(added)::bigint as cost, added as audit, shown as turns from facts, pads where source = '0'
  union all
  (with edits as (
    select w.conv_id, f.nth, w.state as state, w.cost + 4 as cost, w.audit || 'D' as audit, w.turns from ways w join f on f.conv_id is not distinct from w.conv_id and f.nth = w.nth + 1
    union all
    select w.conv_id, f.nth, x.state, w.cost + (fault = 'truncated')::int * 3, w.audit || 'K', list_append(w.turns, f.role || ':' || f.text)
    from ways w join f on f.conv_id is not distinct from w.conv_id and f.nth = w.nth + 1 join follows x on x.source = w.state and x.kind = f.kind where fault not in ('blank', 'duplicate')
    union all
    select w.conv_id, f.nth, x.state, w.cost + 3 + (fault = 'truncated')::int * 3, w.audit || 'R', list_append(w.turns, x.role || ':' || f.text)
    from ways w join f on f.conv_id is not distinct from w.conv_id and f.nth = w.nth + 1 join follows x on x.source = w.state and x.role <> '' where fault not in ('blank', 'duplicate'))
  select conv_id, nth, p.state, cost + 3 * len(added), audit || added, list_concat(turns, shown) from edits e join pads p on p.source = e.state
  qualify row_number() over (partition by conv_id, nth, p.state order by cost + 3 * len(added), audit || added) = 1)),
done as (
  select w.*, row_number() over (partition by w.conv_id order by w.cost, w.audit) as best from ways w join facts on facts.conv_id is not distinct from w.conv_id and w.nth = facts.n where w.state in ('0', 'a'))
select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
  coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(turns, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) i left join facts on facts.conv_id is not distinct from i.conv_id left join done on done.conv_id is not distinct from i.conv_id and best = 1
"""
