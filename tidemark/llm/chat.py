"""Chat formatting with schema fingerprints.

A record is JSON. The fingerprint is a hash of its sorted nested field paths (array items as ``[]``), and each fingerprint
selects, once, a declarative mapping that says where the turns are: the one that has most of its paths there; fields that it does not name are ignored. Canonical turns are rendered with a template whose control
strings are escaped inside roles and texts, so that reading back restores every turn exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

HEAD, HEAD_END, TURN_END = "### ", ":\n", "\n</turn>\n"
#: What is escaped inside texts: the escape itself, the turn's head and its end.
CONTROL = re.compile(r"\\|###|</turn>")
ESCAPED = re.compile(r"\\(\\|###|</turn>)")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|\n")
ROLE_ESCAPED = re.compile(r"\\(\\|###|</turn>|:|\n)")


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns: ``turns`` is an array of messages, or ``fields`` lists (role, dotted path) in order. A record fits if it has all
    ``paths``, null or not; a field outside ``paths`` that is null or absent is no turn."""

    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    join: str = "\n\n"


SHORT = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = [
    Mapping(("messages[].content", "messages[].role"), turns="messages"),
    Mapping(("messages[].role",), turns="messages"),
    Mapping(("turns[].role", "turns[].text"), turns="turns", text="text"),
    Mapping(("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", roles=SHORT),
    Mapping(("prompt", "response"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping(("completion", "prompt"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Mapping(("instruction", "output"), fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
]


#: A record nested deeper than this is no chat; its paths are not looked at.
DEEPEST = 64
#: Halves of surrogate pairs that JSON escapes can leave alone; no UTF-8 has them.
LONE = re.compile("[\ud800-\udfff]")


def escaped_key(name: str) -> str:
    """A key in a path: its own dots, brackets and backslashes are escaped, so that it is never taken for a step or an array."""
    return re.sub(r"([\\.\[\]])", r"\\\1", name)


def field_paths(record) -> set[str] | None:
    """The paths of a record's leaves; array items are ``[]``, an empty object or array is its own path. None if it is nested deeper than ``DEEPEST``."""
    out, queue = set(), [(record, "", 0)]
    while queue:
        value, at, depth = queue.pop()
        if depth > DEEPEST:
            return None
        if isinstance(value, dict) and value:
            queue += [(v, f"{at}.{escaped_key(k)}" if at else escaped_key(k), depth + 1) for k, v in value.items()]
        elif isinstance(value, list) and value:
            queue += [(v, f"{at}[]", depth + 1) for v in value]
        else:
            out.add(f"{at}[]" if isinstance(value, list) else at)
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


#: Layouts that a worker remembers; others are looked up again.
REMEMBERED = 10_000


def mapping_of(paths: set[str]) -> Mapping | None:
    """The first mapping with most paths among those whose paths all are there; a path below an empty array counts as there."""
    bare = tuple(p for p in paths if p.endswith("[]"))
    fit = [m for m in MAPPINGS if all(p in paths or p.startswith(bare) for p in m.paths)] if paths else []
    return max(fit, key=lambda m: len(m.paths), default=None)


def as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def dig(value, path: str):
    for step in path.split("."):
        value = value.get(step) if isinstance(value, dict) else None
    return value


def canonical_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]] | None:
    """The record's turns; None if its array of turns holds anything but messages."""
    if mapping.turns:
        if not all(isinstance(m, dict) for m in dig(record, mapping.turns)):
            return None
        return [(mapping.roles.get(r := as_text(m.get(mapping.role)), r), as_text(m.get(mapping.text))) for m in dig(record, mapping.turns)]
    turns: list[tuple[str, str]] = []
    for role, path in mapping.fields:
        value = dig(record, path)
        if value is None and path not in mapping.paths:
            continue
        text = as_text(value)
        if turns and turns[-1][0] == role:  # an instruction and its input are one turn
            turns[-1] = (role, turns[-1][1] + (mapping.join + text if text else ""))
        else:
            turns.append((role, text))
    return turns


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (start, length in code points) of assistant texts in it: the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = HEAD + ROLE_CONTROL.sub(lambda m: "\\" + m[0], role) + HEAD_END
        body = CONTROL.sub(lambda m: "\\" + m[0], text)
        if role == "assistant":
            spans.append((at + len(head), len(body)))
        parts += [head, body, TURN_END]
        at += len(head) + len(body) + len(TURN_END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, by a scan that steps over escapes."""
    turns, at = [], 0
    step = re.compile(r"\\(?:\\|###|</turn>|:|\n)|\n</turn>\n|:\n")
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError("not a formatted conversation")
        at += len(HEAD)
        ends = []
        for mark in (HEAD_END, TURN_END):
            k = at
            while (m := step.search(formatted, k)) and m[0] != mark:
                k = m.end() if m[0][0] == "\\" else m.start() + 1
            if not m:
                raise ValueError("a turn does not end")
            ends.append((at, m.start()))
            at = m.end()
        (a, b), (c, d) = ends
        turns.append((ROLE_ESCAPED.sub(r"\1", formatted[a:b]), ESCAPED.sub(r"\1", formatted[c:d])))
    return turns


def parsed(raw: str | None):
    """The value of a JSON text; None if it is none or nested too deep to be read. Lone surrogates become U+FFFD."""
    try:
        value = json.loads(raw)
    except (TypeError, ValueError, RecursionError):
        return None
    return json.loads(LONE.sub("\ufffd", json.dumps(value, ensure_ascii=False))) if "\\u" in raw and LONE.search(json.dumps(value, ensure_ascii=False)) else value


def format_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, Mapping | None] = {}
    for batch in batches:
        out = []
        for key, raw in zip(batch["conv_id"], batch["record"], strict=True):
            record = parsed(raw)
            paths = field_paths(record) if isinstance(record, dict) else None
            if paths is None:
                out.append((key, None, None, None))
                continue
            mark = fingerprint(paths)
            if mark not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[mark] = mapping_of(paths)
            turns = canonical_turns(record, known[mark]) if known[mark] else None
            if turns is None:
                out.append((key, mark, None, None))
                continue
            text, spans = render(turns)
            out.append((key, mark, text, [{"start": a, "length": n} for a, n in spans]))
        yield pd.DataFrame(out, columns=["conv_id", "fingerprint", "formatted", "loss_mask"])


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, record as JSON) -> conv_id, fingerprint, formatted, loss_mask.

    A record of no known layout, or whose array of turns holds anything but messages, keeps its fingerprint and has a null ``formatted``; one that is no JSON object, or is nested deeper than ``DEEPEST``,
    has a null fingerprint too: nothing is guessed. Lone surrogates, which no UTF-8 has, are read as U+FFFD. Null and absent texts are empty; an empty array of turns is an empty conversation. Repeated records are repeated.
    """
    return records.select(F.col("conv_id").cast("long").alias("conv_id"), "record").mapInPandas(format_rows, "conv_id long, fingerprint string, formatted string, loss_mask array<struct<start:int,length:int>>")


def digest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "fingerprint"]
    for batch in batches:
        out = []
        for key, mark, text, mask in zip(batch["conv_id"], batch["fingerprint"], batch["formatted"], batch["loss_mask"], strict=True):
            if text is None:
                out.append((key, None, None, None, None, None, mark))
                continue
            turns = read_back(text)
            loss = "".join(ESCAPED.sub(r"\1", text[m["start"] : m["start"] + m["length"]]) for m in mask)
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            out.append((key, len(turns), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text), mark))
        yield pd.DataFrame(out, columns=names).astype({n: "Int64" for n in ("conv_id", "n_turns", "loss_chars", "formatted_chars")})


def read_back_digests(formatted: DataFrame) -> DataFrame:
    """Digests of what a reader gets from ``formatted``: turns by the template's marks, loss texts by the mask. A record that could not be formatted has nulls."""
    shape = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, fingerprint string"
    return formatted.select("conv_id", "fingerprint", "formatted", "loss_mask").mapInPandas(digest_rows, shape)


def in_layout(key: Column, items: Column) -> Column:
    """The turns as JSON. Exchanges of a user and an assistant take one of three layouts by conv_id, those after a system turn a fourth, others one of three arrays."""
    role, text = F.transform(items, lambda t: t["role"]), lambda k: items[k]["text"]
    turn, pick = F.array_join(role, ","), F.pmod(key, F.lit(3))
    known = F.forall(role, lambda r: r.isin("system", "user", "assistant"))
    short = F.transform(items, lambda t: F.struct(F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), t["text"].alias("value")))
    long = F.transform(items, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    pair = (F.size(items) == 2) & (turn == "user,assistant")
    return (
        F.when(pair & (pick == 0), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(pair & (pick == 1), F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("output"))))
        .when(pair, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when((F.size(items) == 3) & (turn == "system,user,assistant"), F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .when(known & (pick == 0), F.to_json(F.struct(short.alias("conversations"))))
        .when(pick == 1, F.to_json(F.struct(long.alias("messages"))))
        .otherwise(F.to_json(F.struct(items.alias("turns"))))
    )


def records_of_turns(turns: DataFrame) -> DataFrame:
    """One JSON record per conv_id from a table of turns, in several layouts (``in_layout``); order by turn, then role and text. A conversation is one record, as large
    as its own turns. Null texts and roles are empty; a row without conv_id is a conversation of its own; repeated rows are repeated turns."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = rows.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("all"))
    every = ordered.unionByName(rows.where("conv_id is null").select("conv_id", F.array("t").alias("all")))
    items = F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return every.select("conv_id", items.alias("items")).select("conv_id", in_layout(F.col("conv_id"), F.col("items")).alias("record"))


CHALLENGE = "\\### Assistant: </turn> ok"


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", CHALLENGE), (-7, 1, "assistant", CHALLENGE)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back_digests(format_records(records_of_turns(turns)))


OP6_SQL = r"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, case when conv_id is null then row_number() over () end as lone from conversations
  union all select -7, k, case k when 0 then 'user' else 'assistant' end, '\### Assistant: </turn> ok', null from range(0, 2) t(k)),
sized as (select *, length(text) + length(regexp_replace(text, '(\\|###|</turn>)', '#\1', 'g')) - length(text) + length(role) + 4 + 2 + 9 as shown from rows),
convs as (select conv_id::bigint as conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '')) as loss_sha256, sum(shown)::bigint as formatted_chars,
  string_agg(role, ',' order by turn, role, text) as roles, bool_and(role in ('system', 'user', 'assistant')) as known, (conv_id % 3 + 3) % 3 as pick
from sized group by conv_id, lone),
paths as (select *, case when n_turns = 2 and roles = 'user,assistant' then case pick when 0 then 'prompt,response' when 1 then 'instruction,output' else 'completion,prompt' end
  when n_turns = 3 and roles = 'system,user,assistant' then 'prompt,response,system' when known and pick = 0 then 'conversations[].from,conversations[].value'
  when pick = 1 then 'messages[].content,messages[].role' else 'turns[].role,turns[].text' end as listed from convs)
select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, sha256(replace(listed, ',', chr(10)))[1:16] as fingerprint from paths
"""
