"""Chat formatting: a finite-state machine over roles, a declarative template, and loss flags.

Rows stream in turn order through the machine, one conversation after the other, so a conversation
of any length needs no memory beyond the current turn. Every turn becomes three text segments:
opening mark, text, closing mark. A segment carries loss only if it is text of a role that the
template trains on. Control strings inside texts get a backslash in front (a run of backslashes
before a control string gets one more), which the reader takes away again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import small_batches

#: The template. ``marks`` gives the strings around a text of a role; other roles get ``other`` with
#: their name, percent-encoded, in it. Marks never touch a text: a blank stands between them.
TEMPLATE = {
    "marks": {
        "system": ("<s>[SYS]", "[/SYS]"),
        "user": ("<s>[INST]", "[/INST]"),
        "assistant": ("[OUT]", "</s>"),
    },
    "other": ("<s>[ROLE={name}]", "[/ROLE]"),
    "control": ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[ROLE=", "[/ROLE]"],
    "loss": ["assistant"],
    # Which role may follow which; "" is the start. A conversation is valid if it ends in ``final``.
    "turns": {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "final": ["assistant"],
}

SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
    ("loss", pa.bool_()), ("in_order", pa.bool_()),
])
SUMMARY = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()),
])
ROWS_PER_BATCH = 2_000
CHARS_PER_BATCH = 4_000_000


def _control(template: dict) -> re.Pattern:
    return re.compile(r"(\\*)(" + "|".join(map(re.escape, sorted(template["control"], key=len, reverse=True))) + ")")


def escape(text: str, control: re.Pattern) -> str:
    return control.sub(r"\\\1\2", text)


def unescape(text: str, control: re.Pattern) -> str:
    return control.sub(lambda m: m[1][1:] + m[2], text)


def marks_of(role: str, template: dict) -> tuple[str, str]:
    if role in template["marks"]:
        return template["marks"][role]
    start, end = template["other"]
    return start.replace("{name}", quote(role, safe="")), end


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    chunk: list[tuple] = []
    chars = 0
    for row in rows:
        chunk.append(row)
        chars += len(row[3]) if isinstance(row[3], str) else 0
        if len(chunk) == ROWS_PER_BATCH or chars > CHARS_PER_BATCH:
            yield _batch(chunk, schema)
            chunk, chars = [], 0
    if chunk:
        yield _batch(chunk, schema)


def _batch(chunk: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*chunk, strict=True), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def segments_of(rows: Iterator[tuple], template: dict) -> Iterator[tuple]:
    """Segments of rows (conv_id, role, text) that arrive in turn order."""
    control, none = _control(template), object()
    conv, state, number, order = none, "", 0, True
    for conv_id, role, text in rows:
        if conv_id != conv or conv is none:
            conv, state, number, order = conv_id, "", 0, True
        order = order and role in template["turns"].get(state, ())
        start, end = marks_of(role, template)
        loss = role in template["loss"]
        yield conv_id, number, 0, f"{start} ", False, order
        yield conv_id, number, 1, escape(text, control), loss, order
        yield conv_id, number, 2, f" {end}", False, order
        state, number = role, number + 1


def format_conversations(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Segments (conv_id, turn_no, part, text, loss, in_order) of every conversation.

    Null roles and texts count as empty; rows with a null conv_id form one conversation; a null turn
    comes first. Ties in turn go by role, then text; repeated rows are separate turns. Roles the
    template does not know are formatted with their name and make the turn order invalid. No row is
    dropped. Other columns are not looked at. The result is dealt by conv_id and in turn order.
    """
    rows = small_batches(conversations).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        yield from _batches(segments_of(_rows(batches), template), SEGMENTS)

    return ordered.select("conv_id", "role", "text").mapInArrow(run, _ddl(SEGMENTS))


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def read_turn(formatted: str, template: dict, control: re.Pattern) -> tuple[str, str]:
    """(role, text) of one formatted turn, from its marks alone."""
    for role, (start, end) in template["marks"].items():
        if formatted.startswith(f"{start} "):
            break
    else:
        before, after = template["other"][0].split("{name}")
        name = formatted[len(before):formatted.index(f"{after} ", len(before))]
        role, start, end = unquote(name), f"{before}{name}{after}", template["other"][1]
    return role, unescape(formatted[len(start) + 1:len(formatted) - len(end) - 1], control)


def read_back(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per conversation from formatted segments in order: digests of turns and of loss text."""

    def run(batches):
        control = _control(template)

        def summaries():
            conv = none = object()
            parts: list[str] = []
            turns = loss = None
            n = chars = loss_chars = 0
            valid, role = True, ""
            for conv_id, _, part, text, flagged, in_order in _rows(batches):
                if conv is none or conv_id != conv:
                    if conv is not none:
                        yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid and role in template["final"]
                    conv, turns, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                    n = chars = loss_chars = 0
                    valid = True
                chars += len(text)
                if flagged:
                    plain = unescape(text, control)
                    loss.update(plain.encode())
                    loss_chars += len(plain)
                parts = [text] if part == 0 else [*parts, text]
                if part == 2:
                    role, said = read_turn("".join(parts), template, control)
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                    valid = valid and in_order
            if conv is not none:
                yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid and role in template["final"]

        yield from _batches(summaries(), SUMMARY)

    return segments.mapInArrow(run, _ddl(SUMMARY))


PROBE = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -7, two turns whose texts are control strings."""
    spark = conversations.sparkSession
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after,
    length(text) + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|\[SYS\]|\[/SYS\]|\[OUT\]|\[ROLE=|\[/ROLE\]')) AS escaped,
    CASE role WHEN 'system' THEN 16 WHEN 'user' THEN 18 WHEN 'assistant' THEN 11 END AS marks
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + marks)::BIGINT AS formatted_chars,
  bool_and((before || '>' || role) IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""
