"""Deeply nested records to related flat tables.

Method: single-pass tagged emission. One depth-first visitor reads each payload
once and emits rows (tag, document_id, record_key, parent_key, body) for all
tables; they are written partitioned by tag, and each table's schema is applied
to its part. Nothing is grouped by document, so a document that is delivered in
a third of the records costs no more than any other.

Accepted shapes: text around the JSON (byte order mark, blanks, code fences,
prose), a document inside an object or a string, a list given as one object, as
a map from id to object or as JSON text, null elements. A payload that is cut
off, broken, empty or null gives no rows, as does one without questions.

Keys: a question's is its id (the map's key where the id is absent; rows of a
question without either are keyed by the parent's key, '#' and the position);
an escalation's is the question's key, '/' and its 1-based position in its array,
in which elements that are not objects keep their place. Depth is not bounded by
the interpreter's stack. Repeated deliveries give equal rows; tables are distinct.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.session import stage

EMITTED = "tag string, document_id string, record_key string, parent_key string, ordinal int, depth int, body string"
_ARROW = pa.schema([("tag", pa.string()), ("document_id", pa.string()), ("record_key", pa.string()), ("parent_key", pa.string()), ("ordinal", pa.int32()), ("depth", pa.int32()), ("body", pa.string())])
_ESCALATION_FIELDS = {"kind", "attempt", "decision", "reason", "model", "previous_status"}
_QUESTION_FIELDS = {"id", "question_text", "question_type", "source_type", "sub_questions", "validation", "options", "marks"}
_space = re.compile(r"[ \t\n\r]*")
_scalar = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null|NaN|-?Infinity")
_fence = re.compile(r"^`{3,}\w*\s*|\s*`{3,}$")

SCHEMAS: dict[str, T.StructType] = {
    "question": T.StructType([T.StructField(f, T.StringType()) for f in ("source_type", "question_type", "question_text", "marks", "options")]),
    "escalation": T.StructType([T.StructField(f, T.StringType()) for f in ("kind", "attempt", "model", "reason", "decision", "previous_status")]),
}


def _read_deep(text: str, at: int) -> tuple[object, int]:
    """The JSON value that starts at a place of the text, and its end, without recursion."""
    skip = lambda i: _space.match(text, i).end()

    def name(i: int) -> tuple[str, int]:
        if text[i:i + 1] != '"':
            raise ValueError("no key")
        key, i = json.decoder.scanstring(text, i + 1, False)
        i = skip(i)
        if text[i:i + 1] != ":":
            raise ValueError("no colon")
        return key, skip(i + 1)

    stack: list[list] = []
    at = skip(at)
    while True:
        c = text[at:at + 1]
        if c and c in "{[":
            value, at = {} if c == "{" else [], skip(at + 1)
            if text[at:at + 1] != ("}" if c == "{" else "]"):
                stack.append([value, None])
                if c == "{":
                    stack[-1][1], at = name(at)
                continue
            at += 1
        elif c == '"':
            value, at = json.decoder.scanstring(text, at + 1, False)
        elif m := _scalar.match(text, at):
            value, at = json.loads(m[0]), m.end()
        else:
            raise ValueError("no value")
        while stack:
            box, key = stack[-1]
            keyed = isinstance(box, dict)
            if keyed:
                box[key] = value
            else:
                box.append(value)
            at = skip(at)
            c = text[at:at + 1]
            if c == ",":
                at = skip(at + 1)
                if keyed:
                    stack[-1][1], at = name(at)
                break
            if c != ("}" if keyed else "]"):
                raise ValueError("not closed")
            stack.pop()
            value, at = box, at + 1
        else:
            return value, at


def _load(text: str):
    """json.loads for any depth."""
    try:
        return json.loads(text, strict=False)
    except RecursionError:
        value, end = _read_deep(text, 0)
        if _space.match(text, end).end() < len(text):
            raise ValueError("extra data") from None
        return value


def _load_start(text: str, at: int):
    """The value that starts at a place of the text, whatever follows it, for any depth."""
    try:
        return json.JSONDecoder(strict=False).raw_decode(text, at)[0]
    except RecursionError:
        return _read_deep(text, at)[0]


def _dump(value) -> str:
    """json.dumps for any depth."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        out, stack = [], [(False, value)]
    while stack:
        ready, v = stack.pop()
        if ready:
            out.append(v)
        elif v and isinstance(v, dict):
            parts = [p for i, (k, x) in enumerate(v.items()) for p in ((True, ("{" if i == 0 else ", ") + json.dumps(k, ensure_ascii=False) + ": "), (False, x))]
            stack += [*parts, (True, "}")][::-1]
        elif v and isinstance(v, list):
            parts = [p for i, x in enumerate(v) for p in ((True, "[" if i == 0 else ", "), (False, x))]
            stack += [*parts, (True, "]")][::-1]
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


def read_payload(payload: str | None, depth: int = 0) -> dict | None:
    """The object in a payload once what is wrapped around it is removed; None if there is none that is whole."""
    # every step goes inside what is wrapped, so that it ends for any number of wrappings
    while isinstance(payload, str):
        text = payload.strip("﻿​ \t\r\n\x00")
        text = _fence.sub("", text).strip("﻿​ \t\r\n\x00") if text.startswith("`") or text.endswith("`") else text
        if not text:
            return None
        try:
            payload = _load(text)
        except (ValueError, RecursionError):
            start = text.find("{")
            if start <= 0:
                try:
                    payload = _load_start(text, 0) if start == 0 else None
                except (ValueError, RecursionError):
                    return None
            else:
                try:
                    payload = _load_start(text, start)
                except (ValueError, RecursionError):
                    return None
            if not isinstance(payload, dict):
                return None
    while not (isinstance(payload, dict) and "questions" in payload):
        if isinstance(payload, list) and len(payload) == 1:
            payload = payload[0]
        elif isinstance(payload, dict):
            payload = payload.get("document", next((v for v in payload.values() if isinstance(v, dict) and ("questions" in v or "document" in v)), None))
        elif isinstance(payload, str):
            return read_payload(payload, depth + 1)
        else:
            return None
    return payload


def _as_list(value, fields: set[str]) -> list[tuple[str | None, object]]:
    """(key, element) of a list in any of its shapes."""
    while isinstance(value, str):
        try:
            value = _load(value)
        except (ValueError, RecursionError):
            return []
    if isinstance(value, list):
        return [(None, _as_object(v)) for v in value]
    if isinstance(value, dict):
        if fields & value.keys():
            return [(None, value)]
        return [(k, _as_object(v)) for k, v in value.items()]
    return []


def _as_object(value):
    while isinstance(value, str) and value.lstrip()[:1] in ("{", '"'):
        try:
            value = _load(value)
        except (ValueError, RecursionError):
            return None
    return value


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else _dump(value)


def _own_key(value) -> str:
    return str(value).strip() if isinstance(value, (str, int)) and not isinstance(value, bool) else ""


def visit(document_id: str, document: dict) -> Iterator[tuple]:
    """Rows of all tables of one document, depth first; a stack of its own keeps any depth possible."""
    stack = [(key, q, "", i + 1, 0) for i, (key, q) in enumerate(_as_list(document.get("questions"), _QUESTION_FIELDS))][::-1]
    while stack:
        map_key, q, parent, ordinal, depth = stack.pop()
        if not isinstance(q, dict):
            continue
        key = _own_key(q.get("id")) or _own_key(map_key) or f"{parent}#{ordinal}"
        body = {f: _text(q[f]) for f in SCHEMAS["question"].names if q.get(f) is not None}
        yield ("question", document_id, key, parent, ordinal, depth, json.dumps(body, ensure_ascii=False))
        validation = _as_object(q.get("validation"))
        if isinstance(validation, dict):
            for at, (_, e) in enumerate(_as_list(validation.get("escalations"), _ESCALATION_FIELDS), 1):
                if isinstance(e, dict):
                    body = {f: _text(e[f]) for f in SCHEMAS["escalation"].names if e.get(f) is not None}
                    yield ("escalation", document_id, f"{key}/{at}", key, at, depth, json.dumps(body, ensure_ascii=False))
        subs = _as_list(q.get("sub_questions"), _QUESTION_FIELDS)
        stack.extend((k, s, key, i, depth + 1) for i, (k, s) in reversed(list(enumerate(subs, 1))))


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    for batch in batches:
        rows: list[tuple] = []
        for document_id, payload in zip(batch.column("document_id").to_pylist(), batch.column("payload").to_pylist()):
            document = read_payload(payload)
            if document is None:
                continue
            own = document_id if document_id is not None else _own_key(document.get("document_id")) or None
            if own is None:
                continue
            for row in visit(own, document):
                rows.append(row)
                if len(rows) >= 20_000:
                    yield flush(rows)
                    rows = []
        if rows:
            yield flush(rows)


def emit(canonical: DataFrame) -> DataFrame:
    """Tagged rows of all flat tables, in one pass over the payloads."""
    return canonical.filter("payload is not null").select("document_id", "payload").mapInArrow(_emit, EMITTED)


def links(emitted: DataFrame) -> DataFrame:
    """document_id, entity, record_key and parent_key of every flat row."""
    return emitted.select("document_id", F.col("tag").alias("entity"), "record_key", "parent_key").distinct()


def flat_table(emitted: DataFrame, tag: str) -> DataFrame:
    """One flat table with its schema; equal rows of repeated deliveries count once."""
    schema = SCHEMAS[tag]
    rows = emitted.filter(F.col("tag") == tag).select("document_id", "record_key", "parent_key", "ordinal", "depth", F.from_json("body", schema).alias("b"))
    return rows.select("document_id", "record_key", "parent_key", "ordinal", "depth", "b.*").distinct()


def written(canonical: DataFrame, folder: str | None = None) -> DataFrame:
    """The tagged rows, written once partitioned by tag; every flat table reads its own partition.

    Without a folder a new one in the shared folder is taken, which is released
    with the session's staged tables.
    """
    emitted = emit(canonical)
    if folder is None:
        return stage(emitted, "nested", partition_by=("tag",))
    emitted.write.mode("errorifexists").partitionBy("tag").parquet(folder)
    return canonical.sparkSession.read.schema(emitted.schema).parquet(folder)


def write_tables(canonical: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """All flat tables over one write."""
    rows = written(canonical, folder)
    return {tag: flat_table(rows, tag) for tag in SCHEMAS}
