"""Deeply nested records to related flat tables, by single-pass tagged emission.

A depth-first visitor walks each JSON document once and emits one row per object that
belongs to a table of the specification: the table's tag, a primary key, the key of the
parent row, the position, and the remaining fields as a JSON payload. The emitted rows
can be written partitioned by tag; ``flat_table`` then applies a schema to one tag.

Keys are paths (``17/pass:2/chunk:1/inventor:3``), so they are stable over re-runs and the
parent's key is a prefix of the child's key: no key lookup or join is needed to link them.

Defined cases: a null or invalid document gives no rows; a single object where a list is
usual counts as a list of one; a bare string stands for an object whose name it is; a list
may hold nulls, which take up a position but give no row; JSON inside a JSON string is
read through; a document delivered twice under the same root key gives its rows once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Tag of the row of a document that could not be read.
ERROR = "error"
TAGGED_SCHEMA = "root BIGINT, tag STRING, pk STRING, parent_pk STRING, ordinal INT, payload STRING"
_ARROW = pa.schema(
    [
        ("root", pa.int64()),
        ("tag", pa.string()),
        ("pk", pa.string()),
        ("parent_pk", pa.string()),
        ("ordinal", pa.int32()),
        ("payload", pa.string()),
    ]
)


@dataclass(frozen=True)
class Node:
    """One table of the flattened result.

    tag: name of the table. keys: names of the member that holds its rows, the first one
    present and not null wins. number: member that numbers the rows (else the position).
    bare: member that a bare string stands for. nested: members read through on the way to
    the children, e.g. ``("prediction",)``.
    """

    tag: str
    keys: tuple[str, ...]
    number: str | None = None
    bare: str | None = None
    through: tuple[str, ...] = ()
    children: tuple["Node", ...] = field(default=())


def _opened(value):
    """A JSON string that holds an object or a list is replaced by what it holds."""
    if isinstance(value, str):
        text = value.strip()
        if text[:1] in ("{", "["):
            try:
                return json.loads(text)
            except ValueError:
                return value
    return value


def _members(value) -> list:
    if value is None:
        return []
    return value if isinstance(value, list) else [value]


def _visit(root: int, parent: str, holder, nodes: tuple[Node, ...], out: list) -> None:
    """Depth first; rows of a node come before the rows of its children."""
    for node in nodes:
        value = next((holder[k] for k in node.keys if holder.get(k) is not None), None)
        value = value if node.bare and isinstance(value, str) and value.strip()[:1] not in ("{", "[") else _opened(value)
        for place, item in enumerate(_members(value), 1):
            if isinstance(item, str):
                opened = _opened(item)
                item = opened if isinstance(opened, dict) else ({node.bare: item} if node.bare else None)
            if not isinstance(item, dict):
                continue
            number = item.get(node.number) if node.number else place
            if isinstance(number, bool) or not isinstance(number, int):
                number = place
            pk = f"{parent}/{node.tag}:{number}"
            below = item
            for step in node.through:  # an optional level: where it is left out, its members stand one level up
                below = _opened(below.get(step, below)) if isinstance(below, dict) else None
            hidden = {k for child in node.children for k in child.keys} | set(node.through)
            payload = {k: v for k, v in item.items() if k not in hidden}
            if node.through and isinstance(below, dict):
                payload |= {k: v for k, v in below.items() if k not in hidden}
            out.append((root, node.tag, pk, parent, number, json.dumps(payload, ensure_ascii=False)))
            if isinstance(below, dict):
                _visit(root, pk, below, node.children, out)


def tagged_rows(df: DataFrame, root: str, document: str, nodes: tuple[Node, ...], through: tuple[str, ...] = ()) -> DataFrame:
    """Rows of all tables of the specification, from the JSON strings in ``document``.

    root: BIGINT column that identifies the record. through: members read through from the
    document's top. Rows with a null root or document, and text that is no JSON, give nothing;
    a document nested too deep to be read gives one row tagged ``error``. The order of the rows
    isn't defined; the work is one narrow stage.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key is None or text is None:
                    continue
                own: list = []
                try:
                    value = _opened(json.loads(text))
                    for step in through:
                        value = _opened(value.get(step)) if isinstance(value, dict) else None
                    if isinstance(value, dict):
                        _visit(key, str(key), value, nodes, own)
                except RecursionError:  # valid, but nested deeper than the parser goes
                    own = [(key, ERROR, str(key), "", 0, '{"error": "too deep"}')]
                except ValueError:
                    continue
                out += own
            columns = list(zip(*out)) if out else [[]] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    return df.select(F.col(root).cast("bigint").alias("root"), F.col(document).alias("document")).mapInArrow(emit, TAGGED_SCHEMA)


def write_tagged(rows: DataFrame, path: str) -> None:
    """Write the tables, one folder a tag; an existing path is replaced."""
    rows.write.mode("overwrite").partitionBy("tag").parquet(path)


def flat_table(rows: DataFrame, tag: str, schema: str) -> DataFrame:
    """One flat table: keys, position and the payload under ``schema`` (a DDL string).

    Fields of the payload that clash with the key columns keep their names inside the
    schema's struct only under another name, so list no field called root, pk, parent_pk
    or ordinal in it.
    """
    return (
        rows.filter(F.col("tag") == tag)
        .withColumn("_row", F.from_json("payload", schema))
        .select("root", "pk", "parent_pk", "ordinal", "_row.*")
    )


def once(df: DataFrame, root: str, document: str) -> DataFrame:
    """One row of each (root, document): the same answer delivered again is left out."""
    return df.filter(F.col(document).isNotNull()).groupBy(root, F.sha2(document, 256).alias("_digest")).agg(F.first(document).alias(document)).drop("_digest")


# The project's own answers -------------------------------------------------------------

PARTIES = (
    Node("inventor", ("inventors", "inventor"), bare="name"),
    Node("assignee", ("assignees", "assignee"), bare="name"),
)
ANSWER = (Node("pass", ("passes", "pass"), number="pass", children=(Node("chunk", ("chunks",), number="chunk", through=("prediction",), children=PARTIES),)),)


def party_rows(predictions: DataFrame, raw: DataFrame) -> DataFrame:
    """Every named party of the delivered predictions and of the raw answers.

    predictions needs rec_id and prediction, raw needs rec_id and payload; further columns
    don't matter. Result: rec_id, pass_no, chunk_no, party, pos; one row each.
    """
    delivered = predictions.filter("prediction is not null").select(
        "rec_id",
        F.to_json(F.struct(F.col("prediction.inventors").alias("inventors"), F.col("prediction.assignees").alias("assignees"))).alias("document"),
    )
    rows = tagged_rows(delivered, "rec_id", "document", PARTIES).unionByName(
        tagged_rows(once(raw.select("rec_id", "payload"), "rec_id", "payload"), "rec_id", "payload", ANSWER, through=("answer",))
    )
    name = F.get_json_object("payload", "$.name")
    return (
        rows.filter(F.col("tag").isin("inventor", "assignee"))
        .filter(F.length(F.regexp_replace(name, r"(?U)\s+", "")) > 0)
        .select(
            F.col("root").alias("rec_id"),
            F.coalesce(F.regexp_extract("pk", r"/pass:(-?\d+)", 1).try_cast("int"), F.lit(0)).alias("pass_no"),
            F.coalesce(F.regexp_extract("pk", r"/chunk:(-?\d+)", 1).try_cast("int"), F.lit(0)).alias("chunk_no"),
            F.col("tag").alias("party"),
            F.col("ordinal").alias("pos"),
        )
        .distinct()
    )
