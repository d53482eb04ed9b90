"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text's lines are its paragraphs; a paragraph's pieces (sentences, or 96
characters of a longer one) are the leaves.  A paragraph whose digest ends in
three zero bits closes a section, so that an edit moves section borders only
nearby.  A leaf's digest is the SHA-256 of its UTF-8 bytes, every other node's
that of its children's digests (in hex, joined); the root's covers the whole
text, so equal roots mean equal texts.

A fingerprint is written as ``root/section/section/...``; a section is its
paragraphs joined by ``;`` and a paragraph the first six hex digits of each of
its leaves.  Two fingerprints with different roots are compared branch by
branch: ``differing_paragraphs`` says where texts differ, ``likeness`` how much
of their leaves they share (2 x shared / both, 0 to 1).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import small_batches, written

_PIECE = re.compile(r"[^.!?]{1,96}[.!?]*|[.!?]+")
_LEAF_HEX = 6


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


class Tree:
    """The tree of one text."""

    __slots__ = ("leaves", "root", "sections")

    def __init__(self, text: str):
        sections, paragraphs, leaves = [], [], []
        section, section_digests = [], []

        def close() -> None:
            sections.append(";".join(paragraphs))
            section_digests.append(_digest("".join(section)))
            paragraphs.clear()
            section.clear()

        for line in text.split("\n"):
            digests = list(map(_digest, _PIECE.findall(line)))
            section.append(_digest("".join(digests)))
            short = [d[:_LEAF_HEX] for d in digests]
            leaves += short
            paragraphs.append("".join(short))
            if section[-1][-1] in "08":  # the last three bits
                close()
        if paragraphs:
            close()
        self.root, self.sections, self.leaves = _digest("".join(section_digests)), sections, leaves

    def __str__(self) -> str:
        return "/".join([self.root, *self.sections])


def _likeness(a_root: str, a: list[str], b_root: str, b: list[str]) -> float:
    if a_root == b_root:
        return 1.0
    if not a or not b:
        return 0.0
    return 2 * (Counter(a) & Counter(b)).total() / (len(a) + len(b))


def _parsed(fingerprint: str) -> tuple[str, list[list[str]]]:
    root, *sections = fingerprint.split("/")
    return root, [s.split(";") for s in sections]


def likeness(a: str, b: str) -> float:
    """Share of common leaves of two fingerprints: 1 for equal texts."""

    def leaves(sections: list[list[str]]) -> list[str]:
        return [p[i : i + _LEAF_HEX] for s in sections for p in s for i in range(0, len(p), _LEAF_HEX)]

    (a_root, a_sections), (b_root, b_sections) = _parsed(a), _parsed(b)
    return _likeness(a_root, leaves(a_sections), b_root, leaves(b_sections))


def differing_paragraphs(a: str, b: str) -> list[int]:
    """Paragraphs (by number from 0) of ``a`` in which it differs from ``b``:
    equal roots end the comparison, sections that ``b`` has too are skipped
    whole, and of the others the paragraphs that ``b`` hasn't are named."""
    (a_root, a_sections), (b_root, b_sections) = _parsed(a), _parsed(b)
    if a_root == b_root:
        return []
    whole = Counter(";".join(s) for s in b_sections)
    open_, number = [], 0
    for s in a_sections:
        key = ";".join(s)
        if whole[key]:
            whole[key] -= 1
        else:
            open_ += [(number + i, p) for i, p in enumerate(s)]
        number += len(s)
    rest = Counter(p for s in whole.elements() for p in s.split(";"))
    out = []
    for at, p in open_:
        if rest[p]:
            rest[p] -= 1
        else:
            out.append(at)
    return out


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first
    code points of ``following``, or all."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


def _compared(text: str, tree: Tree, following: str, following_tree: Tree) -> tuple:
    edited = edited_text(text, following)
    edited_tree = Tree(edited)
    return (
        len(text),
        _digest(edited),
        str(tree),
        str(edited_tree),
        _likeness(tree.root, tree.leaves, edited_tree.root, edited_tree.leaves),
        _likeness(tree.root, tree.leaves, following_tree.root, following_tree.leaves),
    )


_RESULT = {
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
_RESULT_DDL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_COMPARED, _FIRST, _LAST = 0, 1, 2


def _rows(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.int32()), ("task", pa.int64()), ("doc_id", id_type), *_RESULT.items(), ("text", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row behind it; the task's first and last texts go out
    for the row before its first and for its last."""
    task, held, out = TaskContext.get().partitionId(), None, []
    nothing = (None,) * len(_RESULT)
    id_type = pa.int64()
    for batch in small_batches(batches, "text", 4 << 20):
        id_type = batch.column("doc_id").type
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            tree = Tree(text)
            if held is None:
                out.append((_FIRST, task, None, *nothing, text))
            else:
                out.append((_COMPARED, task, held[0], *_compared(held[1], held[2], text, tree), None))
            held = doc_id, text, tree
        if out:
            yield _rows(out, id_type)
            out = []
    if held is not None:
        yield _rows([(_LAST, task, held[0], *nothing, held[1])], id_type)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            found = _compared(row["text"], Tree(row["text"]), row["following"], Tree(row["following"]))
            rows.append((_COMPARED, 0, row["doc_id"], *found, None))
        if rows:
            yield _rows(rows, batch.column("doc_id").type).select(["doc_id", *_RESULT])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of every document; the next document is the one
    with the next smaller doc_id, after the last the first.

    Null text is empty.  Null ids come last, rows with the same id follow each
    other by a hash of their texts, then by text, also over several tasks; a
    single document is its own next; an empty table gives an empty table.  Other
    columns are ignored.  The texts are shuffled once, by ranges of doc_id and
    that hash; a task holds a text, however long, the one behind it and a small
    batch of results.  What borders on another task's rows (one text at each end of
    a task) is joined afterwards from the table that the tasks have written.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    down = F.col("doc_id").desc_nulls_last()
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    ordered = hashed.repartitionByRange(down, "hash").sortWithinPartitions(down, "hash", "text")
    found = ordered.select("doc_id", "text").mapInArrow(_neighbours, f"kind int, task long, doc_id {kind}, {_RESULT_DDL}, text string")
    found = written(found, "merkle")
    first = found.filter(F.col("kind") == _FIRST).select(F.col("task").alias("next_task"), F.col("text").alias("following"))
    last = found.filter(F.col("kind") == _LAST).select("task", "doc_id", "text")
    # tasks that had rows, by number: a few bytes each
    tasks = last.select("task")
    order = Window.orderBy("task")
    after = tasks.select("task", F.lead("task").over(order).alias("after"), F.min("task").over(order).alias("least"))
    pairs = last.join(after.select("task", F.coalesce("after", "least").alias("next_task")), "task").join(first, "next_task")
    ends = pairs.select("doc_id", "text", "following").mapInArrow(_ends, f"doc_id {kind}, {_RESULT_DDL}")
    names = ["doc_id", *_RESULT]
    return found.filter(F.col("kind") == _COMPARED).select(names).unionByName(ends.select(names))
