"""Fingerprints of documents packed into binary columns, one row per batch and part.

A part is a slice of the fingerprint space; all of a part's rows meet in one task. A row holds
the ids of a batch's documents, how many fingerprints each has there, and the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from clickmodel.llm.hashing import mix

CELLS = "part int, kind int, ids binary, counts binary, prints binary"
HITS = "_id bigint, prints binary"


def cells(ids: np.ndarray, prints: np.ndarray, parts: int, kind: int, wide: bool, by_id: bool = False) -> pa.RecordBatch:
    """Fingerprints of a batch, packed by part; ``ids`` names the document of each. Parts are
    slices of the fingerprints, or with ``by_id`` of the documents."""
    part = (mix(ids.view(np.uint64)) if by_id else prints >> np.uint64(32)) % np.uint64(parts)
    order = np.lexsort((ids, part))
    ids, prints, part = ids[order], prints[order], part[order].astype(np.int64)
    new_doc = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (ids[1:] != ids[:-1])]) if len(ids) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[new_doc, len(ids)]).astype(np.int32)
    doc_ids, doc_part = ids[new_doc], part[new_doc]
    new_part = np.flatnonzero(np.r_[True, doc_part[1:] != doc_part[:-1]]) if len(doc_part) else np.zeros(0, np.int64)
    ends = np.r_[new_part[1:], len(doc_part)]
    at = np.r_[0, np.cumsum(counts)]
    kept = prints if wide else prints.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_part[new_part], pa.int32()),
            pa.array(np.full(len(new_part), kind), pa.int32()),
            pa.array([doc_ids[a:b].tobytes() for a, b in zip(new_part, ends, strict=True)], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in zip(new_part, ends, strict=True)], pa.binary()),
            pa.array([kept[at[a] : at[b]].tobytes() for a, b in zip(new_part, ends, strict=True)], pa.binary()),
        ],
        ["part", "kind", "ids", "counts", "prints"],
    )


def unpack(row: dict, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int32)
    return np.repeat(ids, counts), np.frombuffer(row["prints"], np.uint64 if wide else np.uint32)


def per_document(ids: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """One row per document with all its fingerprints."""
    order = np.argsort(ids, kind="stable")
    ids, prints = ids[order], prints[order]
    new = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
    ends = np.r_[new[1:], len(ids)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[new], pa.int64()), pa.array([prints[a:b].tobytes() for a, b in zip(new, ends, strict=True)], pa.binary())], ["_id", "prints"]
    )


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of cells dealt out by document and sorted by part."""
    part, held = None, []

    def close():
        if held:
            yield per_document(*(np.concatenate(x) for x in zip(*held, strict=True)))

    for b in batches:
        for row in b.to_pylist():
            if row["part"] != part:
                yield from close()
                part, held = row["part"], []
            held.append(unpack(row, True))
    yield from close()
