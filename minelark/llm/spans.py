"""Spans found in texts, written as kind:start:end in code points."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

Span = tuple[str, int, int]


def joined(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    """Spans by start, then by kind as listed, comma-joined."""
    rank = {kind: k for k, kind in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2])))


def digest(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    return hashlib.sha256(joined(spans, kinds).encode()).hexdigest()


def span_digests(spans: Column, base_kinds: tuple[str, ...], kinds: tuple[str, ...]) -> Column:
    """``base_sha256`` and ``spans`` of an array of spans with ``base``, ``kind``, ``start`` and ``end``."""

    @arrow_udf("struct<base_sha256:string,spans:string>")
    def digests(column: pa.Array) -> pa.Array:
        out = []
        for row in column.to_pylist():
            every = [(s["kind"], s["start"], s["end"]) for s in row]
            base = [span for span, s in zip(every, row) if s["base"]]
            out.append({"base_sha256": digest(base, base_kinds), "spans": joined(every, kinds)})
        return pa.array(out, pa.struct([("base_sha256", pa.string()), ("spans", pa.string())]))

    return digests(spans)
