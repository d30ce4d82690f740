"""Variants of the test tables: empty, with nulls in every column and repeated rows, with extra columns whose names clash."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

CLASHING = "id parent root depth path hops ptr low cycle cycle_key pos values kind key side bit range month at value attribute valid_from valid_to entity employee found reason known missing events status count tokens weight piece capacity epochs rest budget score label window n level node".split()


def variant(src: Path, dst: Path, how: str) -> str:
    dst.mkdir(parents=True, exist_ok=True)
    for p in src.glob("*.parquet"):
        t = pq.read_table(p)
        if how == "empty":
            t = t.slice(0, 0)
        elif how == "nulls" and p.stem not in ("nation", "region", "container_sizes"):
            rows = [t, t.slice(0, 25)]
            for i, c in enumerate(t.column_names):  # in turn one column null in some rows
                part = t.slice(i * 3, 3)
                if len(part) and not (p.stem == "documents" and c == "doc_id"):
                    rows.append(part.set_column(i, t.schema.field(c).with_nullable(True), pa.nulls(len(part), t.schema.field(c).type)))
            rows.append(pa.table([pa.nulls(2, f.type) for f in t.schema], schema=pa.schema([f.with_nullable(True) for f in t.schema])))
            schema = pa.schema([f.with_nullable(True) for f in t.schema])
            t = pa.concat_tables([r.cast(schema) for r in rows])
        elif how == "extra":
            for c in CLASHING:
                if c not in t.column_names:
                    t = t.append_column(c, pa.array(["x"] * len(t)))
        pq.write_table(t, dst / p.name)
    return str(dst)
