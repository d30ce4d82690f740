"""All queries outside the llm subpackage, and their SQL."""

from __future__ import annotations

from starloom.plans import feeds, health, marts, model, problems, streams, warehouse

_PARTS = (problems, marts, model, feeds, health, streams, warehouse)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: text for part in _PARTS for name, text in part.SQL.items()}
SQL |= {name: SQL["p2_found"] for name in ("stream_envelope_apply", "stream_replay_idempotent")}
