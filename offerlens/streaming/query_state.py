"""Status per query key as streaming state, with late rows.

The state of a key is one row: the fields of ``operators.runs.query_states``, and the failures that the watermark has not passed
yet. A late success closes the failures before it only, so those have to be told apart; once the watermark has passed them no
success can come before them, and a number stands for them. An event-time timeout does this folding for keys that are quiet, so
the state of a key is bounded by its failures within the delay.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = """query_key string, status string, last_run_at string, last_success_at string, last_error_at string, failures long, last_error string"""
#: latest: (ts, seq, event); success: (ts, seq); folded: [number, (ts, seq, error) of the last]; open: (ts, seq, error, event time in ms).
STATE = "state string"
NEW = {"latest": None, "run": None, "success": None, "error": None, "folded": [0, None], "open": []}


def _later(a, b):
    return b if a is None or (b is not None and tuple(b[:2]) > tuple(a[:2])) else a


def _take(state: dict, ts: str, seq: int, event: str, error: str | None, at: int) -> None:
    state["latest"] = _later(state["latest"], [ts, seq, event])
    if event == "RUNNING":
        state["run"] = max(filter(None, (state["run"], ts)))
    elif event == "ERROR":
        state["error"] = max(filter(None, (state["error"], ts)))
        if state["success"] is None or (ts, seq) > tuple(state["success"]):
            state["open"].append([ts, seq, error, at])
    elif event == "SUCCESS":
        state["success"] = _later(state["success"], [ts, seq])
        done = tuple(state["success"])
        state["open"] = [e for e in state["open"] if tuple(e[:2]) > done]
        last = state["folded"][1]
        if last is not None and tuple(last[:2]) < done:
            state["folded"] = [0, None]


def _fold(state: dict, watermark: int) -> None:
    """Count the failures that no later row can close any more."""
    for e in sorted(e for e in state["open"] if e[3] < watermark):
        state["folded"] = [state["folded"][0] + 1, _later(state["folded"][1], e[:3])]
    state["open"] = [e for e in state["open"] if e[3] >= watermark]


def _row(key: str, state: dict) -> dict:
    last = None
    for e in [state["folded"][1], *state["open"]]:
        last = _later(last, e)
    return {"query_key": key, "status": state["latest"][2], "last_run_at": state["run"], "last_success_at": state["success"] and state["success"][0],
            "last_error_at": state["error"], "failures": state["folded"][0] + len(state["open"]), "last_error": last[2] if last else None}


def _update(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
    state = json.loads(held.get[0]) if held.exists else json.loads(json.dumps(NEW))
    arrived = False
    for rows in batches:
        for r in rows.itertuples(index=False):
            arrived = True
            _take(state, r.ts, int(r.seq), r.event, None if pd.isna(r.error) else r.error, int(r.event_time.timestamp() * 1000))
    watermark = held.getCurrentWatermarkMs()
    _fold(state, watermark)
    held.update((json.dumps(state),))
    if state["open"]:
        held.setTimeoutTimestamp(max(max(e[3] for e in state["open"]), watermark) + 1)
    if arrived:
        yield pd.DataFrame([_row(key[0], state)])


def status_stream(events: DataFrame, delay: str) -> DataFrame:
    """The changed states of each micro-batch, to be merged by query_key.

    ``events``: query_key string, event_time timestamp, ts string, seq long, event (RUNNING, SUCCESS, ERROR) and error. ts and
    event_time order alike. Rows later than ``delay`` are dropped by the watermark.
    """
    rows = events.select("query_key", "event_time", "ts", "seq", "event", "error").withWatermark("event_time", delay)
    return rows.groupBy("query_key").applyInPandasWithState(_update, OUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)
