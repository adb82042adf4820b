"""Health of sources as a stream of checks: failures in a row, reset by a success."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DISABLE_AFTER = 8
OUTPUT = "source string, checks long, open_failures long, status string, last_check timestamp, last_success timestamp"
STATE = "checks long, open_failures long, last_check timestamp, last_success timestamp"


def health_status(open_failures: int, rejected: bool = False) -> str:
    if rejected:
        return "Rejected"
    return "Inactive" if open_failures >= DISABLE_AFTER else "Warning" if open_failures else "Active"


def _advance(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    checks, failures, last, success = state.get if state.exists else (0, 0, None, None)
    rows = pd.concat(list(batches)).sort_values("ts", kind="stable", ignore_index=True)
    good = rows.index[rows["ok"].to_numpy(bool)]
    checks, last = checks + len(rows), rows["ts"].iloc[-1].to_pydatetime()
    if len(good):
        success, failures = rows["ts"].iloc[good[-1]].to_pydatetime(), len(rows) - 1 - int(good[-1])
    else:
        failures += len(rows)
    state.update((checks, failures, last, success))
    yield pd.DataFrame({"source": [key[0]], "checks": [checks], "open_failures": [failures], "status": [health_status(failures)], "last_check": pd.to_datetime([last]), "last_success": pd.to_datetime([success])})


def source_health(checks: DataFrame) -> DataFrame:
    """The state of each source after each batch. ``checks``: (source string, ts timestamp, ok boolean).

    A batch's rows of one source are brought into order of time; the state of a source is four numbers.
    """
    return checks.groupBy("source").applyInPandasWithState(_advance, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
