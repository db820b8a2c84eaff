"""Previous value and gap per key on a stream.

Plain ``lag`` is not available on streams, and rows of one key may come in any
order within the watermark's delay. Each key keeps the rows that the watermark
has not passed; what it passes is final, so it is put in order and emitted, and
only the newest of it stays as the previous row of what follows. The result is
the same however the input is split into files and batches; rows older than the
watermark are late and are dropped, as by any windowed operator. Rows without
a time come last, so they wait for the end of the stream (``runner.run_closed``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foldwright.streaming.runner import END_US

#: stands for no time: after all times, before the end of the stream
_NEVER = END_US - 10**18
_DAY_US = 86_400_000_000
_DAY_MS = 86_400_000


def reorder(key_name: str, expire_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The state function: buffer, emit what the watermark has passed, wait for the next row or the expiry."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        us, ids, values, last_us, last_value = state.get if state.exists else ([], [], [], None, None)
        us, ids, values = ([np.asarray(x)] if len(x) else [] for x in (us, ids, values))
        for batch in batches:
            us.append(batch["us"].to_numpy(np.int64))
            ids.append(batch["id"].to_numpy())
            values.append(batch["value"].to_numpy(np.float64, na_value=np.nan))
        mark = state.getCurrentWatermarkMs()
        empty = not us
        us = np.concatenate(us).astype(np.int64) if not empty else np.zeros(0, np.int64)
        ids = np.concatenate(ids) if not empty else np.zeros(0, object)
        values = np.concatenate(values).astype(np.float64) if not empty else np.zeros(0)
        done = us // 1000 < mark
        if done.any():
            out = pd.DataFrame({"us": us[done], "id": ids[done], "value": values[done]}).sort_values(["us", "id"], kind="stable")
            now = out["us"].astype("Int64").mask(out["us"] == _NEVER)
            before = pd.Series([last_us, *now.iloc[:-1]], dtype="Int64").set_axis(out.index)
            previous = pd.Series([np.nan if last_value is None else last_value, *out["value"].iloc[:-1]], dtype="float64").set_axis(out.index)
            last_us, last_value = int(out["us"].iloc[-1]), float(out["value"].iloc[-1])
            yield pd.DataFrame(
                {
                    key_name: [key[0]] * len(out),
                    "id": out["id"],
                    "previous": previous.where(previous.notna(), None),
                    "days_since": (now - before) // _DAY_US,
                }
            )
        us, ids, values = us[~done], ids[~done], values[~done]
        if not len(us) and state.hasTimedOut and not done.any():
            state.remove()
            return
        kept = None if last_value is None or np.isnan(last_value) else last_value
        state.update((us.tolist(), ids.tolist(), values.tolist(), last_us, kept))
        wake = int(us.min()) // 1000 if len(us) else last_us // 1000 + expire_ms
        state.setTimeoutTimestamp(max(wake, mark + 1))

    return run


def previous_stream(
    stream: DataFrame, key: str, time: str, id_col: str, value: str, delay: str = "1 hour", expire_days: int = 30
) -> DataFrame:
    """``(key, id, previous, days_since)`` per event in the order of ``(time, id)``, once the watermark has passed it.

    A key without rows for ``expire_days`` is forgotten. Rows without a time
    follow all others of their key, by id, without a gap.
    """
    # names the time, so the row that ends the stream is dropped behind the watermark and not before it
    rows = stream.withWatermark(time, delay).filter(F.col(time).isNull() | (F.col(time) < F.timestamp_micros(F.lit(END_US))))
    us = F.coalesce(F.unix_micros(time), F.lit(_NEVER))
    rows = rows.select(key, time, us.alias("us"), F.col(id_col).alias("id"), F.col(value).cast("double").alias("value"))
    kind = dict(stream.dtypes)
    return rows.groupBy(key).applyInPandasWithState(
        reorder(key, expire_days * _DAY_MS),
        f"{key} {kind[key]}, id {kind[id_col]}, previous double, days_since long",
        f"us array<long>, id array<{kind[id_col]}>, value array<double>, last_us long, last_value double",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
