"""Statistics of every user in Spark's keyed state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.features import FLAT_STATS, flat_merger, row_stats

_STATE = ", ".join(f"{c} {kind}" for c, kind in FLAT_STATS.items())
#: A user's statistics after a micro-batch and before it, and the calendar days of its rows.
CHANGED_SCHEMA = (
    f"user_id long, {_STATE}, known boolean, "
    + ", ".join(f"old_{c} {kind}" for c, kind in FLAT_STATS.items())
    + ", days array<int>"
)


def _processor() -> StatefulProcessor:
    """Merges the rows of a user into one state value, and reports it with the one before.

    Spark also starts the processor in a worker on the driver, which does not know this
    package; a class from inside a function travels whole.
    """
    state, names, merge = _STATE, list(FLAT_STATS), flat_merger()

    class UserStats(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.stats = handle.getValueState("stats", state)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            old = tuple(self.stats.get()) if self.stats.exists() else None
            new = list(old) if old else [None] * len(names)
            days, places = set(), None
            for row in rows:
                if places is None:
                    places = [row.__fields__.index(c) for c in names]
                merge(new, [row[i] for i in places])
                days.add(row["day"])
            self.stats.update(tuple(new))
            yield Row(
                user_id=key[0],
                **dict(zip(names, new)),
                known=old is not None,
                **{f"old_{c}": v for c, v in zip(names, old or [None] * len(names))},
                days=sorted(days - {None}),
            )

        def close(self) -> None:
            pass

    return UserStats()


def changed_users(activity: DataFrame) -> DataFrame:
    """Of a stream of activity rows, the users that each micro-batch changes.

    A batch reads and writes the state of its own users and of no others.
    """
    rows = row_stats(activity.where("user_id IS NOT NULL"))
    return rows.groupBy("user_id").transformWithState(
        _processor(), CHANGED_SCHEMA, outputMode="Update", timeMode="None"
    )
