"""Live trips with keyed state: pings kept by time slot, settled by event-time timers.

Vehicles are dealt into groups. The state of a group and day is a map with the pings that wait, in
pieces, and a row with the last status and an open start of every vehicle seen. What a micro-batch
brings to a group is a piece for each hour, stored under its first time slot; a piece is written
again only to leave out slots that were settled. So the bytes of pings written follow the new pings
and not all that wait, and the calls to the state store follow groups and hours and not pings. A timer
at each slot's end settles the slot once the watermark has passed it; a last one at the day's end
forgets the vehicles. A ping sent again falls into the slot of the first and is dropped there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import AbstractContextManager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tripweave.params import DEFAULTS, Params
from tripweave.session import settings
from tripweave.streaming.live import ASSEMBLED, HELD, TAIL, by_vehicle_group, packed, replay, valid

#: Seconds of a time slot: pings settle at most this much later than the watermark allows.
SLOT_S = 300
#: Slots of a piece at most.
PIECE_SLOTS = 12
#: Timers and map state need a store that reads and writes single keys.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_PIECE = StructType([StructField("slot", LongType()), StructField("part", LongType())])
_ROWS = StructType([StructField("rows", BinaryType())])


def _day_end_us(day: dt.date) -> int:
    return int((dt.datetime.combine(day, dt.time(), dt.timezone.utc) + dt.timedelta(days=1)).timestamp()) * 1_000_000


class TripAssembler(StatefulProcessor):
    """Trips of one group of vehicles and day."""

    def __init__(self, slot_s: int = SLOT_S):
        self.slot_us = slot_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", _PIECE, _ROWS)
        self.tails = handle.getValueState("tails", _ROWS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        pings = np.concatenate([packed(pdf) for pdf in rows])
        waiting = [tuple(k) for k in self.pending.keys()]
        part = max((part for _, part in waiting), default=-1) + 1
        pieces = pings["us"] // (self.slot_us * PIECE_SLOTS)
        order = np.argsort(pieces, kind="stable")
        begins = np.unique(pieces[order], return_index=True)[1]
        first = min(self._hold(own, part) for own in np.split(pings[order], begins[1:]))
        if not waiting or first < min(waiting)[0]:  # one timer is set at most for what waits: the end of its first slot
            self.handle.registerTimer(self._end_ms(first))
        return iter(())  # trips come with the timers

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        timer_ms = expiredTimerInfo.getExpiryTimeInMs()
        # the watermark told here may be that of the batch before, which is behind the timer
        passed_ms = max(timer_ms, timerValues.getCurrentWatermarkInMs())
        border_us = passed_ms * 1000 // self.slot_us * self.slot_us  # slots before it are due
        waiting = {tuple(k) for k in self.pending.keys()}
        due = {k for k in waiting if k[0] * self.slot_us < border_us}
        held = self.tails.get()
        tails = np.frombuffer(b"" if held is None else held[0], TAIL)
        later = [slot for slot, _ in waiting - due]
        trips = None
        if due:
            if due == waiting:
                stored = {tuple(k): v[0] for k, v in self.pending.iterator()}
                self.pending.clear()
            else:
                stored = {k: self.pending.getValue(k)[0] for k in due}
                for k in due:
                    self.pending.removeKey(k)
            pieces = {k: np.frombuffer(rows, HELD) for k, rows in stored.items()}
            for (_, part), piece in pieces.items():
                if (piece["us"] >= border_us).any():
                    later.append(self._hold(piece[piece["us"] >= border_us], part))
            pings = np.concatenate([pieces[k] for k in sorted(pieces, key=lambda k: k[1])])
            trips, tails = replay(self._once(pings[pings["us"] < border_us]), tails, key[1])
        day_end_ms = _day_end_us(key[1]) // 1000
        if passed_ms >= day_end_ms and not later:
            self.tails.clear()
        elif due:
            self.tails.update((tails.tobytes(),))
            if held is None:
                self.handle.registerTimer(day_end_ms)
        if later:
            self.handle.registerTimer(self._end_ms(min(later)))
        if trips is not None and len(trips):
            yield trips

    def _end_ms(self, slot: int) -> int:
        return (slot + 1) * self.slot_us // 1000

    def _hold(self, piece: np.ndarray, part: int) -> int:
        """Stores pings of one part under their first slot."""
        first = int(piece["us"].min()) // self.slot_us
        self.pending.updateValue((first, part), (piece.tobytes(),))
        return first

    def _once(self, pings: np.ndarray) -> np.ndarray:
        """Of pings under one number in a vehicle's slot, the one that came first."""
        names = pings["vehicle_id"], pings["us"] // self.slot_us, pings["seq"]
        order = np.lexsort(names[::-1])
        new = np.ones(len(pings), bool)
        new[1:] = np.logical_or.reduce([np.diff(n[order]) != 0 for n in names])
        return pings[order[new]]

    def close(self) -> None:
        pass


def state_store(spark: SparkSession) -> AbstractContextManager[None]:
    """Settings under which a stream with :func:`assemble_keyed` must be started."""
    return settings(spark, STATE_STORE)


def assemble_keyed(pings: DataFrame, p: Params = DEFAULTS, slot_s: int = SLOT_S) -> DataFrame:
    """Watermarked stream of pings, repeats among them, to a stream of valid trips with s_ts and e_ts.

    The same trips as :func:`tripweave.streaming.live.assemble`, each at most a slot later. Start
    it inside :func:`state_store`. Days are those of UTC.
    """
    raw = by_vehicle_group(pings, p).transformWithStateInPandas(
        TripAssembler(slot_s), ASSEMBLED, "append", "eventtime"
    )
    return valid(raw, p)
