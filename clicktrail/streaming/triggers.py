"""When a streaming query fires."""

from __future__ import annotations

from pyspark.sql.streaming.readwriter import DataStreamWriter

#: ``None``: back to back; ``"available now"``: what is there, then stop;
#: otherwise a processing-time interval such as ``"5 seconds"``.
Trigger = str | None

AVAILABLE_NOW = "available now"
ROLLUP_TRIGGER = "5 seconds"


def with_trigger(writer: DataStreamWriter, trigger: Trigger) -> DataStreamWriter:
    if trigger is None:
        return writer
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)
