"""Broadcasts that can be taken back.

A lazy result may need its broadcasts until it has been written, so operators leave them alone. Whoever writes the result
records what was sent meanwhile and destroys it afterwards; else each run leaves some megabytes with the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark import Broadcast, SparkContext

_recorders: list[list[Broadcast]] = []


def send(context: SparkContext, value: Any) -> Broadcast:
    """A broadcast, noted by all recorders."""
    sent = context.broadcast(value)
    for recorder in _recorders:
        recorder.append(sent)
    return sent


@contextmanager
def recording(into: list[Broadcast]) -> Iterator[None]:
    _recorders.append(into)
    try:
        yield
    finally:
        _recorders.pop()


def destroy(sent: list[Broadcast]) -> None:
    """Takes back what was recorded; the results that needed it must have been written."""
    while sent:
        sent.pop().destroy()
