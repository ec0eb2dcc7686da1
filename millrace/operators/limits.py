"""How many calls may be open, and how often one may begin: one gate per task.

A limit over all tasks is dealt out: with a fixed number of calling tasks each has its
share, and the shares never add up to more than the limit. No service is needed for it.
"""

from __future__ import annotations

import threading
import time


def share(total: float, tasks: int, index: int, whole: bool = True) -> float:
    """Task ``index``'s part of ``total``; whole parts differ by one at most and add up to ``total``."""
    if not whole:
        return total / tasks
    return int(total) // tasks + (index % tasks < int(total) % tasks)


class Gate:
    """Permits for open calls, and a pace at which calls begin.

    A permit is held until its call has really ended, also when nobody waits for the call
    any more, so open calls never exceed ``most``. With ``adaptive`` a failed call halves
    the permits in use (one stays) and each good one gives a part of a permit back.
    """

    def __init__(self, most: int, per_minute: float | None = None, adaptive: bool = False):
        self.most, self.adaptive = most, adaptive
        self.pause = 60.0 / per_minute if per_minute else 0.0
        self.allowed, self.open, self.next_begin = float(most), 0, 0.0
        self.changed = threading.Condition()

    def enter(self, patience: float | None = None) -> bool:
        """Wait for a permit, then for the call's turn; False if no permit came free within ``patience`` seconds."""
        with self.changed:
            if not self.changed.wait_for(lambda: self.open < max(1, int(self.allowed)), patience):
                return False
            self.open += 1
            now = time.monotonic()
            begin = max(now, self.next_begin)
            self.next_begin = begin + self.pause
        if begin > now:
            time.sleep(begin - now)
        return True

    def leave(self) -> None:
        """The call has ended."""
        with self.changed:
            self.open -= 1
            self.changed.notify_all()

    def report(self, good: bool) -> None:
        """What the caller made of the call."""
        if self.adaptive:
            with self.changed:
                self.allowed = min(self.most, self.allowed + 1 / self.allowed) if good else max(1.0, self.allowed / 2)
                self.changed.notify_all()
